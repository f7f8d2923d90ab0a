"""Joins of gauges, weather and station tables. No hint forces a broadcast: the planner uses measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import col
from ..functions.text import normal_name
from .blocks import names, with_keyless


def on_time(left: DataFrame, right: DataFrame, time: str = "time", suffix: str = "_right") -> DataFrame:
    """Every left row with every right row of the same instant; clashing right names get the suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c != time}
    return left.join(right.withColumnsRenamed(clash), time)


def on_series_time(left: DataFrame, right: DataFrame, key="station", time: str = "time") -> DataFrame:
    return left.join(right, [*names(key), time])


def outer_two_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Full outer join that keeps both key columns."""
    return left.join(right, left[left_on] == right[right_on], "full_outer")


def with_dimension(df: DataFrame, dim: DataFrame, left_id: str, right_id: str, how: str = "inner") -> DataFrame:
    """Attach a station table by id compared as text."""
    right = dim.withColumn("_id", F.col(right_id).cast("string"))
    return df.withColumn("_id", F.col(left_id).cast("string")).join(right, "_id", how).drop("_id")


def containing_names(ids: DataFrame, files: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """First file (by name) whose name contains the id as a substring, per id.

    Every substring of a name is listed once and matched by equality, which replaces a comparison of
    all pairs. ``36`` also meets ``361``; use an equality join where ids must match exactly.
    """
    lengths = F.sequence(F.lit(1), F.length(name_col))
    parts = (
        files.select(name_col).distinct()
        .select(name_col, F.explode(lengths).alias("_from"))
        .select(name_col, F.explode(F.expr(f"transform(sequence(_from, length({name_col})), e -> substring({name_col}, _from, e - _from + 1))")).alias("_part"))
    )
    wanted = ids.select(F.col(id_col).cast("string").alias("_part")).distinct()
    # one row per substring before the join, so a substring of most names is no hot key
    first = parts.groupBy("_part").agg(F.min(name_col).alias(name_col)).join(wanted, "_part", "left_semi")
    return ids.join(first, ids[id_col].cast("string") == first["_part"]).drop("_part")


def station_ids(names_df: DataFrame, stations: DataFrame, name_col: str = "name", id_col: str = "station_id") -> DataFrame:
    """Station id for each name, compared in normal form; unknown names keep NULL."""
    dim = stations.groupBy(normal_name(name_col).alias("_norm")).agg(F.min(id_col).alias(id_col))
    return names_df.withColumn("_norm", normal_name(name_col)).join(dim, "_norm", "left").drop("_norm")


def keep_listed(df: DataFrame, listed: DataFrame, key) -> DataFrame:
    return df.join(listed.select(*names(key)), names(key), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, key) -> DataFrame:
    """Rows whose key is not in the list; also the resumable load: work minus what has landed."""
    return df.join(listed.select(*names(key)), names(key), "left_anti")


def side_by_side(left: DataFrame, right: DataFrame, key, suffixes=("_a", "_b")) -> DataFrame:
    """Two summary tables in one row per key."""
    keys = names(key)

    def tagged(df, s):
        return df.withColumnsRenamed({c: c + s for c in df.columns if c not in keys})

    return tagged(left, suffixes[0]).join(tagged(right, suffixes[1]), keys)


def lookup_mean(df: DataFrame, value: str, **parts) -> DataFrame:
    """Attach ``part_mean``, the group mean over calendar parts, summed per day first.

    The means come back on (parts, day), so rows of one hot part are spread over days. Rows without a time or a part have no mean.
    """

    def placed(part: DataFrame) -> DataFrame:
        partial = part.groupBy(*parts, "_day").agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
        means = partial.groupBy(*parts).agg((F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))).alias("part_mean"))
        spread = partial.select(*parts, "_day").join(means, list(parts))
        return part.join(spread, [*parts, "_day"])

    rows = df.withColumns({n: col(c) for n, c in parts.items()}).withColumn("_day", F.to_date("time"))
    return with_keyless(rows, [*parts, "_day"], placed).drop("_day")
