"""Row cleaning: negatives, outliers, overrides, duplicates, null handling, type coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import non_negative
from .blocks import BLOCK, names, in_blocks, with_keyless, with_moments

OUTLIER_STD = 10.0


def null_negatives(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumn(value, non_negative(value))


def outlier(value, mean, std, k: float = OUTLIER_STD) -> Column:
    """Strictly outside mean ± k·std; false where the deviation is missing."""
    v, m, s = F.col(value), F.col(mean), F.col(std)
    return F.coalesce((v > m + k * s) | (v < m - k * s), F.lit(False))


def null_outliers(df: DataFrame, key="station", value: str = "value", time: str = "time", k: float = OUTLIER_STD,
                  low_only: bool = False, block: int = BLOCK) -> DataFrame:
    """Blank values beyond k deviations of their own series. Rows without a time take part; rows without a series stay as they are."""
    cols = df.columns
    bad = F.coalesce(F.col(value) < F.col("_s_mean") - k * F.col("_s_std"), F.lit(False)) if low_only else outlier(
        value, "_s_mean", "_s_std", k)

    def blank(part: DataFrame) -> DataFrame:
        rows = with_moments(in_blocks(part, key, time, block), key, value, prefix="_s_")
        return rows.withColumn(value, F.when(~bad, F.col(value))).select(*cols)

    return with_keyless(df, key, blank)


def flag_implausible(df: DataFrame, key="station", value: str = "value", time: str = "time", k: float = OUTLIER_STD,
                     block: int = BLOCK) -> DataFrame:
    """Flag values above mean + k·std or below zero; the moments include the negatives. Rows without a time take part; rows
    without a series have no moments, and a NULL flag."""
    flag = (F.col(value) > F.col("_s_mean") + k * F.col("_s_std")) | (F.col(value) < 0)

    def flagged(part: DataFrame) -> DataFrame:
        rows = with_moments(in_blocks(part, key, time, block), key, value, prefix="_s_")
        return rows.withColumn("implausible", F.coalesce(flag, F.lit(False))).select(*df.columns, "implausible")

    return with_keyless(df, key, flagged)


def blank_implausible(df: DataFrame, key="station", value: str = "value", time: str = "time", k: float = OUTLIER_STD,
                      block: int = BLOCK) -> DataFrame:
    """Blank the values that ``flag_implausible`` marks; every row stays."""
    rows = flag_implausible(df, key, value, time, k, block)
    return rows.withColumn(value, F.when(~F.coalesce("implausible", F.lit(False)), F.col(value))).drop("implausible")


def implausible_report(df: DataFrame, key="station", value: str = "value", k: float = OUTLIER_STD) -> DataFrame:
    flagged = flag_implausible(df, key, value, k=k)
    return flagged.groupBy(*names(key)).agg(
        F.count_if("implausible").alias("n_implausible"),
        (F.count_if("implausible") * 100.0 / F.count(F.lit(1))).alias("pct_implausible"),
    )


def in_range(value, low: float, high: float) -> Column:
    return F.coalesce(F.col(value).between(low, high), F.lit(False))


def override_points(df: DataFrame, corrections: DataFrame, key="station", time: str = "time",
                    value: str = "value") -> DataFrame:
    """Blank the readings named by a corrections table (key, time)."""
    marks = corrections.select(*names(key), time).distinct().withColumn("_bad", F.lit(True))
    return (
        df.join(marks, [*names(key), time], "left")
        .withColumn(value, F.when(F.col("_bad").isNull(), F.col(value))).drop("_bad")
    )


def keep_first(df: DataFrame, key, tie) -> DataFrame:
    """First row per key in the declared order ``tie``; a NULL tie comes last. The row is kept whole.

    An aggregate rather than a ranked window: copies collapse on the map side, so a key repeated a
    billion times costs one row per task.
    """
    keys, ties = names(key), names(tie)
    order = F.struct(*[x for i, t in enumerate(ties) for x in (F.col(t).isNull().alias(f"n{i}"), F.col(t).alias(f"t{i}"))])
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])


def with_copies(df: DataFrame, key, tie: str, salts: int = 1024) -> DataFrame:
    """Attach ``copies`` (rows sharing the key) and ``first_tie`` (smallest tie among them).

    Counted per (key, salt) and joined back on the same pair, so copies of one key never meet in one
    task. Only pairs that occur have a row, so the salt costs nothing where copies are few.
    """
    keys = names(key)
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(salts)))
    per_key = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"), F.min(tie).alias("_t")).select(
        *keys, "_salt", F.sum("_n").over(per_key).alias("copies"), F.min("_t").over(per_key).alias("first_tie")
    )
    return rows.join(counts, [*keys, "_salt"]).drop("_salt")


def duplicates(df: DataFrame, key, tie: str, later_only: bool = False) -> DataFrame:
    """Members of duplicate groups: all of them, or only those after the first."""
    marked = with_copies(df, key, tie).filter("copies > 1")
    if later_only:
        marked = marked.filter(F.col(tie) != F.col("first_tie"))
    return marked.select(*df.columns)


def null_shares(df: DataFrame, key=(), cols=None) -> DataFrame:
    """Long table (key, column, n_null, pct_null) from one aggregate over all columns."""
    keys = names(key)
    cols = [c for c in (cols or df.columns) if c not in keys]
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in cols]))
    return wide.select(*keys, "_n", long.alias("_x")).select(
        *keys, "_x.column", "_x.n_null", F.try_divide(F.col("_x.n_null") * F.lit(100.0), F.col("_n").cast("double")).alias("pct_null")
    )


def drop_sparse_columns(df: DataFrame, max_null_share: float) -> DataFrame:
    """Drop columns whose share of NULLs exceeds the bound. Runs one aggregate over ``df``."""
    shares = null_shares(df).filter(F.col("pct_null") > max_null_share * 100).select("column")
    return df.drop(*[r["column"] for r in shares.collect()])  # one row per column at most


def clean_step_one(df: DataFrame, key="station", value: str = "value", time: str = "time") -> DataFrame:
    """Negatives and outliers to NULL."""
    return null_outliers(null_negatives(df, value), key, value, time)
