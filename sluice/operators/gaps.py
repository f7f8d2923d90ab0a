"""Gap, duplicate and completeness accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_between, midnight
from ..functions.numeric import percent
from .blocks import BLK, BLOCK, DAY, HOUR, epoch_micros, from_micros, names, in_blocks, with_previous
from .grid import QUARTER_HOUR, one_per_time


def _phases(readings: DataFrame, keys: list[str], known: dict[str, Column], time: str, step: int) -> DataFrame:
    """(keys, n_expected, columns of ``known``): slots of the anchored grid, and how many of them hold what is counted.

    Readings are counted by their offset within a step, a combined count; the offset of a series' first reading is
    that of its grid. So no slot is laid out and no reading is moved, and a wrong timestamp costs nothing.
    """
    step_us = step * 1_000_000
    us = epoch_micros(time)
    phases = readings.groupBy(*keys, F.pmod(us, F.lit(step_us)).alias("_phase")).agg(
        F.min(us).alias("_first"), F.max(us).alias("_last"), *[F.count_if(c).alias(n) for n, c in known.items()])
    out = phases.groupBy(*keys).agg(
        (F.floor((F.max("_last") - F.min("_first")) / F.lit(step_us)) + 1).alias("n_expected"),
        F.min_by(F.struct(*known), "_first").alias("_at"))
    return out.select(*keys, "n_expected", *[F.col(f"_at.{n}").alias(n) for n in known])


def _placed(df: DataFrame, keys: list[str], value: str, time: str, step: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The known readings on the anchored grid, in blocks, with their ``_slot`` and the series' ``_first`` time and number of slots
    ``_n``; and the last two per series. Extremes come back by block, so a hot series stays spread."""
    us, step_us = epoch_micros(time), F.lit(step * 1_000_000)
    readings = in_blocks(one_per_time(_keyed(df, keys, time), keys, value, time), keys, time, block)
    edges = readings.groupBy(*keys, BLK).agg(F.min(us).alias("_first"), F.max(us).alias("_last"))
    whole = Window.partitionBy(*keys)
    edges = edges.select(*keys, BLK, F.min("_first").over(whole).alias("_first"), F.max("_last").over(whole).alias("_last"))
    n = F.floor((F.col("_last") - F.col("_first")) / step_us) + 1
    rows = readings.join(edges.select(*keys, BLK, "_first", n.alias("_n")), [*keys, BLK])
    rows = rows.filter(((us - F.col("_first")) % step_us == 0) & F.col(value).isNotNull())
    return rows.withColumn("_slot", F.floor((us - F.col("_first")) / step_us)), edges.select(*keys, "_first", n.alias("_n")).distinct()


def _keyed(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    for c in (*keys, time):
        df = df.filter(F.col(c).isNotNull())
    return df


def missing_slots(df: DataFrame, key="station", values="value", time: str = "time", step: int = QUARTER_HOUR) -> DataFrame:
    """Missing cells of the anchored grid, summed over all value columns, and their share of slots."""
    keys, values = names(key), names(values)
    readings = one_per_time(_keyed(df, keys, time), keys, values, time)
    counts = _phases(readings, keys, {f"_k{i}": F.col(v).isNotNull() for i, v in enumerate(values)}, time, step)
    known = reduce(lambda a, b: a + b, [F.col(f"_k{i}") for i in range(len(values))])
    return counts.select(*keys, "n_expected", (F.col("n_expected") * len(values) - known).alias("n_missing")).withColumn(
        "pct_missing", percent("n_missing", "n_expected"))


def missing_days(df: DataFrame, key="station", values="value", time: str = "time", rule: str = "midnight") -> DataFrame:
    """Days without a reading between the first and last day.

    ``midnight``: only a complete row at 00:00 counts as present. ``any``: any row of the day does.
    Days are first made distinct per series (a combined count), then counted.
    """
    keys = names(key)
    day = F.to_date(time)
    complete = F.lit(True)
    for v in names(values):
        complete = complete & F.col(v).isNotNull()
    present = ((F.col(time) == midnight(time)) & complete) if rule == "midnight" else F.lit(True)
    if rule not in ("midnight", "any"):
        raise ValueError("rule must be 'midnight' or 'any'")
    daily = df.groupBy(*keys, day.alias("_day")).agg(F.max(present).alias("_present"))
    return (
        daily.groupBy(*keys)
        .agg((F.datediff(F.max("_day"), F.min("_day")) + 1).cast("bigint").alias("n_days"),
             F.count_if("_present").alias("_have"))
        .withColumn("n_missing", F.col("n_days") - F.col("_have"))
        .withColumn("pct_missing", percent("n_missing", "n_days"))
        .drop("_have")
    )


def duplicate_stats(df: DataFrame, key="station", time: str = "time") -> DataFrame:
    """Rows in duplicate groups, rows after the first, and the latter's share."""
    keys = names(key)
    per_time = df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_time.groupBy(*keys)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("n_duplicate_rows"),
            F.sum(F.col("_n") - 1).alias("n_excess"),
        )
        .withColumn("pct_excess", percent("n_excess", "n_rows"))
    )


def missing_steps(df: DataFrame, key="station", time: str = "time", step: int = HOUR) -> DataFrame:
    """Steps of the range first..last (counted from the first time) that no row falls on."""
    keys = names(key)
    times = _keyed(df, keys, time).groupBy(*keys, time).agg(F.lit(1).alias("_here"))
    counts = _phases(times, keys, {"_k": F.lit(True)}, time, step)
    return counts.select(*keys, "n_expected", (F.col("n_expected") - F.col("_k")).alias("n_missing")).withColumn(
        "pct_missing", percent("n_missing", "n_expected"))


def missing_share(df: DataFrame, part, key="station", value: str = "value", time: str = "time",
                  step: int = QUARTER_HOUR, name: str = "part", cycle: str = "week", block: int = BLOCK) -> DataFrame:
    """Percent missing per calendar part; series without any gap are left out.

    Slots are counted in closed form. ``cycle="week"`` is for parts that follow from the weekday and the time of day: as many rows per series
    as slots in a week, each standing for every so-manieth slot. ``cycle="month"`` is for parts that follow from the
    month: one row per month of the series.
    """
    if cycle not in ("week", "month") or (cycle == "week" and 7 * DAY % step):
        raise ValueError("cycle is 'week' (of a whole number of steps) or 'month'")
    keys, step_us = names(key), step * 1_000_000
    rows, series = _placed(df, keys, value, time, step, block)
    if cycle == "week":
        turn = 7 * DAY // step
        some = series.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col("_n"), F.lit(turn)) - 1)))
        expected = some.select(*keys, from_micros(F.col("_first") + F.col("_slot") * step_us).alias(time),
                               (F.floor((F.col("_n") - 1 - F.col("_slot")) / turn) + 1).alias("_c"))
    else:
        start, end = from_micros(F.col("_first")), from_micros(F.col("_first") + (F.col("_n") - 1) * step_us)
        months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
        some = series.withColumn("_month", F.explode(months)).withColumn("_month", F.col("_month").cast("timestamp_ntz"))
        # slots before a time: the whole steps that begin before it
        before = lambda t: F.least(F.greatest(F.ceil((epoch_micros(t) - F.col("_first")) / F.lit(step_us)), F.lit(0)), F.col("_n"))
        after = (F.col("_month") + F.expr("interval 1 month"))
        expected = some.select(*keys, F.col("_month").alias(time), (before(after) - before(F.col("_month"))).alias("_c"))
    expected = expected.groupBy(*keys, part(F.col(time)).alias(name)).agg(F.sum("_c").alias("_n")).filter("_n > 0")
    known = rows.groupBy(*keys, part(F.col(time)).alias(name)).agg(F.count(F.lit(1)).alias("_k"))
    cells = expected.join(known, [*keys, name], "left").withColumn("_m", F.col("_n") - F.coalesce("_k", F.lit(0)))
    return (
        cells.withColumn("_all", F.sum("_m").over(Window.partitionBy(*keys)))
        .filter("_all > 0")
        .select(*keys, name, percent("_m", "_n").alias("pct_missing"))
    )


def monthly_missingness(df: DataFrame, key="station", value: str = "value", time: str = "time") -> DataFrame:
    """Unweighted mean over series of their monthly missing share."""
    per_series = df.groupBy(*names(key), F.month(time).alias("month")).agg(
        F.avg(F.col(value).isNull().cast("int")).alias("_share")
    )
    return per_series.groupBy("month").agg((F.avg("_share") * 100).alias("pct_missing"), F.count(F.lit(1)).alias("n_series"))


def missing_blocks(df: DataFrame, key="station", value: str = "value", time: str = "time", step: int = QUARTER_HOUR,
                   block: int = BLOCK) -> DataFrame:
    """Stretches of missing slots on the anchored grid; a single missing slot lasts 0 days.

    A stretch lies between a known reading and the one before it, found across block borders, or after a series' last one;
    its bounds follow from their slots, whatever its length.
    """
    keys = names(key)
    rows, series = _placed(df, keys, value, time, step, block)
    inner = with_previous(rows, keys, "_slot", "_slot", "_prior").select(
        *keys, "_first", (F.coalesce("_prior", F.lit(-1)) + 1).alias("_from"), (F.col("_slot") - 1).alias("_to"))
    ends = rows.groupBy(*keys).agg(F.max("_slot").alias("_slot"))
    tails = series.join(ends, keys, "left").select(
        *keys, "_first", (F.coalesce("_slot", F.lit(-1)) + 1).alias("_from"), (F.col("_n") - 1).alias("_to"))
    at = lambda slot: from_micros(F.col("_first") + F.col(slot) * (step * 1_000_000))
    return (
        inner.unionByName(tails).filter("_from <= _to")
        .select(*keys, at("_from").alias("start"), at("_to").alias("end"), (F.col("_to") - F.col("_from") + 1).alias("n_rows"))
        .withColumn("duration_days", days_between("start", "end"))
    )


def completeness(df: DataFrame, key="station", value: str = "value", time: str = "time", step: int = QUARTER_HOUR) -> DataFrame:
    """Known readings over the clock slots the series spans, without building the grid."""
    keys = names(key)
    us = F.lit(step * 1_000_000)
    t = F.unix_micros(F.col(time).cast("timestamp"))
    per_slot = df.groupBy(*keys, F.floor(t / us).alias("_slot")).agg(F.max(F.col(value).isNotNull()).alias("_known"))
    return (
        per_slot.groupBy(*keys)
        .agg((F.max("_slot") - F.min("_slot") + 1).alias("n_slots"), F.count_if("_known").alias("n_known"))
        .withColumn("pct_complete", percent("n_known", "n_slots"))
    )
