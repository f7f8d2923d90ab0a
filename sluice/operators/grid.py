"""Regular time grids and bucket aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLK, BLOCK, DAY, HOUR, attach, epoch_micros, from_micros, names, in_blocks, with_previous, with_row_number

QUARTER_HOUR = 900
#: More slots than this in one series is taken for a wrong timestamp.
MAX_SLOTS = 100_000_000
_CHUNK = 100_000


def spans(df: DataFrame, key, time: str = "time", **extra: Column) -> DataFrame:
    """First and last time of each series, plus any further aggregates."""
    return df.groupBy(*names(key)).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        *[c.alias(n) for n, c in extra.items()],
    )


def slots(series: DataFrame, key, step: int, anchored: bool = False, time: str = "time",
          max_slots: int = MAX_SLOTS) -> DataFrame:
    """All grid times of each series in ``spans`` form, with ``slot`` (0-based) and ``n_slots``.

    The clock grid counts steps from midnight of the first day; the anchored grid counts from the
    first reading. Chunks of slots are spread before they are expanded, so one long series does not
    expand in one task.
    """
    step_us = F.lit(step * 1_000_000)
    first, last = epoch_micros("first_time"), epoch_micros("last_time")
    day = F.floor(first / F.lit(DAY * 1_000_000)) * F.lit(DAY * 1_000_000)  # exact below 2^53 microseconds
    start = first if anchored else day + F.floor((first - day) / step_us) * step_us
    carried = [c for c in series.columns if c not in ("first_time", "last_time")]
    n = F.floor((last - start) / step_us) + 1
    return (
        series.filter(F.col("first_time").isNotNull())
        .select(*carried, F.coalesce(start, F.lit(0)).alias("_start"), n.alias("n_slots"))
        .withColumn(
            "n_slots",
            F.when(F.col("n_slots") > max_slots, F.raise_error(F.lit("grid longer than max_slots")).cast("bigint"))
            .otherwise(F.col("n_slots")),
        )
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_slots") - 1) / _CHUNK))))
        .repartition(*names(key), "_chunk")
        .withColumn(
            "slot",
            F.explode(F.sequence(
                F.col("_chunk") * _CHUNK, F.least(F.col("_chunk") * _CHUNK + (_CHUNK - 1), F.col("n_slots") - 1)
            )),
        )
        .withColumn(time, from_micros(F.col("_start") + F.col("slot") * step_us))
        .drop("_start", "_chunk")
    )


def one_per_time(df: DataFrame, key, values, time: str = "time") -> DataFrame:
    """Readings keyed by (key, time); a repeated time raises, as a label would be ambiguous."""
    checked = df.groupBy(*names(key), time).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.first(v).alias(v) for v in names(values)]
    )
    ok = F.when(F.col("_copies") > 1, F.raise_error(F.lit("duplicate times in a series: deduplicate first")).cast("boolean"))
    return checked.filter(F.coalesce(ok, F.lit(True))).drop("_copies")


def on_grid(df: DataFrame, key, step: int, values="value", anchored: bool = False, time: str = "time",
            unique: bool = False, max_slots: int = MAX_SLOTS, repeats: bool = False, block: int = BLOCK, **extra: Column) -> DataFrame:
    """Put each series on its grid; slots without a reading get NULL, off-grid readings are dropped.

    ``extra`` are per-series aggregates over all readings carried on every slot. ``unique=True``
    promises that (key, time) is already unique. ``repeats=True`` keeps every reading of a repeated time as a row of its
    own; ``slot`` then counts the rows of the series, the readings of one time in order of their values.
    """
    keys, values = names(key), names(values)
    # the join would filter these rows on its own side only, and the two sides could not share a shuffle
    for c in (*keys, time):
        df = df.filter(F.col(c).isNotNull())
    readings = df.select(*keys, time, *values) if unique or repeats else one_per_time(df, keys, values, time)
    grid = slots(spans(df, keys, time, **extra), keys, step, anchored, time, max_slots)
    rows = grid.join(readings, [*keys, time], "left")
    if not repeats:
        return rows
    numbered = with_row_number(in_blocks(rows, keys, time, block), keys, [time, *values])
    return numbered.withColumn("slot", F.col("rn") - 1).drop("rn", BLK)


def bucket(time, step: int) -> Column:
    """Start of the step-wide clock bucket."""
    us = F.lit(step * 1_000_000)
    return from_micros(F.floor(epoch_micros(time) / us) * us)


def bucket_mean(df: DataFrame, key, step: int, values="value", time: str = "time", agg=F.avg) -> DataFrame:
    """Mean per clock bucket; empty buckets inside the range are present with NULL."""
    keys, values = names(key), names(values)
    means = df.groupBy(*keys, bucket(time, step).alias(time)).agg(*[agg(v).alias(v) for v in values])
    grid = slots(spans(means, keys, time), keys, step, False, time)
    return grid.join(means, [*keys, time], "left")


def month_mean(df: DataFrame, key, values="value", time: str = "time") -> DataFrame:
    """Mean per month labelled by the last day of the month, months without readings included."""
    keys, values = names(key), names(values)
    means = df.groupBy(*keys, F.last_day(F.to_date(time)).alias(time)).agg(*[F.avg(v).alias(v) for v in values])
    months = spans(means, keys, time).select(
        *keys,
        F.explode(F.sequence(F.trunc("first_time", "month"), F.trunc("last_time", "month"), F.expr("interval 1 month")))
        .alias("_month"),
    ).select(*keys, F.last_day("_month").alias(time))
    return months.join(means, [*keys, time], "left")


def daily_at_midnight(df: DataFrame, key, values="value", time: str = "time") -> DataFrame:
    """One row per day holding the midnight reading only."""
    return on_grid(df, key, DAY, values, False, time)


def nearest_on_grid(df: DataFrame, key, step: int = HOUR, value: str = "value", time: str = "time",
                    block: int = 30 * DAY) -> DataFrame:
    """Nearest reading on either side of each clock slot, whether its value is known or not; a tie takes the later one.

    An as-of merge in both directions without a grid: each reading looks back at the one before it, across
    block borders, and lays out the slots in between; the nearer of the two gives a slot its value. Only the
    first reading lays out its own slot as well. Of equal times a known value wins. Rows without a time have no place and go.
    """
    keys, us = names(key), F.col("_us")
    readings = (
        df.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.max(value).cast("double").alias("_value"))
        .withColumn("_us", epoch_micros(time))
        .withColumn("_here", F.struct("_us", "_value"))
    )
    rows = with_previous(in_blocks(readings, keys, time, block), keys, "_us", "_here", "_prev")
    step_us, day_us = step * 1_000_000, DAY * 1_000_000
    if DAY % step:  # slots are counted from midnight of the first day
        first = readings.groupBy(*keys).agg((F.floor(F.min("_us") / day_us) * day_us).alias("_origin"))
        rows = attach(rows, first, keys, "_us")
    else:
        rows = rows.withColumn("_origin", F.lit(0).cast("bigint"))
    slot_of = lambda t: F.floor((t - F.col("_origin")) / F.lit(step_us))
    low = F.coalesce(slot_of(F.col("_prev._us")) + 1, slot_of(us))
    laid = (
        rows.select(*keys, "_us", "_value", "_prev", "_origin", low.alias("_low"), slot_of(us).alias("_high"))
        .filter("_low <= _high")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_high") - F.col("_low")) / _CHUNK))))
        .withColumn("_slot", F.explode(F.sequence(
            F.col("_low") + F.col("_chunk") * _CHUNK,
            F.least(F.col("_low") + F.col("_chunk") * _CHUNK + (_CHUNK - 1), F.col("_high")))))
        .withColumn("_at", F.col("_origin") + F.col("_slot") * step_us)
    )
    later = F.col("_prev").isNull() | (us - F.col("_at") <= F.col("_at") - F.col("_prev._us"))
    return laid.select(*keys, from_micros(F.col("_at")).alias(time), F.when(later, F.col("_value")).otherwise(F.col("_prev._value")).alias(value))
