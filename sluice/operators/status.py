"""A status for every series: one that an operator cannot work on is set aside with a reason, and the others go on.

The operators themselves raise on such a series, which ends the job for all of them. The functions here check every
series first, by aggregates with a map-side combine, and hand only the sound ones to the operator.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .blocks import epoch_micros, names
from .decompose import decompose
from .grid import MAX_SLOTS, on_grid
from .lowess import PASSES, lowess, neighbours

OK, NO_SERIES = "ok", "no_series"


@dataclass
class Outcome:
    """``rows``: the operator's result for the sound series. ``status``: (key, n_rows, n_no_time, status) of every series, ``ok`` or the
    first reason that holds; rows without a key are one series of status ``no_series``."""

    rows: DataFrame
    status: DataFrame


def series_status(df: DataFrame, key, rules: dict[str, Column], time: str = "time", weight: Column | None = None) -> DataFrame:
    """(key, n_rows, n_no_time, status). ``rules`` names boolean aggregates over a series, in the order they are tried; ``weight`` is
    how many rows a row of ``df`` stands for."""
    keys = names(key)
    one = F.lit(1) if weight is None else weight
    out = df.groupBy(*keys).agg(
        F.sum(one).cast("bigint").alias("n_rows"), F.coalesce(F.sum(F.when(F.col(time).isNull(), one)), F.lit(0)).cast("bigint").alias("n_no_time"),
        *[rule.alias(f"_r{i}") for i, rule in enumerate(rules.values())])
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    status = F.when(unkeyed, F.lit(NO_SERIES))
    for i, name in enumerate(rules):
        status = status.when(F.col(f"_r{i}"), F.lit(name))
    return out.select(*keys, "n_rows", "n_no_time", status.otherwise(F.lit(OK)).alias("status"))


def sound_rows(df: DataFrame, status: DataFrame, key, time: str | None = "time", observation: Observation | None = None) -> DataFrame:
    """Rows of the series whose status is ``ok``, without those that have no time (``time=None`` keeps them). ``observation``
    counts, while the result is computed, the rows read (``n_rows``) and those set aside for want of a key or a time (``n_set_aside``).

    Only the keys of bad series travel to the rows.
    """
    keys = names(key)
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, *names(time or []))])
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("n_rows"), F.count_if(~placed).alias("n_set_aside"))
    bad = status.filter(~F.col("status").isin(OK, NO_SERIES)).select(*keys)
    return df.filter(placed).join(bad, keys, "left_anti")


def gridded(df: DataFrame, key, step: int, values="value", anchored: bool = False, time: str = "time", max_slots: int = MAX_SLOTS,
            observation: Observation | None = None) -> Outcome:
    """``on_grid`` for the series that have a time (else ``no_times``), no time twice (``repeated_times``) and a grid of
    at most ``max_slots`` slots (``grid_too_long``, which a wrong timestamp causes)."""
    keys = names(key)
    cells = df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_c"))
    at = epoch_micros(time)
    rules = {
        "no_times": F.count(F.col(time)) == 0,
        "repeated_times": F.max(F.when(F.col(time).isNotNull(), F.col("_c"))) > 1,
        "grid_too_long": (F.max(at) - F.min(at)) / F.lit(step * 1_000_000) + 1 > max_slots,
    }
    status = series_status(cells, keys, rules, time, F.col("_c"))
    rows = sound_rows(df, status, keys, time, observation)
    return Outcome(on_grid(rows, keys, step, values, anchored, time, unique=True, max_slots=max_slots + 1 + 86400 // step), status)


def decomposed(df: DataFrame, period: int, key="station", value: str = "value", time: str = "time", model: str = "additive",
               extrapolate: bool = False, observation: Observation | None = None) -> Outcome:
    """``decompose`` for the series that have two periods of rows (else ``too_short``) and no unknown value (``unknown_values``)."""
    timed = F.col(time).isNotNull()
    rules = {
        "too_short": F.count_if(timed) < 2 * period,
        "unknown_values": F.count_if(timed & F.col(value).isNull()) > 0,
    }
    status = series_status(df, key, rules, time)
    return Outcome(decompose(sound_rows(df, status, key, time, observation), period, key, value, time, model, extrapolate), status)


def smoothed(df: DataFrame, frac: float, x: str = "x", y: str = "value", key="station", order: str = "time", passes: int = PASSES,
             observation: Observation | None = None) -> Outcome:
    """``lowess`` for the series whose local fits hold two points or more (else ``too_short``)."""
    known = F.count_if(F.col(order).isNotNull() & F.col(y).isNotNull())
    status = series_status(df, key, {"too_short": neighbours(frac, known) < 2}, order)
    return Outcome(lowess(sound_rows(df, status, key, order, observation), frac, x, y, key, order, passes), status)


def file_status(rows: DataFrame, file: str = "file", corrupt: str = "_corrupt", time: str = "time") -> DataFrame:
    """(file, n_rows, n_no_time, n_bad, status) of files read by ``read_tolerant``: ``unreadable`` if no record could be read,
    ``bad_records`` if some could not, else ``ok``. Other files are not affected by a bad one."""
    bad = F.count_if(F.col(corrupt).isNotNull())
    n = F.count(F.lit(1))
    return rows.groupBy(file).agg(
        n.alias("n_rows"), F.count_if(F.col(time).isNull()).alias("n_no_time"), bad.alias("n_bad"),
        F.when(bad == n, F.lit("unreadable")).when(bad > 0, F.lit("bad_records")).otherwise(F.lit(OK)).alias("status"))
