"""Filling missing values on a regular grid (columns ``slot`` and the value)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import year_slot
from .blocks import BLOCK, names, in_blocks, with_known_neighbours, with_moments
from .clean import null_negatives, null_outliers, outlier
from .grid import QUARTER_HOUR, on_grid


def month_hour(time: str = "time") -> dict[str, Column]:
    at = F.col(time).cast("timestamp")  # its parts are never NULL for a known time, see block_id
    return {"_month": F.month(at), "_hour": F.hour(at)}


def day_slot(time: str = "time") -> dict[str, Column]:
    return {"_slot_of_year": year_slot(F.col(time).cast("timestamp"))}


def seasonal_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", season=month_hour,
                  noise: float = 0.0, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Fill NULLs with the mean of the same season over the whole series.

    Season means travel through the block table, so the rows are shuffled once. A season without any
    known value stays NULL. ``noise`` adds a normal term with that share of the mean as deviation.
    """
    cols = df.columns
    parts = season(time)
    rows = with_moments(in_blocks(df.withColumns(parts), key, time, block), key, value, list(parts), prefix="_s_")
    fill = F.col("_s_mean")
    if noise:
        fill = fill + _normal(seed, *names(key), time) * F.lit(noise) * F.col("_s_mean")
    return rows.withColumn(value, F.coalesce(F.col(value), fill)).select(*cols)


def _normal(seed: int, *cols) -> Column:
    """Standard normal number from a hash of the row key: the same on every retry of a task."""
    unit = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(i), *cols), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1)) for i in (0, 1)]
    return F.sqrt(F.lit(-2.0) * F.log(unit[0])) * F.cos(F.lit(2 * math.pi) * unit[1])


def _neighbours(df, key, value, time, pos, block):
    return with_known_neighbours(in_blocks(df, key, time, block), key, pos, value)


def _straight_line(pos: str) -> Column:
    a, b = F.col("_prev"), F.col("_next")
    share = F.try_divide((F.col(pos) - a.pos).cast("double"), (b.pos - a.pos).cast("double"))
    return a.value + (b.value - a.value) * share


def linear_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                block: int = BLOCK) -> DataFrame:
    """Straight line by row position; leading NULLs stay, trailing NULLs repeat the last value."""
    rows = _neighbours(df, key, value, time, pos, block)
    fill = F.when(F.col("_next").isNull(), F.col("_prev.value")).otherwise(_straight_line(pos))
    return rows.withColumn(value, F.coalesce(F.col(value), fill)).select(*df.columns)


def nearest_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                 block: int = BLOCK) -> DataFrame:
    """Nearest known value by position; a tie takes the earlier one, both ends stay NULL."""
    rows = _neighbours(df, key, value, time, pos, block)
    left, right = F.col(pos) - F.col("_prev.pos"), F.col("_next.pos") - F.col(pos)
    fill = F.when(left <= right, F.col("_prev.value")).when(right < left, F.col("_next.value"))
    return rows.withColumn(value, F.coalesce(F.col(value), fill)).select(*df.columns)


def guarded_linear_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                        step: int = QUARTER_HOUR, z: float = 10.0, max_gap_seconds: int = 7200,
                        block: int = BLOCK) -> DataFrame:
    """Straight line only across gaps up to the bound whose two neighbours are within mean ± z·std."""
    cols = df.columns
    rows = with_known_neighbours(with_moments(in_blocks(df, key, time, block), key, value, prefix="_s_"), key, pos, value)
    low, high = F.col("_s_mean") - z * F.col("_s_std"), F.col("_s_mean") + z * F.col("_s_std")
    ok = (
        ((F.col("_next.pos") - F.col("_prev.pos")) * step <= max_gap_seconds)
        & F.col("_prev.value").between(low, high)
        & F.col("_next.value").between(low, high)
    )
    return rows.withColumn(value, F.coalesce(F.col(value), F.when(ok, _straight_line(pos)))).select(*cols)


def forward_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                 limit: int | None = None, block: int = BLOCK) -> DataFrame:
    """Repeat the last known value for at most ``limit`` rows."""
    rows = _neighbours(df, key, value, time, pos, block)
    fill = F.col("_prev.value")
    if limit is not None:
        fill = F.when(F.col(pos) - F.col("_prev.pos") <= limit, fill)
    return rows.withColumn(value, F.coalesce(F.col(value), fill)).select(*df.columns)


def hybrid_fill(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                limit: int = 96, noise: float = 0.0, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Short gaps by forward fill, the rest by the season means of the filled series."""
    filled = forward_fill(df, key, value, time, pos, limit, block)
    return seasonal_fill(filled, key, value, time, noise=noise, seed=seed, block=block)


def negatives_by_nearest(df: DataFrame, key="station", value: str = "value", time: str = "time", pos: str = "slot",
                         block: int = BLOCK) -> DataFrame:
    return nearest_fill(null_negatives(df, value), key, value, time, pos, block)


def river_clean(df: DataFrame, key="station", value: str = "value", time: str = "time", step: int = QUARTER_HOUR,
                grid: str = "clock", k: float = 10.0, block: int = BLOCK, unique: bool = False) -> DataFrame:
    """Negatives and k-sigma outliers to NULL, regular grid, season means into the gaps.

    Mean and deviation are taken over all readings before the grid. They ride on the grid rows, which
    saves a join of the readings with their own statistics.
    """
    if grid not in ("clock", "anchored"):
        raise ValueError("grid must be 'clock' or 'anchored'")
    rows = null_negatives(df, value)
    gridded = on_grid(rows, key, step, value, grid == "anchored", time, unique,
                      _mean=F.avg(value), _std=F.stddev_samp(value))
    cleaned = gridded.withColumn(value, F.when(~outlier(value, "_mean", "_std", k), F.col(value))).drop("_mean", "_std")
    return seasonal_fill(cleaned, key, value, time, block=block)


def second_pass(df: DataFrame, key="station", value: str = "value", time: str = "time", k: float = 10.0,
                block: int = BLOCK) -> DataFrame:
    """Blank low outliers of an imputed series and fill them again."""
    return seasonal_fill(null_outliers(df, key, value, time, k, low_only=True, block=block), key, value, time, block=block)
