"""Classical seasonal decomposition of every series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLK, core, inside, names, with_halo
from .features import numbered


def decompose(df: DataFrame, period: int, key="station", value: str = "value", time: str = "time",
              model: str = "additive", extrapolate: bool = False) -> DataFrame:
    """Trend, seasonal and residual parts: (key, time, value, trend, seasonal, resid).

    The trend is the centred mean over one period (half weights at both ends of an even period), read
    off running sums in haloed blocks, so its cost does not grow with the period. Period means are
    formed per block, then per position, and come back through (block, position). A series shorter
    than two periods or with NULLs is an error.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError("model must be 'additive' or 'multiplicative'")
    keys, half = names(key), period // 2
    rows = numbered(df.select(*keys, time, value), keys, time, total="_n")
    bad = (F.col("_n") < 2 * period) | F.col(value).isNull()
    message = F.lit(f"decomposition needs known values over at least {2 * period} rows")
    rows = rows.withColumn("_x", F.when(bad, F.raise_error(message).cast("double")).otherwise(F.col(value).cast("double")))
    rows = with_halo(rows, keys, "rn", half, half)
    w = inside(keys, "rn")
    rows = rows.withColumn("_cum", F.sum("_x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    total = F.lead("_cum", half).over(w) - F.coalesce(F.lag("_cum", half + 1).over(w), F.lit(0.0))
    if period % 2 == 0:
        total = total - (F.lag("_x", half).over(w) + F.lead("_x", half).over(w)) / 2
    whole = (F.col("rn") > half) & (F.col("rn") <= F.col("_n") - half)
    rows = core(rows.withColumn("trend", F.when(whole, total / period)))

    if extrapolate:
        rows = _extended(rows, keys, half)
    removed = F.col("_x") - F.col("trend") if model == "additive" else F.try_divide(F.col("_x"), F.col("trend"))
    rows = rows.withColumn("_d", removed).withColumn("_at", F.pmod(F.col("rn") - 1, F.lit(period)))
    partial = rows.groupBy(*keys, BLK, "_at").agg(F.sum("_d").alias("_s"), F.count("_d").alias("_c"))
    means = partial.groupBy(*keys, "_at").agg((F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))).alias("_m"))
    centre = F.avg("_m").over(Window.partitionBy(*keys))
    season = means.withColumn("seasonal", F.col("_m") - centre if model == "additive" else F.try_divide(F.col("_m"), centre))
    spread = partial.select(*keys, BLK, "_at").join(season.drop("_m"), [*keys, "_at"])
    rows = rows.join(spread, [*keys, BLK, "_at"])
    rest = (
        F.col("_x") - F.col("trend") - F.col("seasonal") if model == "additive"
        else F.try_divide(F.col("_x"), F.col("trend") * F.col("seasonal"))
    )
    return rows.select(*keys, time, F.col("_x").alias(value), "trend", "seasonal", rest.alias("resid"))


def _extended(rows: DataFrame, keys: list[str], half: int) -> DataFrame:
    """Continue the trend at both ends along the line through its outermost two points."""
    rn, n = F.col("rn"), F.col("_n")

    def pick(position):
        return F.max(F.when(rn == position, F.col("trend")))

    edge = rows.groupBy(*keys, BLK).agg(
        pick(F.lit(half + 1)).alias("_f0"), pick(F.lit(half + 2)).alias("_f1"),
        pick(n - half - 1).alias("_l0"), pick(n - half).alias("_l1"),
    )
    per_key = Window.partitionBy(*keys)
    edges = edge.select(*keys, BLK, *[F.max(c).over(per_key).alias(c) for c in ("_f0", "_f1", "_l0", "_l1")])
    left = F.col("_f0") + (F.col("_f1") - F.col("_f0")) * (rn - (half + 1))
    right = F.col("_l1") + (F.col("_l1") - F.col("_l0")) * (rn - (n - half))
    trend = F.coalesce(F.col("trend"), F.when(rn <= half, left).otherwise(right))
    return rows.join(edges, [*keys, BLK]).withColumn("trend", trend).drop("_f0", "_f1", "_l0", "_l1")
