"""Locally weighted regression of down-sampled series."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint
from .blocks import BLK, attach, names, with_halo
from .features import numbered
from .quantiles import exact_quantiles

# Fixed value: residuals beyond this multiple of the median absolute residual get weight zero.
ROBUST_SCALE = 6.0
#: Robust passes unless told otherwise, and cells of the table of points and neighbours that is worked on at once.
PASSES, TILE = 3, 1 << 19


def neighbours(frac: float, n) -> Column:
    """Points in each local fit: the whole part of frac · n."""
    return F.floor(F.lit(frac) * n + F.lit(1e-10))


def lowess(df: DataFrame, frac: float, x: str = "x", y: str = "value", key="station", order: str = "time",
           passes: int = PASSES) -> DataFrame:
    """Local tricube line through the ``frac · n`` nearest points of each point: adds ``smooth``.

    ``x`` must grow with ``order``. Rows live in haloed row blocks; the longest frame is read once from the series lengths. A block is one
    sorted array, in which the neighbours of a point are one interval, so no row holds its neighbours. Cost grows with rows times
    neighbours: feed bucket means. Each robust pass reweights by the residuals and is written to the shared folder
    before the next one. Rows without a value go; a series too short for two neighbours has no smooth value.
    """
    keys = names(key)
    rows = numbered(df.filter(F.col(y).isNotNull()), keys, order, total="_n")
    rows = rows.withColumn("_k", neighbours(frac, F.col("_n"))).withColumn("_r", F.lit(1.0))
    longest = int(rows.agg(F.max("_k")).first()[0] or 0)
    rows = _fit(rows, keys, x, y, longest)
    for _ in range(passes):
        rows = checkpoint(rows)
        size = rows.withColumn("_e", F.abs(F.col(y) - F.col("smooth")))
        scale = exact_quantiles(size, keys, "_e", {"_median": 0.5})
        u = F.try_divide(F.col("_e"), F.col("_median") * ROBUST_SCALE)
        weight = F.when(u < 1, F.pow(1 - u * u, F.lit(2))).when(u.isNull() & (F.col("_e") == 0), F.lit(1.0)).otherwise(F.lit(0.0))
        rows = attach(size, scale, keys, "rn").withColumn("_r", weight).drop("_e", "_median", "smooth")
        rows = _fit(rows, keys, x, y, longest)
    return rows.select(*df.columns, "smooth")


def local_lines(x: np.ndarray, y: np.ndarray, r: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Value at ``x[at]`` of the line through the ``k`` nearest of the points (sorted by x), with tricube weights times ``r``.

    The nearest points of one point are an interval, which moves on while its left end is farther than the point after it:
    one binary search in the sums of both. Points at the bound of the interval weigh nothing, so ties are harmless.
    """
    k = min(k, len(x))
    if k < 2:
        return np.full(len(at), np.nan)
    left = np.searchsorted(x[:len(x) - k] + x[k:], 2 * x[at], side="left")
    h = np.maximum(x[at] - x[left], x[left + k - 1] - x[at])
    out = y[at].copy()
    step = max(1, TILE // k)
    for i in range(0, len(at), step):
        near = left[i:i + step, None] + np.arange(k)
        dx, width = x[near] - x[at[i:i + step], None], h[i:i + step, None]
        u = np.abs(dx) / np.where(width > 0, width, 1.0)
        w = np.where((u < 1) & (width > 0), (1 - u * u * u) ** 3, 0.0) * r[near]
        own = y[near]
        s, sx, sy = w.sum(1), (w * dx).sum(1), (w * own).sum(1)
        sxx, sxy = (w * dx * dx).sum(1), (w * dx * own).sum(1)
        det = s * sxx - sx * sx
        line = (sxx * sy - sx * sxy) / np.where(det != 0, det, 1.0)
        mean = np.where(s != 0, sy / np.where(s != 0, s, 1.0), out[i:i + step])
        out[i:i + step] = np.where(det != 0, line, mean)
    return out


def _fit(rows: DataFrame, keys: list[str], x: str, y: str, longest: int) -> DataFrame:
    reach = max(0, longest - 1)
    haloed = with_halo(rows, keys, "rn", reach, reach, max(4096, 2 * longest))
    haloed = haloed.withColumns({"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double")})
    kept = rows.columns

    def fit(block: pa.Table) -> pa.Table:
        block = block.sort_by("rn").combine_chunks()
        xs, ys, rs, core = (block[c].to_numpy() for c in ("_x", "_y", "_r", "_core"))
        smooth = local_lines(xs, ys, rs, np.flatnonzero(core), block["_k"][0].as_py())
        return block.filter(block["_core"]).select(kept).append_column("smooth", pa.array(smooth, from_pandas=True))

    schema = T.StructType([*rows.schema.fields, T.StructField("smooth", T.DoubleType())])
    return haloed.groupBy(*keys, BLK).applyInArrow(fit, schema)
