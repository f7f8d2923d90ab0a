"""Exact linear quantiles of very large groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .blocks import names

#: Cells of the first histogram per power of e, parts a crowded cell is split into, and rows of a cell that are sorted.
CELLS_PER_E, PARTS, FIT = 1024, 1024, 4096
#: Up to so many cells (counted first) travel to the rows; beyond, rows and cells meet by a shuffle on the key.
FEW_CELLS = 20_000


def exact_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float], fit: int = FIT) -> DataFrame:
    """One row per key with the interpolated quantiles named in ``probs``. NULL and NaN values do not count; a NULL key is a group.

    The built-in ``percentile`` keeps every distinct value of a group in one buffer. Here rows are counted into value cells
    (a monotone log scale) with their least and largest value, and the cells that hold a wanted rank are found. A cell of more
    than ``fit`` rows is split into equal parts between its own extremes, round by round, until the part with the
    rank holds few rows or one value; each round splits off the extremes, and reads only rows of crowded cells. What
    is left is sorted in arrays of at most ``fit`` values.
    """
    given = names(keys)
    keys = [f"_k{i}" for i in range(max(1, len(given)))]
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull() & ~F.isnan(v)).select(
        *([F.col(g).alias(k) for g, k in zip(given, keys)] or [F.lit(0).alias(keys[0])]), v.alias("_v"))
    cell = F.floor(F.signum("_v") * F.log1p(F.abs("_v")) * CELLS_PER_E)
    extent = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b")]
    per_key = Window.partitionBy(*keys)

    cells = rows.groupBy(*keys, cell.alias("_cell")).agg(*extent)
    named = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probs.items()])
    upto = F.sum("_n").over(per_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    place = (F.col("_total") - 1) * F.col("_q.p")
    wanted = (
        cells.select(*keys, "_n", "_a", "_b", F.sum("_n").over(per_key).alias("_total"), (upto - F.col("_n")).alias("_before"))
        .withColumn("_q", F.explode(named))
        .withColumn("_end", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_rank", F.when(F.col("_end") == 0, F.floor(place)).otherwise(F.ceil(place)))
        .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        .select(*keys, F.col("_q.name").alias("_name"), "_end", (place - F.floor(place)).alias("_share"),
                (F.col("_rank") - F.col("_before")).alias("_rank"), "_n", "_a", "_b")
    )
    wanted = checkpoint(wanted)
    crowded = (F.col("_n") > fit) & (F.col("_a") < F.col("_b"))
    while not wanted.filter(crowded).isEmpty():
        part = F.least(F.floor((F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * PARTS), F.lit(PARTS - 1))
        parts = (
            _within(rows, wanted.filter(crowded), keys)
            .groupBy(*keys, F.col("_a").alias("_low"), part.alias("_part")).agg(*extent)
        )
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_low").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
        parts = parts.withColumn("_before", upto - F.col("_n"))
        held = wanted.filter(crowded).select(*keys, "_name", "_end", "_share", "_rank", F.col("_a").alias("_low"))
        finer = (
            _null_safe(held, parts, [*keys, "_low"])
            .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
            .withColumn("_rank", F.col("_rank") - F.col("_before"))
            .select(*wanted.columns)
        )
        wanted = checkpoint(wanted.filter(~crowded).unionByName(finer))

    several = F.col("_a") < F.col("_b")
    ranks = F.collect_set(F.struct("_name", "_end", "_share", "_rank"))
    open_cells = wanted.filter(several).groupBy(*keys, "_a", "_b").agg(ranks.alias("_ranks"))
    sorted_cells = (
        _within(rows, open_cells, keys).groupBy(*keys, "_a")
        .agg(F.array_sort(F.collect_list("_v")).alias("_sorted"), F.any_value("_ranks").alias("_ranks"))  # ``fit`` values at most
        .select(*keys, "_sorted", F.explode("_ranks").alias("_r"))
        .select(*keys, "_r._name", "_r._end", "_r._share", F.element_at("_sorted", (F.col("_r._rank") + 1).cast("int")).alias("_x"))
    )
    found = sorted_cells.unionByName(wanted.filter(~several).select(*keys, "_name", "_end", "_share", F.col("_a").alias("_x")))

    def quantile(name: str):
        low, high = (F.max(F.when((F.col("_name") == name) & (F.col("_end") == end), F.col("_x"))) for end in (0, 1))
        return (low + (high - low) * F.max(F.when(F.col("_name") == name, F.col("_share")))).alias(name)

    out = found.groupBy(*keys).agg(*[quantile(n) for n in probs])
    return out.select(*[F.col(k).alias(g) for g, k in zip(given, keys)], *probs)


def _within(rows: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the cell (_a, _b) of their key that holds them; the cells of a key do not overlap."""
    extra = [c for c in ("_ranks",) if c in cells.columns]
    cells = cells.select(*keys, "_a", "_b", *extra) if extra else cells.select(*keys, "_a", "_b").distinct()
    if cells.limit(FEW_CELLS + 1).count() <= FEW_CELLS:
        cells = F.broadcast(cells)
    return _null_safe(rows, cells, keys, F.col("_v").between(F.col("_a"), F.col("_b")))


def _null_safe(left: DataFrame, right: DataFrame, on: list[str], and_also=None) -> DataFrame:
    right = right.withColumnsRenamed({c: f"_right{c}" for c in on})
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right{c}")) for c in on])
    return left.join(right, condition if and_also is None else condition & and_also).drop(*[f"_right{c}" for c in on])
