"""Order-dependent work on long series without one task per series.

A station may hold a third of all rows, so no window here is partitioned by station alone on the
rows themselves. Rows get a time block; windows run inside (station, block); and what must cross a
block border (row offsets, last known values, run heads, running sums) travels through a *block
table* with one row per (station, block). That table is an aggregate with a map-side combine and is
joined back on (station, block), the placement the windows already need, so the rows themselves are
shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

HOUR = 3600
DAY = 86400
#: About a week: some 670 rows of a 15-minute series, 600 thousand of a 1 Hz one. Pass a shorter block for faster
#: sensors; ``suggest_block`` measures one.
BLOCK = 7 * DAY
BLK = "_blk"
#: Block of the rows without a time: above every real one, as times have 63 bits of microseconds at most.
NO_TIME = 1 << 62


def names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def epoch_micros(col) -> Column:
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def from_micros(col: Column) -> Column:
    return F.timestamp_micros(col.cast("bigint")).cast("timestamp_ntz")


def block_id(time, seconds: int) -> Column:
    """Number of the block a time falls in; the length is the power of two of microseconds next to
    ``seconds``. Rows without a time share a block of their own after all others, so that joins on the
    block keep them. The number is never NULL, which spares a filter that would keep equal shuffles from
    being shared."""
    return F.coalesce(F.shiftright(epoch_micros(time), round(math.log2(seconds * 1_000_000))), F.lit(NO_TIME))


def in_blocks(df: DataFrame, key, time: str = "time", block: int = BLOCK) -> DataFrame:
    """Add the block column. Nothing is moved here: block tables are combined before their shuffle, and
    the first window or join on (key, block) places the rows."""
    return df.withColumn(BLK, block_id(time, block))


def inside(key, *order) -> Window:
    """Window over the rows of one block, in order."""
    return Window.partitionBy(*names(key), BLK).orderBy(*order)


def suggest_block(df: DataFrame, key, time: str = "time", target_rows: int = 1_000_000) -> int:
    """Longest block, by halving from a week to one minute, whose fullest cell stays below the target.

    One aggregation per candidate length; each is a map-side combined count.
    """
    seconds = BLOCK
    while seconds > 60:  # at most 14 rounds
        cells = df.groupBy(*names(key), block_id(time, seconds).alias(BLK)).count()
        if (cells.agg(F.max("count")).first()[0] or 0) <= target_rows:
            return seconds
        seconds //= 2
    return 60


def with_row_number(df: DataFrame, key, order, total: str | None = None, name: str = "rn") -> DataFrame:
    """1-based position of each row of a frame in blocks within its whole series.

    ``total`` also adds the length of the series under that name.
    """
    keys, order = names(key), names(order)
    sizes = df.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, BLK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(per_key).alias(total)] if total else []),
    )
    return (
        df.withColumn("_pos", F.row_number().over(inside(keys, *order)))
        .join(offsets, [*keys, BLK])
        .withColumn(name, F.col("_pos") + F.col("_before"))
        .drop("_pos", "_before")
    )


def with_keyless(df: DataFrame, key, apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply`` to the rows that belong to a series; rows without a key, which joins on it would lose, come back as they
    are, with NULL in the columns that ``apply`` adds. Their filter reaches the scan, so where there are none this costs next to nothing."""
    known = F.lit(True)
    for k in names(key):
        known = known & F.col(k).isNotNull()
    return apply(df.filter(known)).unionByName(df.filter(~known), allowMissingColumns=True)


def with_halo(df: DataFrame, key, pos: str, back: int, ahead: int = 0, rows: int = 0) -> DataFrame:
    """Cut rows into (key, row block) together with the neighbours a bounded frame needs.

    ``pos`` is a dense row position, counted from 0 or from 1. A row is copied to every block one of whose rows looks
    back over ``back`` or ahead over ``ahead`` rows and meets it. Rows belonging to the block carry
    ``_core``; run the window over (key, _blk) and then keep core rows only.
    """
    rows = rows or max(4096, 8 * (back + ahead))
    at = F.col(pos)
    low = F.greatest(F.floor((at - ahead) / rows), F.lit(0).cast("bigint"))
    high = F.floor((at + back) / rows)
    return (
        df.drop(BLK)
        .withColumn(BLK, F.explode(F.sequence(low, high)))
        .withColumn("_core", F.col(BLK) == F.floor(at / rows))
    )


def core(df: DataFrame) -> DataFrame:
    """Drop the halo copies; rows keep their (key, block)."""
    return df.filter("_core").drop("_core")


def with_known_neighbours(df: DataFrame, key, pos: str, value: str, prefix: str = "_") -> DataFrame:
    """For each row of a frame in blocks, the nearest known value at or before it and at or after it.

    Adds the structs ``{prefix}prev`` and ``{prefix}next`` with fields ``pos`` and ``value``.
    """
    keys = names(key)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("pos"), F.col(value).alias("value")))
    edges = df.groupBy(*keys, BLK).agg(F.max(known).alias("_last"), F.min(known).alias("_first"))
    up = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.desc(BLK)).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *keys, BLK,
        F.last("_last", ignorenulls=True).over(up).alias("_from_left"),
        F.last("_first", ignorenulls=True).over(down).alias("_from_right"),
    )
    left = inside(keys, F.asc(pos)).rowsBetween(Window.unboundedPreceding, 0)
    right = inside(keys, F.desc(pos)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_known", known)
        .withColumn(f"{prefix}prev", F.last("_known", ignorenulls=True).over(left))
        .withColumn(f"{prefix}next", F.last("_known", ignorenulls=True).over(right))
        .join(carried, [*keys, BLK])
        .withColumn(f"{prefix}prev", F.coalesce(f"{prefix}prev", "_from_left"))
        .withColumn(f"{prefix}next", F.coalesce(f"{prefix}next", "_from_right"))
        .drop("_known", "_from_left", "_from_right")
    )


def filled_forward(df: DataFrame, key, pos: str, cols) -> DataFrame:
    """Replace NULLs of ``cols`` by the last known value of the series, with no limit (frame in blocks).

    Filled inside the block first; the last row of a block then holds what the next blocks inherit.
    """
    keys, cols = names(key), names(cols)
    left = inside(keys, F.asc(pos)).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumns({c: F.last(c, ignorenulls=True).over(left) for c in cols})
    up = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    ends = filled.groupBy(*keys, BLK).agg(F.max_by(F.struct(*cols), pos).alias("_end"))
    carried = ends.select(*keys, BLK, *[F.last(f"_end.{c}", ignorenulls=True).over(up).alias(f"_c_{c}") for c in cols])
    return filled.join(carried, [*keys, BLK]).select(
        *[F.coalesce(c, f"_c_{c}").alias(c) if c in cols else c for c in df.columns]
    )


def with_moments(df: DataFrame, key, value: str, parts=(), prefix: str = "") -> DataFrame:
    """Attach count, mean and sample deviation of ``value`` over the whole (key, parts) group.

    Blocks are summed first; the group totals are formed on those partial rows and joined back on
    (key, parts, block), so a hot group is spread over its blocks on both sides.
    """
    keys, parts = names(key), list(parts)
    v = F.col(value)
    partial = df.groupBy(*keys, BLK, *parts).agg(
        F.count(v).alias("_n"), F.avg(v).alias("_m"), F.var_pop(v).alias("_v")
    )
    group = Window.partitionBy(*keys, *parts)
    n, mean, std = f"{prefix}n", f"{prefix}mean", f"{prefix}std"
    totals = (
        partial.withColumn(n, F.sum("_n").over(group))
        .withColumn(mean, F.sum(F.col("_n") * F.col("_m")).over(group) / F.nullif(F.col(n), F.lit(0)))
        .withColumn(
            std,
            F.when(
                F.col(n) > 1,
                F.sqrt(
                    F.sum(F.col("_n") * (F.col("_v") + F.pow(F.col("_m") - F.col(mean), F.lit(2)))).over(group)
                    / (F.col(n) - 1)
                ),
            ),
        )
        .drop("_n", "_m", "_v")
    )
    return df.join(totals, [*keys, BLK, *parts])


def runs(df: DataFrame, key, order, label: str, time: str = "time") -> DataFrame:
    """Maximal runs of equal ``label`` in row order of a frame in blocks: label, start, end, n_rows.

    Runs that do not touch a block border are final after the in-block pass; only the first and last
    run of each block enter the second pass that stitches neighbours together.
    """
    keys, order = names(key), names(order)
    w = inside(keys, *order)
    changed = F.when(
        (F.row_number().over(w) > 1) & F.col(label).eqNullSafe(F.lag(label).over(w)), F.lit(0)
    ).otherwise(F.lit(1))
    pieces = (
        df.withColumn("_changed", changed)
        .withColumn("_run", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, BLK, "_run")
        .agg(
            F.first(label).alias(label), F.min(time).alias("start"),
            F.max(time).alias("end"), F.count(F.lit(1)).alias("n_rows"),
        )
        .withColumn("_runs", F.max("_run").over(Window.partitionBy(*keys, BLK)))
    )
    out = [*keys, label, "start", "end", "n_rows"]
    border = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    per_key = Window.partitionBy(*keys).orderBy(BLK, "_run")
    joined = (
        pieces.filter(border)
        .withColumn(
            "_new",
            F.when(
                (F.col("_run") == 1)
                & (F.row_number().over(per_key) > 1)
                & F.col(label).eqNullSafe(F.lag(label).over(per_key)),
                F.lit(0),
            ).otherwise(F.lit(1)),
        )
        .withColumn("_chain", F.sum("_new").over(per_key.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_chain")
        .agg(
            F.first(label).alias(label), F.min("start").alias("start"),
            F.max("end").alias("end"), F.sum("n_rows").alias("n_rows"),
        )
    )
    return pieces.filter(~border).select(*out).unionByName(joined.select(*out))


def affine_scan(df: DataFrame, key, pos: str, maps: list[tuple[str, str]], rows: int = 256, fan: int = 2048,
                longest: int | None = None) -> DataFrame:
    """Run the recursions ``y = a*y + b`` of a series along ``pos`` (dense, from 0 or 1), started at zero.

    Afterwards each ``b`` column holds y at the row; the ``a`` columns are dropped. Slopes must lie in
    [1e-60, 1] and fall no faster than 1/3 per row on average, so that the running product of one
    short stretch stays a normal number. Inside a stretch y = P * (y0 + sum(b/P)) with two window
    sums for all recursions at once; the stretch totals are chained by ``_stretch_starts``, over as many
    levels as the longest series needs: its last position is read first, unless the caller knows ``longest``.
    """
    keys = names(key)
    if longest is None:
        longest = df.agg(F.max(pos)).first()[0] or 0
    levels, stretches = 1, longest // rows + 1
    while stretches > fan:
        levels, stretches = levels + 1, -(-stretches // fan)
    if BLK not in df.columns:  # a caller that has placed its rows already brings both columns
        df = df.withColumn("_sub", F.floor(F.col(pos) / rows)).withColumn(BLK, F.floor(F.col("_sub") / 16))
    w = Window.partitionBy(*keys, BLK, "_sub").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({a: F.product(a).over(w) for a, _ in maps} | {f"_raw_{a}": F.col(b) for a, b in maps})
    df = df.withColumns({b: F.col(a) * F.sum(F.col(f"_raw_{a}") / F.col(a)).over(w) for a, b in maps})
    df = df.drop(*[f"_raw_{a}" for a, _ in maps])
    totals = df.groupBy(*keys, BLK, F.col("_sub").alias("_idx")).agg(
        F.max_by(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in maps]), pos).alias("_m")
    )
    starts = _stretch_starts(totals.drop(BLK), keys, len(maps), fan, levels)
    per_block = starts.groupBy(*keys, F.floor(F.col("_idx") / 16).alias(BLK)).agg(
        F.map_from_entries(F.collect_list(F.struct("_idx", "_y"))).alias("_starts")  # 16 at most
    )
    df = df.join(per_block, [*keys, BLK]).withColumn("_y", F.element_at("_starts", F.col("_sub")))
    df = df.withColumns({b: F.col(b) + F.col(a) * F.element_at("_y", i + 1) for i, (a, b) in enumerate(maps)})
    return df.drop(BLK, "_sub", "_y", "_starts", *[a for a, _ in maps])


def _stretch_starts(totals: DataFrame, keys: list[str], n: int, fan: int, levels: int) -> DataFrame:
    """Value of every recursion at the start of each stretch, from the stretch totals (a, b).

    Up-sweep: ``fan`` totals are folded in one short array, and the folded groups the same way one level up, until one
    group holds a whole series. Down-sweep: each level gets the values its groups start with from the one above. So no array
    ever grows with the series.
    """
    up = F.floor(F.col("_idx") / fan)
    grouped = totals.groupBy(*keys, up.alias("_up")).agg(
        F.array_sort(F.collect_list(F.struct("_idx", "_m"))).alias("_list")
    )
    identity = F.array_repeat(F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")), n)
    nothing = F.expr("cast(array() as array<struct<idx:bigint,m:array<struct<a:double,b:double>>>>)")

    def step(s, e):
        after = F.zip_with(s["now"], e["_m"], lambda old, m: F.struct(
            (m["a"] * old["a"]).alias("a"), (m["b"] + m["a"] * old["b"]).alias("b")))
        seen = F.concat(s["out"], F.array(F.struct(e["_idx"].alias("idx"), s["now"].alias("m"))))
        return F.struct(after.alias("now"), seen.alias("out"))

    folded = grouped.withColumn(
        "_f", F.aggregate("_list", F.struct(identity.alias("now"), nothing.alias("out")), step)
    ).select(*keys, "_up", "_f")
    if levels == 1:
        folded = folded.withColumn("_in", F.array_repeat(F.lit(0.0), n))
    else:
        if levels > 2:  # every further level would plan all levels below it twice
            folded = checkpoint(folded)
        above = folded.select(*keys, F.col("_up").alias("_idx"), F.col("_f.now").alias("_m"))
        starts = _stretch_starts(above, keys, n, fan, levels - 1)
        folded = folded.join(starts.select(*keys, F.col("_idx").alias("_up"), F.col("_y").alias("_in")), [*keys, "_up"])
    return folded.select(*keys, "_in", F.explode("_f.out").alias("_o")).select(
        *keys, F.col("_o.idx").alias("_idx"),
        F.zip_with("_o.m", "_in", lambda m, y: m["b"] + m["a"] * y).alias("_y"),
    )


def with_previous(df: DataFrame, key, order: str, col: str, name: str) -> DataFrame:
    """``col`` of the previous row of the series (frame in blocks), across block borders."""
    keys = names(key)
    ends = df.groupBy(*keys, BLK).agg(F.max_by(col, order).alias("_end"))
    carried = ends.select(*keys, BLK, F.lag("_end").over(Window.partitionBy(*keys).orderBy(BLK)).alias("_before"))
    w = inside(keys, order)
    return (
        df.withColumn(name, F.lag(col).over(w))
        .withColumn("_head", F.row_number().over(w) == 1)
        .join(carried, [*keys, BLK])
        .withColumn(name, F.when(F.col("_head"), F.col("_before")).otherwise(F.col(name)))
        .drop("_before", "_head")
    )


def attach(df: DataFrame, stats: DataFrame, key, by, salts: int = 64) -> DataFrame:
    """Join one-row-per-key statistics to rows on (key, salt) so that a hot key meets in many tasks.

    Only the small side is repeated. No broadcast is forced; the planner picks one where the measured
    size of the statistics allows it.
    """
    keys = names(key)
    salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*names(by)), F.lit(salts)).cast("int"))
    return rows.join(salted, [*keys, "_salt"], "left").drop("_salt")
