"""Lag, rolling, difference, smoothing and sequence features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import cyclic
from ..functions.numeric import guarded_corr
from .blocks import BLK, BLOCK, affine_scan, core, filled_forward, inside, names, in_blocks, with_halo, with_row_number

LEAD = 6


def numbered(df: DataFrame, key="station", time: str = "time", total: str | None = None, block: int = BLOCK) -> DataFrame:
    """Dense row position ``rn`` per series (and its length)."""
    return with_row_number(in_blocks(df, key, time, block), key, time, total).drop(BLK)


def frames(key, pos: str):
    """Ordered window of a haloed frame and a maker of trailing n-row frames on it."""
    w = inside(key, pos)
    return w, lambda n: w.rowsBetween(-(n - 1), 0)


def known_run(key, pos: str, col: str) -> Column:
    """Length of the run of known values ending at the row (haloed frame).

    One running maximum replaces a count per window: a window of n rows is full where this is n or more.
    """
    so_far = inside(key, pos).rowsBetween(Window.unboundedPreceding, 0)
    gap = F.max(F.when(F.col(col).isNull(), F.col(pos))).over(so_far)
    return F.col(pos) - F.coalesce(gap, F.first(pos).over(so_far) - 1)


def full_windows(df: DataFrame, key, pos: str, made: dict[str, tuple]) -> DataFrame:
    """Rolling aggregates ``name -> (function, column, n)`` of a haloed frame, NULL unless the window is full."""
    _, roll = frames(key, pos)
    columns = sorted({c for _, c, _ in made.values()})
    rows = df.withColumns({f"_run_{c}": known_run(key, pos, c) for c in columns})
    return rows.withColumns({
        name: F.when(F.col(f"_run_{c}") >= n, agg(F.col(c)).over(roll(n))) for name, (agg, c, n) in made.items()
    }).drop(*[f"_run_{c}" for c in columns])


def lead_and_lags(df: DataFrame, key, pos: str, cols: dict[str, range | list[int]], lead: dict[str, int] | None = None) -> DataFrame:
    """``{c}_lag_{k}h`` for the given offsets and ``target_t_plus_{k}`` for the leads."""
    lead = lead or {}
    back = max((max(ks) for ks in cols.values() if len(ks)), default=0)
    ahead = max(lead.values(), default=0)
    rows = with_halo(df, key, pos, back, ahead)
    w = inside(key, pos)
    made = {f"{c}_lag_{k}h": F.lag(c, k).over(w) if k else F.col(c) for c, ks in cols.items() for k in ks}
    made |= {f"target_t_plus_{k}": F.lead(c, k).over(w) for c, k in lead.items()}
    return core(rows.withColumns(made)).drop(BLK)


def rolling(df: DataFrame, key, pos: str, col: str, windows, aggs=("mean", "std")) -> DataFrame:
    """``{c}_rolling_{agg}_{n}h`` over full n-row windows."""
    kinds = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}
    rows = with_halo(df, key, pos, max(windows) - 1)
    made = {f"{col}_rolling_{a}_{n}h": (kinds[a], col, n) for n in windows for a in aggs}
    return core(full_windows(rows, key, pos, made)).drop(BLK)


def differences(df: DataFrame, key, pos: str, col: str, lags=(1, 2)) -> DataFrame:
    rows = with_halo(df, key, pos, max(lags))
    w = inside(key, pos)
    return core(rows.withColumns({f"{col}_diff_{k}h": F.col(col) - F.lag(col, k).over(w) for k in lags})).drop(BLK)


def rolling_corr(df: DataFrame, key, pos: str, a: str, b: str, n: int, name: str = "rolling_corr") -> DataFrame:
    """Correlation over full windows of n complete pairs."""
    rows = with_halo(df, key, pos, n - 1)
    _, roll = frames(key, pos)
    pairs = F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.lit(1))).over(roll(n))
    return core(rows.withColumn(name, F.when(pairs == n, guarded_corr(a, b, roll(n))))).drop(BLK)


def lagged_corr(df: DataFrame, key, pos: str, a: str, b: str, lags) -> DataFrame:
    """One row per (key, lag): r of ``a`` with ``b`` shifted down by ``lag`` rows."""
    lags = list(lags)
    rows = with_halo(df, key, pos, max(lags))
    w = inside(key, pos)
    lagged = core(rows.withColumns({f"_l{k}": F.lag(b, k).over(w) if k else F.col(b) for k in lags}))
    wide = lagged.groupBy(*names(key)).agg(*[guarded_corr(a, f"_l{k}").alias(f"_l{k}") for k in lags])
    pairs = F.array(*[F.struct(F.lit(k).cast("bigint").alias("lag"), F.col(f"_l{k}").alias("r")) for k in lags])
    return wide.select(*names(key), F.explode(pairs).alias("_x")).select(*names(key), "_x.lag", "_x.r")


def ewma(df: DataFrame, key, pos: str, specs: dict[str, tuple[str, int]], rows: int = 256, fan: int = 2048) -> DataFrame:
    """Exponentially weighted means: ``specs`` maps an output name to (column, span).

    The first known value starts the mean; g NULLs in between age its weight by (1-a)^(g+1), with
    a = 2/(span+1). Each row maps the previous mean linearly to the next, which ``affine_scan`` runs
    for all outputs at once. g is the row distance to the last known value, found per block with a
    carry. Span 1 has no memory and is a forward fill.
    """
    keys = names(key)
    columns = sorted({c for c, _ in specs.values()})
    df = df.withColumns({name: F.col(c) for name, (c, span) in specs.items() if span == 1})
    rows_in = df.withColumn(BLK, F.floor(F.col(pos) / (16 * rows)))
    rows_in = rows_in.withColumn("_sub", F.floor(F.col(pos) / rows))
    w = inside(keys, "_sub", pos)  # the order the recursion needs next
    up = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    at = {c: F.when(F.col(c).isNotNull(), F.col(pos)) for c in columns}
    carried = rows_in.groupBy(*keys, BLK).agg(*[F.max(at[c]).alias(f"_k_{c}") for c in columns]).select(
        *keys, BLK, *[F.max(f"_k_{c}").over(up).alias(f"_k_{c}") for c in columns]
    )
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = rows_in.withColumns({f"_p_{c}": F.max(at[c]).over(before) for c in columns}).join(carried, [*keys, BLK])
    out = out.withColumns({f"_p_{c}": F.coalesce(f"_p_{c}", f"_k_{c}") for c in columns}).drop(*[f"_k_{c}" for c in columns])
    repeats = [name for name, (_, span) in specs.items() if span == 1]
    if repeats:
        out = filled_forward(out, keys, pos, repeats)
    maps, made = [], {}
    for i, (name, (c, span)) in enumerate(specs.items()):
        if span == 1:
            continue
        alpha = 2.0 / (span + 1.0)
        x, prev = F.col(c).cast("double"), F.col(f"_p_{c}")
        old = F.pow(F.lit(1.0 - alpha), (F.col(pos) - prev).cast("double"))
        # the first known value is added to zero; a vanished weight is kept at 1e-60, far below rounding
        made[f"_a{i}"] = F.when(x.isNull() | prev.isNull(), F.lit(1.0)).otherwise(F.greatest(old / (old + alpha), F.lit(1e-60)))
        made[f"_b{i}"] = F.when(x.isNull(), F.lit(0.0)).when(prev.isNull(), x).otherwise(F.lit(alpha) * x / (old + alpha))
        maps.append((f"_a{i}", f"_b{i}"))
    if maps:
        longest = df.agg(F.max(pos)).first()[0] or 0  # of the input, before the carries are planned
        out = affine_scan(out.withColumns(made), keys, pos, maps, rows, fan, longest)
    smooth = {
        name: F.when(F.col(c).isNotNull() | F.col(f"_p_{c}").isNotNull(), F.col(f"_b{i}"))
        for i, (name, (c, span)) in enumerate(specs.items()) if span != 1
    }
    return (out.withColumns(smooth) if smooth else out).select(*[c for c in df.columns if c not in specs], *specs)


def is_rain(column: str) -> bool:
    return "rain" in column.lower()


def create_features(df: DataFrame, target: str, weather=(), key="station", time: str = "time", max_lag: int = 6,
                    windows=(3, 6, 12, 24), diff_lags=(1, 2), lead: int = LEAD, pos: str | None = None,
                    lags=None) -> DataFrame:
    """The full feature table of all series in one plan.

    Row windows share one shuffle and one sort; the smoothed columns come from the block scan
    before it. Rows without a target are dropped, remaining NULLs are filled forward over all
    columns, and rows still incomplete are dropped. ``lags`` replaces 1..max_lag where given.
    """
    keys, weather = names(key), list(weather)
    rain = [c for c in weather if is_rain(c)]
    base = df.select(*keys, time, target, *weather, *([pos] if pos else []))
    rows = base.withColumnRenamed(pos, "rn") if pos else numbered(base, keys, time)
    target_lags = list(lags) if lags else list(range(1, max_lag + 1))
    weather_lags = [0, *target_lags]
    specs = {f"{target}_ewm_mean_{n}h": (target, n) for n in windows}
    specs |= {f"{c}_ewm_sum_{n}h": (c, n) for c in rain for n in windows}
    rows = ewma(rows, keys, "rn", specs)
    rows = rows.withColumns({f"{c}_ewm_sum_{n}h": F.col(f"{c}_ewm_sum_{n}h") * n for c in rain for n in windows} or {"rn": F.col("rn")})

    back = max([*target_lags, *windows, *diff_lags])
    rows = with_halo(rows, keys, "rn", back, lead)
    w = inside(keys, "rn")
    made = {f"target_t_plus_{lead}": F.lead(target, lead).over(w)}
    made |= {f"{target}_lag_{k}h": F.lag(target, k).over(w) for k in target_lags}
    made |= {f"{c}_lag_{k}h": F.lag(c, k).over(w) if k else F.col(c) for c in weather for k in weather_lags}
    rolled = {}
    for n in windows:
        rolled[f"{target}_rolling_mean_{n}h"] = (F.avg, target, n)
        rolled[f"{target}_rolling_std_{n}h"] = (F.stddev_samp, target, n)
    for c in rain:
        for n in windows:
            rolled[f"{c}_rolling_sum_{n}h"] = (F.sum, c, n)
            rolled[f"{c}_rolling_mean_{n}h"] = (F.avg, c, n)
            rolled[f"{c}_rolling_std_{n}h"] = (F.stddev_samp, c, n)
    for c in [target, *rain]:
        for k in diff_lags:
            made[f"{c}_diff_{k}h"] = F.col(c) - F.lag(c, k).over(w)
    t = F.col(time)
    made |= {"hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t)}
    for name, x, period in (("hour", F.hour(t), 24), ("day_of_week", F.weekday(t), 7), ("month", F.month(t), 12)):
        made[f"{name}_sin"], made[f"{name}_cos"] = cyclic(x, period)
    made |= {f"{c}_x_{target}": F.col(c) * F.col(target) for c in rain}
    smoothed = list(specs)
    out = core(full_windows(rows.withColumns(made), keys, "rn", rolled)).filter(F.col(f"target_t_plus_{lead}").isNotNull())
    data = [target, *weather, *made, *rolled, *smoothed]
    filled = filled_forward(out, keys, "rn", [c for c in data if c not in ("hour", "day_of_week", "month")])
    return filled.na.drop(subset=data).select(*keys, time, *data)


def sequences(df: DataFrame, key, pos: str, total: str, target: str, columns, length: int = 24, step: int = 1,
              full: bool = False) -> DataFrame:
    """Sliding samples: ``x`` holds ``length`` rows of the columns, ``y`` the target after them.

    Sample starts are i = 0, step, 2·step, … below n-length-1; ``full`` also takes the last possible
    start (below n-length). Arrays are built inside haloed row blocks and are meant for a sink.
    """
    keys, columns = names(key), names(columns)
    rows = with_halo(df, keys, pos, 0, length)
    w = inside(keys, pos)
    sample = F.collect_list(F.struct(F.array(*[F.col(c).cast("double") for c in columns]).alias("v")))
    start = F.col(pos) - 1
    bound = F.col(total) - length - (0 if full else 1)
    return (
        core(
            rows.withColumn("_x", sample.over(w.rowsBetween(0, length - 1)))
            .withColumn("y", F.lead(target, length).over(w))
        )
        .filter((start < bound) & (F.pmod(start, F.lit(step)) == 0))
        .select(*keys, start.cast("bigint").alias("i"), F.transform("_x", lambda s: s["v"]).alias("x"), "y")
    )


def tail_split(df: DataFrame, test_size: int | float, key="station", time: str = "time") -> DataFrame:
    """Mark the last rows of each series: a row count, or a share of the series below 1."""
    rows = numbered(df, key, time, total="_total")
    size = F.lit(test_size) if test_size >= 1 else F.ceil(F.col("_total") * F.lit(float(test_size)))
    return rows.withColumn("is_test", F.col("_total") - F.col("rn") < size).drop("_total")


def select_by_correlation(df: DataFrame, target: str, columns, threshold: float = 0.1, max_features: int | None = None) -> DataFrame:
    """Columns whose |r| with the target reaches the threshold: (feature, abs_r, position).

    All correlations come from one aggregate; the ranking below works on one row per column.
    """
    columns = [c for c in columns if c != target]
    wide = df.agg(*[F.abs(guarded_corr(c, target)).alias(c) for c in columns])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("abs_r"), F.lit(i).cast("bigint").alias("position"))
        for i, c in enumerate(columns)
    ])).alias("_x")).select("_x.*").filter(F.col("abs_r") >= threshold)
    if max_features:
        return long.orderBy(F.desc("abs_r"), "position").limit(max_features)
    return long
