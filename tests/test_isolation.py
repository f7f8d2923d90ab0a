"""Bad series are set aside, rows without keys stay, and nothing depends on the length or the crowding of a series."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluice.operators import blocks, clean, features, gaps, grid, joins, quantiles, stats, status
from sluice.plans import forecast, sweep

T0 = dt.datetime(2024, 1, 1)


def make(spark, series, step=900):
    rows = [(s, T0 + dt.timedelta(seconds=step * i), None if v is None else float(v)) for s, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, time timestamp_ntz, value double")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_bad_station_leaves_the_others_as_they_are(spark):
    rng = random.Random(1)
    good = {s: [rng.random() for _ in range(40)] for s in "ab"}
    wrong = dt.datetime(9000, 1, 1)
    bad = spark.createDataFrame(
        [("far", T0, 1.0), ("far", wrong, 2.0), ("twice", T0, 1.0), ("twice", T0, 2.0), ("never", None, 1.0), (None, T0, 1.0), (None, None, None),
         ("a", None, 5.0)], "station string, time timestamp_ntz, value double")
    seen = Observation("rows")
    out = status.gridded(make(spark, good).unionByName(bad), "station", 900, max_slots=10_000, observation=seen)
    alone = status.gridded(make(spark, good), "station", 900)
    assert collected(out.rows) == collected(alone.rows) and len(collected(out.rows)) == 80
    assert seen.get == {"n_rows": 88, "n_set_aside": 4}
    assert {r["station"]: (r["n_rows"], r["n_no_time"], r["status"]) for r in out.status.collect()} == {
        "a": (41, 1, "ok"), "b": (40, 0, "ok"), "far": (2, 0, "grid_too_long"), "twice": (2, 0, "repeated_times"), "never": (1, 1, "no_times"),
        None: (2, 1, "no_series")}


def test_status_of_nothing(spark):
    empty = spark.createDataFrame([], "station string, time timestamp_ntz, value double, x int")
    assert status.gridded(empty, "station", 900).rows.collect() == []
    assert status.decomposed(empty, 4).status.collect() == []


def test_decomposition_and_local_fit_skip_short_stations(spark):
    rng = random.Random(2)
    good = {"a": [rng.random() for _ in range(30)]}
    rows = make(spark, good | {"short": [1, 2, 3], "hole": [1.0] * 20 + [None] * 3})
    out = status.decomposed(rows, 4)
    assert collected(out.rows) == collected(status.decomposed(make(spark, good), 4).rows)
    assert {r["station"]: r["status"] for r in out.status.collect()} == {"a": "ok", "short": "too_short", "hole": "unknown_values"}
    x = F.unix_seconds(F.col("time").cast("timestamp")) / 900
    fit = status.smoothed(rows.withColumn("x", x), 0.3)
    assert {r["station"] for r in fit.rows.collect()} == {"a", "hole"}
    assert {r["station"]: r["status"] for r in fit.status.collect()}["short"] == "too_short"


@pytest.mark.parametrize("first", [0, 1])
@pytest.mark.parametrize("n, rows, fan", [(1, 4, 2), (700, 4, 2), (5000, 16, 3), (3000, 256, 2048)])
def test_weighted_mean_of_any_length(spark, first, n, rows, fan):
    rng = random.Random(n)
    values = [None if rng.random() < 0.2 else rng.random() for _ in range(n)]
    df = spark.createDataFrame([("a", first + i, v) for i, v in enumerate(values)], "station string, pos long, value double")
    got = {r["pos"]: r["y"] for r in features.ewma(df, "station", "pos", {"y": ("value", 6)}, rows=rows, fan=fan).collect()}
    want = pd.Series(values, dtype=float).ewm(span=6, adjust=False).mean()
    assert len(got) == n
    for i, w in enumerate(want):
        assert got[first + i] is None if np.isnan(w) else abs(got[first + i] - w) < 1e-9


def test_weighted_mean_of_a_long_series_with_default_parameters(spark):
    df = spark.range(100_000).select(F.lit("a").alias("station"), F.col("id").alias("pos"), (F.col("id") % 97).cast("double").alias("value"))
    got = {r["pos"]: r["y"] for r in features.ewma(df, "station", "pos", {"y": ("value", 24)}).filter("pos % 9973 = 0").collect()}
    want = pd.Series(np.arange(100_000) % 97, dtype=float).ewm(span=24, adjust=False).mean()
    assert len(got) == 11 and all(abs(v - want[p]) < 1e-9 for p, v in got.items())


def test_frames_count_positions_from_zero_or_one(spark):
    values = [float(i * i) for i in range(20)]
    for first in (0, 1):
        df = spark.createDataFrame([("a", first + i, v) for i, v in enumerate(values)], "station string, pos long, value double")
        rows = blocks.with_halo(df, "station", "pos", 2, 1, rows=4)
        w = blocks.inside("station", "pos")
        out = blocks.core(rows.withColumn("back", F.lag("value", 2).over(w)).withColumn("ahead", F.lead("value", 1).over(w)))
        assert [(r["value"], r["back"], r["ahead"]) for r in out.orderBy("pos").collect()] == [
            (v, values[i - 2] if i > 1 else None, values[i + 1] if i < 19 else None) for i, v in enumerate(values)]


def test_rows_without_time_or_station_stay(spark):
    rows = [("a" if i % 3 else None, None if i % 4 == 0 else T0 + dt.timedelta(days=11 * i), float(i % 7 if i != 20 else 1000), i) for i in range(60)]
    df = spark.createDataFrame(rows, "station string, time timestamp_ntz, value double, event_id int")
    own = [v for s, _, v, _ in rows if s]
    bound = np.mean(own) + 3 * np.std(own, ddof=1)
    for out in (clean.null_outliers(df, k=3.0), clean.blank_implausible(df, k=3.0)):
        got = {r["event_id"]: r["value"] for r in out.collect()}
        assert got == {i: None if s and v > bound else v for s, _, v, i in rows} and got[20] is None
    flags = {r["event_id"]: r["implausible"] for r in clean.flag_implausible(df, k=3.0).collect()}
    assert flags == {i: None if s is None else v > bound for s, _, v, i in rows}
    monthly = stats.monthly_anomaly(df).collect()
    assert len(monthly) == 60 and all((r["anomaly"] is None) == (r["station"] is None or r["time"] is None) for r in monthly)
    assert joins.lookup_mean(df, "value", station="station", month=F.month("time")).count() == 60
    numbers = [r["rn"] for r in features.numbered(df.filter("station = 'a'"), "station").orderBy(F.col("time").asc_nulls_last()).collect()]
    assert sorted(numbers) == list(range(1, 41)) and numbers[:30] == list(range(1, 31))


def nearest(readings, step, origin):
    first, last = min(readings), max(readings)
    slot = origin + (first - origin) // step * step
    out = {}
    while slot <= last:
        best = min(readings, key=lambda t: (abs(t - slot), -t))
        out[slot] = readings[best]
        slot += step
    return out


@pytest.mark.parametrize("step", [3600, 25_000])
def test_nearest_reading_known_or_not(spark, step):
    rng = random.Random(step)
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    series = {s: {base + rng.randrange(40 * 86400): rng.choice([None, 1.0, 2.0, 3.0]) for _ in range(n)} for s, n in (("a", 200), ("b", 1), ("c", 7))}
    rows = [(s, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t), v) for s, x in series.items() for t, v in x.items()]
    df = spark.createDataFrame(rows + [rows[0], ("a", None, 9.0)], "station string, time timestamp_ntz, value double")
    got = {(r["station"], int((r["time"] - dt.datetime(1970, 1, 1)).total_seconds())): r["value"] for r in grid.nearest_on_grid(df, "station", step, block=3 * 86400).collect()}
    want = {(s, t): v for s, x in series.items() for t, v in nearest(x, step, min(x) // 86400 * 86400).items()}
    assert got == want


def test_one_unknown_between_two_known(spark):
    df = make(spark, {"a": [1, None, 3]}, step=3600)
    assert [r["value"] for r in grid.nearest_on_grid(df, "station", 3600).orderBy("time").collect()] == [1.0, None, 3.0]


def test_crowded_cells_are_split(spark):
    rng = np.random.default_rng(4)
    groups = {"narrow": 1013 + rng.random(30_000), "equal": np.full(9000, 7.5), "spread": rng.normal(size=20_000) ** 5,
              "mixed": np.concatenate([np.full(6000, 2.0), 2 + rng.random(6000) * 1e-6, [-1e300, 1e300, 0.0]]), "few": np.array([3.0, 1.0]), None: rng.random(5000)}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("few", None), ("few", float("nan"))]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["station", "value"]).astype({"station": object}), "station string, value double")
    probs = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["station"]: r for r in quantiles.exact_quantiles(df, "station", "value", probs, fit=64).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12), (k, name)
    whole = quantiles.exact_quantiles(df, [], "value", {"m": 0.5}, fit=64).collect()
    assert len(whole) == 1 and whole[0]["m"] == pytest.approx(np.quantile(np.concatenate(list(groups.values())), 0.5))


def test_no_task_sorts_a_crowded_cell(spark, monkeypatch):
    """10^6 distinct values in [1013, 1014] reach the sort in arrays of at most the bound."""
    df = spark.range(1_000_000).select(F.lit("a").alias("station"), (F.lit(1013) + F.col("id") / 1_000_000).alias("value"))
    sizes = []
    join = quantiles._within

    def watched(rows, cells, keys):
        out = join(rows, cells, keys)
        if "_ranks" in cells.columns:
            sizes.extend(r["count"] for r in out.groupBy(*keys, "_a").count().collect())
        return out

    monkeypatch.setattr(quantiles, "_within", watched)
    got = quantiles.exact_quantiles(df, "station", "value", {"m": 0.5, "q": 0.25}).first()
    assert sizes and max(sizes) <= quantiles.FIT
    assert got["m"] == pytest.approx(1013 + 499_999.5 / 1e6, abs=1e-12) and got["q"] == pytest.approx(1013 + 249_999.75 / 1e6, abs=1e-12)


def slots_of(readings, step):
    """(times, known) of the anchored grid of one series, laid out."""
    first, last = min(readings), max(readings)
    return [(t, readings.get(t) is not None) for t in range(first, last + 1, step)]


@pytest.mark.parametrize("step, shift", [(900, 0), (3600, 1234)])
def test_gap_arithmetic_equals_the_grid(spark, step, shift):
    rng = random.Random(step)
    epoch = dt.datetime(1970, 1, 1)
    base = int((dt.datetime(2023, 12, 29, 21) - epoch).total_seconds()) + shift
    series = {s: {base + i * step + (7 if rng.random() < 0.1 else 0): rng.choice([None, 1.0, 2.0]) for i in range(n) if rng.random() < 0.6}
              for s, n in (("a", 6000), ("b", 700), ("c", 5))}
    series |= {"full": {base + i * step: 1.0 for i in range(9)}, "none": {base: None, base + 3 * step: None}}
    rows = [(s, epoch + dt.timedelta(seconds=t), v) for s, x in series.items() for t, v in x.items()]
    df = spark.createDataFrame(rows + [(None, T0, 1.0), ("a", None, 1.0)], "station string, time timestamp_ntz, value double").repartition(3)
    grids = {s: slots_of(x, step) for s, x in series.items()}
    got = {r["station"]: (r["n_expected"], r["n_missing"]) for r in gaps.missing_slots(df, step=step).collect()}
    assert got == {s: (len(g), sum(not k for _, k in g)) for s, g in grids.items()}
    got = {r["station"]: (r["n_expected"], r["n_missing"]) for r in gaps.missing_steps(df, step=step).collect()}
    assert got == {s: (len(g), sum(t not in series[s] for t, _ in g)) for s, g in grids.items()}
    for part, cycle, of in ((F.hour, "week", lambda t: t.hour), (F.weekday, "week", lambda t: t.weekday()), (F.month, "month", lambda t: t.month)):
        want = {}
        for s, g in grids.items():
            cells = {}
            for t, known in g:
                cells.setdefault(of(epoch + dt.timedelta(seconds=t)), []).append(not known)
            if any(map(any, cells.values())):
                want |= {(s, p): pytest.approx(100 * sum(c) / len(c)) for p, c in cells.items()}
        assert {(r["station"], r["part"]): r["pct_missing"] for r in gaps.missing_share(df, part, step=step, cycle=cycle, block=3 * 86400).collect()} == want
    want = set()
    for s, g in grids.items():
        run = []
        for t, known in [*g, (None, True)]:
            if known and run:
                want.add((s, run[0], run[-1], len(run)))
            run = [] if known else [*run, t]
    seconds = lambda t: int((t - epoch).total_seconds())
    got = gaps.missing_blocks(df, step=step, block=3 * 86400).collect()
    assert {(r["station"], seconds(r["start"]), seconds(r["end"]), r["n_rows"]) for r in got} == want and len(got) == len(want)


def test_a_wrong_time_costs_nothing(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=1), 1.0), ("a", dt.datetime(9000, 1, 1), 1.0)], "station string, time timestamp_ntz, value double")
    n = int((dt.datetime(9000, 1, 1) - T0).total_seconds()) // 900 + 1
    assert gaps.missing_slots(df).first()["n_missing"] == n - 3
    assert sorted(r["n_rows"] for r in gaps.missing_blocks(df).collect()) == [3, n - 6]
    hours = gaps.missing_share(df, F.hour).collect()
    assert len(hours) == 24 and all(r["pct_missing"] > 99.99 for r in hours)
    assert len(gaps.missing_share(df, F.month, cycle="month").collect()) == 12


def test_a_local_fit_of_unsorted_short_and_equal_points(spark):
    rows = [("one", 1, 0.0, 5.0), ("same", 1, 2.0, 1.0), ("same", 2, 2.0, 4.0), ("same", 3, 2.0, 7.0)] + [("line", i, float(i), 2.0 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "station string, time int, x double, value double")
    got = {(r["station"], r["time"]): r["smooth"] for r in status.lowess(df.repartition(5).withColumn("time", F.timestamp_seconds("time").cast("timestamp_ntz")), 0.9)
           .withColumn("time", F.unix_seconds(F.col("time").cast("timestamp"))).collect()}
    assert got["one", 1] is None and [got["same", i] for i in (1, 2, 3)] == [1.0, 4.0, 7.0]
    assert all(got["line", i] == pytest.approx(2.0 * i) for i in range(50))


def test_sweep_equals_separate_fits(spark):
    rng = np.random.default_rng(5)
    series = {"a": rng.normal(size=200).cumsum(), "b": rng.normal(size=45), "c": np.array([1.0, 2.0, 3.0])}
    df = make(spark, {s: [None if s == "a" and i == 30 else v for i, v in enumerate(x)] for s, x in series.items()})
    lengths, folds = [1, 4, 7], 3
    got = {(r["station"], r["fold"], r["length"]): r for r in sweep.length_sweep(df, lengths, folds, block=30_000).collect()}
    for s, x in series.items():
        n, size = len(x), len(x) // (folds + 1)
        x = np.where((np.arange(n) == 30) & (s == "a"), np.nan, x)
        rows = [i for i in range(7, n) if not np.isnan(x[i - 7:i + 1]).any()]
        for f in range(1, folds + 1):
            start = n - (folds + 1 - f) * size
            train, test = [i for i in rows if i < start], [i for i in rows if start <= i < start + size]
            for k in lengths:
                if not train or not test:
                    assert (s, f, k) not in got
                    continue
                design = lambda at: np.array([[1, *x[i - k:i][::-1]] for i in at])
                fit = np.linalg.lstsq(design(train), x[train], rcond=None)[0]
                r = got[s, f, k]
                assert (r["n_train"], r["n_test"]) == (len(train), len(test))
                if len(train) > 12:
                    assert [r["intercept"], *r["weights"]] == pytest.approx(fit, rel=1e-6, abs=1e-8)
                    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((design(test) @ fit - x[test]) ** 2)), rel=1e-6)
    best = {r["station"]: r["length"] for r in sweep.best_length(sweep.length_sweep(df, lengths, folds)).collect()}
    assert set(best) == {"a", "b"}


def test_forecast_of_a_long_horizon(spark):
    season, n = 4, 100_000
    state = spark.createDataFrame([("a", [float(i % season) for i in range(2 * season + 2)], 10, 0.3, 0.2, n), ("b", [1.0], 1, 0.1, 0.1, 3),
                                   ("c", [1.0] * 12, 12, None, 0.1, 2)], "station string, _ys array<double>, _end long, phi double, seasonal_phi double, _h long")
    got = forecast.forecast_path(state, "station", season).collect()
    a = {r["rn"]: r["prediction"] for r in got if r["station"] == "a"}
    assert len(a) == n and all(a[11 + i] == pytest.approx((10 + i) % season, abs=1e-3) for i in range(0, n, 997))
    assert [(r["rn"], r["prediction"]) for r in got if r["station"] == "b"] == [(2, None), (3, None), (4, None)]
    assert all(r["prediction"] is None for r in got if r["station"] == "c")
