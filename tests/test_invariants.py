"""Random series against pandas, numpy and brute force; independence of partitions and blocks."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators import blocks, features, gaps, grid, impute, lowess, quality, spatial, stats
from sluice.operators.decompose import decompose
from sluice.operators.quantiles import exact_quantiles
from sluice.plans import forecast

from .conftest import column


def random_values(seed, n, nulls=0.25):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(20, 15, n), 3)
    v[rng.random(n) < nulls] = np.nan
    return v


def frame(spark, seed, n=400, nulls=0.25, stations=("a", "b"), step=900):
    parts = []
    for i, s in enumerate(stations):
        t = pd.date_range("2024-01-01", periods=n, freq=f"{step}s")
        parts.append(pd.DataFrame({"station": s, "time": t, "value": random_values(seed + i, n, nulls), "slot": range(n)}))
    pdf = pd.concat(parts).sample(frac=1, random_state=seed)
    df = spark.createDataFrame(pdf, "station string, time timestamp_ntz, value double, slot bigint")
    return pdf.sort_values(["station", "time"]), df.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))


def got(df, *cols):
    return df.toPandas().sort_values(["station", "time"])[list(cols)].to_numpy(dtype=float)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ewma_equals_pandas(spark, seed):
    pdf, df = frame(spark, seed, 500)
    specs = {"e2": ("value", 2), "e24": ("value", 24), "e100": ("value", 100)}
    out = got(features.ewma(df.withColumn("rn", F.col("slot") + 1), "station", "rn", specs, rows=8, fan=5), *specs)
    for j, span in enumerate((2, 24, 100)):
        want = pdf.groupby("station")["value"].transform(lambda s, k=span: s.ewm(span=k, adjust=False).mean()).to_numpy()
        np.testing.assert_allclose(out[:, j], want, rtol=1e-9, equal_nan=True)


def test_ewma_over_a_very_long_gap(spark):
    values = [5.0] + [None] * 3000 + [7.0, 9.0]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0 + dt.timedelta(minutes=i), v, i + 1) for i, v in enumerate(values)], "station string, time timestamp_ntz, value double, rn bigint")
    out = column(features.ewma(df, "station", "rn", {"e": ("value", 3)}), "e")
    want = pd.Series(values).ewm(span=3, adjust=False).mean()
    np.testing.assert_allclose(out, want, rtol=1e-9)


@pytest.mark.parametrize("block", [3600, 86400, 30 * 86400])
def test_fills_do_not_depend_on_blocks(spark, block):
    pdf, df = frame(spark, 5, 300, 0.6)
    want = pdf.groupby("station")["value"].transform(lambda s: s.interpolate("linear")).to_numpy()
    np.testing.assert_allclose(got(impute.linear_fill(df, block=block), "value")[:, 0], want, equal_nan=True)
    want = pdf.groupby("station")["value"].transform(lambda s: s.ffill(limit=2)).to_numpy()
    np.testing.assert_allclose(got(impute.forward_fill(df, limit=2, block=block), "value")[:, 0], want, equal_nan=True)


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_partition_independence(spark, partitions):
    _, df = frame(spark, 9, 300)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = df.repartition(partitions)
        out = got(impute.river_clean(rows.drop("slot"), block=7200), "value")
        rn = features.numbered(rows, block=7200).filter("rn != slot + 1").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rn == 0
    pdf, _ = frame(spark, 9, 300)
    v = pdf["value"].where(pdf["value"] >= 0)
    keys = [pdf["station"], pdf["time"].dt.month, pdf["time"].dt.hour]
    want = v.fillna(v.groupby(keys).transform("mean"))
    np.testing.assert_allclose(out[:, 0], want.to_numpy(), equal_nan=True)


def test_grid_invariants(spark):
    _, df = frame(spark, 4, 200, 0)
    holes = df.filter("slot % 7 != 5")
    g = grid.on_grid(holes, "station", 900, anchored=True)
    assert g.filter("station = 'a'").count() == 200
    known = gaps.missing_slots(holes).filter("station = 'a'").first()
    assert known["n_expected"] - known["n_missing"] == holes.filter("station = 'a'").count()


def test_runs_partition_the_rows(spark):
    pdf, df = frame(spark, 12, 500, 0)
    rows = df.withColumn("quality", F.when(F.col("value") > 20, "Good").otherwise("Suspect"))
    runs = quality.label_runs(rows, block=3600)
    assert runs.agg(F.sum("n_rows")).first()[0] == 1000
    good = (pdf["value"] > 20).to_numpy()
    station = pdf["station"].to_numpy()
    changes = 1 + int(((good[1:] != good[:-1]) | (station[1:] != station[:-1])).sum())
    assert runs.count() == changes


@pytest.mark.parametrize("keys", [["station"], []])
def test_quantiles_equal_numpy(spark, keys):
    pdf, df = frame(spark, 21, 777)
    probs = {"q0": 0.0, "q1": 0.01, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    out = exact_quantiles(df, keys, "value", probs).toPandas()
    groups = pdf.groupby("station") if keys else [(None, pdf)]
    for name, group in groups:
        row = out[out["station"] == name].iloc[0] if keys else out.iloc[0]
        for q, p in probs.items():
            assert row[q] == pytest.approx(np.nanquantile(group["value"], p), abs=1e-12)


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(1000).select(F.lit("a").alias("station"), F.lit(-3.5).alias("value"))
    assert exact_quantiles(df, "station", "value", {"q": 0.3}).first()["q"] == -3.5


def test_row_windows_equal_pandas(spark):
    pdf, df = frame(spark, 31, 300, 0.1)
    rows = df.withColumn("rn", F.col("slot") + 1)
    haloed = blocks.with_halo(rows, "station", "rn", 23, 6, rows=50)
    w, roll = features.frames("station", "rn")
    out = blocks.core(haloed.withColumns({
        "lag5": F.lag("value", 5).over(w), "lead6": F.lead("value", 6).over(w),
        "mean24": F.when(F.count("value").over(roll(24)) == 24, F.avg("value").over(roll(24))),
    }))
    assert out.count() == 600
    have = got(out, "lag5", "lead6", "mean24")
    by = pdf.groupby("station")["value"]
    np.testing.assert_allclose(have[:, 0], by.shift(5), equal_nan=True)
    np.testing.assert_allclose(have[:, 1], by.shift(-6), equal_nan=True)
    np.testing.assert_allclose(have[:, 2], by.transform(lambda s: s.rolling(24).mean()), equal_nan=True)


def brute_lowess(x, y, frac, passes):
    n = len(x)
    k = int(frac * n + 1e-10)
    robust = np.ones(n)
    fit = None
    for step in range(passes + 1):
        fit = np.empty(n)
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            u = d / h
            w = np.where(u < 1, (1 - u**3) ** 3, 0) * robust
            dx = x - x[i]
            sw, sx, sy, sxx, sxy = w.sum(), (w * dx).sum(), (w * y).sum(), (w * dx * dx).sum(), (w * dx * y).sum()
            fit[i] = (sxx * sy - sx * sxy) / (sw * sxx - sx * sx)
        if step < passes:
            e = np.abs(y - fit)
            u = e / (6 * np.median(e))
            robust = np.where(u < 1, (1 - u**2) ** 2, 0)
    return fit


@pytest.mark.parametrize("passes", [0, 3])
def test_lowess_equals_brute_force(spark, passes):
    rng = np.random.default_rng(8)
    x = np.sort(rng.choice(400, 120, replace=False)).astype(float)
    y = np.sin(x / 40) + rng.normal(0, 0.3, 120)
    t = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=float(v)) for v in x]
    df = spark.createDataFrame([("a", a, float(b), float(c)) for a, b, c in zip(t, x, y)], "station string, time timestamp_ntz, x double, value double")
    out = lowess.lowess(df, 0.2, passes=passes).orderBy("time").toPandas()["smooth"].to_numpy()
    np.testing.assert_allclose(out, brute_lowess(x, y, 0.2, passes), rtol=1e-8)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_k_nearest_equals_brute_force(spark, k):
    rng = np.random.default_rng(3)
    lat = np.concatenate([rng.uniform(-89, 89, 80), rng.normal(50, 0.01, 60), [10.0] * 20])
    lon = np.concatenate([rng.uniform(-180, 180, 80), rng.normal(-5, 0.01, 60), [179.99] * 20])
    stations = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))], "station_id bigint, lat double, lon double")
    plat, plon = np.array([50.0, 89.9, 10.0, -45.0]), np.array([-5.0, 0.0, -179.99, 100.0])
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(plat, plon))], "point_id bigint, lat double, lon double")
    out = spatial.k_nearest(points, stations, k).toPandas()
    for i in range(4):
        p1, p2 = np.radians(plat[i]), np.radians(lat)
        h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon - plon[i]) / 2) ** 2
        d = 2 * 6371.0088 * np.arcsin(np.sqrt(h))
        mine = out[out["point_id"] == i].sort_values("rank")
        assert len(mine) == min(k, len(lat))
        np.testing.assert_allclose(np.sort(d)[:k], mine["distance_km"], atol=1e-6)


@pytest.mark.parametrize("ground", [False, True])
def test_within_distance_equals_brute_force(spark, ground):
    rng = np.random.default_rng(6)
    rows = [(i, float(50 + rng.normal(0, 0.2)), float(-5 + rng.normal(0, 0.2))) for i in range(120)]
    points = spark.createDataFrame(rows[:40], "point_id bigint, lat double, lon double")
    stations = spark.createDataFrame(rows[40:], "station_id bigint, lat double, lon double")
    out = spatial.within_distance(points, stations, 15000, ground=ground)
    both = points.withColumnsRenamed({"lat": "a", "lon": "b"}).join(stations, F.lit(True))
    from sluice.functions.geo import haversine_km, mercator_x, mercator_y

    d = haversine_km("a", "b", "lat", "lon") * 1000 if ground else F.sqrt(
        F.pow(mercator_x("b") - mercator_x("lon"), F.lit(2)) + F.pow(mercator_y("a") - mercator_y("lat"), F.lit(2)))
    want = {(r[0], r[1]) for r in both.filter(d <= 15000).select("point_id", "station_id").collect()}
    assert {(r["point_id"], r["station_id"]) for r in out.collect()} == want and want


@pytest.mark.parametrize("metres", [300.0, 40_000.0, 9_000_000.0])
def test_ground_distance_at_poles_and_date_line(spark, metres):
    """Cells that the circle does not meet are left out; the rest still hold every pair, with the columns asked for."""
    rng = np.random.default_rng(8)
    lat = np.concatenate([rng.uniform(-90, 90, 60), 90 - rng.exponential(0.2, 60), rng.normal(0, 0.2, 60), rng.normal(50, 0.002, 60)])
    lon = np.concatenate([rng.uniform(-180, 180, 120), 180 - rng.exponential(0.2, 30), -180 + rng.exponential(0.2, 30), rng.normal(-5, 0.002, 60)])
    rows = [(i, float(a), float(b), i * 10) for i, (a, b) in enumerate(zip(lat, lon))]
    points = spark.createDataFrame(rows[::2], "point_id bigint, lat double, lon double, tag bigint")
    stations = spark.createDataFrame([r[:3] for r in rows[1::2]], "station_id bigint, lat double, lon double")
    out = spatial.within_distance(points, stations, metres, ground=True, keep=("tag",)).toPandas()
    assert (out["tag"] == out["point_id"] * 10).all()
    p, q = np.radians(lat), np.radians(lon)
    h = np.sin((p[:, None] - p) / 2) ** 2 + np.cos(p[:, None]) * np.cos(p) * np.sin((q[:, None] - q) / 2) ** 2
    d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(h, 1)))
    want = {(i, j) for i in range(0, 240, 2) for j in range(1, 240, 2) if d[i, j] <= metres}
    assert set(zip(out["point_id"], out["station_id"])) == want and len(out) == len(want) > 0


def test_pair_lines_join_no_pairs(spark, tmp_path):
    """Against the SQL twin; the plan joins points with points and points with stations, but no pairs with either."""
    import check
    from sluice.queries import ORACLE, QUERIES

    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b)], i % 10) for i, (a, b) in enumerate(rng.normal(0, 0.1, (200, 2)))]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = check.duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    name = "j13_pair_lines"
    status, note, _ = check.compare(spark, con, str(tmp_path), name, QUERIES[name], ORACLE[name])
    assert status == "ok", note
    plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = [i for i, line in enumerate(plan) if "Join" in line]
    assert "_salt" in plan[above[0]], plan[above[0]]  # the topmost join makes the pairs


def test_extrapolated_trend_is_a_line(spark):
    _, df = frame(spark, 2, 100, 0, stations=("a",))
    rows = df.withColumn("value", F.col("slot") * 2.0)
    out = decompose(rows, 6, extrapolate=True).orderBy("time").collect()
    np.testing.assert_allclose([r["trend"] for r in out], np.arange(100) * 2.0, atol=1e-9)


def test_moments_of_a_shifted_series_are_stable(spark):
    df = spark.range(1000).select(F.lit("a").alias("station"), (F.lit(1e9) + F.col("id") % 10).alias("value"),
                                  F.timestamp_seconds(F.col("id") * 900).cast("timestamp_ntz").alias("time"))
    r = blocks.with_moments(blocks.in_blocks(df, "station", block=3600), "station", "value").select("mean", "std").first()
    v = 1e9 + np.arange(1000) % 10
    assert r["std"] == pytest.approx(v.std(ddof=1), rel=1e-9) and r["mean"] == pytest.approx(v.mean())


def test_suggested_block_follows_density(spark):
    df = spark.range(10000).select(F.lit("a").alias("station"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("time"))
    seconds = blocks.suggest_block(df, "station", target_rows=500)
    assert 60 <= seconds <= 500 * 60


def test_vif_and_pacf(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    b = a + rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    r = np.corrcoef(a, b)[0, 1]
    assert stats.vif(df, ["a", "b"]).first()["vif"] == pytest.approx(1 / (1 - r * r))
    assert stats.pacf_from_acf([0.5, 0.25, 0.125]) == pytest.approx([0.5, 0, 0])


def test_folds_cover_the_tail_once(spark):
    _, df = frame(spark, 3, 103, 0, stations=("a",))
    folds = forecast.expanding_folds(df, 5)
    test = folds.filter("role = 'test'")
    assert test.count() == test.select("time").distinct().count() == 5 * (103 // 6)
    assert folds.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("time"))).alias("a"), F.min(F.when(F.col("role") == "test", F.col("time"))).alias("b")).filter("a >= b").count() == 0


def test_seasonal_ar_continues_a_clean_pattern(spark):
    n, m = 24 * 20, 24
    rng = np.random.default_rng(0)
    values = [np.sin(2 * np.pi * i / m) * 3 + 0.01 * i + rng.normal(0, 0.01) for i in range(n)]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0 + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values)], "station string, time timestamp_ntz, value double")
    metrics, predictions = forecast.evaluate(df, forecast.SeasonalAR(m), 48)
    assert predictions.count() == 48
    assert metrics.first()["rmse"] < 0.5


def test_tree_model_runs_over_all_stations(spark):
    _, df = frame(spark, 77, 300, 0)
    rows = df.withColumn("x", F.col("slot") % 10).withColumn("value", F.col("x") * 2.0)
    model = forecast.TreeModel(["x"], kind="boosted", maxIter=5)
    metrics, predictions = forecast.evaluate(rows.drop("slot"), model, 50)
    assert predictions.count() == 100 and metrics.count() == 2
    assert metrics.filter("r2 > 0.9").count() == 2
    assert model.importance().count() == 2
