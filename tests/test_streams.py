"""Several micro-batches, late rows and state across batches."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.streaming import jobs

SCHEMA = "station string, time timestamp, value double"


def land(spark, folder, batches):
    """One parquet folder per batch, in order of arrival."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(s, dt.datetime.fromisoformat(t), v) for s, t, v in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(folder)
        import os
        import time

        stamp = time.time() - 1000 + i * 10
        for f in os.listdir(folder):
            p = f"{folder}/{f}"
            if p not in land.seen:
                land.seen.add(p)
                os.utime(p, (stamp, stamp))


land.seen = set()


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return jobs.read_stream(spark, folder, schema, files="*.parquet", per_trigger=1)


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, [
        [("a", "2024-01-01 00:05", 1.0), ("a", "2024-01-01 00:20", 3.0)],
        [("a", "2024-01-01 06:00", 5.0)],
        [("a", "2024-01-01 06:20", 6.0)],  # the bound that drops rows lags the watermark by one batch
        [("a", "2024-01-01 00:06", 100.0)],
        [("a", "2024-01-01 12:00", 7.0)],
    ])
    out = jobs.drain(jobs.tumbling_mean(stream(spark, folder)), "late", str(tmp_path / "out"))
    rows = {r["time"].strftime("%H:%M"): (r["value"], r["n"]) for r in out.collect()}
    assert rows["00:00"] == (1.0, 1) and rows["00:15"] == (3.0, 1) and rows["06:00"] == (5.0, 1)
    assert "12:00" not in rows


def test_duplicates_across_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, [[("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 00:00", 2.0)], [("a", "2024-01-01 00:00", 3.0), ("a", "2024-01-01 00:15", 4.0)]])
    out = jobs.drain(jobs.deduplicated(stream(spark, folder)), "dedup", str(tmp_path / "out"))
    assert out.count() == 2


def test_smoothing_carries_state(spark, tmp_path):
    folder = str(tmp_path / "in")
    values = [3.0, None, 4.0, 8.0, None, None, 1.0, 2.0]
    rows = [("a", f"2024-01-01 0{i}:00", v) for i, v in enumerate(values)]
    land(spark, folder, [rows[:3], rows[3:5], rows[5:]])
    out = jobs.drain(jobs.online_smooth(stream(spark, folder), span=3), "smooth", str(tmp_path / "out")).orderBy("time").toPandas()
    want = pd.Series(values).ewm(span=3, adjust=False).mean()
    np.testing.assert_allclose(out["smooth"], want)
    assert out["last_known"].tolist() == pytest.approx(pd.Series(values).ffill().tolist())


def test_timed_smoothing_follows_event_time(spark, tmp_path):
    """Batches arrive out of order; hours fold in order once the watermark has passed them, and what comes later is marked."""
    folder = str(tmp_path / "in")
    land(spark, folder, [
        [("a", "2024-01-01 00:50", 3.0), ("a", "2024-01-01 00:10", 1.0), ("b", "2024-01-01 00:20", 7.0), ("a", "2024-01-01 01:30", 5.0)],
        [("a", "2024-01-01 00:30", None), ("a", "2024-01-01 01:10", 2.0), ("b", "2024-01-01 06:00", 1.0)],
        [("a", "2024-01-01 00:40", 9.0), ("a", "2024-01-01 08:00", 4.0), ("b", "2024-01-01 04:00", 8.0)],
        [("b", "2024-01-01 20:00", 0.0)],
    ])
    out = jobs.drain(jobs.timed_smooth(stream(spark, folder), span=3, lateness="1 hour"), "timed", str(tmp_path / "out"))
    rows = [(r["station"], f"{r['time']:%H:%M}", r["value"], r["last_known"], r["smooth"], r["late"]) for r in out.collect()]
    want = pd.Series([1.0, None, 3.0, 2.0, 5.0, 4.0]).ewm(span=3, adjust=False).mean().tolist()
    times = ["00:10", "00:30", "00:50", "01:10", "01:30", "08:00"]
    a = sorted(r for r in rows if r[0] == "a" and not r[5])
    assert [r[1] for r in a] == times and [r[4] for r in a] == pytest.approx(want) and [r[3] for r in a] == [1.0, 1.0, 3.0, 2.0, 5.0, 4.0]
    assert sorted(r for r in rows if r[5]) == [("a", "00:40", 9.0, None, None, True), ("b", "04:00", 8.0, None, None, True)]
    assert sorted((r[1], r[4]) for r in rows if r[0] == "b" and not r[5]) == [("00:20", 7.0), ("06:00", 4.0)]


def test_a_reading_meets_one_hour_of_weather(spark, tmp_path):
    river, weather = str(tmp_path / "river"), str(tmp_path / "weather")
    land(spark, river, [[("a", "2024-01-01 00:10", 1.0), ("a", "2024-01-01 00:40", 2.0), ("b", "2024-01-01 00:40", 3.0)], [("a", "2024-01-01 09:00", 4.0)]])
    land(spark, weather, [[("a", f"2024-01-01 00:{m}", float(m)) for m in range(10, 30)], [("a", "2024-01-01 09:30", 1.0), ("a", "2024-01-01 00:59", 5000.0)]])
    rain = stream(spark, weather).withColumnRenamed("value", "rain")
    out = jobs.drain(jobs.river_with_hourly_weather(stream(spark, river), rain), "joined", str(tmp_path / "out"))
    assert len(out.collect()) == 2 and {(r["value"], r["n_rain"] >= 20) for r in out.collect()} == {(1.0, True), (2.0, True)}


def test_a_crowded_hour_is_joined_in_packs(spark, tmp_path):
    """300 readings meet 200 weather rows of their hour: all 60,000 pairs come out, and none of them is written."""
    river, weather = str(tmp_path / "river"), str(tmp_path / "weather")
    at = lambda i: f"2024-01-01 00:{i // 60 % 60:02}:{i % 60:02}"
    land(spark, river, [[("a", at(i), float(i)) for i in range(300)] + [("b", "2024-01-01 00:30", None), ("c", "2024-01-01 00:30", 1.0)],
                        [("a", "2024-01-01 00:59", 1000.0), ("a", "2024-01-01 01:00", 2000.0)]])
    land(spark, weather, [[("a", at(i), float(i)) for i in range(200)] + [("b", "2024-01-01 00:10", 7.0), ("b", "2024-01-01 00:20", None)]])
    rain = stream(spark, weather).withColumnRenamed("value", "rain")
    packs = jobs.drain(jobs.river_with_weather(stream(spark, river), rain), "packs", str(tmp_path / "out"))
    assert packs.count() <= 10
    rows = [(r["station"], r["time"].strftime("%H:%M:%S"), r["value"], r["rain"]) for r in jobs.laid_out(packs).collect()]
    want = [("a", at(i)[11:], float(i), float(j)) for i in range(300) for j in range(200)]
    want += [("a", "00:59:00", 1000.0, float(j)) for j in range(200)] + [("b", "00:30:00", None, x) for x in (7.0, None)]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def rows_made(plan):
    """Rows that each explode of an executed plan made."""
    while (name := plan.nodeName()).startswith("AdaptiveSparkPlan") or name.endswith("QueryStage"):
        plan = plan.executedPlan() if name.startswith("Adaptive") else plan.plan()
    below = plan.children()
    own = [plan.metrics().apply("numOutputRows").value()] if name == "Generate" else []
    return own + [n for i in range(below.size()) for n in rows_made(below.apply(i))]


def test_a_pack_is_laid_out_slice_by_slice(spark, tmp_path):
    """The first pair of 1000 x 1000 is there before the others are made, whose number no task has to hold."""
    numbers = lambda n, null: f"transform(sequence(1, {n}), i -> if(i = {null}, null, double(i)))"
    spark.range(1).selectExpr("'a' as station", "transform(sequence(1, 1000), i -> i * 1000000L) as time", f"{numbers(1000, 7)} as value",
                              f"{numbers(1000, 3)} as rain").write.parquet(str(tmp_path / "packs"))
    packs = spark.read.parquet(str(tmp_path / "packs"))
    first = jobs.laid_out(packs).limit(1)
    assert len(first.collect()) == 1
    made = rows_made(first._jdf.queryExecution().executedPlan())
    assert made and max(made) <= jobs.PAIRS, made
    pairs = jobs.laid_out(packs, naive=True)
    assert dict(pairs.dtypes) == {"station": "string", "time": "timestamp_ntz", "value": "double", "rain": "double"}
    got = pairs.agg(F.count(F.lit(1)), F.count_distinct("time", F.coalesce("rain", F.lit(3.0))), F.sum("value"), F.sum("rain"),
                    F.count_if(F.col("value") != F.unix_seconds(F.col("time").cast("timestamp")))).first()
    assert tuple(got) == (10**6, 10**6, 1000.0 * (500500 - 7), 1000.0 * (500500 - 3), 0)


@pytest.mark.parametrize("pairs", [1, 7, 40, 1000])
def test_slices_hold_every_pair_once(spark, pairs):
    packs = spark.createDataFrame([("a", list(range(13)), [float(i) for i in range(13)], [0.5, None, 0.5]), ("b", [1], [None], [None]),
                                   ("c", [1, 1], [2.0, None], [float(i) for i in range(9)])],
                                  "station string, time array<bigint>, value array<double>, rain array<double>")
    rows = jobs.sliced(packs, pairs).collect()
    assert all(len(r["time"]) == len(r["value"]) and (len(r["time"]) == 1 or len(r["time"]) * len(r["rain"]) <= pairs) for r in rows)
    laid = lambda rs: sorted(((r["station"], t, v, w) for r in rs for t, v in zip(r["time"], r["value"]) for w in r["rain"]), key=repr)
    assert laid(rows) == laid(packs.collect())


def test_packs_are_cut_at_their_size(spark):
    rows = spark.range(25).selectExpr("if(id = 24, null, if(id < 10, 'a', 'b')) as station", "timestamp'2024-01-01 00:00:00' as hour",
                                      "if(id % 5 = 0, null, double(id)) as value").coalesce(1)
    out = jobs.packed(rows, ["value"], size=4).collect()
    assert sorted((r["station"], len(r["value"])) for r in out) == [("a", 2), ("a", 4), ("a", 4), ("b", 2), ("b", 4), ("b", 4), ("b", 4)]
    assert sorted(v for r in out for v in r["value"] if v is not None) == [float(i) for i in range(24) if i % 5]
