"""Streaming jobs run to the end of the available data, checked against the batch result.

Open windows stay inside the stream: the twins keep windows that end before the watermark, which is
the latest time less the lateness bound.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_path
from ..streaming import jobs
from .base import gauge, query, table, tidy


def events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return jobs.read_stream(spark, sf, schema, files="events.parquet")


def readings(spark, sf):
    return events_stream(spark, sf).select(
        F.col("event_type").alias("station"), F.col("ts").cast("timestamp").alias("time"), (F.col("value") - 5).alias("value"), "event_id")


def naive(df):
    """Timestamps back to naive UTC."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema.fields])


def plain(df):
    return tidy(naive(df))


MARK = "(SELECT max(ts) - INTERVAL '1 hour' FROM events)"


@query("st1_stream_ingest", """SELECT CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS station, CASE WHEN event_id % 37 = 0 THEN NULL ELSE ts END AS time,
 round(CASE WHEN event_id % 17 <> 0 AND value - 5 >= 0 THEN value - 5 END + 1e-9, 6) AS value, event_id % 31 = 0 OR event_id % 37 = 0 AS quarantined FROM events""")
def st1_stream_ingest(spark, sf):
    """ST1: dirty text in, typed readings and quarantined rows out, partitioned apart."""
    raw = events_stream(spark, sf).select(
        F.when(F.col("event_id") % 31 != 0, F.col("event_type")).alias("station"),
        F.when(F.col("event_id") % 37 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(F.lit("soon")).alias("time"),
        F.when(F.col("event_id") % 17 != 0, (F.col("value") - 5).cast("string")).otherwise(F.lit("n/a")).alias("value"))
    return plain(jobs.drain(jobs.ingest(raw), "ingest", partition="quarantined"))


@query("st2_stream_dedup", "SELECT event_type AS station, time_bucket(INTERVAL '30 minutes', ts) AS time FROM events GROUP BY 1, 2")
def st2_stream_dedup(spark, sf):
    """ST2: one row per station and half hour; which copy is kept depends on arrival."""
    half = readings(spark, sf).withColumn("time", F.window("time", "30 minutes").start)
    return plain(jobs.drain(jobs.deduplicated(half).select("station", "time"), "dedup"))


def _closed(width: str, agg: str) -> str:
    return f"""SELECT station, time, until, {agg}, n FROM (SELECT event_type AS station, time_bucket(INTERVAL '{width}', ts) AS time,
 time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS until, round(avg(value - 5) + 1e-9, 6) AS value, count(*) AS n FROM events GROUP BY 1, 2, 3) WHERE until <= {MARK}"""


@query("st3_stream_quarter_mean", _closed("15 minutes", "value"))
def st3_stream_quarter_mean(spark, sf):
    return plain(jobs.drain(jobs.tumbling_mean(readings(spark, sf)), "quarter"))


@query("st3_stream_hourly_mean", _closed("1 hour", "value"))
def st3_stream_hourly_mean(spark, sf):
    return plain(jobs.drain(jobs.tumbling_mean(readings(spark, sf), "1 hour"), "hourly"))


def _sliding(h: int) -> str:
    return f"""WITH w AS (SELECT event_type AS station, unnest(generate_series(time_bucket(INTERVAL '1 hour', ts) - INTERVAL '{h - 1} hours', time_bucket(INTERVAL '1 hour', ts), INTERVAL '1 hour')) AS time, value FROM events)
SELECT station, time, time + INTERVAL '{h} hours' AS until, round(sum(value - 5) + 1e-9, 6) AS total, count(*) AS n FROM w GROUP BY 1, 2 HAVING time + INTERVAL '{h} hours' <= {MARK}"""


@query("st4_stream_rain_3h", _sliding(3))
def st4_stream_rain_3h(spark, sf):
    return plain(jobs.drain(jobs.sliding_total(readings(spark, sf), "3 hours"), "rain3"))


@query("st4_stream_rain_24h", _sliding(24))
def st4_stream_rain_24h(spark, sf):
    return plain(jobs.drain(jobs.sliding_total(readings(spark, sf), "24 hours"), "rain24"))


@query("st5_stream_sessions", f"""WITH g AS (SELECT event_type AS station, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL '40 minutes' THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
i AS (SELECT station, ts, sum(s) OVER (PARTITION BY station ORDER BY ts) AS k FROM g)
SELECT station, min(ts) AS first_time, max(ts) AS last_time, count(*) AS n FROM i GROUP BY station, k HAVING max(ts) + INTERVAL '40 minutes' <= {MARK}""")
def st5_stream_sessions(spark, sf):
    """ST5: activity sessions closed by 40 silent minutes; each end is an outage."""
    return plain(jobs.drain(jobs.sessions(readings(spark, sf), "40 minutes"), "sessions"))


@query("st6_stream_alerts", """WITH d AS (SELECT event_type AS station, avg(value - 5) + 2 * stddev_samp(value - 5) AS high, 0.9 * max(value - 5) AS rec FROM events GROUP BY 1)
SELECT station, ts AS time, round(value - 5 + 1e-9, 6) AS value, round(high + 1e-9, 6) AS high_mark, value - 5 > rec AS is_record FROM events JOIN d ON station = event_type WHERE value - 5 >= high""")
def st6_stream_alerts(spark, sf):
    """ST6: alerts against per-station marks from the batch table."""
    marks = gauge(spark, sf).groupBy("station").agg(
        (F.avg("value") + 2 * F.stddev_samp("value")).alias("percentile5"), (F.max("value") * 0.9).alias("por_max"))
    path = work_path(spark, "marks")
    marks.write.parquet(path)
    return plain(jobs.drain(jobs.threshold_alerts(readings(spark, sf), spark.read.parquet(path)), "alerts"))


@query("st7_stream_join", """WITH w AS (SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS h, value AS rain FROM events)
SELECT event_type AS station, ts AS time, round(value - 5 + 1e-9, 6) AS value, round(rain + 1e-9, 6) AS rain FROM events JOIN w ON w.station = event_type AND w.h = time_bucket(INTERVAL '1 hour', ts)""")
def st7_stream_join(spark, sf):
    """ST7: readings joined with all weather rows of their station and hour, both as streams.

    Values are rounded and times made naive once a row and not once a pair."""
    weather = events_stream(spark, sf).select(
        F.col("event_type").alias("station"), F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("rain"))
    return jobs.laid_out(jobs.drain(jobs.river_with_weather(tidy(readings(spark, sf)), tidy(weather)), "join"), naive=True)


@query("st7_stream_hourly_join", f"""WITH w AS (SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS h, avg(value) AS rain, count(*) AS n_rain FROM events GROUP BY 1, 2)
SELECT event_type AS station, ts AS time, round(value - 5 + 1e-9, 6) AS value, round(rain + 1e-9, 6) AS rain, n_rain
FROM events JOIN w ON w.station = event_type AND w.h = time_bucket(INTERVAL '1 hour', ts) WHERE h + INTERVAL '1 hour' <= {MARK}""")
def st7_stream_hourly_join(spark, sf):
    """ST7: readings joined with the hourly mean of the weather stream; every reading of a closed hour comes out once."""
    weather = events_stream(spark, sf).select(
        F.col("event_type").alias("station"), F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("rain"))
    return plain(jobs.drain(jobs.river_with_hourly_weather(readings(spark, sf), weather), "hourly-join"))


@query("st8_stream_smooth", """WITH RECURSIVE g AS (SELECT event_type AS station, ts AS time, CASE WHEN value >= 10 THEN value - 5 END AS value, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM events),
e AS (SELECT station, rn, time, value, value AS y, value AS last, 1.0::DOUBLE AS w FROM g WHERE rn = 1
 UNION ALL SELECT e.station, g.rn, g.time, g.value,
  CASE WHEN e.y IS NULL THEN g.value WHEN g.value IS NULL THEN e.y ELSE (e.w * 0.92 * e.y + 0.08 * g.value) / (e.w * 0.92 + 0.08) END,
  coalesce(g.value, e.last), CASE WHEN e.y IS NULL OR g.value IS NOT NULL THEN 1.0 ELSE e.w * 0.92 END
 FROM e JOIN g ON g.station = e.station AND g.rn = e.rn + 1)
SELECT station, time, round(value + 1e-9, 6) AS value, round(last + 1e-9, 6) AS last_known, round(y + 1e-9, 6) AS smooth FROM e""")
def st8_stream_smooth(spark, sf):
    """ST8: running weighted mean with span 24 and last known value, as keyed state."""
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") >= 5, F.col("value"))).select("station", "time", "value")
    return plain(jobs.drain(jobs.online_smooth(rows), "smooth"))


@query("st8_stream_smooth_timed", f"""WITH RECURSIVE g AS (SELECT event_type AS station, ts AS time, CASE WHEN value >= 10 THEN value - 5 END AS value, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn
 FROM events WHERE time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= {MARK}),
e AS (SELECT station, rn, time, value, value AS y, value AS last, 1.0::DOUBLE AS w FROM g WHERE rn = 1
 UNION ALL SELECT e.station, g.rn, g.time, g.value,
  CASE WHEN e.y IS NULL THEN g.value WHEN g.value IS NULL THEN e.y ELSE (e.w * 0.92 * e.y + 0.08 * g.value) / (e.w * 0.92 + 0.08) END,
  coalesce(g.value, e.last), CASE WHEN e.y IS NULL OR g.value IS NOT NULL THEN 1.0 ELSE e.w * 0.92 END
 FROM e JOIN g ON g.station = e.station AND g.rn = e.rn + 1)
SELECT station, time, round(value + 1e-9, 6) AS value, round(last + 1e-9, 6) AS last_known, round(y + 1e-9, 6) AS smooth, false AS late FROM e""")
def st8_stream_smooth_timed(spark, sf):
    """ST8 in event-time order by timers: every reading of a closed hour, whatever the order of arrival."""
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") >= 5, F.col("value"))).select("station", "time", "value")
    return plain(jobs.drain(jobs.timed_smooth(rows), "timed-smooth"))
