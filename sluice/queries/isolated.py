"""Bad series, rows without a key or a time, positions from zero, long series: what must not end or thin out a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, features, grid, joins, quantiles, status
from ..operators.blocks import BLK, in_blocks, with_row_number
from ..session import work_path
from ..sources import gauges
from .base import (
    GAUGE, HOURLY, QUARTER, TABLE_BLOCK, clock_grid, gauge, hourly, quarter, query, table, tidy,
)
from .summary import decompose_sql, lines, lowess_sql

STATUS = "station, n_rows, n_no_time, status"


def with_gaps_in_keys(df: DataFrame) -> DataFrame:
    """Some readings without a station, some without a time."""
    return df.withColumns({
        "station": F.when(F.col("event_id") % 7 != 0, F.col("station")), "time": F.when(F.col("event_id") % 11 != 0, F.col("time"))})


HOLES = (GAUGE + ", holes AS (SELECT CASE WHEN event_id % 7 <> 0 THEN station END AS station, CASE WHEN event_id % 11 <> 0 THEN time END AS time, "
         "value, event_id FROM gauge)")


@query("p03_null_keys", f"""WITH {HOLES}, lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM holes GROUP BY 1)
SELECT h.station, event_id, round(CASE WHEN h.station IS NOT NULL AND coalesce(value > m + 2 * s OR value < m - 2 * s, false) THEN NULL ELSE value END + 1e-9, 6) AS value
FROM holes h LEFT JOIN lim l ON l.station = h.station""")
def p03_null_keys(spark, sf):
    """P03 where stations and times are missing: as many rows come out as go in."""
    return tidy(clean.null_outliers(with_gaps_in_keys(gauge(spark, sf)), k=2.0, block=TABLE_BLOCK).select("station", "event_id", "value"))


@query("p04_implausible_blanked", f"""WITH {HOLES}, lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM holes GROUP BY 1)
SELECT h.station, event_id, round(CASE WHEN h.station IS NOT NULL AND (value > m + 2 * s OR value < 0) THEN NULL ELSE value END + 1e-9, 6) AS value
FROM holes h LEFT JOIN lim l ON l.station = h.station""")
def p04_implausible_blanked(spark, sf):
    """P04 with removal of the reading: its row stays."""
    return tidy(clean.blank_implausible(with_gaps_in_keys(gauge(spark, sf)), k=2.0, block=TABLE_BLOCK).select("station", "event_id", "value"))


@query("j07_lookup_mean_null_keys", f"""WITH {HOLES}
SELECT event_id, round(CASE WHEN station IS NOT NULL AND time IS NOT NULL THEN avg(value) OVER (PARTITION BY station, month(time)) END + 1e-9, 6) AS part_mean FROM holes""")
def j07_lookup_mean_null_keys(spark, sf):
    """Readings without a station or a time stay, without a mean."""
    out = joins.lookup_mean(with_gaps_in_keys(gauge(spark, sf)), "value", station="station", month=F.month("time"))
    return tidy(out.select("event_id", "part_mean"))


@query("w02_lags_on_slots", f"WITH {HOURLY}, {clock_grid('hourly', 'grid', '1 hour')} SELECT station, slot, " + ", ".join(
    f"round(lag(value, {k}) OVER (PARTITION BY station ORDER BY slot) + 1e-9, 6) AS value_lag_{k}h" for k in (1, 3)) +
    ", round(lead(value, 2) OVER (PARTITION BY station ORDER BY slot) + 1e-9, 6) AS value_t_plus_2 FROM grid")
def w02_lags_on_slots(spark, sf):
    """W01, W02 on the slots of a grid, which count from zero: no numbering, and the first row stays."""
    rows = grid.on_grid(hourly(spark, sf), "station", 3600, unique=True)
    w = features.lead_and_lags(rows, "station", "slot", {"value": (1, 3)}, {"value": 2})
    return tidy(w.select("station", "slot", "value_lag_1h", "value_lag_3h", F.col("target_t_plus_2").alias("value_t_plus_2")))


@query("w07_ewma_long", f"""WITH {GAUGE}, n AS (SELECT value, row_number() OVER (ORDER BY time, event_id) AS rn FROM gauge)
SELECT a.rn, round(sum(b.value * (5.0::DOUBLE / 7) ** (a.rn - b.rn) * CASE WHEN b.rn = 1 THEN 1 ELSE 2.0::DOUBLE / 7 END) + 1e-9, 6) AS smooth
FROM n a JOIN n b ON b.rn BETWEEN a.rn - 150 AND a.rn GROUP BY 1""")
def w07_ewma_long(spark, sf):
    """W07 over all readings as one series, in short stretches, so that their totals are chained over several levels."""
    rows = gauge(spark, sf).withColumn("station", F.lit("all"))
    rows = with_row_number(in_blocks(rows, "station", "time", TABLE_BLOCK), "station", ["time", "event_id"]).drop(BLK)
    return tidy(features.ewma(rows, "station", "rn", {"smooth": ("value", 6)}, rows=32, fan=8).select("rn", "smooth"))


def far(df: DataFrame) -> DataFrame:
    """One station with wrong timestamps, one with readings that have none, one that is repeated."""
    seventh = F.to_date("time") == F.lit("2024-01-07").cast("date")
    early = F.hour("time") < 3
    moved = (F.when((F.col("station") == "view") & seventh & early, F.col("time") + F.expr("interval 7000 years"))
             .when((F.col("station") == "click") & seventh & early, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("time")))
    moved = df.withColumn("time", moved)
    return moved.unionByName(moved.filter((F.col("station") == "error") & seventh))


FAR = QUARTER + """, moved AS (SELECT station, CASE WHEN station = 'view' AND time::DATE = DATE '2024-01-07' AND hour(time) < 3 THEN time + INTERVAL 7000 YEAR
  WHEN station = 'click' AND time::DATE = DATE '2024-01-07' AND hour(time) < 3 THEN NULL ELSE time END AS time, value FROM quarter),
far AS (SELECT * FROM moved UNION ALL SELECT * FROM moved WHERE station = 'error' AND time::DATE = DATE '2024-01-07'),
bad AS (SELECT station, count(*) AS n_rows, count(*) FILTER (WHERE time IS NULL) AS n_no_time,
  CASE WHEN count(time) > count(DISTINCT time) THEN 'repeated_times' WHEN year(max(time)) > 8000 THEN 'grid_too_long' ELSE 'ok' END AS status FROM far GROUP BY 1),
sound AS (SELECT far.* FROM far JOIN bad USING (station) WHERE status = 'ok' AND time IS NOT NULL)"""


@query("g01_with_wrong_time", f"WITH {FAR}, {clock_grid('sound', 'grid')} SELECT station, time, slot, round(value + 1e-9, 6) AS value FROM grid")
def g01_with_wrong_time(spark, sf):
    """The stations without a fault get their grid, as in a run without the others."""
    out = status.gridded(far(quarter(spark, sf)), "station", 900, max_slots=1_000_000)
    return tidy(out.rows.select("station", "time", "slot", "value"))


@query("g01_status", f"WITH {FAR} SELECT {STATUS} FROM bad")
def g01_status(spark, sf):
    """What became of every station."""
    return tidy(status.gridded(far(quarter(spark, sf)), "station", 900, max_slots=1_000_000).status)


def short(df: DataFrame) -> DataFrame:
    """One station of a day and a half, one with an unknown value."""
    return df.filter("station <> 'view' or time < '2024-01-02 12:00:00'").withColumn(
        "value", F.when(~((F.col("station") == "click") & (F.dayofmonth("time") == 9) & (F.hour("time") < 12)), F.col("value")))


SHORT = HOURLY + """, short AS (SELECT station, time, CASE WHEN NOT (station = 'click' AND day(time) = 9 AND hour(time) < 12) THEN value END AS value FROM hourly
  WHERE station <> 'view' OR time < TIMESTAMP '2024-01-02 12:00:00'),
bad AS (SELECT station, count(*) AS n_rows, 0 AS n_no_time, CASE WHEN count(*) < 48 THEN 'too_short' WHEN count(*) > count(value) THEN 'unknown_values' ELSE 'ok' END AS status
  FROM short GROUP BY 1),
sound AS (SELECT short.* FROM short JOIN bad USING (station) WHERE status = 'ok')"""


@query("ts9_with_short_station", f"WITH {SHORT}, {decompose_sql('sound', 24)}")
def ts9_with_short_station(spark, sf):
    """TS9: a short station and one with a gap do not stop the others."""
    return tidy(status.decomposed(short(hourly(spark, sf)), 24).rows)


@query("ts9_status", f"WITH {SHORT} SELECT {STATUS} FROM bad")
def ts9_status(spark, sf):
    return tidy(status.decomposed(short(hourly(spark, sf)), 24).status)


@query("ts10_with_short_station", f"""WITH readings AS (SELECT l_returnflag AS station, date_diff('day', DATE '1995-01-01', date_trunc('month', l_shipdate)::DATE) AS x, avg(l_quantity) AS value
  FROM lineitem WHERE l_returnflag <> 'N' OR l_shipdate >= DATE '1998-10-01' GROUP BY 1, 2),
src AS (SELECT * FROM readings WHERE station IN (SELECT station FROM readings GROUP BY 1 HAVING floor(0.3 * count(*) + 1e-10) >= 2)), {lowess_sql('src', '0.3::DOUBLE')}""")
def ts10_with_short_station(spark, sf):
    """TS10: a station of a few months has no local fit, and is left out."""
    rows = lines(spark, sf).filter("station <> 'N' or time >= '1998-10-01'")
    rows = rows.groupBy("station", F.trunc("time", "month").alias("time")).agg(F.avg("value").alias("value"))
    rows = rows.withColumn("x", F.datediff("time", F.lit("1995-01-01").cast("date")))
    return tidy(status.smoothed(rows, 0.3, passes=0).rows.select("station", "x", "value", "smooth"))


@query("s20_file_status", """WITH c AS (SELECT c_custkey % 4 AS part, c_custkey FROM customer)
SELECT part::BIGINT AS part, count(*) AS n_rows, count(*) FILTER (WHERE part = 3 OR (part = 2 AND c_custkey % 3 = 0)) AS n_bad,
  CASE part WHEN 2 THEN 'bad_records' WHEN 3 THEN 'unreadable' ELSE 'ok' END AS status FROM c GROUP BY part""")
def s20_file_status(spark, sf):
    """Of four folders of files one has bad records and one has no readable record; the others are not affected."""
    path = work_path(spark, "faulty")
    key = F.col("c_custkey")
    bad = (key % 4 == 3) | ((key % 4 == 2) & (key % 3 == 0))
    rows = table(spark, sf, "customer").select(
        (key % 4).alias("part"), F.when(bad, F.concat(F.lit("x"), key)).otherwise(key.cast("string")).alias("id"), F.lit("2024-01-01").alias("time"))
    rows.repartition("part").write.partitionBy("part").option("header", "true").csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("time", T.DateType())])
    read = gauges.read_tolerant(spark, path, schema, "id,time")
    files = status.file_status(read.withColumn("file", F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint")))
    return files.select(F.col("file").alias("part"), "n_rows", "n_bad", "status")


@query("j08_nearest_time_unknown", f"""
WITH {GAUGE}, known AS (SELECT station, time, CASE WHEN event_id % 3 > 0 THEN value END AS value FROM gauge),
span AS (SELECT station, time_bucket(INTERVAL '1 hour', min(time)) AS a, max(time) AS b FROM known GROUP BY 1),
slots AS (SELECT station, unnest(generate_series(a, b, INTERVAL '1 hour')) AS time FROM span),
l AS (SELECT s.station, s.time, g.time AS lt, g.value AS lv FROM slots s ASOF LEFT JOIN known g ON s.station = g.station AND s.time >= g.time),
r AS (SELECT s.station, s.time, g.time AS rt, g.value AS rv FROM slots s ASOF LEFT JOIN known g ON s.station = g.station AND s.time <= g.time)
SELECT l.station, l.time, round(CASE WHEN lt IS NULL OR (rt IS NOT NULL AND rt - l.time <= l.time - lt) THEN rv ELSE lv END + 1e-9, 6) AS value
FROM l JOIN r ON l.station = r.station AND l.time = r.time""")
def j08_nearest_time_unknown(spark, sf):
    """A reading without a value is the nearest one all the same."""
    rows = gauge(spark, sf).withColumn("value", F.when(F.col("event_id") % 3 > 0, F.col("value")))
    return tidy(grid.nearest_on_grid(rows, "station", 3600, block=TABLE_BLOCK))


@query("a03_narrow_quantiles", """WITH v AS (SELECT l_returnflag AS station, 1013 + (l_orderkey * 7 + l_linenumber) / 1e8 AS value FROM lineitem)
SELECT station, round(quantile_cont(value, 0.01) * 1e6 + 1e-9, 4) AS low, round(quantile_cont(value, 0.5) * 1e6 + 1e-9, 4) AS middle, round(quantile_cont(value, 0.99) * 1e6 + 1e-9, 4) AS high
FROM v GROUP BY 1""")
def a03_narrow_quantiles(spark, sf):
    """All values within one cell of the first histogram, which is split until few are left."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station"), (F.lit(1013) + (F.col("l_orderkey") * 7 + F.col("l_linenumber")) / F.lit(1e8)).alias("value"))
    out = quantiles.exact_quantiles(rows, "station", "value", {"low": 0.01, "middle": 0.5, "high": 0.99}, fit=256)
    return out.select("station", *[F.round(F.col(c) * 1e6 + 1e-9, 4).alias(c) for c in ("low", "middle", "high")])
