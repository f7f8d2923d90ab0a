"""Flagship cleaning, imputation and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, clean, grid, impute
from .base import (
    GAUGE, HOURLY, QUARTER, TABLE_BLOCK, USERS, anchored_grid, clock_grid, gauge, hourly, quarter, query, tidy, users,
)

CLEANED = """
limits AS (SELECT station, avg(CASE WHEN value >= 0 THEN value END) AS m, stddev_samp(CASE WHEN value >= 0 THEN value END) AS s
           FROM {src} GROUP BY 1),
kept AS (SELECT g.station, g.time, g.slot,
                CASE WHEN g.value >= 0 AND NOT coalesce(g.value > m + {k} * s OR g.value < m - {k} * s, false) THEN g.value END AS value
         FROM grid g JOIN limits USING (station))
"""
SEASONAL = """coalesce(value, avg(value) OVER (PARTITION BY station, month(time), hour(time)))"""


@query("ts7_river_clean", f"""
WITH {HOURLY}, {clock_grid('hourly', 'grid', '1 hour')}, {CLEANED.format(src='hourly', k='10')}
SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM kept""")
def ts7_river_clean(spark, sf):
    """TS7, also P01, P03, G01, TS1: the cleaning chain on the hourly clock grid."""
    out = impute.river_clean(hourly(spark, sf), step=3600, block=TABLE_BLOCK, unique=True)
    return tidy(out.select("station", "time", "value"))


@query("ts7_river_clean_quarter", f"""
WITH {QUARTER}, {clock_grid('quarter', 'grid')}, {CLEANED.format(src='quarter', k='10')}
SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM kept""")
def ts7_river_clean_quarter(spark, sf):
    """TS7 at the gauge step of 15 minutes."""
    return tidy(impute.river_clean(quarter(spark, sf), block=TABLE_BLOCK, unique=True).select("station", "time", "value"))


@query("ts7_river_clean_anchored", f"""
WITH {HOURLY}, {anchored_grid('hourly', 'grid', '1 hour')}, {CLEANED.format(src='hourly', k='2')}
SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM kept""")
def ts7_river_clean_anchored(spark, sf):
    """TS7 with the grid counted from the first reading and a 2-sigma bound that bites."""
    out = impute.river_clean(hourly(spark, sf), step=3600, grid="anchored", k=2.0, block=TABLE_BLOCK, unique=True)
    return tidy(out.select("station", "time", "value"))


@query("p01_null_negatives", f"WITH {GAUGE} SELECT station, time, round(CASE WHEN value >= 0 THEN value END + 1e-9, 6) AS value FROM gauge")
def p01_null_negatives(spark, sf):
    return tidy(clean.null_negatives(gauge(spark, sf)).drop("event_id"))


@query("p02_drop_negatives", f"WITH {GAUGE} SELECT station, time, round(value + 1e-9, 6) AS value FROM gauge WHERE value >= 0")
def p02_drop_negatives(spark, sf):
    return tidy(gauge(spark, sf).filter("value >= 0").drop("event_id"))


@query("p03_null_outliers", f"""
WITH {GAUGE}, pos AS (SELECT station, time, event_id, CASE WHEN value >= 0 THEN value END AS value FROM gauge),
lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM pos GROUP BY 1)
SELECT station, event_id, round(CASE WHEN NOT coalesce(value > m + 3 * s OR value < m - 3 * s, false) THEN value END + 1e-9, 6) AS value
FROM pos JOIN lim USING (station)""")
def p03_null_outliers(spark, sf):
    """P03 with a 3-sigma bound so that some readings are hit."""
    out = clean.null_outliers(clean.null_negatives(gauge(spark, sf)), k=3.0, block=TABLE_BLOCK)
    return tidy(out.select("station", "event_id", "value"))


@query("p04_implausible_report", f"""
WITH {GAUGE}, lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM gauge GROUP BY 1)
SELECT station, count(*) FILTER (WHERE value > m + 10 * s OR value < 0) AS n_implausible,
       round(count(*) FILTER (WHERE value > m + 10 * s OR value < 0) * 100.0::DOUBLE / count(*) + 1e-9, 6) AS pct_implausible
FROM gauge JOIN lim USING (station) GROUP BY 1""")
def p04_implausible_report(spark, sf):
    """Count and share of readings above mean + 10 std or below zero."""
    return tidy(clean.implausible_report(gauge(spark, sf)))


@query("p04_implausible_removed", f"""
WITH {GAUGE}, lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM gauge GROUP BY 1)
SELECT station, event_id, round(value + 1e-9, 6) AS value FROM gauge JOIN lim USING (station)
WHERE NOT (value > m + 2 * s OR value < 0)""")
def p04_implausible_removed(spark, sf):
    """P04 with removal, at 2 sigma."""
    out = clean.flag_implausible(gauge(spark, sf), k=2.0, block=TABLE_BLOCK).filter("not implausible")
    return tidy(out.select("station", "event_id", "value"))


# --- grids -----------------------------------------------------------------------------------

@query("g01_clock_grid", f"WITH {QUARTER}, {clock_grid('quarter', 'grid')} SELECT station, time, slot, round(value + 1e-9, 6) AS value FROM grid")
def g01_clock_grid(spark, sf):
    return tidy(grid.on_grid(quarter(spark, sf), "station", 900).drop("n_slots"))


@query("g01_clock_grid_off_grid_rows", f"""
WITH {GAUGE}, mixed AS (SELECT station, CASE WHEN event_id % 2 = 0 THEN time_bucket(INTERVAL '1 hour', time) ELSE time END AS time,
     value, event_id FROM gauge),
once AS (SELECT station, time, arg_min(value, event_id) AS value FROM mixed GROUP BY 1, 2),
{clock_grid('once', 'grid')}
SELECT station, time, round(value + 1e-9, 6) AS value FROM grid""")
def g01_clock_grid_off_grid_rows(spark, sf):
    """G01 on readings of which half are off the grid and dropped."""
    raw = gauge(spark, sf)
    mixed = raw.withColumn("time", F.when(F.col("event_id") % 2 == 0, grid.bucket("time", 3600)).otherwise(F.col("time")))
    once = clean.keep_first(mixed, ["station", "time"], "event_id")
    return tidy(grid.on_grid(once, "station", 900, unique=True).select("station", "time", "value"))


@query("g02_anchored_grid", f"WITH {GAUGE}, {anchored_grid('gauge', 'grid')} SELECT station, time, slot, round(value + 1e-9, 6) AS value FROM grid")
def g02_anchored_grid(spark, sf):
    """G02 on raw times, repeated ones included: the grid runs from each station's first reading."""
    out = grid.on_grid(gauge(spark, sf), "station", 900, anchored=True, repeats=True, block=TABLE_BLOCK)
    return tidy(out.select("station", "time", "slot", "value"))


@query("g03_daily_mean", f"""
WITH {USERS}, m AS (SELECT station, time_bucket(INTERVAL '1 day', time) AS time, avg(value) AS value FROM users GROUP BY 1, 2),
{clock_grid('m', 'grid', '1 day')} SELECT station, time, round(value + 1e-9, 6) AS value FROM grid""")
def g03_daily_mean(spark, sf):
    """G03 by day over many sparse stations, which have empty days."""
    return tidy(grid.bucket_mean(users(spark, sf), "station", 86400).select("station", "time", "value"))


@query("g03_hourly_mean", f"""
WITH {GAUGE}, m AS (SELECT station, time_bucket(INTERVAL '1 hour', time) AS time, avg(value) AS value FROM gauge GROUP BY 1, 2),
{clock_grid('m', 'grid', '1 hour')} SELECT station, time, round(value + 1e-9, 6) AS value FROM grid""")
def g03_hourly_mean(spark, sf):
    """G03 by hour, also G06: negatives kept."""
    return tidy(grid.bucket_mean(gauge(spark, sf), "station", 3600).select("station", "time", "value"))


@query("g03_monthly_mean", """
WITH m AS (SELECT l_returnflag AS station, last_day(l_shipdate) AS time, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
s AS (SELECT station, unnest(generate_series(date_trunc('month', min(time)), date_trunc('month', max(time)), INTERVAL '1 month')) AS mo
      FROM m GROUP BY 1)
SELECT s.station, last_day(s.mo) AS time, round(m.value + 1e-9, 6) AS value FROM s LEFT JOIN m ON m.station = s.station AND m.time = last_day(s.mo)""")
def g03_monthly_mean(spark, sf):
    """G03 by month, labelled by the month's last day."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("value"))
    return tidy(grid.month_mean(rows, "station"))


@query("g05_daily_midnight", f"""
WITH {QUARTER}, {clock_grid('quarter', 'grid', '1 day')} SELECT station, time, round(value + 1e-9, 6) AS value FROM grid""")
def g05_daily_midnight(spark, sf):
    return tidy(grid.daily_at_midnight(quarter(spark, sf), "station").select("station", "time", "value"))


@query("g06_hourly_clean", f"""
WITH {QUARTER}, pos AS (SELECT station, time, CASE WHEN value >= 0 THEN value END AS value FROM quarter),
{anchored_grid('pos', 'grid')},
m AS (SELECT station, time_bucket(INTERVAL '1 hour', time) AS time, avg(value) AS value FROM grid GROUP BY 1, 2)
SELECT station, time, round(value + 1e-9, 6) AS value FROM m""")
def g06_hourly_clean(spark, sf):
    """Negatives to NULL, 15-minute grid, hourly mean."""
    rows = clean.null_negatives(quarter(spark, sf))
    gridded = grid.on_grid(rows, "station", 900, anchored=True, unique=True)
    return tidy(grid.bucket_mean(gridded, "station", 3600).select("station", "time", "value"))


@query("j08_nearest_time", f"""
WITH {GAUGE}, span AS (SELECT station, time_bucket(INTERVAL '1 hour', min(time)) AS a, max(time) AS b FROM gauge GROUP BY 1),
slots AS (SELECT station, unnest(generate_series(a, b, INTERVAL '1 hour')) AS time FROM span),
l AS (SELECT s.station, s.time, g.time AS lt, g.value AS lv FROM slots s ASOF LEFT JOIN gauge g ON s.station = g.station AND s.time >= g.time),
r AS (SELECT s.station, s.time, g.time AS rt, g.value AS rv FROM slots s ASOF LEFT JOIN gauge g ON s.station = g.station AND s.time <= g.time)
SELECT l.station, l.time, round(CASE WHEN lt IS NULL OR (rt IS NOT NULL AND rt - l.time <= l.time - lt) THEN rv ELSE lv END + 1e-9, 6) AS value
FROM l JOIN r ON l.station = r.station AND l.time = r.time""")
def j08_nearest_time(spark, sf):
    """Nearest reading for each clock hour."""
    return tidy(grid.nearest_on_grid(gauge(spark, sf), "station", 3600, block=TABLE_BLOCK))


# --- fills -----------------------------------------------------------------------------------

def _gridded(spark, sf):
    """15-minute grid with negatives blanked; about half of the slots are empty."""
    return grid.on_grid(clean.null_negatives(quarter(spark, sf)), "station", 900, unique=True).drop("n_slots")


FILL_BASE = f"{QUARTER}, pos AS (SELECT station, time, CASE WHEN value >= 0 THEN value END AS value FROM quarter), {clock_grid('pos', 'grid')}"
NEIGHBOURS = """near AS (SELECT *,
  max(CASE WHEN value IS NOT NULL THEN slot END) OVER (PARTITION BY station ORDER BY slot ROWS UNBOUNDED PRECEDING) AS ps,
  min(CASE WHEN value IS NOT NULL THEN slot END) OVER (PARTITION BY station ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ns
  FROM grid),
around AS (SELECT n.station, n.time, n.slot, n.value, n.ps, n.ns, p.value AS pv, q.value AS nv FROM near n
  LEFT JOIN grid p ON p.station = n.station AND p.slot = n.ps LEFT JOIN grid q ON q.station = n.station AND q.slot = n.ns)"""


@query("ts1_seasonal_fill", f"WITH {FILL_BASE} SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM grid")
def ts1_seasonal_fill(spark, sf):
    """TS1, J07: month and hour means into the gaps."""
    return tidy(impute.seasonal_fill(_gridded(spark, sf), block=TABLE_BLOCK).select("station", "time", "value"))


@query("ts2_day_slot_fill", """
WITH daily AS (SELECT l_returnflag AS station, l_shipdate AS time, CASE WHEN day(l_shipdate) % 4 <> 0 THEN avg(l_quantity) END AS value
               FROM lineitem GROUP BY 1, 2)
SELECT station, time, round(coalesce(value, avg(value) OVER (PARTITION BY station, dayofyear(time) * 96 + hour(time) * 4 + minute(time) // 15)) + 1e-9, 6) AS value
FROM daily""")
def ts2_day_slot_fill(spark, sf):
    """TS2 over seven years of daily values; leap years shift the key."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(
        F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time")).agg(F.avg("l_quantity").alias("value"))
    rows = rows.withColumn("value", F.when(F.dayofmonth("time") % 4 != 0, F.col("value")))
    return tidy(impute.seasonal_fill(rows, season=impute.day_slot, block=365 * 86400))


@query("ts3_hybrid_fill", f"""
WITH {FILL_BASE}, {NEIGHBOURS},
f AS (SELECT station, time, coalesce(value, CASE WHEN slot - ps <= 2 THEN pv END) AS value FROM around)
SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM f""")
def ts3_hybrid_fill(spark, sf):
    """TS3 without noise, forward fill limited to two slots so that the season means are used."""
    return tidy(impute.hybrid_fill(_gridded(spark, sf), limit=2, block=TABLE_BLOCK).select("station", "time", "value"))


@query("ts4_linear_fill", f"""
WITH {FILL_BASE}, {NEIGHBOURS}
SELECT station, time, round(coalesce(value, CASE WHEN ns IS NULL THEN pv ELSE pv + (nv - pv) * ((slot - ps)::DOUBLE / (ns - ps)) END) + 1e-9, 6) AS value
FROM around""")
def ts4_linear_fill(spark, sf):
    return tidy(impute.linear_fill(_gridded(spark, sf), block=TABLE_BLOCK).select("station", "time", "value"))


@query("ts5_nearest_fill", f"""
WITH {FILL_BASE}, {NEIGHBOURS}
SELECT station, time, round(coalesce(value, CASE WHEN slot - ps <= ns - slot THEN pv WHEN ns - slot < slot - ps THEN nv END) + 1e-9, 6) AS value
FROM around""")
def ts5_nearest_fill(spark, sf):
    """TS5: negatives to NULL and nearest value by position."""
    rows = grid.on_grid(quarter(spark, sf), "station", 900, unique=True)
    return tidy(impute.negatives_by_nearest(rows, block=TABLE_BLOCK).select("station", "time", "value"))


@query("ts6_guarded_linear_fill", f"""
WITH {FILL_BASE}, {NEIGHBOURS}, lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY 1)
SELECT station, time, round(coalesce(value, CASE WHEN (ns - ps) * 900 <= 2700 AND pv BETWEEN m - 2 * s AND m + 2 * s
  AND nv BETWEEN m - 2 * s AND m + 2 * s THEN pv + (nv - pv) * ((slot - ps)::DOUBLE / nullif(ns - ps, 0)) END) + 1e-9, 6) AS value
FROM around JOIN lim USING (station)""")
def ts6_guarded_linear_fill(spark, sf):
    """TS6 with a 45-minute gap bound and 2-sigma neighbours, so both guards are used."""
    out = impute.guarded_linear_fill(_gridded(spark, sf), z=2.0, max_gap_seconds=2700, block=TABLE_BLOCK)
    return tidy(out.select("station", "time", "value"))


@query("ts8_second_pass", f"""
WITH {HOURLY}, {clock_grid('hourly', 'grid', '1 hour')}, {CLEANED.format(src='hourly', k='10')},
filled AS (SELECT station, time, {SEASONAL} AS value FROM kept),
lim AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM filled GROUP BY 1),
cut AS (SELECT station, time, CASE WHEN NOT coalesce(value < m - 1 * s, false) THEN value END AS value FROM filled JOIN lim USING (station))
SELECT station, time, round({SEASONAL} + 1e-9, 6) AS value FROM cut""")
def ts8_second_pass(spark, sf):
    """TS8 with a 1-sigma low bound so that the second pass changes rows."""
    first = impute.river_clean(hourly(spark, sf), step=3600, block=TABLE_BLOCK, unique=True)
    return tidy(impute.second_pass(first, k=1.0, block=TABLE_BLOCK).select("station", "time", "value"))


@query("w13_forward_fill", f"""
WITH {FILL_BASE}, {NEIGHBOURS} SELECT station, time, round(coalesce(value, pv) + 1e-9, 6) AS value FROM around""")
def w13_forward_fill(spark, sf):
    rows = blocks.in_blocks(_gridded(spark, sf), "station", "time", TABLE_BLOCK)
    return tidy(blocks.filled_forward(rows, "station", "slot", "value").select("station", "time", "value"))


@query("w14_forward_fill_limited", f"""
WITH {FILL_BASE}, {NEIGHBOURS} SELECT station, time, round(coalesce(value, CASE WHEN slot - ps <= 1 THEN pv END) + 1e-9, 6) AS value FROM around""")
def w14_forward_fill_limited(spark, sf):
    """W14 with a limit of one slot."""
    return tidy(impute.forward_fill(_gridded(spark, sf), limit=1, block=TABLE_BLOCK).select("station", "time", "value"))
