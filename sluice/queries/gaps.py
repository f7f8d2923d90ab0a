"""Gap, duplicate and quality accounting; sets, sorts and reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import midnight
from ..operators import clean, gaps, grid, quality, reshape, stats
from ..plans.weather_clean import weather_clean
from ..schemas import QUALITY_LABELS
from .base import (
    GAUGE, HOURLY, QUALIFIED, QUARTER, RUN_LABEL_SQL, TABLE_BLOCK, USERS, anchored_grid, gauge, hourly, qualified, quarter,
    query, run_label, table, tidy, users,
)


def pct(a: str, b: str) -> str:
    return f"round({a} * 100.0::DOUBLE / {b} + 1e-9, 6)"


@query("a19_missing_quarter_hours", f"""
WITH {QUARTER}, two AS (SELECT station, time, value FROM quarter), {anchored_grid('two', 'grid')}
SELECT station, count(*) AS n_expected, count(*) - count(value) + count(*) FILTER (WHERE value IS NULL OR value < 0) AS n_missing,
 {pct("(count(*) - count(value) + count(*) FILTER (WHERE value IS NULL OR value < 0))", "count(*)")} AS pct_missing
FROM grid GROUP BY 1""")
def a19_missing_quarter_hours(spark, sf):
    """A19 with two value columns, whose missing cells add up."""
    rows = quarter(spark, sf).withColumn("positive", F.when(F.col("value") >= 0, F.col("value")))
    return tidy(gaps.missing_slots(rows, values=["value", "positive"]))


MIDNIGHT = "time = date_trunc('day', time) AND value IS NOT NULL"


def _days(rule: str) -> str:
    return f"""
WITH {QUARTER}, d AS (SELECT station, time::DATE AS day, bool_or({rule}) AS present FROM quarter GROUP BY 1, 2)
SELECT station, (date_diff('day', min(day), max(day)) + 1)::BIGINT AS n_days,
 (date_diff('day', min(day), max(day)) + 1 - count(*) FILTER (WHERE present))::BIGINT AS n_missing,
 {pct("(date_diff('day', min(day), max(day)) + 1 - count(*) FILTER (WHERE present))", "(date_diff('day', min(day), max(day)) + 1)")} AS pct_missing
FROM d GROUP BY 1"""


@query("a20_missing_days_midnight", _days(MIDNIGHT))
def a20_missing_days_midnight(spark, sf):
    return tidy(gaps.missing_days(quarter(spark, sf), rule="midnight"))


@query("a20_missing_days_any", _days("true").replace(QUARTER, USERS + ", quarter AS (SELECT station, time, value FROM users)"))
def a20_missing_days_any(spark, sf):
    """A20, any-row rule, over many sparse stations."""
    return tidy(gaps.missing_days(users(spark, sf), rule="any"))


HALF_DAY = "halfday AS (SELECT station, time_bucket(INTERVAL '30 minutes', time) AS time, value, event_id FROM gauge)"


def half_day(spark, sf):
    return gauge(spark, sf).withColumn("time", grid.bucket("time", 1800))


@query("a21_duplicate_stats", f"""
WITH {GAUGE}, {HALF_DAY}, c AS (SELECT station, time, count(*) AS n FROM halfday GROUP BY 1, 2)
SELECT station, sum(n)::BIGINT AS n_rows, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS n_duplicate_rows,
 sum(n - 1)::BIGINT AS n_excess, {pct('sum(n - 1)', 'sum(n)')} AS pct_excess FROM c GROUP BY 1""")
def a21_duplicate_stats(spark, sf):
    return tidy(gaps.duplicate_stats(half_day(spark, sf)))


MISSING_HOURS = f"""{anchored_grid('once', 'grid', '1 hour')}
"""


@query("a22_missing_hours", f"""
WITH {HOURLY}, once AS (SELECT station, time, 1 AS value FROM hourly), {MISSING_HOURS}
SELECT station, count(*) AS n_expected, count(*) - count(value) AS n_missing, {pct('(count(*) - count(value))', 'count(*)')} AS pct_missing
FROM grid GROUP BY 1""")
def a22_missing_hours(spark, sf):
    return tidy(gaps.missing_steps(hourly(spark, sf)))


@query("a27_weather_cleanup", f"""
WITH {GAUGE}, raw AS (SELECT station, CASE WHEN event_id % 50 = 7 THEN NULL ELSE time_bucket(INTERVAL '1 hour', time) END AS time, value, event_id FROM gauge),
good AS (SELECT * FROM raw WHERE time IS NOT NULL),
c AS (SELECT station, time, count(*) AS n FROM good GROUP BY 1, 2),
d AS (SELECT station, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS n_duplicate_rows, {pct('sum(n - 1)', 'sum(n)')} AS pct_excess FROM c GROUP BY 1),
once AS (SELECT station, time, 1 AS value FROM c), {MISSING_HOURS}
SELECT station, n_duplicate_rows, pct_excess, count(*) - count(value) AS n_missing, {pct('(count(*) - count(value))', 'count(*)')} AS pct_missing
FROM grid JOIN d USING (station) GROUP BY ALL""")
def a27_weather_cleanup(spark, sf):
    """The metadata of the weather clean-up (bad times dropped, duplicates and missing hours counted)."""
    return tidy(weather_clean(_weather_text(spark, sf), station="station", time="date", tie="event_id")[1])


def _weather_text(spark, sf):
    """Hour-aligned readings with the time as text, every fiftieth unreadable."""
    rows = half_day(spark, sf).withColumn("time", grid.bucket("time", 3600))
    text = F.when(F.col("event_id") % 50 == 7, F.lit("not a time")).otherwise(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return rows.withColumn("date", text).drop("time")


@query("a27_weather_cleaned_rows", f"""
WITH {GAUGE}, raw AS (SELECT station, time_bucket(INTERVAL '1 hour', time) AS time, value, event_id FROM gauge WHERE event_id % 50 <> 7)
SELECT station, time, min(event_id) AS event_id, round(arg_min(value, event_id) + 1e-9, 6) AS value FROM raw GROUP BY 1, 2""")
def a27_weather_cleaned_rows(spark, sf):
    """The cleaned rows."""
    return tidy(weather_clean(_weather_text(spark, sf), station="station", time="date", tie="event_id")[0])


W12_SQL = f"""
WITH {QUARTER}, {anchored_grid('quarter', 'grid')},
m AS (SELECT station, time, value IS NULL AS gap, slot - row_number() OVER (PARTITION BY station, value IS NULL ORDER BY slot) AS g FROM grid),
b AS (SELECT station, min(time) AS "start", max(time) AS "end", count(*) AS n_rows FROM m WHERE gap GROUP BY station, g)
SELECT station, "start", "end", n_rows, round(epoch("end" - "start") / 86400.0::DOUBLE + 1e-9, 6) AS duration_days FROM b"""


@query("w12_missing_blocks", W12_SQL)
def w12_missing_blocks(spark, sf):
    return tidy(gaps.missing_blocks(quarter(spark, sf), block=TABLE_BLOCK))


@query("l02_longest_missing_blocks", W12_SQL + ' ORDER BY duration_days DESC, "start", station LIMIT 30')
def l02_longest_missing_blocks(spark, sf):
    """The 30 longest missing blocks."""
    return tidy(reshape.top_k(gaps.missing_blocks(quarter(spark, sf), block=TABLE_BLOCK), 30, F.desc("duration_days"), "start", "station"))


def _share(part_sql: str) -> str:
    return f"""
WITH {QUARTER}, {anchored_grid('quarter', 'grid')},
c AS (SELECT station, {part_sql} AS part, count(*) AS n, count(*) - count(value) AS m FROM grid GROUP BY 1, 2)
SELECT station, part, {pct('m', 'n')} AS pct_missing FROM (SELECT *, sum(m) OVER (PARTITION BY station) AS all_m FROM c) WHERE all_m > 0"""


@query("a06_missing_by_hour", _share("hour(time)"))
def a06_missing_by_hour(spark, sf):
    return tidy(gaps.missing_share(quarter(spark, sf), F.hour))


@query("a06_missing_by_weekday", _share("isodow(time) - 1"))
def a06_missing_by_weekday(spark, sf):
    return tidy(gaps.missing_share(quarter(spark, sf), F.weekday))


@query("a06_missing_by_month", _share("month(time)"))
def a06_missing_by_month(spark, sf):
    return tidy(gaps.missing_share(quarter(spark, sf), F.month, cycle="month"))


@query("a07_monthly_missingness", """
WITH c AS (SELECT l_suppkey AS station, month(l_shipdate) AS month, avg(CASE WHEN l_quantity < 10 THEN 1.0 ELSE 0.0 END) AS share FROM lineitem GROUP BY 1, 2)
SELECT month, round(avg(share) * 100 + 1e-9, 6) AS pct_missing, count(*) AS n_series FROM c GROUP BY 1""")
def a07_monthly_missingness(spark, sf):
    """A07 over suppliers as stations; small quantities count as missing."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_shipdate").alias("time"), F.when(F.col("l_quantity") >= 10, F.col("l_quantity")).alias("value"))
    return tidy(gaps.monthly_missingness(rows))


@query("c08_completeness", f"""
WITH {USERS}, s AS (SELECT station, floor(epoch_us(time) / 900000000)::BIGINT AS slot, bool_or(value >= 0) AS known FROM users GROUP BY 1, 2)
SELECT station, max(slot) - min(slot) + 1 AS n_slots, count(*) FILTER (WHERE known) AS n_known,
 {pct('count(*) FILTER (WHERE known)', '(max(slot) - min(slot) + 1)')} AS pct_complete FROM s GROUP BY 1""")
def c08_completeness(spark, sf):
    """Known readings over the slots of the series' span."""
    return tidy(gaps.completeness(clean.null_negatives(users(spark, sf))))


# --- quality ---------------------------------------------------------------------------------

@query("a01_quality_distribution", f"""
WITH {QUALIFIED}, c AS (SELECT station, quality, count(*) AS n FROM qualified GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY station) AS total, sum(CASE WHEN quality IS NOT NULL THEN n END) OVER (PARTITION BY station) AS labelled FROM c)
SELECT station, quality, n, total::BIGINT AS total_records, {pct('n', 'labelled')} AS pct FROM t WHERE quality IS NOT NULL""")
def a01_quality_distribution(spark, sf):
    return tidy(quality.label_distribution(qualified(spark, sf)))


def _label_pivot(part: str, name: str) -> str:
    cols = ", ".join(f"count(value) FILTER (WHERE quality = '{q}') AS \"{q}\"" for q in QUALITY_LABELS)
    return f"""WITH {QUALIFIED}, pos AS (SELECT station, time, quality, CASE WHEN value >= 0 THEN value END AS value FROM qualified)
SELECT station, {part} AS {name}, {cols} FROM pos GROUP BY 1, 2"""


def _positive(spark, sf):
    return clean.null_negatives(qualified(spark, sf))


@query("a02_quality_by_hour", _label_pivot("hour(time)", "hour"))
def a02_quality_by_hour(spark, sf):
    return tidy(quality.label_calendar(_positive(spark, sf), F.hour, "hour"))


@query("a02_quality_by_weekday", _label_pivot("isodow(time) - 1", "weekday"))
def a02_quality_by_weekday(spark, sf):
    return tidy(quality.label_calendar(_positive(spark, sf), F.weekday, "weekday"))


@query("a02_quality_by_month", _label_pivot("month(time)", "month"))
def a02_quality_by_month(spark, sf):
    return tidy(quality.label_calendar(_positive(spark, sf), F.month, "month"))


RUNS = f"""labelled AS (SELECT event_type AS station, ts AS time, event_id, {RUN_LABEL_SQL} AS quality FROM events),
mark AS (SELECT *, CASE WHEN quality IS NOT DISTINCT FROM lag(quality) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS ch
  FROM labelled WINDOW w AS (PARTITION BY station ORDER BY time, event_id)),
isle AS (SELECT *, sum(ch) OVER (PARTITION BY station ORDER BY time, event_id ROWS UNBOUNDED PRECEDING) AS g FROM mark),
runs AS (SELECT station, any_value(quality) AS quality, min(time) AS "start", max(time) AS "end", count(*) AS n_rows
  FROM isle WHERE quality IS NOT NULL GROUP BY station, g)"""


def _runs(spark, sf):
    rows = gauge(spark, sf).withColumn("quality", run_label())
    return quality.label_runs(rows, tie="event_id", block=TABLE_BLOCK)


@query("w10_quality_runs", f'WITH {RUNS} SELECT station, quality, "start", "end", n_rows FROM runs')
def w10_quality_runs(spark, sf):
    """The runs themselves."""
    return tidy(_runs(spark, sf))


@query("w10_quality_streaks", f"""WITH {RUNS} SELECT station, quality, (max(n_rows) * 15)::BIGINT AS longest_streak_minutes,
 round(avg(n_rows) * 15 + 1e-9, 6) AS avg_streak_minutes FROM runs GROUP BY 1, 2""")
def w10_quality_streaks(spark, sf):
    return tidy(quality.streak_summary(_runs(spark, sf)))


@query("w10_streak_distribution", f"WITH {RUNS} SELECT station, quality, n_rows AS length, count(*) AS n_streaks FROM runs GROUP BY 1, 2, 3")
def w10_streak_distribution(spark, sf):
    return tidy(quality.streak_lengths(_runs(spark, sf)))


@query("w11_training_periods", f"""WITH {RUNS} SELECT station, "start" AS start_date, "end" AS end_date,
 round(epoch_us("end") / 86400000000.0::DOUBLE - epoch_us("start") / 86400000000.0::DOUBLE + 1e-9, 6) AS length_days, n_rows AS n_records
FROM runs WHERE quality = 'Good' AND "end" - "start" >= INTERVAL '6 hours'""")
def w11_training_periods(spark, sf):
    """W11 with a quarter-day minimum, which the stand-in labels reach."""
    return tidy(quality.training_periods(_runs(spark, sf), min_days=0.25))


@query("c07_overall_quality", f"""
WITH {QUALIFIED}, c AS (SELECT station, quality, count(*) AS n FROM qualified WHERE quality IS NOT NULL GROUP BY 1, 2),
t AS (SELECT *, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY station) AS pct FROM c)
SELECT quality, sum(n)::BIGINT AS n, count(*) AS n_series, round(min(pct) + 1e-9, 6) AS min_pct, round(avg(pct) + 1e-9, 6) AS mean_pct, round(max(pct) + 1e-9, 6) AS max_pct,
 round(sum(n) * 100.0::DOUBLE / sum(sum(n)) OVER () + 1e-9, 6) AS pct FROM t GROUP BY 1""")
def c07_overall_quality(spark, sf):
    """Label shares over all gauges and their spread."""
    return tidy(quality.overall_quality(qualified(spark, sf)))


# --- duplicates, sets, reshapes, small filters -----------------------------------------------

@query("d01_distinct_rows", """SELECT DISTINCT l_returnflag AS station, l_shipdate AS time, l_quantity AS value FROM lineitem""")
def d01_distinct_rows(spark, sf):
    """D01."""
    return tidy(table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("value")).dropDuplicates())


@query("d02_keep_first", f"""WITH {GAUGE}, {HALF_DAY}
SELECT station, time, min(event_id) AS event_id, round(arg_min(value, event_id) + 1e-9, 6) AS value FROM halfday GROUP BY 1, 2""")
def d02_keep_first(spark, sf):
    return tidy(clean.keep_first(half_day(spark, sf), ["station", "time"], "event_id"))


DUP = """SELECT station, time, event_id, round(value + 1e-9, 6) AS value FROM
 (SELECT *, count(*) OVER (PARTITION BY station, time) AS n, row_number() OVER (PARTITION BY station, time ORDER BY event_id) AS rn FROM halfday)"""


@query("d03_duplicate_members", f"WITH {GAUGE}, {HALF_DAY} {DUP} WHERE n > 1")
def d03_duplicate_members(spark, sf):
    return tidy(clean.duplicates(half_day(spark, sf), ["station", "time"], "event_id"))


@query("d03_later_duplicates", f"WITH {GAUGE}, {HALF_DAY} {DUP} WHERE rn > 1")
def d03_later_duplicates(spark, sf):
    return tidy(clean.duplicates(half_day(spark, sf), ["station", "time"], "event_id", later_only=True))


@query("p05_in_range", f"WITH {GAUGE} SELECT event_id, coalesce(value BETWEEN 0 AND 5, false) AS in_range FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM gauge)")
def p05_in_range(spark, sf):
    """Both halves of the split as a flag; NULL falls outside."""
    rows = gauge(spark, sf).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return rows.select("event_id", clean.in_range("value", 0, 5).alias("in_range"))


@query("p06_active_stations", """SELECT user_id AS station, max(ts) AS updated FROM events GROUP BY 1
HAVING max(ts) >= (SELECT max(ts) - INTERVAL '2 days' FROM events)""")
def p06_active_stations(spark, sf):
    """Stations whose last update is recent against the latest of all."""
    last = table(spark, sf, "events").groupBy(F.col("user_id").alias("station")).agg(F.max("ts").alias("updated"))
    latest = table(spark, sf, "events").agg((F.max("ts") - F.expr("interval 2 days")).alias("limit"))
    return last.filter(F.col("updated") >= latest.scalar()).select("station", "updated")


@query("p06_updated_in_year", "SELECT o_custkey AS station, max(o_orderdate) AS updated FROM orders GROUP BY 1 HAVING year(max(o_orderdate)) = 2001")
def p06_updated_in_year(spark, sf):
    """Year filter on the last update."""
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("station")).agg(F.max("o_orderdate").alias("updated"))
    return last.filter(F.year("updated") == 2001)


@query("p07_attribute_filter", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def p07_attribute_filter(spark, sf):
    return table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")


@query("p08_day_slice", f"WITH {GAUGE} SELECT station, time, round(value + 1e-9, 6) AS value FROM gauge WHERE time::DATE = DATE '2024-01-15'")
def p08_day_slice(spark, sf):
    """One whole day, as a time range that reaches the scan."""
    return tidy(gauge(spark, sf).filter("time >= timestamp_ntz'2024-01-15' AND time < timestamp_ntz'2024-01-16'").drop("event_id"))


@query("p08_cross_section", f"WITH {HOURLY} SELECT station, round(value + 1e-9, 6) AS value FROM hourly WHERE time = TIMESTAMP '2024-01-15'")
def p08_cross_section(spark, sf):
    """All stations at exactly midnight of a day."""
    return tidy(hourly(spark, sf).filter(F.col("time") == F.expr("timestamp_ntz'2024-01-15'")).drop("time"))


@query("p09_prune_rename", "SELECT s_suppkey AS station_id, s_name AS label FROM supplier")
def p09_prune_rename(spark, sf):
    return table(spark, sf, "supplier").drop("s_acctbal", "s_nationkey").withColumnsRenamed({"s_suppkey": "station_id", "s_name": "label"})


SPARSE = "sparse AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS rare, CASE WHEN event_id % 20 <> 0 THEN value END AS dense FROM events)"


def sparse(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("rare"),
        F.when(F.col("event_id") % 20 != 0, F.col("value")).alias("dense"))


@query("a05_null_shares", f"""WITH {SPARSE} SELECT 'event_id' AS "column", count(*) - count(event_id) AS n_null, {pct('(count(*) - count(event_id))', 'count(*)')} AS pct_null FROM sparse
UNION ALL SELECT 'rare', count(*) - count(rare), {pct('(count(*) - count(rare))', 'count(*)')} FROM sparse
UNION ALL SELECT 'dense', count(*) - count(dense), {pct('(count(*) - count(dense))', 'count(*)')} FROM sparse""")
def a05_null_shares(spark, sf):
    return tidy(clean.null_shares(sparse(spark, sf)))


@query("p10_drop_sparse_columns", f"WITH {SPARSE} SELECT event_id, dense FROM sparse")
def p10_drop_sparse_columns(spark, sf):
    """P10: the column that is two thirds empty goes."""
    return tidy(clean.drop_sparse_columns(sparse(spark, sf), 0.5))


@query("p11_drop_null_rows", f"WITH {SPARSE} SELECT event_id, rare, dense FROM sparse WHERE rare IS NOT NULL AND dense IS NOT NULL")
def p11_drop_null_rows(spark, sf):
    """P11, W15."""
    return tidy(sparse(spark, sf).na.drop(subset=["rare", "dense"]))


DIRTY = """dirty AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE value::VARCHAR END AS raw,
 CASE WHEN event_id % 11 = 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events)"""


@query("p12_coerce", f"WITH {DIRTY} SELECT event_id, round(TRY_CAST(raw AS DOUBLE) + 1e-9, 6) AS value, TRY_CAST(stamp AS TIMESTAMP) AS time FROM dirty")
def p12_coerce(spark, sf):
    """Unreadable numbers and times become NULL."""
    from ..functions.numeric import number_or_null

    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 9 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("raw"),
        F.when(F.col("event_id") % 11 == 0, F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("stamp"))
    return tidy(rows.select("event_id", number_or_null("raw").alias("value"),
                            F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("time")))


@query("p13_to_utc", "SELECT event_id, ts - INTERVAL '1 hour' AS time FROM events")
def p13_to_utc(spark, sf):
    """Local times of a fixed +01:00 zone to UTC."""
    return table(spark, sf, "events").select(
        "event_id", F.convert_timezone(F.lit("+01:00"), F.lit("UTC"), "ts").alias("time"))


@query("p14_missing_indicator", f"WITH {SPARSE} SELECT event_id, (rare IS NULL)::BIGINT AS missing FROM sparse")
def p14_missing_indicator(spark, sf):
    return sparse(spark, sf).select("event_id", F.col("rare").isNull().cast("bigint").alias("missing"))


@query("p16_point_override", f"""WITH {GAUGE}, fix AS (SELECT event_type AS station, min(ts) AS time FROM events GROUP BY event_type, ts::DATE)
SELECT g.station, g.event_id, round(CASE WHEN f.time IS NULL THEN g.value END + 1e-9, 6) AS value FROM gauge g LEFT JOIN fix f ON f.station = g.station AND f.time = g.time""")
def p16_point_override(spark, sf):
    """A corrections table (here the first reading of each day) blanks readings."""
    rows = gauge(spark, sf)
    fixes = rows.groupBy("station", F.to_date("time").alias("d")).agg(F.min("time").alias("time")).drop("d")
    return tidy(clean.override_points(rows, fixes).select("station", "event_id", "value"))


@query("p17_row_at_position", f"WITH {GAUGE} SELECT station, time, event_id, round(value + 1e-9, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY time) AS rn FROM gauge) WHERE rn = 744")
def p17_row_at_position(spark, sf):
    return tidy(reshape.row_at(gauge(spark, sf), 743))


@query("p18_type_change", "SELECT event_id::VARCHAR AS id_text, trunc(value)::BIGINT AS whole FROM events")
def p18_type_change(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id_text"), F.col("value").cast("bigint").alias("whole"))


@query("l01_sort_by_time", f"WITH {HOURLY} SELECT station, time, round(value + 1e-9, 6) AS value FROM hourly ORDER BY station, time")
def l01_sort_by_time(spark, sf):
    """Range-partitioned sort at the sink."""
    return tidy(hourly(spark, sf)).orderBy("station", "time")


@query("l04_head", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 6")
def l04_head(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey").limit(6)


@query("l05_rows_at_maximum", "SELECT l_returnflag, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem l WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem m WHERE m.l_returnflag = l.l_returnflag)")
def l05_rows_at_maximum(spark, sf):
    """Every tie at the maximum of its group."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return tidy(stats.at_maximum(rows, "l_quantity", "l_returnflag"))


@query("u01_union_by_name", """SELECT n_name AS name, n_nationkey::BIGINT AS id, n_regionkey::BIGINT AS parent FROM nation
UNION ALL SELECT r_name, r_regionkey, NULL FROM region""")
def u01_union_by_name(spark, sf):
    a = table(spark, sf, "nation").selectExpr("n_name AS name", "n_nationkey AS id", "n_regionkey AS parent")
    b = table(spark, sf, "region").selectExpr("r_regionkey AS id", "r_name AS name")
    return tidy(reshape.union_all(a, b))


@query("u02_months_side_by_side", """SELECT month(l_shipdate) AS month, round(avg(l_quantity) FILTER (WHERE l_returnflag = 'A') + 1e-9, 6) AS "A",
 round(avg(l_quantity) FILTER (WHERE l_returnflag = 'N') + 1e-9, 6) AS "N", round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R') + 1e-9, 6) AS "R" FROM lineitem GROUP BY 1""")
def u02_months_side_by_side(spark, sf):
    """One column per series aligned on the month."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("value"))
    return tidy(reshape.side_by_side_months(rows, "station", ["A", "N", "R"]))


@query("u03_shared_ids", "SELECT o_custkey AS id FROM orders INTERSECT SELECT c_custkey FROM customer")
def u03_shared_ids(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("id")).intersect(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


@query("u04_missing_ids", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def u04_missing_ids(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).subtract(
        table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("id")))


@query("r01_long_to_wide", """WITH c AS (SELECT l_shipdate AS time, l_returnflag AS datatype, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2)
SELECT time, round(max(value) FILTER (WHERE datatype = 'A') + 1e-9, 6) AS "A", round(max(value) FILTER (WHERE datatype = 'N') + 1e-9, 6) AS "N",
 round(max(value) FILTER (WHERE datatype = 'R') + 1e-9, 6) AS "R" FROM c GROUP BY 1""")
def r01_long_to_wide(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("time"), F.col("l_returnflag").alias("datatype")).agg(F.avg("l_quantity").alias("value"))
    return tidy(reshape.widen(rows, "time", "datatype", "value", ["A", "N", "R"]))


@query("r02_pivot_of_means", """SELECT hour(ts) AS hour, round(avg(value) FILTER (WHERE event_type = 'click') + 1e-9, 6) AS click,
 round(avg(value) FILTER (WHERE event_type = 'error') + 1e-9, 6) AS error,
 round(avg(value) FILTER (WHERE event_type = 'purchase') + 1e-9, 6) AS purchase,
 round(avg(value) FILTER (WHERE event_type = 'signup') + 1e-9, 6) AS signup,
 round(avg(value) FILTER (WHERE event_type = 'view') + 1e-9, 6) AS view FROM events GROUP BY 1""")
def r02_pivot_of_means(spark, sf):
    """Means by hour and station, one column per station."""
    rows = table(spark, sf, "events").groupBy(F.hour("ts").alias("hour")).pivot("event_type", ["click", "error", "purchase", "signup", "view"]).agg(F.avg("value"))
    return tidy(rows)


@query("r03_station_report", f"""WITH {QUARTER}, {anchored_grid('quarter', 'grid')}, m AS (SELECT station, count(*) - count(value) AS n_missing FROM grid GROUP BY 1),
c AS (SELECT station, count(*) AS n_rows, count(*) FILTER (WHERE value < 0) AS n_negative FROM quarter GROUP BY 1)
SELECT station, n_rows, n_negative, n_missing FROM m JOIN c USING (station)""")
def r03_station_report(spark, sf):
    """One report row per station from several accounts."""
    rows = quarter(spark, sf)
    counts = rows.groupBy("station").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value") < 0).alias("n_negative"))
    return tidy(counts.join(gaps.missing_slots(rows).select("station", "n_missing"), "station"))


@query("a23_frequency", "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC")
def a23_frequency(spark, sf):
    rows = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return tidy(stats.value_counts(rows, "year")).orderBy(F.desc("n"))


@query("f11_midnight", "SELECT event_id, date_trunc('day', ts) AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def f11_midnight(spark, sf):
    """time text and day start."""
    return table(spark, sf, "events").select("event_id", midnight("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
