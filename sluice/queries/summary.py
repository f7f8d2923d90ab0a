"""Statistics, decomposition and smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decompose as dec
from ..operators import lowess as low
from ..operators import stats
from ..operators.grid import bucket
from .base import (
    GAUGE, HOURLY, SHIPMENTS, TABLE_BLOCK, gauge, hourly, query, shipments, table, tidy,
)
from .featured import corr_sql


def lines(spark, sf):
    """Shipments by return flag: seven years of readings in three stations."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("value"),
        "l_orderkey", "l_linenumber")


LINES = "readings AS (SELECT l_returnflag AS station, l_shipdate AS time, l_quantity AS value, l_orderkey, l_linenumber FROM lineitem)"


@query("a03_describe", f"""WITH {GAUGE} SELECT station, count(value) AS count, round(avg(value) + 1e-9, 6) AS mean, round(stddev_samp(value) + 1e-9, 6) AS std,
 round(min(value) + 1e-9, 6) AS min, round(quantile_cont(value, 0.25) + 1e-9, 6) AS p25, round(quantile_cont(value, 0.5) + 1e-9, 6) AS p50,
 round(quantile_cont(value, 0.75) + 1e-9, 6) AS p75, round(max(value) + 1e-9, 6) AS max FROM gauge GROUP BY 1""")
def a03_describe(spark, sf):
    return tidy(stats.describe(gauge(spark, sf)))


@query("a04_series_health", """WITH g AS (SELECT event_type AS station, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value - 5 END AS value FROM events)
SELECT station, count(*) - count(value) AS n_missing, count(*) FILTER (WHERE value < 0) AS n_negative, round(skewness(value) + 1e-9, 6) AS skewness FROM g GROUP BY 1""")
def a04_series_health(spark, sf):
    rows = gauge(spark, sf).withColumn("value", F.when(F.col("event_id") % 13 != 0, F.col("value")))
    return tidy(stats.series_health(rows))


@query("a08_month_year_pivot", "SELECT month(l_shipdate) AS month, " + ", ".join(
    f"round(avg(l_quantity) FILTER (WHERE year(l_shipdate) = {y}) + 1e-9, 6) AS y{y}" for y in range(1995, 2002)) + " FROM lineitem GROUP BY 1")
def a08_month_year_pivot(spark, sf):
    out = stats.calendar_pivot(lines(spark, sf), ("month", F.month("time")), ("year", F.year("time")), range(1995, 2002))
    return tidy(out)


@query("a08_week_year_pivot", "SELECT week(l_shipdate) AS week, " + ", ".join(
    f"round(avg(l_quantity) FILTER (WHERE year(l_shipdate) = {y}) + 1e-9, 6) AS y{y}" for y in range(1995, 2002)) + " FROM lineitem GROUP BY 1")
def a08_week_year_pivot(spark, sf):
    """ISO week with the calendar year, so late December may count as week 1 of the same year."""
    out = stats.calendar_pivot(lines(spark, sf), ("week", F.weekofyear("time")), ("year", F.year("time")), range(1995, 2002))
    return tidy(out)


@query("a09_profile_month_year", "SELECT month(l_shipdate) AS month, year(l_shipdate) AS year, round(avg(l_quantity) + 1e-9, 6) AS mean FROM lineitem GROUP BY 1, 2")
def a09_profile_month_year(spark, sf):
    return tidy(stats.profile(lines(spark, sf), month=F.month("time"), year=F.year("time")))


@query("a09_profile_hour_weekday", f"WITH {GAUGE} SELECT hour(time) AS hour, isodow(time) - 1 AS weekday, round(avg(value) + 1e-9, 6) AS mean FROM gauge GROUP BY 1, 2")
def a09_profile_hour_weekday(spark, sf):
    return tidy(stats.profile(gauge(spark, sf), hour=F.hour("time"), weekday=F.weekday("time")))


def _box(part: str, name: str) -> str:
    keys = f"station, {name}"
    return f"""WITH r AS (SELECT l_returnflag AS station, {part} AS {name}, l_extendedprice AS value FROM lineitem),
q AS (SELECT {keys}, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM r GROUP BY ALL)
SELECT {keys}, round(any_value(p25) + 1e-9, 6) AS p25, round(any_value(p50) + 1e-9, 6) AS p50, round(any_value(p75) + 1e-9, 6) AS p75,
 min(value) FILTER (WHERE value BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)) AS low_whisker,
 max(value) FILTER (WHERE value BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)) AS high_whisker,
 count(*) FILTER (WHERE NOT value BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)) AS n_outside
FROM r JOIN q USING ({keys}) GROUP BY ALL"""


def prices(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("value"))


@query("a10_box_by_month", _box("month(l_shipdate)", "month"))
def a10_box_by_month(spark, sf):
    return tidy(stats.box_stats(prices(spark, sf).withColumn("month", F.month("time")), ["station", "month"]))


@query("a10_box_by_week", _box("week(l_shipdate)", "week"))
def a10_box_by_week(spark, sf):
    return tidy(stats.box_stats(prices(spark, sf).withColumn("week", F.weekofyear("time")), ["station", "week"]))


ANOMALY = f"{LINES}, a AS (SELECT station, time, value - avg(value) OVER (PARTITION BY station, month(time)) AS anomaly FROM readings)"


@query("a11_monthly_anomaly", f"WITH {ANOMALY} SELECT station, year(time) AS year, month(time) AS month, round(avg(anomaly) + 1e-9, 6) AS anomaly FROM a GROUP BY 1, 2, 3")
def a11_monthly_anomaly(spark, sf):
    """Anomalies averaged by year and month, long form."""
    rows = stats.monthly_anomaly(lines(spark, sf), block=365 * 86400)
    return tidy(rows.groupBy("station", F.year("time").alias("year"), "month").agg(F.avg("anomaly").alias("anomaly")))


@query("a11_anomaly_pivot", f"WITH {ANOMALY} SELECT year(time) AS year, " + ", ".join(
    f"round(avg(anomaly) FILTER (WHERE month(time) = {m}) + 1e-9, 6) AS m{m}" for m in range(1, 13)) + " FROM a GROUP BY 1")
def a11_anomaly_pivot(spark, sf):
    rows = stats.monthly_anomaly(lines(spark, sf), block=365 * 86400).drop("value", "month")
    return tidy(stats.calendar_pivot(rows, ("year", F.year("time")), ("month", F.month("time")), range(1, 13), "anomaly", prefix="m"))


@query("a12_extreme_events", f"""WITH {GAUGE}, q AS (SELECT station, quantile_cont(value, 0.99) AS lim FROM gauge GROUP BY 1)
SELECT station, time, round(value + 1e-9, 6) AS value FROM gauge JOIN q USING (station) WHERE value >= lim""")
def a12_extreme_events(spark, sf):
    return tidy(stats.extreme_events(gauge(spark, sf)).select("station", "time", "value"))


@query("a13_sum_per_station", """SELECT user_id AS station, round(coalesce(sum(CASE WHEN event_type = 'view' THEN value END), 0) + 1e-9, 6) AS total FROM events GROUP BY 1""")
def a13_sum_per_station(spark, sf):
    """Total per station, zero where nothing is known."""
    rows = table(spark, sf, "events").groupBy(F.col("user_id").alias("station"))
    return tidy(rows.agg(F.coalesce(F.sum(F.when(F.col("event_type") == "view", F.col("value"))), F.lit(0.0)).alias("total")))


@query("a13_dry_stations", """SELECT l_orderkey AS station FROM lineitem GROUP BY 1 HAVING coalesce(sum(CASE WHEN l_discount > 0.03 THEN l_discount END), 0) = 0""")
def a13_dry_stations(spark, sf):
    """Stations whose total is zero; the discount stands in for rain."""
    dry = F.coalesce(F.sum(F.when(F.col("l_discount") > 0.03, F.col("l_discount"))), F.lit(0.0))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("station")).agg(dry.alias("t")).filter("t = 0").drop("t")


def _hist(bins: int) -> str:
    return f"""WITH {GAUGE}, e AS (SELECT station, min(value) AS lo, max(value) AS hi FROM gauge GROUP BY 1),
b AS (SELECT station, least(floor((value - lo) / ((hi - lo) / {bins})), {bins} - 1)::BIGINT AS bin, lo, hi FROM gauge JOIN e USING (station))
SELECT station, bin, count(*) AS n, round(any_value(lo + (hi - lo) / {bins} * bin) + 1e-9, 6) AS low_edge FROM b GROUP BY 1, 2"""


@query("a14_histogram_50", _hist(50))
def a14_histogram_50(spark, sf):
    return tidy(stats.histogram(gauge(spark, sf), 50))


@query("a14_histogram_100", _hist(100))
def a14_histogram_100(spark, sf):
    return tidy(stats.histogram(gauge(spark, sf), 100))


@query("a15_inventory", """SELECT user_id AS station, count(*) AS n_rows, round(avg(value) + 1e-9, 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY 1""")
def a15_inventory(spark, sf):
    """Rows and value range per station."""
    rows = table(spark, sf, "events").withColumnRenamed("user_id", "station")
    return tidy(rows.groupBy("station").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")))


@query("a16_granularity", f"""WITH {GAUGE}, d AS (SELECT station, value, (epoch_us(time) - lag(epoch_us(time)) OVER (PARTITION BY station ORDER BY time)) / 1000000.0::DOUBLE AS gap FROM gauge)
SELECT station, count(*) AS n_rows, round(avg(value) + 1e-9, 6) AS mean, round(min(value) + 1e-9, 6) AS min, round(max(value) + 1e-9, 6) AS max,
 round(quantile_cont(gap, 0.5) + 1e-9, 6) AS median_gap_seconds FROM d GROUP BY 1""")
def a16_granularity(spark, sf):
    """A16, W16."""
    return tidy(stats.granularity(gauge(spark, sf), block=TABLE_BLOCK))


@query("a17_time_extent", f"WITH {GAUGE} SELECT station, min(time) AS first_time, max(time) AS last_time FROM gauge GROUP BY 1")
def a17_time_extent(spark, sf):
    from ..operators.grid import spans

    return spans(gauge(spark, sf), "station")


A18_COLS = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


@query("a18_correlation_with_target", "WITH r AS (SELECT *, 7 AS constant FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs({corr_sql(c, 'l_extendedprice')}) + 1e-9, 6) AS abs_r FROM r" for c in (*A18_COLS, "constant")))
def a18_correlation_with_target(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("constant", F.lit(7))
    return tidy(stats.correlation_with(rows, "l_extendedprice", [*A18_COLS, "constant"]))


@query("c02_vif", f"""WITH r AS (SELECT {corr_sql('l_quantity', 'l_extendedprice')} AS a, {corr_sql('l_quantity', 'l_discount')} AS b, {corr_sql('l_extendedprice', 'l_discount')} AS c FROM lineitem),
d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM r)
SELECT 'l_quantity' AS feature, round((1 - c * c) / det + 1e-9, 6) AS vif FROM d UNION ALL SELECT 'l_extendedprice', round((1 - b * b) / det + 1e-9, 6) FROM d
UNION ALL SELECT 'l_discount', round((1 - a * a) / det + 1e-9, 6) FROM d""")
def c02_vif(spark, sf):
    """The inverse of a 3 x 3 correlation matrix, written out in the SQL twin."""
    return tidy(stats.vif(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


TRUTH = f"{HOURLY}, truth AS (SELECT station, time, value AS y_true, lag(value) OVER (PARTITION BY station ORDER BY time) AS y_pred FROM hourly), pair AS (SELECT * FROM truth WHERE y_pred IS NOT NULL)"


def truth(spark, sf):
    """Each hourly level against the one before it."""
    from ..operators.blocks import BLK, in_blocks, with_previous

    rows = with_previous(in_blocks(hourly(spark, sf), "station", "time", TABLE_BLOCK), "station", "time", "value", "y_pred")
    return rows.filter(F.col("y_pred").isNotNull()).select("station", "time", F.col("value").alias("y_true"), "y_pred").drop(BLK)


@query("a24_regression_metrics", f"""WITH {TRUTH}, m AS (SELECT *, avg(y_true) OVER (PARTITION BY station) AS mean FROM pair)
SELECT station, count(*) AS n, round(sqrt(avg((y_true - y_pred) ** 2)) + 1e-9, 6) AS rmse, round(avg(abs(y_true - y_pred)) + 1e-9, 6) AS mae,
 round(1 - sum((y_true - y_pred) ** 2) / sum((y_true - mean) ** 2) + 1e-9, 6) AS r2 FROM m GROUP BY 1""")
def a24_regression_metrics(spark, sf):
    return tidy(stats.regression_metrics(truth(spark, sf)))


@query("m07_residuals", f"WITH {TRUTH} SELECT station, time, round(y_true - y_pred + 1e-9, 6) AS residual FROM pair")
def m07_residuals(spark, sf):
    return tidy(truth(spark, sf).select("station", "time", (F.col("y_true") - F.col("y_pred")).alias("residual")))


@query("m08_linear_regression", f"""WITH {TRUTH} SELECT station, round(regr_slope(y_true, y_pred) + 1e-9, 6) AS slope, round(regr_intercept(y_true, y_pred) + 1e-9, 6) AS intercept,
 round(regr_r2(y_true, y_pred) + 1e-9, 6) AS r2 FROM pair GROUP BY 1""")
def m08_linear_regression(spark, sf):
    """Least squares line of every station in one aggregate."""
    return tidy(truth(spark, sf).groupBy("station").agg(
        F.regr_slope("y_true", "y_pred").alias("slope"), F.regr_intercept("y_true", "y_pred").alias("intercept"), F.regr_r2("y_true", "y_pred").alias("r2")))


@query("a25_outliers_zscore", f"""WITH {GAUGE}, l AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM gauge GROUP BY 1)
SELECT station, time, round(value + 1e-9, 6) AS value FROM gauge JOIN l USING (station) WHERE abs((value - m) / nullif(s, 0)) > 3""")
def a25_outliers_zscore(spark, sf):
    return tidy(stats.flag_outliers(gauge(spark, sf), block=TABLE_BLOCK).select("station", "time", "value"))


@query("a25_outliers_iqr", f"""WITH {GAUGE}, l AS (SELECT station, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM gauge GROUP BY 1)
SELECT station, time, round(value + 1e-9, 6) AS value FROM gauge JOIN l USING (station) WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def a25_outliers_iqr(spark, sf):
    return tidy(stats.flag_outliers(gauge(spark, sf), method="iqr").select("station", "time", "value"))


@query("a28_negative_counts", "SELECT user_id AS station, count(*) FILTER (WHERE value - 5 < 0) AS n_negative FROM events GROUP BY 1")
def a28_negative_counts(spark, sf):
    rows = table(spark, sf, "events").select(F.col("user_id").alias("station"), (F.col("value") - 5).alias("value"))
    return tidy(stats.negative_counts(rows))


def decompose_sql(src: str, period: int, model: str = "additive", extrapolate: bool = False) -> str:
    h = period // 2
    half = f"- (lag(value, {h}) OVER w + lead(value, {h}) OVER w) / 2.0" if period % 2 == 0 else ""
    op = "-" if model == "additive" else "/"
    ext = (f"""coalesce(trend, CASE WHEN rn <= {h} THEN f0 + (f1 - f0) * (rn - {h} - 1) ELSE l1 + (l1 - l0) * (rn - (n - {h})) END) AS trend""" if extrapolate else "trend")
    return f"""num AS (SELECT station, time, value, row_number() OVER (PARTITION BY station ORDER BY time) AS rn, count(*) OVER (PARTITION BY station) AS n FROM {src}),
tr AS (SELECT *, CASE WHEN rn > {h} AND rn <= n - {h} THEN (sum(value) OVER (PARTITION BY station ORDER BY rn ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) {half}) / {period} END AS trend
  FROM num WINDOW w AS (PARTITION BY station ORDER BY rn)),
ends AS (SELECT station, max(trend) FILTER (WHERE rn = {h} + 1) AS f0, max(trend) FILTER (WHERE rn = {h} + 2) AS f1,
  max(trend) FILTER (WHERE rn = n - {h} - 1) AS l0, max(trend) FILTER (WHERE rn = n - {h}) AS l1 FROM tr GROUP BY 1),
ext AS (SELECT station, time, value, rn, {ext} FROM tr JOIN ends USING (station)),
pos AS (SELECT station, (rn - 1) % {period} AS p, avg(value {op} trend) AS m FROM ext GROUP BY 1, 2),
sea AS (SELECT station, p, m {op} avg(m) OVER (PARTITION BY station) AS seasonal FROM pos)
SELECT station, time, round(value + 1e-9, 6) AS value, round(trend + 1e-9, 6) AS trend, round(seasonal + 1e-9, 6) AS seasonal,
 round({'value - trend - seasonal' if op == '-' else 'value / (trend * seasonal)'} + 1e-9, 6) AS resid
FROM ext JOIN sea ON sea.station = ext.station AND sea.p = (ext.rn - 1) % {period}""".replace("SELECT station, time, round(value", "SELECT ext.station, ext.time, round(value")


@query("ts9_decompose_daily", f"WITH {SHIPMENTS}, {decompose_sql('shipments', 7)}")
def ts9_decompose_daily(spark, sf):
    """TS9, odd period: a week of days."""
    return tidy(dec.decompose(shipments(spark, sf), 7))


@query("ts9_decompose_yearly", f"WITH {SHIPMENTS}, {decompose_sql('shipments', 365)}")
def ts9_decompose_yearly(spark, sf):
    """TS9 with a long period."""
    return tidy(dec.decompose(shipments(spark, sf), 365))


@query("ts9_decompose_hourly", f"WITH {HOURLY}, {decompose_sql('hourly', 24)}")
def ts9_decompose_hourly(spark, sf):
    """TS9, even period."""
    return tidy(dec.decompose(hourly(spark, sf), 24))


@query("ts9_decompose_multiplicative", f"WITH {SHIPMENTS}, {decompose_sql('shipments', 30, 'multiplicative')}")
def ts9_decompose_multiplicative(spark, sf):
    return tidy(dec.decompose(shipments(spark, sf), 30, model="multiplicative"))


@query("ts9_decompose_extrapolated", f"WITH {HOURLY}, {decompose_sql('hourly', 24, extrapolate=True)}")
def ts9_decompose_extrapolated(spark, sf):
    """TS9 as in the exploration bundle: the trend continues to both ends."""
    return tidy(dec.decompose(hourly(spark, sf), 24, extrapolate=True))


@query("a26_eda_summary", f"""WITH {HOURLY}, l AS (SELECT station, avg(value) AS m, stddev_samp(value) AS s FROM hourly GROUP BY 1)
SELECT station, count(value) AS count, round(avg(value) + 1e-9, 6) AS mean, count(*) FILTER (WHERE value < 0) AS n_negative,
 round(skewness(value) + 1e-9, 6) AS skewness, count(*) FILTER (WHERE abs((value - m) / s) > 3) AS n_outliers FROM hourly JOIN l USING (station) GROUP BY 1""")
def a26_eda_summary(spark, sf):
    """The parts of the exploration bundle joined per station (its decomposition is checked above)."""
    parts = stats.eda_bundle(hourly(spark, sf))
    outliers = parts["outliers"].groupBy("station").agg(F.count(F.lit(1)).alias("n_outliers"))
    out = parts["summary_stats"].join(parts["health"], "station").join(outliers, "station", "left")
    return tidy(out.select("station", "count", "mean", "n_negative", "skewness", F.coalesce("n_outliers", F.lit(0)).alias("n_outliers")))


def lowess_sql(src: str, frac: str) -> str:
    """Zero robust passes: the k nearest points by distance, tricube weights, weighted line."""
    return f"""pts AS (SELECT station, x, value, count(*) OVER (PARTITION BY station) AS n FROM {src}),
d AS (SELECT a.station, a.x, a.value AS own, b.x AS bx, b.value AS y, abs(b.x - a.x) AS dist, floor({frac} * a.n + 1e-10) AS k FROM pts a JOIN pts b USING (station)),
r AS (SELECT *, row_number() OVER (PARTITION BY station, x ORDER BY dist, bx) AS o FROM d),
h AS (SELECT station, x, max(dist) FILTER (WHERE o <= k) AS h FROM r GROUP BY 1, 2),
wt AS (SELECT d.*, CASE WHEN dist < h THEN (1 - (dist / h) ** 3) ** 3 ELSE 0 END AS w, bx - d.x AS dx FROM d JOIN h ON h.station = d.station AND h.x = d.x),
s AS (SELECT station, x, any_value(own) AS own, sum(w) AS w, sum(w * dx) AS sx, sum(w * y) AS sy, sum(w * dx * dx) AS sxx, sum(w * dx * y) AS sxy FROM wt GROUP BY 1, 2)
SELECT station, x, round(own + 1e-9, 6) AS value, round((sxx * sy - sx * sxy) / (w * sxx - sx * sx) + 1e-9, 6) AS smooth FROM s"""


@query("ts10_lowess", f"""WITH {GAUGE}, pos AS (SELECT station, time_bucket(INTERVAL '1 hour', time) AS time, avg(value) AS value FROM gauge WHERE value >= 0 GROUP BY 1, 2),
src AS (SELECT station, epoch(time)::BIGINT // 3600 AS x, value FROM pos), {lowess_sql('src', '0.05::DOUBLE')}""")
def ts10_lowess(spark, sf):
    """TS10: negatives dropped, hourly means, five percent of the points, no robust pass."""
    rows = gauge(spark, sf).filter("value >= 0").groupBy("station", bucket("time", 3600).alias("time")).agg(F.avg("value").alias("value"))
    rows = rows.withColumn("x", F.floor(F.unix_seconds(F.col("time").cast("timestamp")) / 3600))
    return tidy(low.lowess(rows, 0.05, passes=0).select("station", "x", "value", "smooth"))


def lowess_passes_sql(src: str, frac: str, passes: int) -> str:
    """The local fit repeated with weights from the residuals of the fit before it."""
    out = [f"pts AS (SELECT station, x, value, count(*) OVER (PARTITION BY station) AS n FROM {src})", "r0 AS (SELECT station, x, 1.0::DOUBLE AS r FROM pts)"]
    for p in range(passes + 1):
        out += [
            f"""d{p} AS (SELECT a.station, a.x, a.value AS own, b.x AS bx, b.value AS y, w.r, abs(b.x - a.x) AS dist, floor({frac} * a.n + 1e-10) AS k
 FROM pts a JOIN pts b USING (station) JOIN r{p} w ON w.station = b.station AND w.x = b.x)""",
            f"o{p} AS (SELECT *, row_number() OVER (PARTITION BY station, x ORDER BY dist, bx) AS o FROM d{p})",
            f"h{p} AS (SELECT station, x, max(dist) FILTER (WHERE o <= k) AS h FROM o{p} GROUP BY 1, 2)",
            f"t{p} AS (SELECT d.*, CASE WHEN dist < h THEN (1 - (dist / h) ** 3) ** 3 ELSE 0 END * r AS w, bx - d.x AS dx FROM d{p} d JOIN h{p} h ON h.station = d.station AND h.x = d.x)",
            f"s{p} AS (SELECT station, x, any_value(own) AS own, sum(w) AS w, sum(w * dx) AS sx, sum(w * y) AS sy, sum(w * dx * dx) AS sxx, sum(w * dx * y) AS sxy FROM t{p} GROUP BY 1, 2)",
            f"f{p} AS (SELECT station, x, own, (sxx * sy - sx * sxy) / (w * sxx - sx * sx) AS smooth FROM s{p})",
            f"m{p} AS (SELECT station, 6 * quantile_cont(abs(own - smooth), 0.5) AS s FROM f{p} GROUP BY 1)",
            f"r{p + 1} AS (SELECT station, x, CASE WHEN abs(own - smooth) < s THEN (1 - ((own - smooth) / s) ** 2) ** 2 ELSE 0 END AS r FROM f{p} JOIN m{p} USING (station))",
        ]
    return ", ".join(out) + f" SELECT station, x, round(own + 1e-9, 6) AS value, round(smooth + 1e-9, 6) AS smooth FROM f{passes}"


@query("ts10_lowess_robust", f"""WITH src AS (SELECT l_returnflag AS station, date_diff('day', DATE '1995-01-01', date_trunc('month', l_shipdate)::DATE) AS x, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
{lowess_passes_sql('src', '0.3::DOUBLE', 3)}""")
def ts10_lowess_robust(spark, sf):
    """TS10 with three robust passes on monthly means; each pass is written to the shared folder."""
    rows = lines(spark, sf).groupBy("station", F.trunc("time", "month").alias("time")).agg(F.avg("value").alias("value"))
    rows = rows.withColumn("x", F.datediff("time", F.lit("1995-01-01").cast("date")))
    return tidy(low.lowess(rows, 0.3, passes=3).select("station", "x", "value", "smooth"))


@query("a29_availability", """WITH r AS (SELECT o_orderdate AS time, avg(o_totalprice) AS level FROM orders GROUP BY 1),
w AS (SELECT l_shipdate AS date, sum(l_quantity) AS rain FROM lineitem GROUP BY 1)
SELECT count(time) AS n_time, count(level) AS n_level, count(date) AS n_date, count(rain) AS n_rain FROM r FULL JOIN w ON r.time = w.date""")
def a29_availability(spark, sf):
    """Known cells after a full outer join."""
    from .joined import daily_levels, daily_rain
    from ..operators.joins import outer_two_keys

    out = outer_two_keys(daily_levels(spark, sf), daily_rain(spark, sf), "time", "date")
    return tidy(out.agg(*[F.count(c).alias(f"n_{c}") for c in ("time", "level", "date", "rain")]))
