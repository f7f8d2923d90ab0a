"""Feature engineering and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import text
from ..operators import features
from ..operators.grid import bucket
from .base import (
    GAUGE, HOURLY, PAIRED, TABLE_BLOCK, gauge, hourly, paired, query, table, tidy,
)

WINDOWS = (3, 6, 12, 24)


def numbered(spark, sf, src=paired):
    return features.numbered(src(spark, sf), block=TABLE_BLOCK)


W = "OVER (PARTITION BY station ORDER BY rn)"


def roll(n: int) -> str:
    return f"OVER (PARTITION BY station ORDER BY rn ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) {roll(n)} = {n} THEN {agg}({c}) {roll(n)} END"


@query("w01_lead_target", f"WITH {PAIRED} SELECT station, rn, round(level + 1e-9, 6) AS level, round(lead(level, 6) {W} + 1e-9, 6) AS target_t_plus_6 FROM paired")
def w01_lead_target(spark, sf):
    out = features.lead_and_lags(numbered(spark, sf), "station", "rn", {}, {"level": 6})
    return tidy(out.select("station", "rn", "level", "target_t_plus_6"))


@query("w02_target_lags", f"WITH {PAIRED} SELECT station, rn, " + ", ".join(f"round(lag(level, {k}) {W} + 1e-9, 6) AS level_lag_{k}h" for k in range(1, 7)) + " FROM paired")
def w02_target_lags(spark, sf):
    out = features.lead_and_lags(numbered(spark, sf), "station", "rn", {"level": range(1, 7)})
    return tidy(out.select("station", "rn", *[f"level_lag_{k}h" for k in range(1, 7)]))


@query("w03_weather_lags", f"WITH {PAIRED} SELECT station, rn, " + ", ".join(f"round(lag(rain, {k}) {W} + 1e-9, 6) AS rain_lag_{k}h" for k in range(7)) + " FROM paired")
def w03_weather_lags(spark, sf):
    out = features.lead_and_lags(numbered(spark, sf), "station", "rn", {"rain": range(7)})
    return tidy(out.select("station", "rn", *[f"rain_lag_{k}h" for k in range(7)]))


@query("c06_configured_lags", f"WITH {PAIRED} SELECT station, rn, " + ", ".join(f"round(lag(level, {k}) {W} + 1e-9, 6) AS level_lag_{k}h" for k in (1, 3, 6, 12, 24)) + " FROM paired")
def c06_configured_lags(spark, sf):
    """The lags of the configuration file."""
    out = features.lead_and_lags(numbered(spark, sf), "station", "rn", {"level": [1, 3, 6, 12, 24]})
    return tidy(out.select("station", "rn", *[f"level_lag_{k}h" for k in (1, 3, 6, 12, 24)]))


@query("w04_rolling_mean_std", f"WITH {PAIRED} SELECT station, rn, " + ", ".join(
    f"round({full(a, 'level', n)} + 1e-9, 6) AS level_rolling_{b}_{n}h" for n in WINDOWS for a, b in (("avg", "mean"), ("stddev_samp", "std"))) + " FROM paired")
def w04_rolling_mean_std(spark, sf):
    out = features.rolling(numbered(spark, sf), "station", "rn", "level", WINDOWS)
    return tidy(out.select("station", "rn", *[f"level_rolling_{b}_{n}h" for n in WINDOWS for b in ("mean", "std")]))


@query("w04_twelve_month_mean", """
WITH m AS (SELECT l_returnflag AS station, last_day(l_shipdate) AS time, avg(l_quantity) AS value, row_number() OVER (PARTITION BY l_returnflag ORDER BY last_day(l_shipdate)) AS rn
  FROM lineitem GROUP BY 1, 2)
SELECT station, time, round(CASE WHEN count(value) OVER w = 12 THEN avg(value) OVER w END + 1e-9, 6) AS value_rolling_mean_12h FROM m
WINDOW w AS (PARTITION BY station ORDER BY rn ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def w04_twelve_month_mean(spark, sf):
    """W04 over monthly means."""
    from ..operators.grid import month_mean

    rows = month_mean(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("value")), "station")
    out = features.rolling(features.numbered(rows, block=3650 * 86400), "station", "rn", "value", [12], ["mean"])
    return tidy(out.select("station", "time", "value_rolling_mean_12h"))


@query("w05_rolling_rain", f"WITH {PAIRED} SELECT station, rn, " + ", ".join(
    f"round({full(a, 'rain', n)} + 1e-9, 6) AS rain_rolling_{b}_{n}h" for n in WINDOWS for a, b in (("sum", "sum"), ("avg", "mean"), ("stddev_samp", "std"))) + " FROM paired")
def w05_rolling_rain(spark, sf):
    out = features.rolling(numbered(spark, sf), "station", "rn", "rain", WINDOWS, ("sum", "mean", "std"))
    return tidy(out.select("station", "rn", *[f"rain_rolling_{b}_{n}h" for n in WINDOWS for b in ("sum", "mean", "std")]))


@query("w06_differences", f"WITH {PAIRED} SELECT station, rn, round(level - lag(level, 1) {W} + 1e-9, 6) + 0.0::DOUBLE AS level_diff_1h, round(level - lag(level, 2) {W} + 1e-9, 6) + 0.0::DOUBLE AS level_diff_2h FROM paired")
def w06_differences(spark, sf):
    out = features.differences(numbered(spark, sf), "station", "rn", "level")
    return tidy(out.select("station", "rn", "level_diff_1h", "level_diff_2h"))


def ewm_sql(src: str, col: str, span: int, out: str) -> str:
    """Recursive walk over each series, the plain definition of the weighted mean."""
    a = 2.0 / (span + 1)
    return f"""{out} AS (
 SELECT station, rn, {col} AS x, {col} AS y, 1.0::DOUBLE AS w FROM {src} WHERE rn = 1
 UNION ALL
 SELECT e.station, p.rn, p.{col},
   CASE WHEN e.y IS NULL THEN p.{col} WHEN p.{col} IS NULL THEN e.y
        ELSE (e.w * {1 - a!r} * e.y + {a!r} * p.{col}) / (e.w * {1 - a!r} + {a!r}) END,
   CASE WHEN e.y IS NULL OR p.{col} IS NOT NULL THEN 1.0 ELSE e.w * {1 - a!r} END
 FROM {out} e JOIN {src} p ON p.station = e.station AND p.rn = e.rn + 1)"""


EWM_BASE = PAIRED.replace("LEFT JOIN rainfall r USING (time))", "LEFT JOIN rainfall r USING (time)), gappy AS (SELECT station, rn, CASE WHEN level >= 10 THEN level END AS level, rain FROM paired)")


@query("w07_ewma", f"""WITH RECURSIVE {EWM_BASE}, {ewm_sql('gappy', 'level', 3, 'e3')}, {ewm_sql('gappy', 'level', 24, 'e24')}, {ewm_sql('gappy', 'rain', 6, 'r6')}
SELECT a.station, a.rn, round(a.y + 1e-9, 6) AS level_ewm_mean_3h, round(b.y + 1e-9, 6) AS level_ewm_mean_24h, round(c.y * 6 + 1e-9, 6) AS rain_ewm_sum_6h
FROM e3 a JOIN e24 b ON a.station = b.station AND a.rn = b.rn JOIN r6 c ON a.station = c.station AND a.rn = c.rn""")
def w07_ewma(spark, sf):
    """Weighted means of a level with gaps, and the rain version times its span. Blocks are small
    enough here that carries cross several of them."""
    rows = numbered(spark, sf).withColumn("level", F.when(F.col("level") >= 10, F.col("level")))
    specs = {"level_ewm_mean_3h": ("level", 3), "level_ewm_mean_24h": ("level", 24), "rain_ewm_sum_6h": ("rain", 6)}
    out = features.ewma(rows, "station", "rn", specs, rows=16, fan=4)
    return tidy(out.withColumn("rain_ewm_sum_6h", F.col("rain_ewm_sum_6h") * 6).select("station", "rn", *specs))


def corr_sql(a: str, b: str, over: str = "") -> str:
    """Pearson r over complete pairs, NULL where a side is constant."""
    sa, sb = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return f"covar_samp({a}, {b}) {over} / nullif(stddev_samp({sa}) {over} * stddev_samp({sb}) {over}, 0)"


def _rolling_corr(n: int) -> str:
    r = roll(n)
    return (f"WITH {PAIRED} SELECT station, rn, round(CASE WHEN count(CASE WHEN level IS NOT NULL AND rain IS NOT NULL THEN 1 END) {r} = {n} "
            f"THEN {corr_sql('level', 'rain', r)} END + 1e-9, 6) AS rolling_corr FROM paired")


@query("w08_rolling_corr_24", _rolling_corr(24))
def w08_rolling_corr_24(spark, sf):
    return tidy(features.rolling_corr(numbered(spark, sf), "station", "rn", "level", "rain", 24).select("station", "rn", "rolling_corr"))


@query("w08_rolling_corr_6", _rolling_corr(6))
def w08_rolling_corr_6(spark, sf):
    return tidy(features.rolling_corr(numbered(spark, sf), "station", "rn", "level", "rain", 6).select("station", "rn", "rolling_corr"))


def lag_corr_sql(a: str, b: str, lags) -> str:
    cols = ", ".join(f"lag({b}, {k}) {W} AS l{k}" for k in lags)
    rows = " UNION ALL ".join(f"SELECT station, {k}::BIGINT AS lag, round({corr_sql(a, f'l{k}')} + 1e-9, 6) AS r FROM s GROUP BY 1" for k in lags)
    return f"s AS (SELECT station, {a}, {cols} FROM paired) {rows}"


@query("w09_lagged_corr", f"WITH {PAIRED}, {lag_corr_sql('level', 'rain', range(1, 25))}")
def w09_lagged_corr(spark, sf):
    return tidy(features.lagged_corr(numbered(spark, sf), "station", "rn", "level", "rain", range(1, 25)))


@query("c01_acf", f"WITH {PAIRED}, {lag_corr_sql('level', 'level', range(1, 13))}")
def c01_acf(spark, sf):
    """Autocorrelation of each series."""
    return tidy(features.lagged_corr(numbered(spark, sf), "station", "rn", "level", "level", range(1, 13)))


@query("f06_time_features", f"""WITH {GAUGE} SELECT event_id, round(sin(2 * pi() * hour(time) / 24) + 1e-9, 6) + 0.0::DOUBLE AS hour_sin, round(cos(2 * pi() * hour(time) / 24) + 1e-9, 6) + 0.0::DOUBLE AS hour_cos,
 round(sin(2 * pi() * (isodow(time) - 1) / 7) + 1e-9, 6) + 0.0::DOUBLE AS day_sin, round(cos(2 * pi() * (isodow(time) - 1) / 7) + 1e-9, 6) + 0.0::DOUBLE AS day_cos,
 round(sin(2 * pi() * month(time) / 12) + 1e-9, 6) + 0.0::DOUBLE AS month_sin, round(cos(2 * pi() * month(time) / 12) + 1e-9, 6) + 0.0::DOUBLE AS month_cos,
 (isodow(time) >= 6)::BIGINT AS is_weekend FROM gauge""")
def f06_time_features(spark, sf):
    """F06, F07."""
    return tidy(cal.time_features(gauge(spark, sf)).drop("station", "time", "value"))


@query("f01_calendar_parts", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, year(t) AS year, month(t) AS month, hour(t) AS hour, minute(t) AS minute,
 week(t) AS week, isodow(t) - 1 AS weekday, dayofyear(t) AS day_of_year, strftime(t, '%a') AS day_name, strftime(t, '%Y_%m') AS year_month
FROM (SELECT l_orderkey, l_linenumber, l_shipdate + l_linenumber * INTERVAL '3 hours 7 minutes' AS t FROM lineitem)""")
def f01_calendar_parts(spark, sf):
    """F01 to F05."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_shipdate") + F.col("l_linenumber") * F.expr("interval '3:07' hour to minute")).alias("time"))
    return tidy(cal.calendar_parts(rows).drop("time"))


@query("f08_epoch_and_ranges", """SELECT event_id, to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMP AS from_epoch, ts + INTERVAL '1 month' AS next_month,
 least(ts + INTERVAL '1 month', TIMESTAMP '2024-02-15') AS chunk_end, len(generate_series(time_bucket(INTERVAL '1 hour', ts), ts, INTERVAL '15 minutes')) AS n_slots,
 round(epoch_us(TIMESTAMP '2024-02-01') / 86400000000.0::DOUBLE - epoch_us(ts) / 86400000000.0::DOUBLE + 1e-9, 6) AS days_left FROM events""")
def f08_epoch_and_ranges(spark, sf):
    """F08 to F10, F12."""
    month = F.expr("interval 1 month")
    end = F.lit("2024-02-15").cast("timestamp_ntz")
    return tidy(table(spark, sf, "events").select(
        "event_id", F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("from_epoch"),
        (F.col("ts") + month).alias("next_month"), F.least(F.col("ts") + month, end).alias("chunk_end"),
        F.size(F.sequence(bucket("ts", 3600), F.col("ts"), F.expr("interval 15 minutes"))).alias("n_slots"),
        cal.days_between("ts", F.lit("2024-02-01").cast("timestamp_ntz")).alias("days_left")))


@query("f13_text_functions", """SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, len(regexp_extract_all(c_name || '-7', '([0-9]+)', 1)) AS n_groups,
 lower(replace(c_mktsegment || '-St', '-', '_')) AS normal, split_part(c_name, '#', 1) AS prefix, starts_with(c_name, 'Cust') AS starts, ends_with(c_name, '7') AS ends,
 c_mktsegment || '_' || c_custkey AS key FROM customer""")
def f13_text_functions(spark, sf):
    """F13 to F15."""
    name = F.col("c_name")
    return tidy(table(spark, sf, "customer").select(
        "c_custkey", text.digits("c_name").alias("digits"), F.size(text.digit_groups(F.concat("c_name", F.lit("-7")))).alias("n_groups"),
        text.normal_name(F.concat("c_mktsegment", F.lit("-St"))).alias("normal"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("prefix"),
        name.startswith("Cust").alias("starts"), name.endswith("7").alias("ends"), text.key_of("c_mktsegment", "c_custkey").alias("key")))


@query("f16_z_score", f"""WITH {GAUGE} SELECT event_id, round((value - avg(value) OVER (PARTITION BY station)) / nullif(stddev_samp(value) OVER (PARTITION BY station), 0) + 1e-9, 6) AS z,
 round(abs(value) + 1e-9, 6) AS size, round(sqrt(abs(value)) + 1e-9, 6) AS root FROM gauge""")
def f16_z_score(spark, sf):
    from ..functions.numeric import z_score
    from ..operators.blocks import in_blocks, with_moments

    rows = with_moments(in_blocks(gauge(spark, sf), "station", "time", TABLE_BLOCK), "station", "value")
    return tidy(rows.select("event_id", z_score("value", "mean", "std").alias("z"), F.abs("value").alias("size"), F.sqrt(F.abs("value")).alias("root")))


@query("f18_lookup_default", """SELECT event_id, coalesce((props::JSON ->> '$.k'), 'No Data') AS k, coalesce((props::JSON ->> '$.pp'), 'No Data') AS pp FROM events""")
def f18_lookup_default(spark, sf):
    """JSON text to a map, looked up with a default."""
    parsed = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select(
        "event_id", text.lookup(parsed, "k", "No Data").alias("k"), text.lookup(parsed, "pp", "No Data").alias("pp"))


@query("p15_interaction", f"WITH {PAIRED} SELECT station, time, round(rain * level + 1e-9, 6) + 0.0::DOUBLE AS rain_x_level FROM paired")
def p15_interaction(spark, sf):
    return tidy(paired(spark, sf).select("station", "time", (F.col("rain") * F.col("level")).alias("rain_x_level")))


@query("c09_holidays", f"""WITH {GAUGE}, h AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE day(ts) IN (1, 15))
SELECT event_id, (time::DATE IN (SELECT day FROM h))::BIGINT AS is_holiday FROM gauge""")
def c09_holidays(spark, sf):
    """A holiday table, here two days of each month in the data."""
    days = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct().filter(F.dayofmonth("day").isin(1, 15))
    return tidy(cal.with_holidays(gauge(spark, sf), days).select("event_id", "is_holiday"))


def feature_sql() -> str:
    cols = {"target_t_plus_6": f"lead(level, 6) {W}"}
    cols |= {f"level_lag_{k}h": f"lag(level, {k}) {W}" for k in range(1, 7)}
    cols |= {f"rain_lag_{k}h": f"lag(rain, {k}) {W}" for k in range(7)}
    for n in WINDOWS:
        cols |= {f"level_rolling_mean_{n}h": full("avg", "level", n), f"level_rolling_std_{n}h": full("stddev_samp", "level", n)}
        cols |= {f"rain_rolling_{b}_{n}h": full(a, "rain", n) for a, b in (("sum", "sum"), ("avg", "mean"), ("stddev_samp", "std"))}
    for c in ("level", "rain"):
        cols |= {f"{c}_diff_{k}h": f"{c} - lag({c}, {k}) {W}" for k in (1, 2)}
    cols |= {"rain_x_level": "rain * level"}
    made = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    ewm = {f"level_ewm_mean_{n}h": ("level", n, 1) for n in WINDOWS} | {f"rain_ewm_sum_{n}h": ("rain", n, n) for n in WINDOWS}
    rec = ", ".join(ewm_sql("gappy", c, n, f"{c}{n}") for c, n, _ in ewm.values())
    joins = " ".join(f"JOIN {c}{n} ON {c}{n}.station = m.station AND {c}{n}.rn = m.rn" for c, n, _ in ewm.values())
    ewm_cols = ", ".join(f"{c}{n}.y * {f} AS {k}" for k, (c, n, f) in ewm.items())
    data = ["level", "rain", *cols, *ewm]
    ff = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY rn ROWS UNBOUNDED PRECEDING) AS {c}" for c in data)
    known = " AND ".join(f"{c} IS NOT NULL" for c in data)
    out = ", ".join(f"round({c} + 1e-9, 6) + 0.0::DOUBLE AS {c}" for c in data)
    t = {"hour": ("hour(time)", 24), "day_of_week": ("isodow(time) - 1", 7), "month": ("month(time)", 12)}
    parts = ", ".join(f"{e} AS {k}, round(sin(2 * pi() * ({e}) / {p}) + 1e-9, 6) + 0.0::DOUBLE AS {k}_sin, round(cos(2 * pi() * ({e}) / {p}) + 1e-9, 6) + 0.0::DOUBLE AS {k}_cos" for k, (e, p) in t.items())
    return f"""WITH RECURSIVE {GAPPY_PAIRED}, {rec},
made AS (SELECT station, time, rn, level, rain, {made} FROM gappy),
joined AS (SELECT m.*, {ewm_cols} FROM made m {joins} WHERE target_t_plus_6 IS NOT NULL),
filled AS (SELECT station, time, {ff} FROM joined)
SELECT station, time, {out}, {parts} FROM filled WHERE {known}"""


GAPPY_PAIRED = PAIRED + ", gappy AS (SELECT station, time, rn, CASE WHEN level >= 0 THEN level END AS level, rain FROM paired)"


@query("create_features", feature_sql())
def create_features(spark, sf):
    """W01 to W07, W13, W15, P15, F06 in one table; the level has gaps so the fill is exercised."""
    rows = paired(spark, sf).withColumn("level", F.when(F.col("level") >= 0, F.col("level")))
    return tidy(features.create_features(rows, "level", ["rain"]))


def sequence_sql(bound: str, step: int) -> str:
    return f"""WITH {PAIRED}, s AS (SELECT station, rn - 1 AS i, count(*) OVER (PARTITION BY station) AS n,
 list([round(level + 1e-9, 6), round(rain + 1e-9, 6)]) OVER (PARTITION BY station ORDER BY rn ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS x,
 lead(level, 24) OVER (PARTITION BY station ORDER BY rn) AS y FROM paired)
SELECT station, i, x, round(y + 1e-9, 6) AS y FROM s WHERE i < {bound} AND i % {step} = 0"""


def _sequences(spark, sf, step, full):
    rows = features.numbered(paired(spark, sf), total="n", block=TABLE_BLOCK)
    rows = rows.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("level", "rain")})
    out = features.sequences(rows, "station", "rn", "n", "level", ["level", "rain"], 24, step, full)
    return tidy(out)


@query("w17_sequence_features", sequence_sql("n - 24 - 1", 2))
def w17_sequence_features(spark, sf):
    """W17 with every second start."""
    return _sequences(spark, sf, 2, False)


@query("w18_sequence_dataset", sequence_sql("n - 24", 1))
def w18_sequence_dataset(spark, sf):
    return _sequences(spark, sf, 1, True)


@query("w19_tail_split", f"""WITH {HOURLY} SELECT station, time, row_number() OVER (PARTITION BY station ORDER BY time DESC) <= 168 AS is_test FROM hourly""")
def w19_tail_split(spark, sf):
    return features.tail_split(hourly(spark, sf), 168).select("station", "time", "is_test")


@query("w19_share_split", f"""WITH {HOURLY} SELECT station, time, row_number() OVER (PARTITION BY station ORDER BY time DESC) <= ceil(0.2 * count(*) OVER (PARTITION BY station)) AS is_test FROM hourly""")
def w19_share_split(spark, sf):
    return features.tail_split(hourly(spark, sf), 0.2).select("station", "time", "is_test")


@query("l03_select_features", f"""WITH {PAIRED}, f AS (SELECT station, rn, level, rain, lag(level, 1) {W} AS lag1, lag(rain, 1) {W} AS rain1, hour(time) AS hour, 1 AS constant,
  level - lag(level, 1) {W} AS diff1 FROM paired),
c AS (SELECT 'rain' AS feature, 0 AS position, abs({corr_sql('rain', 'level')}) AS abs_r FROM f UNION ALL SELECT 'lag1', 1, abs({corr_sql('lag1', 'level')}) FROM f
 UNION ALL SELECT 'rain1', 2, abs({corr_sql('rain1', 'level')}) FROM f UNION ALL SELECT 'hour', 3, abs({corr_sql('hour', 'level')}) FROM f
 UNION ALL SELECT 'constant', 4, abs({corr_sql('constant', 'level')}) FROM f UNION ALL SELECT 'diff1', 5, abs({corr_sql('diff1', 'level')}) FROM f)
SELECT feature, position::BIGINT AS position, round(abs_r + 1e-9, 6) AS abs_r FROM c WHERE abs_r >= 0.01 ORDER BY abs_r DESC, position LIMIT 2""")
def l03_select_features(spark, sf):
    """The two best of the columns above the threshold; a constant column never qualifies."""
    rows = features.differences(features.lead_and_lags(numbered(spark, sf), "station", "rn", {"level": [1], "rain": [1]}), "station", "rn", "level", [1])
    rows = rows.withColumnsRenamed({"level_lag_1h": "lag1", "rain_lag_1h": "rain1", "level_diff_1h": "diff1"}).withColumns({"hour": F.hour("time"), "constant": F.lit(1)})
    return tidy(features.select_by_correlation(rows, "level", ["rain", "lag1", "rain1", "hour", "constant", "diff1"], 0.01, 2))
