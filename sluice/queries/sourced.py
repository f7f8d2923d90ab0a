"""Sources and sinks: every query lands whole tables as files or payload text and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grid import bucket
from ..schemas import DAILY_CLIMATE, HOURLY_WEATHER
from ..session import work_path
from ..sources import gauges, payloads, sinks
from .base import GAUGE, QUALIFIED, gauge, label_expr, query, table, tidy

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def landed_gauges(spark, sf) -> str:
    """All events as qualified gauge files, one folder per station; every 17th value is not a number."""
    path = work_path(spark, "gauges")
    rows = gauge(spark, sf).select(
        F.concat("station", F.lit("-level-i-900")).alias("measure"), F.date_format("time", ISO).alias("dateTime"),
        F.to_date("time").cast("string").alias("date"),
        F.when(F.col("event_id") % 17 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.lit("Complete").alias("completeness"), label_expr().alias("quality"), F.col("event_id").cast("string").alias("qcode"),
        F.concat("station", F.lit(gauges.QUALIFIED_SUFFIX)).alias("file"))
    rows.write.partitionBy("file").option("header", "true").csv(path)
    return path


RIVER = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END"


@query("s01_river_scan", f"WITH {GAUGE} SELECT station, time, round({RIVER} + 1e-9, 6) AS value FROM gauge")
def s01_river_scan(spark, sf):
    """Time and value of all gauge files, bad numbers NULL."""
    return tidy(gauges.read_river(spark, landed_gauges(spark, sf)))


@query("s01_river_scan_station", f"WITH {GAUGE} SELECT station, time, round({RIVER} + 1e-9, 6) AS value FROM gauge WHERE station = 'click' ORDER BY time")
def s01_river_scan_station(spark, sf):
    """S01 for one station: only its file is read."""
    return tidy(gauges.read_river(spark, landed_gauges(spark, sf), "click")).orderBy("time")


@query("s02_qualified_scan", f"""WITH {QUALIFIED} SELECT station, station || '-level-i-900' AS measure, time AS "dateTime", time::DATE AS date,
 CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE 'number' END AS kind, 'Complete' AS completeness, quality, event_id::VARCHAR AS qcode FROM qualified""")
def s02_qualified_scan(spark, sf):
    """All columns, value left as text."""
    rows = gauges.read_qualified(spark, landed_gauges(spark, sf))
    return rows.withColumn("kind", F.when(F.col("value") == "n/a", "n/a").otherwise("number")).drop("value")


@query("s05_list_stations", "SELECT DISTINCT event_type AS station FROM events")
def s05_list_stations(spark, sf):
    return gauges.available_stations(spark, landed_gauges(spark, sf))


@query("a15_file_inventory", f"""WITH {GAUGE} SELECT station, count(*) AS n_rows, round(avg({RIVER}) + 1e-9, 6) AS mean, round(min({RIVER}) + 1e-9, 6) AS min, round(max({RIVER}) + 1e-9, 6) AS max FROM gauge GROUP BY 1""")
def a15_file_inventory(spark, sf):
    """A15 over files."""
    return tidy(gauges.inventory(gauges.read_river(spark, landed_gauges(spark, sf))))


@query("a15_file_bytes")
def a15_file_bytes(spark, sf):
    """Bytes per station folder from the file listing (sizes depend on the writer, so rows only)."""
    sizes = gauges.file_sizes(spark, landed_gauges(spark, sf))
    station = F.regexp_extract("file", r"file=([^/]+)-level", 1)
    return sizes.groupBy(station.alias("station")).agg(F.sum("n_bytes").alias("n_bytes"))


WEATHER = T.StructType([T.StructField("time", T.TimestampNTZType()), T.StructField("rain", T.DoubleType())])


def landed_weather(spark, sf) -> str:
    """Hourly whole-number rain per station folder, every row written twice."""
    path = work_path(spark, "weather")
    rain = table(spark, sf, "events").groupBy(F.col("event_type").alias("station"), bucket("ts", 3600).alias("time")).agg(
        F.count(F.lit(1)).cast("double").alias("rain"))
    rain.withColumn("time", F.date_format("time", ISO)).withColumn("_twice", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_twice").write.partitionBy("station").option("header", "true").csv(path)
    return path


RAIN_ROWS = "SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS time, count(*)::DOUBLE AS rain FROM events GROUP BY 1, 2"


@query("s03_weather_union", RAIN_ROWS)
def s03_weather_union(spark, sf):
    """All weather files with their station, duplicate rows dropped."""
    rows = gauges.read_weather(spark, landed_weather(spark, sf), WEATHER)
    return tidy(rows.withColumn("station", F.split_part("station", F.lit("="), F.lit(-1))))


@query("s03_weather_union_compat", f"SELECT DISTINCT time, rain FROM ({RAIN_ROWS})")
def s03_weather_union_compat(spark, sf):
    """S03 without the station: equal rows of two stations collapse."""
    return tidy(gauges.read_weather(spark, landed_weather(spark, sf), WEATHER, keep_station=False))


@query("s04_merged_scan", "SELECT 'river_purchase' AS station, ts AS time, value FROM events WHERE event_type = 'purchase'")
def s04_merged_scan(spark, sf):
    """Merged files, one picked by its normalised station name."""
    path = work_path(spark, "merged")
    rows = table(spark, sf, "events").select(F.date_format("ts", ISO).alias("time"), "value", gauges.merged_name(F.concat(F.lit("River-"), F.col("event_type"))).alias("file"))
    rows.write.partitionBy("file").option("header", "true").csv(path)
    return tidy(gauges.read_merged(spark, path, "River-Purchase", T.StructType([T.StructField("time", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])))


@query("s07_station_dimension", "SELECT s_suppkey AS station_id, s_name AS name, s_acctbal AS latitude FROM supplier")
def s07_station_dimension(spark, sf):
    """A projected read of a station table written as CSV."""
    path = work_path(spark, "stations")
    table(spark, sf, "supplier").write.option("header", "true").csv(path)
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    rows = spark.read.schema(schema).option("header", "true").csv(path)
    return tidy(rows.select(F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("latitude")))


@query("s08_station_lists", """SELECT s_suppkey AS "station.id", s_name AS "station.label.name", CASE WHEN s_nationkey % 2 = 0 THEN s_acctbal END AS "station.level", CASE WHEN s_nationkey % 2 = 1 THEN s_nationkey::BIGINT END AS "station.nation" FROM supplier""")
def s08_station_lists(spark, sf):
    """Nested lists of two catchments with different fields, flattened and stacked by name."""
    rows = table(spark, sf, "supplier")
    paths = []
    for odd, extra in ((0, F.col("s_acctbal").alias("level")), (1, F.col("s_nationkey").alias("nation"))):
        path = work_path(spark, "lists")
        label = F.struct(F.col("s_name").alias("name")).alias("label")
        rows.filter(F.col("s_nationkey") % 2 == odd).select(F.struct(F.col("s_suppkey").alias("id"), label, extra).alias("station")).write.json(path)
        paths.append(path)
    return tidy(payloads.read_station_lists(spark, paths, multi_line=False))


def hourly_payloads(spark, sf):
    """One payload per station and hour holding that hour's readings."""
    rows = gauge(spark, sf)
    reading = F.struct(F.date_format("time", ISO).alias("time"), F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"))
    return rows.groupBy("station", bucket("time", 3600).alias("hour")).agg(F.array_sort(F.collect_list(reading)).alias("readings"))


@query("s09_payload_landing", "SELECT event_type AS station, count(*) AS n_readings, sum(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_missing, 0::BIGINT AS n_bad FROM events GROUP BY 1")
def s09_payload_landing(spark, sf):
    """Payload text landed by station; readable ones parsed, unreadable ones quarantined and counted."""
    path = work_path(spark, "landing")
    text = hourly_payloads(spark, sf).select("station", F.to_json(F.struct("readings")).alias("body"))
    broken = text.select("station", F.lit("{not json").alias("body")).distinct()
    sinks.append_new(text.unionByName(broken), path)
    good, bad = payloads.parse_payloads(spark.read.parquet(path), "body", "readings array<struct<time:string,value:double>>")
    counts = good.select("station", F.explode("payload.readings").alias("r")).groupBy("station").agg(
        F.count(F.lit(1)).alias("n_readings"), F.count_if(F.col("r.value").isNull()).alias("n_missing"))
    quarantined = bad.groupBy("station").agg((F.count(F.lit(1)) - 1).alias("n_bad"))
    return tidy(counts.join(quarantined, "station", "left"))


@query("s10_explode_series", "SELECT event_type AS station, ts AS time, round(CASE WHEN event_id % 10 <> 0 THEN value - 5 END + 1e-9, 6) AS value FROM events")
def s10_explode_series(spark, sf):
    """List literals with single quotes and None to rows."""
    item = F.transform("readings", lambda r: F.concat(
        F.lit("{'time': '"), r["time"], F.lit("', 'value': "), F.coalesce(r["value"].cast("string"), F.lit("None")), F.lit("}")))
    literal = hourly_payloads(spark, sf).select("station", F.concat(F.lit("["), F.array_join(item, ", "), F.lit("]")).alias("values"))
    return tidy(payloads.explode_series(literal))


@query("s11_concat_with_id", "SELECT event_type AS station_id, ts AS time, value FROM events")
def s11_concat_with_id(spark, sf):
    """Every file with its id taken from the folder name."""
    path = work_path(spark, "stems")
    rows = table(spark, sf, "events").select(F.col("event_type").alias("station_id"), F.date_format("ts", ISO).alias("time"), "value")
    rows.write.partitionBy("station_id").option("header", "true").csv(path)
    read = gauges.read_csv(spark, path, T.StructType([T.StructField("time", T.StringType()), T.StructField("value", T.DoubleType())]))
    return tidy(read.select(gauges.file_key(r"station_id=([^/]+)/").alias("station_id"), F.col("time").cast("timestamp_ntz").alias("time"), "value"))


@query("s12_parallel_arrays", """SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS time, count(*)::DOUBLE AS rain, sum(length(props))::DOUBLE AS temperature FROM events GROUP BY 1, 2""")
def s12_parallel_arrays(spark, sf):
    """Daily blocks of hourly arrays with start and step, back to rows (empty hours left out)."""
    hour = table(spark, sf, "events").groupBy(F.col("event_type").alias("station"), bucket("ts", 3600).alias("time")).agg(
        F.count(F.lit(1)).cast("double").alias("rain"), F.sum(F.length("props")).cast("double").alias("temperature"))
    day = F.date_trunc("day", "time").alias("day")
    at = [F.col("time").cast("string"), F.hour("time")]
    filled = hour.groupBy("station", day).agg(
        F.map_from_entries(F.collect_list(F.struct(at[1], F.struct("rain", "temperature")))).alias("m"))

    def column(c):
        return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h)[c]).alias(c)

    block = filled.select("station", F.unix_seconds("day").alias("start"), F.lit(3600).alias("interval"),
                          (F.unix_seconds("day") + 86400).alias("end"), column("rain"), column("temperature"))
    return tidy(payloads.parallel_arrays(block, "start", "interval", ["rain", "temperature"], end="end").filter("rain IS NOT NULL"))


@query("s13_month_chunks", """WITH r AS (SELECT o_custkey AS station, date_trunc('day', min(o_orderdate)) AS a, date_trunc('day', max(o_orderdate)) AS b FROM orders GROUP BY 1),
c AS (SELECT station, unnest(generate_series(a, b, INTERVAL '1 month')) AS chunk_start, b FROM r)
SELECT station, chunk_start, least(chunk_start + INTERVAL '1 month', b) AS chunk_end FROM c WHERE chunk_start < least(chunk_start + INTERVAL '1 month', b)""")
def s13_month_chunks(spark, sf):
    """The range of each station cut into months."""
    ranges = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("station")).agg(
        F.date_trunc("day", F.min("o_orderdate")).cast("timestamp_ntz").alias("start"), F.date_trunc("day", F.max("o_orderdate")).cast("timestamp_ntz").alias("end"))
    return payloads.month_chunks(ranges)


@query("s13_chunk_overlap", """SELECT l_returnflag AS station, l_shipdate AS time, round(avg(l_quantity) + 1e-9, 6) AS value FROM lineitem GROUP BY 1, 2""")
def s13_chunk_overlap(spark, sf):
    """Month chunks that share their border day, stacked and deduplicated."""
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("station"), F.col("l_shipdate").alias("time")).agg(F.avg("l_quantity").alias("value"))
    months = F.when(F.dayofmonth("time") == 1, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))
    chunks = rows.withColumn("chunk", F.explode(months))
    from ..operators.clean import keep_first

    return tidy(keep_first(chunks, ["station", "time"], "chunk").drop("chunk"))


@query("s14_forecast_parameters", """SELECT event_id, event_type AS kind, value::VARCHAR AS v FROM events""".replace("value::VARCHAR AS v", "round(value + 1e-9, 6) AS value"))
def s14_forecast_parameters(spark, sf):
    """Parameter list of every payload to a map and looked up by name."""
    pair = lambda n, c: F.struct(F.lit(n).alias("name"), c.cast("string").alias("$"))
    body = F.struct(F.struct(F.struct(F.array(pair("kind", F.col("event_type")), pair("value", F.col("value"))).alias("Param")).alias("Wx")).alias("SiteRep"))
    text = table(spark, sf, "events").select("event_id", F.to_json(body).alias("body"))
    schema = "SiteRep struct<Wx:struct<Param:array<struct<name:string,`$`:string>>>>"
    parsed = payloads.parse_payloads(text, "body", schema)[0].select("event_id", "payload.SiteRep")
    out = payloads.forecast_parameters(parsed)
    return tidy(out.select("event_id", F.col("parameters")["kind"].alias("kind"), F.col("parameters")["value"].cast("double").alias("value")))


@query("s15_observations", """SELECT event_type AS station, CASE WHEN event_id % 4 = 0 THEN 'No Data' ELSE event_id::VARCHAR END AS "Pp", count(*) AS n FROM events GROUP BY 1, 2""")
def s15_observations(spark, sf):
    """Periods and reports of every hour exploded, missing values as 'No Data'."""
    rep = F.struct(F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string")).alias("Pp"), F.lit("x").alias("T"))
    hour = gauge(spark, sf).groupBy("station", bucket("time", 3600).alias("h")).agg(F.collect_list(rep).alias("Rep"))
    body = F.struct(F.struct(F.struct(F.struct(F.array(F.struct("Rep")).alias("Period")).alias("Location")).alias("DV")).alias("SiteRep"))
    text = hour.select("station", F.to_json(body).alias("body"))
    schema = "SiteRep struct<DV:struct<Location:struct<Period:array<struct<Rep:array<struct<Pp:string>>>>>>>"
    parsed = payloads.parse_payloads(text, "body", schema)[0].select("station", "payload.SiteRep")
    return tidy(payloads.observations(parsed).groupBy("station", "Pp").agg(F.count(F.lit(1)).alias("n")))


@query("s16_climate_rows", """WITH c AS (SELECT l_shipdate AS date, l_returnflag AS datatype, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
p AS (SELECT year(date) AS y, count(*) >= 1000 AS cut FROM c GROUP BY 1)
SELECT date, datatype, 'all' AS station, round(value + 1e-9, 6) AS value, cut AS maybe_cut FROM c JOIN p ON p.y = year(c.date)""")
def s16_climate_rows(spark, sf):
    """One page per year; pages at the limit of 1000 rows are marked as possibly cut."""
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("date"), F.col("l_returnflag").alias("datatype")).agg(F.avg("l_quantity").alias("value"))
    item = F.struct(F.date_format("date", ISO).alias("date"), "datatype", F.lit("all").alias("station"), "value")
    pages = rows.groupBy(F.year("date").alias("y")).agg(F.collect_list(item).alias("results"))  # at most 366 days x types
    text = pages.select("y", F.to_json(F.struct("results")).alias("body"))
    item_type = "struct<" + ",".join(f"{f.name}:{'string' if f.name == 'date' else f.dataType.simpleString()}" for f in DAILY_CLIMATE.fields) + ">"
    parsed = payloads.parse_payloads(text, "body", f"results array<{item_type}>")[0].select("payload.results")
    return tidy(payloads.climate_rows(parsed).withColumn("date", F.col("date").cast("timestamp_ntz")))


@query("s17_multi_station_concat", """SELECT station, date_trunc('day', time) AS time, round(avg(rain) + 1e-9, 6) AS rain FROM (SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS time, count(*)::DOUBLE AS rain FROM events GROUP BY 1, 2) GROUP BY 1, 2""")
def s17_multi_station_concat(spark, sf):
    """Hourly files of every station stacked with their id and brought to days."""
    rows = gauges.read_weather(spark, landed_weather(spark, sf), WEATHER).withColumn("station", F.split_part("station", F.lit("="), F.lit(-1)))
    return tidy(rows.groupBy("station", bucket("time", 86400).alias("time")).agg(F.avg("rain").alias("rain")))


@query("s18_resumable_load", """SELECT DISTINCT user_id AS station FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click' AND value > 120)""")
def s18_resumable_load(spark, sf):
    """Stations whose file has not landed yet."""
    path = work_path(spark, "partial")
    sinks.append_new(table(spark, sf, "events").filter("event_type = 'click' AND value > 120").select(F.col("user_id").alias("station"), "value"), path)
    work = table(spark, sf, "events").select(F.col("user_id").alias("station")).distinct()
    return payloads.still_to_load(work, spark.read.parquet(path).select("station").distinct(), "station")


@query("s19_write_and_replace", "SELECT event_type AS station, ts AS time, CASE WHEN event_type = 'view' THEN 0.0::DOUBLE ELSE value END AS value FROM events")
def s19_write_and_replace(spark, sf):
    """Partitioned write, then one station replaced without touching the others."""
    path = work_path(spark, "series")
    rows = table(spark, sf, "events").select(F.col("event_type").alias("station"), F.col("ts").alias("time"), "value").withColumn("day", F.to_date("time"))
    sinks.write_series(rows, path, spread="day")
    sinks.write_series(rows.filter("station = 'view'").withColumn("value", F.lit(0.0)), path, spread="day")
    return tidy(spark.read.parquet(path).drop("day").withColumn("station", F.col("station").cast("string")))


@query("s20_tolerant_scan", """SELECT c_custkey::BIGINT AS id, 'Zen' || chr(243) || 'n ' || c_mktsegment AS name FROM customer""")
def s20_tolerant_scan(spark, sf):
    """Half of the files are UTF-8 and half ISO-8859-1; both come out right."""
    path = work_path(spark, "mixed")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Zenón "), F.col("c_mktsegment")).alias("name"))
    for odd, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        rows.filter(F.col("id") % 2 == odd).write.option("header", "true").option("encoding", encoding).csv(f"{path}/{odd}")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    return gauges.read_tolerant(spark, path, schema, "id,name").select("id", "name")


@query("s21_first_row_per_file", """SELECT event_type AS station, min(ts) AS date, arg_min(value, ts) AS weather_station_latitude FROM events GROUP BY 1""")
def s21_first_row_per_file(spark, sf):
    """The first row of every weather file, which carries the coordinates."""
    path = work_path(spark, "perfile")
    rows = table(spark, sf, "events").select(
        F.date_format("ts", ISO).alias("date"), *[F.lit(None).cast("string").alias(f.name) for f in HOURLY_WEATHER.fields[1:-2]],
        F.col("value").alias("weather_station_latitude"), F.lit(-5.0).alias("weather_station_longitude"), F.col("event_type").alias("station"))
    rows.write.partitionBy("station").option("header", "true").csv(path)
    read = gauges.read_weather(spark, path, HOURLY_WEATHER, "date").withColumnRenamed("time", "date")
    first = gauges.first_row_per_file(read, "station", "date")
    return tidy(first.select(F.split_part("station", F.lit("="), F.lit(-1)).alias("station"), "date", "weather_station_latitude"))
