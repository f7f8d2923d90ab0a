"""Time, id and distance joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, joins, reshape, spatial, stats
from ..operators.grid import bucket
from .base import (
    GAUGE, HOURLY, PAIRED, POINTS, QUARTER, TABLE_BLOCK, mean_per, gauge, hourly, paired, points, quarter, query, table, tidy,
)


def daily_levels(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("time")).agg(F.avg("o_totalprice").alias("level"))


def daily_rain(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("rain"))


def hourly_rain(spark, sf):
    """Hourly mean per weather station; users stand in for weather stations."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("station"), bucket("ts", 3600).alias("time")).agg(F.avg("value").alias("rain"))


@query("j01_join_on_time", f"""WITH {QUARTER}, w AS (SELECT user_id AS station, time_bucket(INTERVAL '1 hour', ts) AS time, avg(value) AS rain FROM events GROUP BY 1, 2)
SELECT q.time, q.station, round(q.value + 1e-9, 6) AS value, w.station AS station_weather, round(w.rain + 1e-9, 6) AS rain FROM quarter q JOIN w USING (time)""")
def j01_join_on_time(spark, sf):
    """Every gauge with every weather station of the same instant; hourly meets the full quarter only."""
    return tidy(joins.on_time(quarter(spark, sf), hourly_rain(spark, sf), suffix="_weather"))


@query("j02_join_series_time", f"""WITH {HOURLY}, w AS (SELECT event_type AS station, time_bucket(INTERVAL '1 hour', ts) AS time, avg(length(props)) AS rain FROM events GROUP BY 1, 2)
SELECT station, time, round(value + 1e-9, 6) AS value, round(rain + 1e-9, 6) AS rain FROM hourly JOIN w USING (station, time)""")
def j02_join_series_time(spark, sf):
    weather = table(spark, sf, "events").groupBy(F.col("event_type").alias("station"), bucket("ts", 3600).alias("time")).agg(F.avg(F.length("props")).alias("rain"))
    return tidy(joins.on_series_time(hourly(spark, sf), weather))


@query("j03_daily_join", """WITH r AS (SELECT o_orderdate AS time, avg(o_totalprice) AS level FROM orders GROUP BY 1),
w AS (SELECT l_shipdate AS time, avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A", avg(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N",
 avg(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1)
SELECT time, round(level + 1e-9, 6) AS level, round("A" + 1e-9, 6) AS "A", round("N" + 1e-9, 6) AS "N", round("R" + 1e-9, 6) AS "R" FROM r JOIN w USING (time)""")
def j03_daily_join(spark, sf):
    """Daily mean level joined with long climate rows turned wide."""
    level = table(spark, sf, "orders").groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("time")).agg(F.avg("o_totalprice").alias("level"))
    long = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("time"), F.col("l_returnflag").alias("datatype")).agg(F.avg("l_quantity").alias("value"))
    return tidy(level.join(reshape.widen(long, "time", "datatype", "value", ["A", "N", "R"]), "time"))


@query("j04_full_outer", """WITH r AS (SELECT o_orderdate AS time, avg(o_totalprice) AS level FROM orders GROUP BY 1),
w AS (SELECT l_shipdate AS date, sum(l_quantity) AS rain FROM lineitem GROUP BY 1)
SELECT time, round(level + 1e-9, 6) AS level, date, round(rain + 1e-9, 6) AS rain FROM r FULL JOIN w ON r.time = w.date""")
def j04_full_outer(spark, sf):
    return tidy(joins.outer_two_keys(daily_levels(spark, sf), daily_rain(spark, sf), "time", "date"))


@query("j05_dimension_join", """SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey::VARCHAR = n_nationkey::VARCHAR JOIN region ON n_regionkey = r_regionkey""")
def j05_dimension_join(spark, sf):
    """Station table by id compared as text."""
    dim = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.with_dimension(table(spark, sf, "supplier"), dim, "s_nationkey", "n_nationkey").select("s_suppkey", "s_name", "n_name", "r_name")


@query("j06_substring_join", """WITH f AS (SELECT s_name || '_weather_' || s_suppkey AS name FROM supplier), i AS (SELECT n_nationkey::VARCHAR AS id FROM nation)
SELECT id, min(name) AS name FROM i JOIN f ON contains(f.name, i.id) GROUP BY 1""")
def j06_substring_join(spark, sf):
    """First file name containing the id anywhere."""
    files = table(spark, sf, "supplier").select(F.concat_ws("_weather_", "s_name", F.col("s_suppkey").cast("string")).alias("name"))
    ids = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"))
    return joins.containing_names(ids, files)


@query("j06_exact_id_join", """WITH f AS (SELECT s_name || '_' || s_suppkey || '_weather' AS name, s_suppkey::VARCHAR AS id FROM supplier), i AS (SELECT n_nationkey::VARCHAR AS id FROM nation)
SELECT id, name FROM i JOIN f USING (id)""")
def j06_exact_id_join(spark, sf):
    """J06, exact mode: the id is the second part of the name."""
    files = table(spark, sf, "supplier").select(F.concat_ws("_", "s_name", F.col("s_suppkey").cast("string"), F.lit("weather")).alias("name"))
    files = files.withColumn("id", F.split_part("name", F.lit("_"), F.lit(2)))
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id")).join(files, "id")


@query("j07_lookup_mean", f"WITH {GAUGE} SELECT event_id, round(avg(value) OVER (PARTITION BY station, month(time)) + 1e-9, 6) AS part_mean FROM gauge")
def j07_lookup_mean(spark, sf):
    out = joins.lookup_mean(gauge(spark, sf), "value", station="station", month=F.month("time"))
    return tidy(out.select("event_id", "part_mean"))


@query("j09_semi_anti", """SELECT c_custkey AS id, 'kept' AS side FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
UNION ALL SELECT c_custkey, 'remaining' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def j09_semi_anti(spark, sf):
    """Ids already landed and ids still to do."""
    work = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    landed = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("id"))
    return joins.keep_listed(work, landed, "id").withColumn("side", F.lit("kept")).unionByName(
        joins.drop_listed(work, landed, "id").withColumn("side", F.lit("remaining")))


def _version(src: str, tag: str) -> str:
    return f"""g{tag} AS (SELECT station, value, (epoch_us(time) - lag(epoch_us(time)) OVER (PARTITION BY station ORDER BY time)) / 1000000.0::DOUBLE AS gap FROM {src}),
{tag} AS (SELECT station, count(*) AS n_rows_{tag}, round(avg(value) + 1e-9, 6) AS mean_{tag}, round(quantile_cont(gap, 0.5) + 1e-9, 6) AS median_gap_seconds_{tag} FROM g{tag} GROUP BY 1)"""


@query("j10_two_versions", f"""WITH {HOURLY}, {mean_per('15 minutes', 'quarter')}, {_version('hourly', 'a')}, {_version('quarter', 'b')}
SELECT * FROM a JOIN b USING (station)""")
def j10_two_versions(spark, sf):
    """Statistics of two versions of the same series side by side."""
    a = stats.granularity(hourly(spark, sf), block=TABLE_BLOCK).drop("min", "max")
    b = stats.granularity(quarter(spark, sf), block=TABLE_BLOCK).drop("min", "max")
    return tidy(joins.side_by_side(a, b, "station"))


HAVERSINE = ("2 * 6371.0088 * asin(sqrt(least(sin((radians({b}lat) - radians({a}lat)) / 2) ** 2 + cos(radians({a}lat)) * cos(radians({b}lat)) * "
             "sin((radians({b}lon) - radians({a}lon)) / 2) ** 2, 1.0)))")


def _gauges_and_weather(spark, sf):
    p = points(spark, sf)
    gauges = p.filter("label % 3 = 0").select(F.col("id").alias("point_id"), "lat", "lon")
    weather = p.filter("label % 3 != 0").select(F.col("id").alias("station_id"), "lat", "lon")
    return gauges, weather


SIDES = f"{POINTS}, g AS (SELECT id AS point_id, lat, lon FROM points WHERE label % 3 = 0), w AS (SELECT id AS station_id, lat, lon FROM points WHERE label % 3 <> 0)"


@query("j11_k_nearest", f"""WITH {SIDES}, d AS (SELECT point_id, station_id, {HAVERSINE.format(a='g.', b='w.')} AS distance_km FROM g, w)
SELECT point_id, station_id, round(distance_km + 1e-9, 6) AS distance_km, rank FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY distance_km, station_id) AS rank FROM d) WHERE rank <= 10""")
def j11_k_nearest(spark, sf):
    """Ten nearest weather stations of every gauge."""
    return tidy(spatial.k_nearest(*_gauges_and_weather(spark, sf), k=10))


@query("j11_nearest_to_point", f"""WITH {POINTS} SELECT id, lat, lon, round(d + 1e-9, 6) AS distance_km FROM (SELECT *, {HAVERSINE.format(a='p.', b='q.')} AS d FROM points q,
 (SELECT 50.4 AS lat, -5.0 AS lon) p(plat, plon)) LIMIT 10""".replace("FROM points q,\n (SELECT 50.4 AS lat, -5.0 AS lon) p(plat, plon)) LIMIT 10",
 "FROM points q) ORDER BY d, id LIMIT 10").replace("radians(p.lat)", "radians(50.4::DOUBLE)").replace("radians(p.lon)", "radians(-5.0::DOUBLE)").replace("SELECT id, lat, lon,", "SELECT id, round(lat + 1e-9, 6) AS lat, round(lon + 1e-9, 6) AS lon,"))
def j11_nearest_to_point(spark, sf):
    return tidy(spatial.nearest_to_point(points(spark, sf).drop("label"), 50.4, -5.0, 10))


MERC = "sqrt((6378137.0 * (radians(g.lon) - radians(w.lon))) ** 2 + (6378137.0 * (ln(tan(radians(g.lat) / 2 + pi() / 4)) - ln(tan(radians(w.lat) / 2 + pi() / 4)))) ** 2)"


@query("j12_within_projected", f"""WITH {SIDES} SELECT point_id, station_id, round({MERC} / 1000 + 1e-9, 6) AS distance FROM g, w WHERE {MERC} <= 10000""")
def j12_within_projected(spark, sf):
    """10 km buffers as drawn on the Mercator plane."""
    out = spatial.within_distance(*_gauges_and_weather(spark, sf))
    return tidy(out.select("point_id", "station_id", (F.col("distance_m") / 1000).alias("distance")))


@query("j12_within_ground", f"""WITH {SIDES} SELECT point_id, station_id, round({HAVERSINE.format(a='g.', b='w.')} + 1e-9, 6) AS distance FROM g, w WHERE {HAVERSINE.format(a='g.', b='w.')} <= 10""")
def j12_within_ground(spark, sf):
    """J12 on true ground distance."""
    out = spatial.within_distance(*_gauges_and_weather(spark, sf), ground=True)
    return tidy(out.select("point_id", "station_id", (F.col("distance_m") / 1000).alias("distance")))


@query("j13_pair_lines", f"""WITH {SIDES}, p AS (SELECT point_id, station_id, g.lat AS a, g.lon AS b, w.lat AS c, w.lon AS d FROM g, w WHERE {MERC} <= 10000)
SELECT point_id, station_id, 'gauge' AS kind, round(a + 1e-9, 6) AS lat, round(b + 1e-9, 6) AS lon FROM p UNION ALL SELECT point_id, station_id, 'weather', round(c + 1e-9, 6), round(d + 1e-9, 6) FROM p""")
def j13_pair_lines(spark, sf):
    """The pairs within 10 km as lines; the coordinates of an id go along with its row, so the pairs are joined with nothing."""
    g, w = _gauges_and_weather(spark, sf)
    ends = {"lat": "glat", "lon": "glon"}, {"lat": "wlat", "lon": "wlon"}
    g = g.join(tidy(g.withColumnsRenamed(ends[0])), "point_id")
    w = w.join(tidy(w.withColumnsRenamed(ends[1])), "station_id")
    pairs = spatial.within_distance(g, w, keep=("glat", "glon", "wlat", "wlon")).drop("distance_m")
    return spatial.pair_lines(pairs, ("glat", "glon"), ("wlat", "wlon"))


@query("c10_coverage_gaps", f"WITH {SIDES} SELECT point_id FROM g WHERE NOT EXISTS (SELECT 1 FROM w WHERE {MERC} <= 2000)")
def c10_coverage_gaps(spark, sf):
    """Gauges with no weather station in reach, here 2 km since the points lie close."""
    return spatial.uncovered(*_gauges_and_weather(spark, sf), metres=2000).select("point_id")


@query("c10_crowded_spots", f"WITH {POINTS} SELECT round(round(lat, 1) + 1e-9, 6) AS lat, round(round(lon, 1) + 1e-9, 6) AS lon, count(*) AS n FROM points GROUP BY round(lat, 1), round(lon, 1) HAVING count(*) > 1")
def c10_crowded_spots(spark, sf):
    """Rounded coordinates shared by several points."""
    return tidy(spatial.crowded_spots(points(spark, sf), 1))


@query("c11_distance_and_response", f"""WITH {PAIRED}, {POINTS},
st AS (SELECT DISTINCT event_type AS station, ascii(event_type) - 97 AS id FROM events),
s AS (SELECT station, level, {", ".join(f"lag(rain, {k}) OVER (PARTITION BY station ORDER BY rn) AS l{k}" for k in range(7))} FROM paired),
r AS ({" UNION ALL ".join(f"SELECT station, {k} AS lag, (covar_samp(level, l{k}) / nullif(stddev_samp(CASE WHEN l{k} IS NOT NULL THEN level END) * stddev_samp(CASE WHEN level IS NOT NULL THEN l{k} END), 0)) AS r FROM s GROUP BY 1" for k in range(7))}),
peak AS (SELECT station, max(abs(r)) AS peak FROM r GROUP BY 1),
d AS (SELECT st.station, min({HAVERSINE.format(a='a.', b='b.')}) AS km FROM st JOIN points a ON a.id = st.id JOIN points b ON b.label % 3 <> 0 AND b.id <> a.id GROUP BY 1)
SELECT station, round(km + 1e-9, 6) AS distance_km, round(peak + 1e-9, 6) AS peak_r FROM peak JOIN d USING (station)""")
def c11_distance_and_response(spark, sf):
    """C11: distance to the nearest weather station beside the peak lagged correlation with rain."""
    curve = features.lagged_corr(features.numbered(paired(spark, sf), block=TABLE_BLOCK), "station", "rn", "level", "rain", range(7))
    peak = curve.groupBy("station").agg(F.max(F.abs("r")).alias("peak_r"))
    p = points(spark, sf)
    ids = gauge(spark, sf).select("station").distinct()
    # stations have no coordinates in the tables: the first letter picks the point
    at = ids.select("station", (F.ascii("station") - 97).cast("bigint").alias("id")).join(p, "id").select(F.col("id").alias("point_id"), "lat", "lon", "station")
    weather = p.filter("label % 3 != 0").select(F.col("id").alias("station_id"), "lat", "lon")
    near = spatial.k_nearest(at.drop("station"), weather, k=2).filter("point_id != station_id")
    nearest = near.groupBy("point_id").agg(F.min("distance_km").alias("distance_km"))
    return tidy(nearest.join(at, "point_id").join(peak, "station").select("station", "distance_km", "peak_r"))


@query("s06_station_name_to_id", """WITH n AS (SELECT DISTINCT replace(lower(n_name), '_', '-') AS name FROM nation UNION SELECT 'nowhere')
SELECT n.name, min(n_nationkey)::BIGINT AS station_id FROM n LEFT JOIN nation d ON replace(lower(n.name), '-', '_') = lower(d.n_name) GROUP BY 1""")
def s06_station_name_to_id(spark, sf):
    """Names in file spelling looked up in the station table; unknown names give NULL."""
    dim = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("station_id"))
    asked = dim.select(F.replace(F.lower("name"), F.lit("_"), F.lit("-")).alias("name")).distinct()
    asked = asked.unionByName(dim.agg(F.max(F.lit("nowhere")).alias("name")))
    return tidy(joins.station_ids(asked, dim))
