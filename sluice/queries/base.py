"""Query registry and the sensor views over the given tables.

The tables hold no gauges, so ``events`` stands in: event types are stations, ``value - 5`` is the
level (which gives negatives). Nothing is written; every view is a projection of a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.blocks import DAY, HOUR
from ..operators.grid import bucket
from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The tables span 30 days, so the block is shortened to make every query cross block borders.
TABLE_BLOCK = 5 * DAY


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__doc__, run.__name__ = fn.__doc__, name
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places, NaN to NULL, no negative zero; integers as bigint.

    Both engines add 1e-9 before rounding: a mean that ends exactly in ...5 at the seventh place would
    otherwise round by its last bit, which depends on the order of a sum."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(F.nanvl(c.cast("double"), F.lit(None).cast("double")) + F.lit(1e-9), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- views -----------------------------------------------------------------------------------

def gauge(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("station"), F.col("ts").alias("time"), (F.col("value") - 5).alias("value"), "event_id"
    )


def users(spark, sf) -> DataFrame:
    """Many sparse stations."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("station"), F.col("ts").alias("time"), (F.col("value") - 5).alias("value"), "event_id"
    )


def on_step(df: DataFrame, step: int) -> DataFrame:
    """Mean reading of each clock bucket, at the bucket start: every reading counts."""
    return df.groupBy("station", bucket("time", step).alias("time")).agg(F.avg("value").alias("value"))


def hourly(spark, sf) -> DataFrame:
    return on_step(gauge(spark, sf), HOUR)


def quarter(spark, sf) -> DataFrame:
    return on_step(gauge(spark, sf), 900)


def label_expr(event_id: str = "event_id") -> Column:
    m = F.col(event_id) % 10
    return (F.when(m == 0, "Suspect").when(m == 1, "Missing").when(m == 2, "Estimated").when(m == 3, "Unchecked")
            .when(m == 4, F.lit(None).cast("string")).otherwise("Good"))


def run_label(event_id: str = "event_id") -> Column:
    m = F.floor(F.col(event_id) / 50) % 4
    return (F.when(m == 0, "Good").when(m == 1, "Suspect").when(m == 2, F.lit(None).cast("string")).otherwise("Good"))


def qualified(spark, sf) -> DataFrame:
    """Gauge rows with a quality label, some missing."""
    return gauge(spark, sf).withColumn("quality", label_expr())


def paired(spark, sf) -> DataFrame:
    """Hourly level of each station with the hourly mean of the ``view`` station as ``rain``."""
    rain = table(spark, sf, "events").filter("event_type = 'view'").groupBy(bucket("ts", HOUR).alias("time")).agg(
        F.avg("value").alias("rain"))
    return hourly(spark, sf).withColumnRenamed("value", "level").join(rain, "time", "left").select(
        "station", "time", "level", "rain")


def shipments(spark, sf) -> DataFrame:
    """Daily sum of shipped quantity as one series."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("time")).agg(
        F.sum("l_quantity").alias("value")).withColumn("station", F.lit("all"))


def points(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), (F.lit(50.0) + F.col("embedding")[0].cast("double")).alias("lat"),
        (F.lit(-5.0) + F.col("embedding")[1].cast("double")).alias("lon"), "label")


# --- the same views as SQL -------------------------------------------------------------------

GAUGE = "gauge AS (SELECT event_type AS station, ts AS time, value - 5 AS value, event_id FROM events)"
USERS = "users AS (SELECT user_id AS station, ts AS time, value - 5 AS value, event_id FROM events)"


def mean_per(step: str, name: str, src: str = "gauge") -> str:
    b = f"time_bucket(INTERVAL '{step}', time)"
    return (f"{name} AS (SELECT station, {b} AS time, avg(value) AS value FROM {src} GROUP BY 1, 2)")


HOURLY = GAUGE + ", " + mean_per("1 hour", "hourly")
QUARTER = GAUGE + ", " + mean_per("15 minutes", "quarter")


def clock_grid(src: str, name: str, step: str = "15 minutes") -> str:
    """CTEs for the clock grid of ``src`` left joined with its readings."""
    return (
        f"{name}_span AS (SELECT station, time_bucket(INTERVAL '{step}', min(time)) AS a, max(time) AS b FROM {src} GROUP BY 1), "
        f"{name}_slots AS (SELECT station, unnest(generate_series(a, b, INTERVAL '{step}')) AS time FROM {name}_span), "
        f"{name} AS (SELECT s.station, s.time, q.value, row_number() OVER (PARTITION BY s.station ORDER BY s.time) - 1 AS slot "
        f"FROM {name}_slots s LEFT JOIN {src} q ON q.station = s.station AND q.time = s.time)"
    )


def anchored_grid(src: str, name: str, step: str = "15 minutes") -> str:
    return clock_grid(src, name, step).replace(f"time_bucket(INTERVAL '{step}', min(time)) AS a", "min(time) AS a")


LABEL_SQL = ("CASE event_id % 10 WHEN 0 THEN 'Suspect' WHEN 1 THEN 'Missing' WHEN 2 THEN 'Estimated' "
             "WHEN 3 THEN 'Unchecked' WHEN 4 THEN NULL ELSE 'Good' END")
RUN_LABEL_SQL = "CASE (event_id // 50) % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Suspect' WHEN 2 THEN NULL ELSE 'Good' END"
QUALIFIED = f"qualified AS (SELECT event_type AS station, ts AS time, value - 5 AS value, event_id, {LABEL_SQL} AS quality FROM events)"
RAIN = ("rainfall AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS time, avg(value) AS rain FROM events "
        "WHERE event_type = 'view' GROUP BY 1)")
PAIRED = (HOURLY + ", " + RAIN + ", paired AS (SELECT h.station, h.time, h.value AS level, r.rain, "
          "row_number() OVER (PARTITION BY h.station ORDER BY h.time) AS rn FROM hourly h LEFT JOIN rainfall r USING (time))")
SHIPMENTS = "shipments AS (SELECT 'all' AS station, l_shipdate AS time, sum(l_quantity) AS value FROM lineitem GROUP BY 2)"
POINTS = ("points AS (SELECT vec_id AS id, 50.0::DOUBLE + embedding[1]::DOUBLE AS lat, "
          "-5.0::DOUBLE + embedding[2]::DOUBLE AS lon, label FROM embeddings)")
