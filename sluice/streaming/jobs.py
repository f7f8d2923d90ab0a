"""Structured Streaming jobs over gauge readings (columns station, time as timestamp, value).

Watermarks need a zoned timestamp, so the sources cast the naive UTC time on the way in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.numeric import non_negative, number_or_null
from ..session import work_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files: str = "*",
                per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(per_trigger))
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def drain(df: DataFrame, name: str, path: str | None = None, partition: str | None = None) -> DataFrame:
    """Run a stream over everything available into a parquet table and return that table.

    Output and checkpoint live in the shared folder; the file sink commits each batch once.
    """
    spark = df.sparkSession
    path = path or work_path(spark, name)
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", f"{path}-progress").trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(partition)
    query = writer.start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def ingest(raw: DataFrame, key: str = "station", time: str = "time", value: str = "value") -> DataFrame:
    """Coerced readings with negatives blanked; rows without key or readable time are quarantined."""
    at = F.col(time).cast("string").try_cast("timestamp")
    return raw.select(
        F.col(key).cast("string").alias("station"), at.alias("time"),
        non_negative(number_or_null(F.col(value).cast("string"))).alias("value"),
        (F.col(key).isNull() | at.isNull()).alias("quarantined"),
    )


def deduplicated(readings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """One reading per (station, time) among those arriving within the lateness bound."""
    return readings.withWatermark("time", lateness).dropDuplicatesWithinWatermark(["station", "time"])


def tumbling_mean(readings: DataFrame, width: str = "15 minutes", lateness: str = "1 hour") -> DataFrame:
    """Mean per station and window, emitted once the watermark has passed; later rows are dropped."""
    return (
        readings.withWatermark("time", lateness)
        .groupBy(F.window("time", width), "station")
        .agg(F.avg("value").alias("value"), F.count("value").alias("n"))
        .select("station", F.col("window.start").alias("time"), F.col("window.end").alias("until"), "value", "n")
    )


def sliding_total(readings: DataFrame, width: str = "24 hours", slide: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    return (
        readings.withWatermark("time", lateness)
        .groupBy(F.window("time", width, slide), "station")
        .agg(F.sum("value").alias("total"), F.count("value").alias("n"))
        .select("station", F.col("window.start").alias("time"), F.col("window.end").alias("until"), "total", "n")
    )


def sessions(readings: DataFrame, gap: str = "2 hours", lateness: str = "1 hour") -> DataFrame:
    """Stretches of activity; an outage starts at ``last_time`` once a session is emitted."""
    return (
        readings.withWatermark("time", lateness)
        .groupBy(F.session_window("time", gap), "station")
        .agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count(F.lit(1)).alias("n"))
        .select("station", "first_time", "last_time", "n")
    )


def threshold_alerts(readings: DataFrame, stations: DataFrame, high: str = "percentile5", record: str = "por_max") -> DataFrame:
    """Readings at or above a station's high mark, flagged where they also pass its record.

    A stream-static join: the station table is broadcast only if the planner measures it small enough.
    """
    marks = stations.select("station", F.col(high).alias("high_mark"), F.col(record).alias("record"))
    return (
        readings.join(marks, "station").filter(F.col("value") >= F.col("high_mark"))
        .withColumn("is_record", F.coalesce(F.col("value") > F.col("record"), F.lit(False)))
        .select("station", "time", "value", "high_mark", "is_record")
    )


#: Rows of one station and hour in a pack at most, and rows a task holds while it packs.
PACK = 4096
HELD = 500_000


def packed(rows: DataFrame, columns: list[str], size: int = PACK, held: int = HELD) -> DataFrame:
    """Rows of a station and hour gathered into arrays of at most ``size``, one per column. Rows without a station or
    an hour, which no join on them keeps, are left out.

    The rows are placed by station and hour first, and a task gathers ``held`` of them at a time, so an hour makes few
    packs and what a task holds does not grow with it.
    """
    types = dict(rows.dtypes)
    names = ["station", "hour", *columns]

    def gathered(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).sort_by([("station", "ascending"), ("hour", "ascending")]).combine_chunks()
        station, hour = table.column("station").chunk(0), table.column("hour").chunk(0)
        code, at = station.dictionary_encode().indices.to_numpy(), hour.to_numpy()
        heads = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (at[1:] != at[:-1])])
        place = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
        cuts = np.flatnonzero(place % size == 0)
        ends = pa.array(np.r_[cuts, len(at)], pa.int32())
        arrays = [pa.ListArray.from_arrays(ends, table.column(c).chunk(0)) for c in columns]
        return pa.RecordBatch.from_arrays([station.take(pa.array(cuts)), hour.take(pa.array(cuts)), *arrays], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            n += batch.num_rows
            if n >= held:
                yield gathered(kept)
                kept, n = [], 0
        if kept:
            yield gathered(kept)

    placed = rows.filter("station is not null and hour is not null").repartition("station", "hour").select(
        "station", F.unix_micros("hour").alias("hour"), *columns)
    out = placed.mapInArrow(pack, "station string, hour bigint, " + ", ".join(f"`{c}` array<{types[c]}>" for c in columns))
    return out.withColumn("hour", F.timestamp_micros("hour"))


def river_with_weather(river: DataFrame, weather: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Stream-stream join on station and hour, both sides bounded by their watermark; ``laid_out`` makes rows of the result.

    Every reading meets every weather row of its hour, so the pairs grow with the square of an hour's rows. The streams
    are joined pack by pack: the state and the rows written hold each reading once per pack of the other side, and
    the pairs themselves are never written or shuffled.
    """
    r = river.withColumn("hour", F.date_trunc("hour", "time")).withColumn("time", F.unix_micros("time"))
    w = weather.withColumn("hour", F.date_trunc("hour", "time"))
    r = packed(r, ["time", "value"]).withWatermark("hour", lateness)
    w = packed(w, ["rain"]).withWatermark("hour", lateness).select(
        F.col("station").alias("w_station"), F.col("hour").alias("w_hour"), F.col("rain"))
    return r.join(w, (F.col("station") == F.col("w_station")) & (F.col("hour") == F.col("w_hour"))).select(
        "station", "time", "value", "rain")


#: Pairs in a slice of joined packs at most, unless one reading alone has more.
PAIRS = 16_384


def sliced(packs: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Joined packs cut along their readings into slices of at most ``pairs`` pairs, or of one reading."""
    size = F.greatest(F.lit(1), F.floor(F.lit(pairs) / F.size("rain"))).cast("int")
    cut = packs.withColumn("_n", size).withColumn("_at", F.explode(F.sequence(F.lit(1), F.size("time"), F.col("_n"))))
    return cut.select("station", *[F.slice(c, F.col("_at"), F.col("_n")).alias(c) for c in ("time", "value")], "rain")


def laid_out(packs: DataFrame, naive: bool = False) -> DataFrame:
    """The pairs (station, time, value, rain) in the joined packs of ``river_with_weather``; ``naive`` gives times as naive
    UTC, turned once a reading and not once a pair.

    Packs are few and make very many pairs, so they are dealt evenly to the tasks first. Rows that stem from one row within a
    stage's generated code are all held before the first is handed on; ``coalesce``, which moves nothing, ends that code
    between the slices and their pairs, so a task holds the pairs of a slice and not those of a whole pack.
    """
    sc = packs.sparkSession.sparkContext
    n = max(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * sc.defaultParallelism)
    slices = sliced(packs.repartition(n)).coalesce(n)
    at = F.timestamp_micros("_r.time")
    readings = slices.select("station", F.explode(F.arrays_zip("time", "value")).alias("_r"), "rain").select(
        "station", (at.cast("timestamp_ntz") if naive else at).alias("time"), F.col("_r.value").alias("value"), "rain")
    return readings.select("station", "time", "value", F.explode("rain").alias("rain"))


def river_with_hourly_weather(river: DataFrame, weather: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each reading with the mean rain of its station and hour: a windowed aggregate of one stream feeds a join with the other.

    An hour leaves the aggregate once, when the watermark has passed it, so a reading is joined with one row at most
    and never with the weather rows themselves. Both join keys carry event time: readings whose hour cannot come any more leave the state.
    """
    hourly = (
        weather.withWatermark("time", lateness).groupBy(F.window("time", "1 hour").alias("hour"), "station")
        .agg(F.avg("rain").alias("rain"), F.count("rain").alias("n_rain"))
        .select("hour", F.col("station").alias("w_station"), "rain", "n_rain")
    )
    at = F.timestamp_micros(F.unix_micros("time")).alias("time")  # a stream may have one event time only: its hour
    placed = river.withWatermark("time", lateness).select("station", at, "value", F.window("time", "1 hour").alias("hour"))
    return placed.join(hourly, (placed["hour"] == hourly["hour"]) & (F.col("station") == F.col("w_station"))).select(
        "station", "time", "value", "rain", "n_rain")


SMOOTH = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("time", T.TimestampType()), T.StructField("value", T.DoubleType()),
    T.StructField("last_known", T.DoubleType()), T.StructField("smooth", T.DoubleType()),
])
SMOOTH_STATE = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("w", T.DoubleType()), T.StructField("last", T.DoubleType())])


def online_smooth(readings: DataFrame, span: int = 24) -> DataFrame:
    """Running weighted mean and last known value per station, carried across batches as three numbers.

    Rows of a station must arrive in time order from batch to batch; within a batch they are sorted.
    """
    alpha = 2.0 / (span + 1.0)

    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        y, w, last = state.get if state.exists else (None, 1.0, None)
        rows = pd.concat(list(batches)).sort_values("time", kind="stable")
        smooth, known = [], []
        for x in rows["value"].to_numpy(dtype=float):
            w = w * (1 - alpha)
            if x == x:
                y = x if y is None else (w * y + alpha * x) / (w + alpha)
                w, last = 1.0, float(x)
            smooth.append(y)
            known.append(last)
        state.update((y, w, last))
        yield pd.DataFrame({"station": key[0], "time": rows["time"].to_numpy(), "value": rows["value"].to_numpy(),
                            "last_known": known, "smooth": smooth})

    return readings.groupBy("station").applyInPandasWithState(update, SMOOTH, SMOOTH_STATE, "append", GroupStateTimeout.NoTimeout)


HOUR_MICROS = 3_600_000_000
ROCKS_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIMED_SMOOTH = "station string, at bigint, value double, last_known double, smooth double, late boolean"


def folded(values: np.ndarray, now: tuple, alpha: float) -> tuple[list, list, tuple]:
    """Weighted means and last known values along ``values`` from the state (mean, weight, last known), and the state after them."""
    y, w, last = now
    smooth, known = [], []
    for x in values:
        w = w * (1 - alpha)
        if x == x:
            y = x if y is None else (w * y + alpha * x) / (w + alpha)
            w, last = 1.0, float(x)
        smooth.append(y)
        known.append(last)
    return smooth, known, (None if y is None else float(y), float(w), last)


class InTimeOrder(StatefulProcessor):
    """Readings of a station wait, by hour, until the watermark has passed their hour; a timer then folds the hour in time order into three numbers.

    Input is taken chunk by chunk, so no more than a chunk and an hour of a station is in memory at once. A reading
    whose hour is over already cannot be folded in order: it comes out at once, marked late.
    """

    def __init__(self, span: int):
        self.alpha = 2.0 / (span + 1.0)

    def init(self, handle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "y double, w double, last double")
        self.waiting = handle.getMapState("waiting", "hour long", "at array<bigint>, value array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() * 1000 // HOUR_MICROS
        for chunk in rows:
            at, value = chunk["at"].to_numpy(dtype=np.int64), chunk["value"].to_numpy(dtype=float)
            hours = at // HOUR_MICROS
            for hour in np.unique(hours[hours >= over]).tolist():
                own = hours == hour
                times, values = at[own].tolist(), [None if x != x else x for x in value[own].tolist()]
                if self.waiting.containsKey((hour,)):
                    before = self.waiting.getValue((hour,))
                    times, values = list(before[0]) + times, list(before[1]) + values
                else:
                    self.handle.registerTimer((hour + 1) * (HOUR_MICROS // 1000))
                self.waiting.updateValue((hour,), (times, values))
            late = hours < over
            if late.any():
                yield pd.DataFrame({"station": key[0], "at": at[late], "value": value[late], "last_known": None, "smooth": None, "late": True})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        hour = expiredTimerInfo.getExpiryTimeInMs() * 1000 // HOUR_MICROS - 1
        times, values = self.waiting.getValue((hour,))
        self.waiting.removeKey((hour,))
        at, value = np.array(times, dtype=np.int64), np.array(values, dtype=float)
        order = np.argsort(at, kind="stable")
        smooth, known, after = folded(value[order], tuple(self.now.get()) if self.now.exists() else (None, 1.0, None), self.alpha)
        self.now.update(after)
        yield pd.DataFrame({"station": key[0], "at": at[order], "value": value[order], "last_known": known, "smooth": smooth, "late": False})

    def close(self) -> None:
        pass


def timed_smooth(readings: DataFrame, span: int = 24, lateness: str = "1 hour") -> DataFrame:
    """Running weighted mean and last known value per station in event-time order, hour by hour as the watermark passes;
    late readings come out unsmoothed and marked ``late``. Rows without a station or a time are left out.

    The state lives in RocksDB, which timers need. The operator is given the time as a plain number: late rows would
    otherwise be dropped before they reach it.
    """
    readings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_STATE)
    rows = readings.filter("station is not null and time is not null").withWatermark("time", lateness).select(
        "station", F.unix_micros("time").alias("at"), "value")
    out = rows.groupBy("station").transformWithStateInPandas(InTimeOrder(span), TIMED_SMOOTH, "Append", "eventTime")
    return out.select("station", F.timestamp_micros("at").alias("time"), "value", "last_known", "smooth", "late")
