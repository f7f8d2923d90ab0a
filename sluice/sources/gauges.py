"""Gauge and weather files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import number_or_null
from ..functions.text import normal_name
from ..operators.clean import keep_first
from ..schemas import QUALIFIED_GAUGE

# File naming of gauge and merged series.
QUALIFIED_SUFFIX = "-level-15min-Qualified.csv"
MERGED_PREFIX = "merged_"
GAUGE_FILE = r"([^/=]+)-level-15min-Qualified\.csv"


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def file_key(pattern: str) -> Column:
    """First group of ``pattern`` in the file path, so the key comes from the name, not the content."""
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def read_csv(spark: SparkSession, path, schema: T.StructType, recursive: bool = True) -> DataFrame:
    """CSV files under a declared schema; a header that disagrees with it is an error."""
    return (
        spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
        .option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.csv").csv(path)
    )


def read_qualified(spark: SparkSession, path: str, station: str | None = None) -> DataFrame:
    """All columns of qualified gauge files plus ``station``. ``path`` is the folder of the files.

    One station reads one file; an unknown station raises ``FileNotFoundError``.
    """
    target = f"{path}/*{station}{QUALIFIED_SUFFIX}" if station else path
    try:
        raw = read_csv(spark, target, _as_text(QUALIFIED_GAUGE)) if not station else (
            spark.read.schema(_as_text(QUALIFIED_GAUGE)).option("header", "true").option("enforceSchema", "false").csv(target)
        )
    except AnalysisException as e:
        if station and "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no gauge file for station {station!r} below {path}") from e
        raise
    rows = raw.withColumn("station", file_key(GAUGE_FILE))
    if station:
        rows = rows.filter(F.col("station") == station)
    return rows.withColumn("dateTime", F.col("dateTime").cast("timestamp_ntz")).withColumn("date", F.col("date").cast("date"))


def read_river(spark: SparkSession, path: str, station: str | None = None) -> DataFrame:
    """(station, time, value): numbers coerced, unreadable values NULL. Sort at the sink."""
    return read_qualified(spark, path, station).select("station", F.col("dateTime").alias("time"), number_or_null("value").alias("value"))


def available_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station names from the file names, which are listed; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    return files.select(file_key(GAUGE_FILE).alias("station")).filter("station <> ''").distinct()


def read_weather(spark: SparkSession, path: str, columns: T.StructType, time: str = "time", keep_station: bool = True) -> DataFrame:
    """Union of all weather files, times parsed, full-row duplicates dropped.

    Without the station (its folder name) equal rows of two stations collapse into one.
    """
    rows = read_csv(spark, path, _as_text(columns))
    parsed = [
        (F.col(f.name).cast("timestamp_ntz") if f.name == time else F.col(f.name).cast(f.dataType)).alias(
            "time" if f.name == time else f.name)
        for f in columns.fields
    ]
    station = [file_key(r"([^/=]+)/[^/]+$").alias("station")] if keep_station else []
    return rows.select(*station, *parsed).dropDuplicates()


def read_merged(spark: SparkSession, path: str, station: str, columns: T.StructType) -> DataFrame:
    """The merged file of one station, found by its normalised name."""
    name = station.replace("-", "_").lower()
    rows = read_csv(spark, path, _as_text(columns)).withColumn("station", file_key(MERGED_PREFIX + r"([^/]+)\.csv"))
    return rows.filter(F.col("station") == name).select(
        "station", F.col("time").cast("timestamp_ntz").alias("time"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns.fields if f.name != "time"])


def merged_name(station) -> Column:
    """File name under which a merged series is stored."""
    return F.concat(F.lit(MERGED_PREFIX), normal_name(station), F.lit(".csv"))


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, header: str) -> DataFrame:
    """CSV lines that are UTF-8 where valid and ISO-8859-1 otherwise; bad records keep their text.

    The text source hands lines over byte for byte, so one pass serves both encodings. Header and
    blank lines go.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(path)
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    kept = lines.select(F.trim(text).alias("_line"), F.col("_metadata.file_path").alias("file"))
    kept = kept.filter((F.col("_line") != "") & (F.col("_line") != header))
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType(), True)])
    parsed = F.from_csv("_line", full.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return kept.select("file", parsed.alias("_row")).select("file", "_row.*")


def first_row_per_file(df: DataFrame, file: str = "file", order: str = "time") -> DataFrame:
    """One row per file, the earliest, as an aggregate."""
    return keep_first(df, file, order)


def inventory(df: DataFrame, key: str = "station", value: str = "value") -> DataFrame:
    """Files, rows and value range per station of a frame read from files."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes per file, from the listing alone (no content column is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("n_bytes"))
