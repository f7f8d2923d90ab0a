"""Landed service payloads (JSON) to rows. Fetching them is outside this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_literal
from ..operators.joins import drop_listed
from ..schemas import READING_LIST

# Page size of the daily climate service, default of a missing observation.
CLIMATE_PAGE_LIMIT = 1000
NO_DATA = "No Data"


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to columns with dotted names, all levels."""
    def walk(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here))

    return df.select(*walk(df.schema, ()))


def read_station_lists(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """Station lists of several catchments, flattened and stacked by column name.

    A service answer is one document per file; ``multi_line=False`` reads one document per line.
    """
    frames = [flatten(spark.read.option("multiLine", str(multi_line).lower()).json(p)) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_payloads(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Split text payloads into parsed rows (``payload``) and a quarantine of unreadable ones."""
    parsed = F.from_json(column, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.withColumn("payload", parsed)
    bad = F.col("payload").isNull() | F.col("payload._corrupt").isNotNull()
    good = rows.filter(~bad).drop(column).withColumn("payload", F.col("payload").dropFields("_corrupt"))
    return good, rows.filter(bad).drop("payload")


def explode_series(df: DataFrame, column: str = "values", schema: str = READING_LIST, time: str = "time") -> DataFrame:
    """List literal to one row per element with a parsed time; an empty list gives no row."""
    rest = [c for c in df.columns if c != column]
    rows = df.select(*rest, F.inline(parse_literal(column, schema)))
    return rows.withColumn(time, F.col(time).try_cast("timestamp_ntz"))


def unreadable(df: DataFrame, column: str = "values", schema: str = READING_LIST) -> DataFrame:
    """Rows whose list was present but could not be parsed."""
    return df.filter(F.col(column).isNotNull() & parse_literal(column, schema).isNull())


def parallel_arrays(df: DataFrame, start: str, interval: str, arrays: list[str], time: str = "time", end: str | None = None) -> DataFrame:
    """Arrays of equal step to rows: element i is at start + i·interval seconds, before ``end``."""
    rest = [c for c in df.columns if c not in (start, interval, end, *arrays)]
    zipped = df.select(*rest, start, interval, *([end] if end else []), F.posexplode(F.arrays_zip(*arrays)).alias("_i", "_z"))
    at = F.col(start) + F.col("_i") * F.col(interval)
    if end:
        zipped = zipped.filter(at < F.col(end))
    return zipped.select(*rest, F.timestamp_seconds(at).cast("timestamp_ntz").alias(time), *[F.col(f"_z.{a}").alias(a) for a in arrays])


def month_chunks(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Cut each range into month chunks; a chunk starts on the day the one before it ended.

    The month is added to the previous chunk, so a range begun on the 31st settles on the 28th after
    its first February. The list per range is as long as its months.
    """
    month = F.expr("interval 1 month")
    rest = [c for c in ranges.columns if c not in (start, end)]
    steps = F.sequence(F.lit(1), F.ceil(F.months_between(F.col(end), F.col(start))).cast("int") + 1)
    borders = F.aggregate(steps, F.array(F.col(start)), lambda seen, _: F.concat(seen, F.array(F.element_at(seen, -1) + month)))
    return (
        ranges.select(*rest, F.col(end).alias("_end"), F.explode(borders).alias("chunk_start"))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + month, F.col("_end")))
        .filter(F.col("chunk_start") < F.col("chunk_end"))
        .drop("_end")
    )


def forecast_parameters(df: DataFrame, params: str = "SiteRep.Wx.Param") -> DataFrame:
    """List of (name, $) pairs to one map column ``parameters``."""
    pairs = F.transform(F.col(params), lambda p: F.struct(p["name"], p["$"]))
    return df.withColumn("parameters", F.map_from_entries(pairs))


def observations(df: DataFrame, periods: str = "SiteRep.DV.Location.Period", rep: str = "Rep", field: str = "Pp") -> DataFrame:
    """Period → Rep → one row with the field, 'No Data' where it is absent."""
    rest = [c for c in df.columns if c != periods.split(".")[0]]
    per = df.select(*rest, F.explode(periods).alias("_p"))
    each = per.select(*rest, F.explode(f"_p.{rep}").alias("_r"))
    return each.select(*rest, F.coalesce(F.col(f"_r.{field}").cast("string"), F.lit(NO_DATA)).alias(field))


def climate_rows(pages: DataFrame, results: str = "results", limit: int = CLIMATE_PAGE_LIMIT) -> DataFrame:
    """Rows of climate pages. A page as long as the limit may be cut off and carries ``maybe_cut``."""
    rest = [c for c in pages.columns if c != results]
    cut = (F.size(results) >= limit).alias("maybe_cut")
    return pages.filter(F.col(results).isNotNull()).select(*rest, cut, F.inline(results))


def still_to_load(work: DataFrame, landed: DataFrame, key) -> DataFrame:
    """Work list minus what has landed, so an interrupted load can go on."""
    return drop_listed(work, landed, key)
