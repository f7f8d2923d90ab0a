"""Pivots, unions and row selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import names
from .features import numbered


def widen(df: DataFrame, index, column: str, value: str, values) -> DataFrame:
    """Long to wide; a repeated (index, column) pair is an error."""
    index = names(index)
    cells = df.groupBy(*index, column).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("repeated cell: aggregate before the pivot")).cast("double"))
    return (
        cells.withColumn("_v", F.coalesce(checked, F.col("_v")))
        .groupBy(*index).pivot(column, list(values)).agg(F.first("_v"))
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def side_by_side_months(df: DataFrame, key, values, value: str = "value", time: str = "time") -> DataFrame:
    """Monthly means of all series aligned on the month, one column per series."""
    return df.groupBy(F.month(time).alias("month")).pivot(key, list(values)).agg(F.avg(value))


def row_at(df: DataFrame, i: int, key="station", time: str = "time") -> DataFrame:
    """The row at 0-based position ``i`` of each series."""
    return numbered(df, key, time).filter(F.col("rn") == i + 1).drop("rn")


def first_rows(df: DataFrame, key, order) -> DataFrame:
    """First row per key in the given order, as an aggregate."""
    from .clean import keep_first

    return keep_first(df, key, order)


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)
