"""Partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.blocks import names

# ISO text with microseconds, which a cast reads back unchanged.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_series(df: DataFrame, path: str, partition="station", fmt: str = "parquet", spread: str | None = None) -> None:
    """One folder per station; only the stations in ``df`` are replaced.

    ``spread`` names a column (a date, a block) that divides a station's rows among writers, so that
    a station holding much of the data is not written by one task.
    """
    parts = names(partition)
    placed = df.repartition(*parts, spread) if spread else df
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    if fmt == "csv":
        writer = writer.option("header", "true").option("timestampNTZFormat", CSV_TIME)
    writer.format(fmt).save(path)


def append_new(df: DataFrame, path: str, partition=()) -> None:
    """Add rows to a landing table. Partition by something with few values (a day, a catchment): a
    folder per station of a large network would mean a file per station and task."""
    df.write.mode("append").partitionBy(*names(partition)).parquet(path)
