"""Helpers shared by the text operators: written tables, Arrow passes, fixed-size bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Rows and bytes of text handed to Python at once.
BATCH_ROWS, BATCH_BYTES = 2048, "8m"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        run.__doc__, run.__name__ = fn.__doc__, name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators. Sorted joins are split by adaptive execution where a key is hot."""
    shared_folder(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once, and a lost executor cannot lose it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, used: list[str], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply`` to ``docs`` while all columns but ``used`` travel in one struct, so that their names cannot clash with those an operator works with.

    The result has the columns of ``docs``, then those that ``apply`` adds; an added name that ``docs`` has already gets
    underscores until it is free.
    """
    used = list(dict.fromkeys(used))
    others = [c for c in docs.columns if c not in used]
    packed = docs.select(*[F.col(f"`{c}`") for c in used], *(
        [F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("_others")] if others else []))
    out = apply(packed)
    taken, added = set(docs.columns), []
    for c in out.columns[len(packed.columns):]:
        name = c
        while name in taken:
            name += "_"
        taken.add(name)
        added.append(F.col(f"`{c}`").alias(name))
    return out.select(*[F.col(f"`{c}`") if c in used else F.col("_others")[f"c{others.index(c)}"].alias(c) for c in docs.columns], *added)


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch. Batches are independent, so nothing is held beyond one."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


# --- bitmaps ---------------------------------------------------------------------------------
# A bitmap of fixed size stands in for a set of keys of any size: it can be broadcast, as its size does
# not grow with the data, and lets through a superset that an exact join then narrows.

#: Bits of a key bitmap: 8 MiB, whatever the number of keys.
BITMAP_BITS = 1 << 26
_BUCKET = 32768  # bits in one bitmap made by bitmap_construct_agg


def key_bitmap(df: DataFrame, key: str | Column, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap over the low bits of a 64-bit key. At most ``bits / 32768`` rows of 4 KiB reach the driver."""
    key = F.col(key) if isinstance(key, str) else key
    position = key.bitwiseAND(F.lit(bits - 1))
    rows = (
        df.select(position.alias("p")).filter(F.col("p").isNotNull())
        .groupBy(F.shiftright("p", 15).alias("b"))
        .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(_BUCKET - 1))).alias("m"))
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        out[r["b"] * (_BUCKET // 8):(r["b"] + 1) * (_BUCKET // 8)] = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (uint64) may be in the set."""
    p = keys & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
