"""Quality-label reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_between
from ..functions.numeric import percent
from ..schemas import QUALITY_LABELS
from .blocks import BLOCK, names, in_blocks, runs


def label_distribution(df: DataFrame, key="station", label: str = "quality") -> DataFrame:
    """Count and percent per label. ``total_records`` counts every row; NULL labels have no row and no
    share in the percentages."""
    keys = names(key)
    per_label = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    labelled = F.sum(F.when(F.col(label).isNotNull(), F.col("n"))).over(w)
    return (
        per_label.withColumn("total_records", F.sum("n").over(w))
        .withColumn("pct", percent("n", labelled))
        .filter(F.col(label).isNotNull())
    )


def label_calendar(df: DataFrame, part, name: str, key="station", label: str = "quality", value: str = "value",
                   time: str = "time", labels=QUALITY_LABELS) -> DataFrame:
    """Known values per calendar part and label, one column per label, 0 where empty."""
    counted = df.groupBy(*names(key), part(F.col(time)).alias(name)).pivot(label, list(labels)).agg(F.count(value))
    return counted.na.fill(0, list(labels))


def label_runs(df: DataFrame, key="station", label: str = "quality", time: str = "time", tie=(), block: int = BLOCK) -> DataFrame:
    """Runs of one label in time order; a NULL label ends a run and forms none."""
    order = [time, *names(tie)]
    return runs(in_blocks(df, key, time, block), key, order, label, time).filter(F.col(label).isNotNull())


def streak_summary(run_table: DataFrame, key="station", label: str = "quality", minutes: int = 15) -> DataFrame:
    return run_table.groupBy(*names(key), label).agg(
        (F.max("n_rows") * minutes).alias("longest_streak_minutes"),
        (F.avg("n_rows") * minutes).alias("avg_streak_minutes"),
    )


def streak_lengths(run_table: DataFrame, key="station", label: str = "quality") -> DataFrame:
    """Distribution of run lengths as rows."""
    return run_table.groupBy(*names(key), label, F.col("n_rows").alias("length")).agg(F.count(F.lit(1)).alias("n_streaks"))


def training_periods(run_table: DataFrame, key="station", label: str = "quality", good: str = "Good",
                     min_days: float = 30) -> DataFrame:
    """Runs of the good label lasting at least ``min_days``. Sort by length at the sink."""
    return (
        run_table.filter(F.col(label) == good)
        .withColumn("length_days", days_between("start", "end"))
        .filter(F.col("length_days") >= min_days)
        .select(*names(key), F.col("start").alias("start_date"), F.col("end").alias("end_date"), "length_days",
                F.col("n_rows").alias("n_records"))
    )


def overall_quality(df: DataFrame, key="station", label: str = "quality") -> DataFrame:
    """Label shares over all series together with the spread of the per-series shares."""
    per_series = label_distribution(df, key, label)
    grand = Window.partitionBy()
    return (
        per_series.groupBy(label)
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_series"), F.min("pct").alias("min_pct"),
             F.avg("pct").alias("mean_pct"), F.max("pct").alias("max_pct"))
        .withColumn("pct", percent("n", F.sum("n").over(grand)))
    )
