"""Weather clean-up with its accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import keep_first
from ..operators.gaps import duplicate_stats, missing_steps


def weather_clean(df: DataFrame, station: str = "station_id", time: str = "date", tie: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with a readable UTC ``time``, one per (station, time), and one metadata row per station.

    ``tie`` orders rows of the same time; without it the smallest remaining row is kept.
    """
    parsed = F.try_to_timestamp(F.col(time).cast("string")).cast("timestamp_ntz")
    rows = df.withColumn("time", parsed).filter(F.col("time").isNotNull())
    if time != "time":
        rows = rows.drop(time)
    ties = [tie] if tie else [c for c in rows.columns if c not in (station, "time")]
    cleaned = keep_first(rows, [station, "time"], ties)
    copies = duplicate_stats(rows, station).select(station, "n_duplicate_rows", "pct_excess")
    holes = missing_steps(cleaned, station).select(station, "n_missing", "pct_missing")
    return cleaned, copies.join(holes, station)
