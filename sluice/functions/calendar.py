"""Calendar and time expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quarter_hour(t) -> Column:
    """Index 0..95 of the quarter hour within the day."""
    return F.hour(col(t)) * 4 + F.floor(F.minute(col(t)) / 15).cast("int")


def year_slot(t) -> Column:
    """Day of year and quarter hour as one key; leap years run one day ahead after February."""
    return F.dayofyear(col(t)) * 96 + quarter_hour(t)


def weekday_name(t) -> Column:
    return F.date_format(col(t), "E")


def year_month(t) -> Column:
    return F.date_format(col(t), "yyyy_MM")


def is_weekend(t) -> Column:
    return (F.weekday(col(t)) >= 5).cast("int")


def cyclic(x: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * x / F.lit(period)
    return F.sin(angle), F.cos(angle)


def midnight(t) -> Column:
    return F.to_date(col(t)).cast("timestamp_ntz")


def days_between(start, end) -> Column:
    """Fractional days."""
    a = F.unix_micros(col(start).cast("timestamp"))
    b = F.unix_micros(col(end).cast("timestamp"))
    return (b - a) / F.lit(86_400_000_000)


def hours_between(start, end) -> Column:
    return days_between(start, end) * 24


def calendar_parts(df: DataFrame, time: str = "time") -> DataFrame:
    t = F.col(time)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "hour": F.hour(t), "minute": F.minute(t),
        "week": F.weekofyear(t), "weekday": F.weekday(t), "day_of_year": F.dayofyear(t),
        "day_name": weekday_name(t), "year_month": year_month(t),
    })


def time_features(df: DataFrame, time: str = "time") -> DataFrame:
    """Cyclic hour, weekday and month plus the weekend flag."""
    t = F.col(time)
    hour, day, month = cyclic(F.hour(t), 24), cyclic(F.weekday(t), 7), cyclic(F.month(t), 12)
    return df.withColumns({
        "hour_sin": hour[0], "hour_cos": hour[1], "day_sin": day[0], "day_cos": day[1],
        "month_sin": month[0], "month_cos": month[1], "is_weekend": is_weekend(t),
    })


def with_holidays(df: DataFrame, holidays: DataFrame, time: str = "time", day: str = "day") -> DataFrame:
    """Flag rows on a day of the user's holiday table.

    A day may hold a third of all rows, so the flag is joined on (day, hour) after the holiday days
    are spread over their 24 hours; the planner broadcasts the table where its size allows.
    """
    marks = (
        holidays.select(F.col(day).cast("date").alias("_day")).distinct()
        .withColumn("_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn("is_holiday", F.lit(1))
    )
    return (
        df.withColumn("_day", F.to_date(time)).withColumn("_hour", F.hour(time))
        .join(marks, ["_day", "_hour"], "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
        .drop("_day", "_hour")
    )
