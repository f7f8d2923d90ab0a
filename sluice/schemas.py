"""Declared input schemas and fixed names."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_S, _D, _N = T.StringType(), T.DoubleType(), T.TimestampNTZType()

# The quality labels of qualified gauge files.
QUALITY_LABELS = ["Good", "Suspect", "Missing", "Error", "Unchecked", "Estimated"]

# The columns of a qualified gauge file. The value stays text until it is coerced.
QUALIFIED_GAUGE = _struct(
    ("measure", _S), ("dateTime", _N), ("date", T.DateType()), ("value", _S),
    ("completeness", _S), ("quality", _S), ("qcode", _S),
)

# Hourly weather variables of the archive service.
HOURLY_VARIABLES = [
    "temperature_2m", "relative_humidity_2m", "rain", "pressure_msl", "surface_pressure", "soil_moisture_0_to_7cm",
]
HOURLY_WEATHER = _struct(
    ("date", _N), *[(v, _D) for v in HOURLY_VARIABLES],
    ("weather_station_latitude", _D), ("weather_station_longitude", _D),
)

# Station weather columns.
STATION_WEATHER = _struct(
    ("time", _N),
    *[(c, _D) for c in ("temp", "dwpt", "rhum", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun", "coco")],
    ("station_id", _S),
)

# Daily climate rows and their datatypes.
DAILY_CLIMATE = _struct(("date", _N), ("datatype", _S), ("station", _S), ("value", _D))
CLIMATE_TYPES = ["PRCP", "TMAX", "TMIN", "AWND", "WSF2"]

READING_LIST = "array<struct<time:string,value:double>>"

# The station table.
STATION_TABLE = _struct(
    ("_c0", T.LongType()), ("station_id", T.LongType()), ("station_reference", _S), ("name", _S), ("latitude", _D),
    ("longitude", _D), ("station_owner", T.LongType()), ("updated_time", _N), ("catchment_name", _S),
    ("river_name", _S), ("elevation", _D), ("station_type", _S), ("region", _S), ("area_name", _S), ("date_open", _N),
    ("stage_datum", _D), ("por_max", _D), ("date_por_max", _N), ("por_min", _D), ("date_por_min", _N),
    ("percentile95", _D), ("percentile5", _D), ("recent_highest", _D), ("date_highest", _N), ("units", _S),
)


def require(df, *cols):
    """Fail at once when an input lacks a column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
