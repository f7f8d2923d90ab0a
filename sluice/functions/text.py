"""Text and nested-value expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two missing-value spellings of a Python list literal.
PYTHON_MISSING = r"\b(None|nan)\b"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits(c) -> Column:
    """All digits of a string joined together."""
    return F.regexp_replace(col(c), "[^0-9]", "")


def digit_groups(c) -> Column:
    return F.regexp_extract_all(col(c), F.lit("([0-9]+)"), F.lit(1))


def normal_name(c) -> Column:
    """Lower case with underscores, as used in merged file names."""
    return F.lower(F.replace(col(c), F.lit("-"), F.lit("_")))


def key_of(*cols) -> Column:
    return F.concat_ws("_", *[col(c).cast("string") for c in cols])


def parse_literal(c, schema: str) -> Column:
    """A Python list or dict literal (single quotes, None, nan) as a Spark value."""
    text = F.regexp_replace(col(c), PYTHON_MISSING, "null")
    return F.from_json(text, schema, {"allowSingleQuotes": "true"})


def lookup(map_col, key, default) -> Column:
    return F.coalesce(F.try_element_at(col(map_col), F.lit(key)), F.lit(default))
