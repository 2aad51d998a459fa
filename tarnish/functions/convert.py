"""Casts between text and typed values that do not depend on the session.

Datetimes use the zone-free timestamp type throughout; ``date_format`` and
``to_timestamp`` would go through the session time zone and shift values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.families import is_integer

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d{1,18}\s*$"
TIMESTAMP_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?\s*$"

# Spellings read as true / false.
TRUE_TEXT = ("true", "t", "yes", "y", "1")
FALSE_TEXT = ("false", "f", "no", "n", "0")


def number_text(c: Column, data_type: T.DataType) -> Column:
    """A number as plain text; doubles of 1e7..1e16 without an exponent."""
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.cast("string")
    plain = F.regexp_replace(c.cast("string").cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    wide = (F.abs(c) >= F.lit(1e7)) & (F.abs(c) < F.lit(1e16))
    return F.when(wide, plain).otherwise(c.cast("string"))


def datetime_text(c: Column, data_type: T.DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; fractions of a second are cut off."""
    stamp = c.cast("timestamp_ntz") if isinstance(data_type, T.DateType) else c
    return F.substring(stamp.cast("string"), 1, 19)


def looks_numeric(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def looks_integer(c: Column) -> Column:
    return c.rlike(INTEGER_PATTERN)


def parse_number(c: Column) -> Column:
    """Text to double, NULL where it is no number ('nan', '1d' and '' are none)."""
    return F.when(looks_numeric(c), F.btrim(c).try_cast("double"))


def parse_integer(c: Column) -> Column:
    return F.when(looks_integer(c), F.btrim(c).try_cast("bigint"))


def parse_timestamp(c: Column) -> Column:
    return F.when(c.rlike(TIMESTAMP_PATTERN), F.btrim(c).try_cast("timestamp_ntz"))


def parse_boolean(c: Column) -> Column:
    word = F.lower(F.btrim(c))
    return F.when(word.isin(*TRUE_TEXT), F.lit(True)).when(word.isin(*FALSE_TEXT), F.lit(False))


def as_number(c: Column, data_type: T.DataType) -> Column:
    """Any column as double: numbers cast, text parsed, the rest NULL."""
    if isinstance(data_type, T.NumericType):
        return c.cast("double")
    if isinstance(data_type, T.StringType):
        return parse_number(c)
    return F.lit(None).cast("double")


def convert_to(c: Column, data_type: T.DataType, target: str) -> Column:
    """Explicit conversion; values that do not fit become NULL."""
    is_text = isinstance(data_type, T.StringType)
    if target == "int":
        if is_integer(data_type):
            return c.cast("bigint")
        return F.rint(as_number(c, data_type)).try_cast("bigint")
    if target == "float":
        return as_number(c, data_type)
    if target in ("string", "category"):
        if isinstance(data_type, T.NumericType):
            return number_text(c, data_type)
        return c.cast("string")
    if target == "datetime":
        return parse_timestamp(c) if is_text else c.cast("timestamp_ntz")
    if target == "boolean":
        return parse_boolean(c) if is_text else c.cast("boolean")
    raise ValueError(f"unknown target type {target!r}; use int, float, string, datetime, boolean or category")


def nan_to_null(c: Column, data_type: T.DataType) -> Column:
    """NaN is the same 'missing' as NULL, but Spark counts it as a value."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast(data_type))
    return c
