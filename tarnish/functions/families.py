"""Column families: which columns an operator applies to.

Dispatch always looks at the *current* schema, so a numeric column that was
turned into text belongs to the text family until it is converted back.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROW_ID = "_row_id"
COPY = "_copy"
#: Columns that identify a row; no operator changes, counts or compares them.
BOOKKEEPING = (ROW_ID, COPY)

NUMERIC = "numeric"
TEXT = "text"
DATETIME = "datetime"
OTHER = "other"


def family_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return TEXT
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return DATETIME
    return OTHER


def is_integer(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.IntegralType)


def data_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    hidden = set(BOOKKEEPING) | set(exclude)
    return [c for c in df.columns if c not in hidden]


def columns_in(df: DataFrame, family: str, exclude: Iterable[str] = ()) -> list[str]:
    wanted = set(data_columns(df, exclude))
    return [f.name for f in df.schema.fields if f.name in wanted and family_of(f.dataType) == family]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_in(df, NUMERIC, exclude)


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_in(df, TEXT, exclude)


def datetime_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_in(df, DATETIME, exclude)


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}; the table has {df.columns}")
