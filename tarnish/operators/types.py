"""Finding out what text columns hold, and turning them back into it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.convert import convert_to, looks_integer, looks_numeric, parse_timestamp
from tarnish.functions.families import require_columns, text_columns, type_of

TARGETS = ("int", "float", "string", "datetime", "boolean", "category")


def parse_rates(df: DataFrame, columns: Sequence[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """(column, filled, numeric, integer, datetime): how many non-blank texts read as what."""
    columns = list(columns if columns is not None else text_columns(df, exclude))
    aggregates, entries = [], []
    for i, c in enumerate(columns):
        s = F.col(c)
        parts = {
            "filled": s.isNotNull() & (F.btrim(s) != ""),
            "numeric": looks_numeric(s),
            "integer": looks_integer(s),
            "datetime": parse_timestamp(s).isNotNull(),
        }
        aggregates += [F.count_if(e).alias(f"{n}{i}") for n, e in parts.items()]
        entries.append(F.struct(F.lit(c).alias("column"), *(F.col(f"{n}{i}").alias(n) for n in parts)))
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column string, filled bigint, numeric bigint, integer bigint, datetime bigint"
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def infer_targets(
    df: DataFrame, threshold: float = 0.5, columns: Sequence[str] | None = None, exclude: Iterable[str] = ()
) -> dict[str, str]:
    """The type each text column should have, for those where enough values read as one."""
    targets = {}
    for row in parse_rates(df, columns, exclude).collect():
        if not row["filled"]:
            continue
        if row["numeric"] / row["filled"] >= threshold:
            targets[row["column"]] = "int" if row["integer"] == row["numeric"] else "float"
        elif row["datetime"] / row["filled"] >= threshold:
            targets[row["column"]] = "datetime"
    return targets


def convert_types(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Columns cast to the named targets; values that do not fit become NULL."""
    require_columns(df, targets)
    return df.select(
        *(
            convert_to(F.col(c), type_of(df, c), targets[c]).alias(c) if c in targets else F.col(c)
            for c in df.columns
        )
    )
