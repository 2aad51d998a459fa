"""Duplicate rows by grouping, never by ranking inside a group.

A window over the duplicate key would sort all copies of a frequent row in one
task. Grouping combines copies on the map side first, so a key that holds a
third of the table costs each task one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.families import COPY, ROW_ID, data_columns, require_columns

KEEP = ("first", "last", False)


def default_order(df: DataFrame) -> list[str]:
    return [c for c in (ROW_ID, COPY) if c in df.columns]


def remove_duplicates(
    df: DataFrame,
    keep: str | bool = "first",
    subset: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per distinct ``subset`` (default: all data columns), or none of those that repeat.

    ``order_by`` says which row is the first or last and must tell rows apart;
    by default it is the row id. NULLs count as equal.
    """
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}")
    order = list(default_order(df) if order_by is None else order_by)
    keys = data_columns(df, order) if subset is None else list(subset)
    require_columns(df, [*keys, *order])
    rest = [c for c in df.columns if c not in keys]
    if not rest and keep:
        return df.dropDuplicates()
    if keep and not order:
        raise ValueError(f"which row is the {keep} one? give order_by")

    aggregates: list[Column] = []
    single = len(rest) == 1 and rest == order
    if single:
        # A plain minimum keeps this a hash aggregation.
        aggregates.append((F.max if keep == "last" else F.min)(order[0]).alias(order[0]))
    elif rest:
        position = F.struct(*order) if len(order) > 1 else F.col(order[0]) if order else F.lit(0)
        pick = F.max_by if keep == "last" else F.min_by
        aggregates.append(pick(F.struct(*rest), position).alias("_row"))
    if not keep:
        aggregates.append(F.count("*").alias("_n"))
    grouped = df.groupBy(*keys).agg(*aggregates)
    if not keep:
        grouped = grouped.filter(F.col("_n") == 1)
    if rest and not single:
        grouped = grouped.select(*keys, "_row.*")
    return grouped.select(*df.columns)
