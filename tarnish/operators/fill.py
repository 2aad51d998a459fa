"""Filling missing cells: constants from statistics, and fills along an order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnish.functions.families import is_integer, require_columns, type_of
from tarnish.functions.quantiles import exact_quantiles
from tarnish.functions.storage import through_table
from tarnish.operators.stats import mode_values

NUMERIC_FILLS = ("median", "mean", "most_frequent", "zero", "constant")
# The texts the named categorical fills write.
TEXT_FILLS = {"unknown": "Unknown", "missing": "Missing", "empty_string": ""}
CATEGORICAL_FILLS = ("most_frequent", *TEXT_FILLS, "constant")
ORDERED_FILLS = ("forward_fill", "back_fill", "interpolate")


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*(F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns))).first()
    return [c for i, c in enumerate(columns) if row[f"n{i}"]]


def numeric_fill_values(
    df: DataFrame, columns: Sequence[str], how: str, constant: float | None = None
) -> dict[str, float]:
    """The number to put into missing cells; a column without any value gets none."""
    if how not in NUMERIC_FILLS:
        raise ValueError(f"unknown numeric fill {how!r}; use one of {NUMERIC_FILLS}")
    if not columns:
        return {}
    if how == "zero":
        return dict.fromkeys(columns, 0.0)
    if how == "constant":
        if constant is None:
            raise ValueError("a constant fill needs its constant")
        return dict.fromkeys(columns, constant)
    if how == "median":
        found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5])[()]
        return {c: q[0] for c, q in found.items() if q[0] is not None}
    if how == "mean":
        row = df.agg(*(F.avg(c).cast("double").alias(f"m{i}") for i, c in enumerate(columns))).first()
        return {c: row[f"m{i}"] for i, c in enumerate(columns) if row[f"m{i}"] is not None}
    doubles = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    return {r["column"]: r["value"] for r in mode_values(doubles, columns).collect()}


def text_fill_values(
    df: DataFrame, columns: Sequence[str], how: str, constant: str | None = None
) -> dict[str, str]:
    """The text to put into missing cells; the most frequent of none is the empty text."""
    if how not in CATEGORICAL_FILLS:
        raise ValueError(f"unknown categorical fill {how!r}; use one of {CATEGORICAL_FILLS}")
    if not columns:
        return {}
    if how in TEXT_FILLS:
        return dict.fromkeys(columns, TEXT_FILLS[how])
    if how == "constant":
        if constant is None:
            raise ValueError("a constant fill needs its constant")
        return dict.fromkeys(columns, constant)
    found = {r["column"]: r["value"] for r in mode_values(df, columns).collect()}
    return {c: found.get(c, "") for c in columns}


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Missing cells replaced; an integer column becomes double when its fill value has a fraction."""
    require_columns(df, values)

    def filled(name: str) -> Column:
        c, data_type, value = F.col(name), type_of(df, name), values[name]
        if is_integer(data_type) and float(value) != int(value):
            return F.coalesce(c.cast("double"), F.lit(float(value)))
        return F.coalesce(c, F.lit(value).cast(data_type))

    return df.select(*(filled(c).alias(c) if c in values else F.col(c) for c in df.columns))


def fill_along(
    df: DataFrame,
    columns: Sequence[str],
    how: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Forward fill, back fill or linear interpolation along an order.

    ``order_by`` must tell the rows of a partition apart. Interpolation works
    on row positions between two known values and carries the last one on.

    A plain window would put a whole partition key (or, without keys, the whole
    table) into one task. Rows are range-partitioned on (keys, order) instead,
    so a long run is cut into slices of like size, and the slicing is written
    down once so that every later read sees the same one. A slice needs only
    the last (first) known value of the slices before (after) it: one row per
    slice and key.

    The next known value is the last one in the reversed order: a frame that
    reaches to the end is added up anew for every row of it, which takes the
    square of a slice.
    """
    if how not in ORDERED_FILLS:
        raise ValueError(f"unknown fill {how!r}; use one of {ORDERED_FILLS}")
    require_columns(df, [*columns, *order_by, *partition_by])
    keys, order = list(partition_by), list(order_by)
    ranges = [*keys, *order]
    parted = df.repartitionByRange(slices, *ranges) if slices else df.repartitionByRange(*ranges)
    sliced = through_table(parted.withColumn("_slice", F.spark_partition_id()), "slices")

    # A track is followed along the order: the value and, to interpolate, its row position.
    tracks = {f"_v{i}": F.col(c).cast("double") if how == "interpolate" else F.col(c) for i, c in enumerate(columns)}
    rows = Window.partitionBy("_slice", *keys).orderBy(*order)
    if how != "forward_fill":
        sliced = sliced.withColumn("_at", F.row_number().over(rows).cast("bigint"))
    if how == "interpolate":
        tracks |= {f"_p{i}": F.when(F.col(c).isNotNull(), F.col("_at")) for i, c in enumerate(columns)}
    sliced = sliced.withColumns(tracks)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    nearest = []
    if how != "back_fill":
        nearest.append(("before", F.last, F.max_by, rows.rowsBetween(*so_far)))
    if how != "forward_fill":
        back = Window.partitionBy("_slice", *keys).orderBy(F.desc("_at"))
        nearest.append(("after", F.first, F.min_by, back.rowsBetween(*so_far)))

    # One row per slice and key: the outermost known values, then the nearest ones of other slices.
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    edges = sliced.groupBy("_slice", *keys).agg(
        F.count("*").alias("_size"),
        *(
            pick(t, F.when(F.col(t).isNotNull(), position)).alias(f"{t}_{side}")
            for t in tracks
            for side, _, pick, _ in nearest
        ),
    )
    of_key = Window.partitionBy(*keys).orderBy("_slice")
    others = {
        "before": of_key.rowsBetween(Window.unboundedPreceding, -1),
        "after": of_key.rowsBetween(1, Window.unboundedFollowing),
    }
    edges = edges.withColumn("_offset", F.coalesce(F.sum("_size").over(others["before"]), F.lit(0)))

    def global_position(t: str, c: Column) -> Column:
        return c + F.col("_offset") if t.startswith("_p") else c

    carry = edges.withColumns({f"{t}_{side}": global_position(t, F.col(f"{t}_{side}")) for t in tracks for side, *_ in nearest})
    carry = carry.select(
        F.col("_slice").alias("_s"),
        "_offset",
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        *(
            pick(f"{t}_{side}", ignorenulls=True).over(others[side]).alias(f"{t}_{side}")
            for t in tracks
            for side, pick, _, _ in nearest
        ),
    )
    same = F.col("_slice") == F.col("_s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = sliced.withColumns(
        {f"{t}_in_{side}": F.last(t, ignorenulls=True).over(frame) for t in tracks for side, *_, frame in nearest}
    )
    joined = inside.join(carry, same)

    def found(t: str, side: str) -> Column:
        return F.coalesce(global_position(t, F.col(f"{t}_in_{side}")), F.col(f"{t}_{side}"))

    filled = {}
    for i, c in enumerate(columns):
        value, place = f"_v{i}", f"_p{i}"
        if how == "interpolate":
            low, high = found(value, "before"), found(value, "after")
            at = F.col("_at") + F.col("_offset")
            gap = (found(place, "after") - found(place, "before")).cast("double")
            share = (at - found(place, "before")).cast("double") / gap
            between = F.when(high.isNull(), low).when(low.isNotNull(), low + (high - low) * share)
            filled[c] = F.coalesce(F.col(value), between)
        else:
            filled[c] = found(value, nearest[0][0])
    return joined.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in df.columns))
