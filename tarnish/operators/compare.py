"""Two versions of a table side by side: cell audit, similarity, new values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.convert import datetime_text, number_text
from tarnish.functions.families import COPY, DATETIME, ROW_ID, data_columns, family_of, require_columns, type_of
from tarnish.functions.text import collapse, remove_special, strip


def as_text(df: DataFrame, column: str, name: str | None = None) -> Column:
    """A cell of ``column`` (held under ``name``) as text, the same for a typed column and for its text form."""
    c, data_type = F.col(name or column), type_of(df, column)
    if isinstance(data_type, T.NumericType):
        return number_text(c, data_type)
    if family_of(data_type) == DATETIME:
        return datetime_text(c, data_type)
    return c.cast("string")


def _shared(left: DataFrame, right: DataFrame, exclude: Sequence[str]) -> list[str]:
    names = set(data_columns(right, exclude))
    return [c for c in data_columns(left, exclude) if c in names]


def _originals(df: DataFrame) -> DataFrame:
    return df.filter(F.col(COPY) == 0) if COPY in df.columns else df


def kind_of_change(before: Column, after: Column, family: str) -> Column:
    """What happened to a cell that changed, from its two texts."""
    if family != "text":
        return (
            F.when(after.isNull(), F.lit("nulled"))
            .when(before.isNull(), F.lit("filled"))
            .when(after.isin("-999", "0", "999999", "-999.0", "0.0", "999999.0"), F.lit("sentinel"))
            .otherwise(F.lit("value"))
        )
    return (
        F.when(after.isNull(), F.lit("nulled"))
        .when(before.isNull(), F.lit("filled"))
        .when(after == "", F.lit("emptied"))
        .when(collapse(strip(before)) == collapse(strip(after)), F.lit("whitespace"))
        .when(F.lower(before) == F.lower(after), F.lit("case"))
        .when(remove_special(before) == remove_special(after), F.lit("special_characters"))
        .otherwise(F.lit("value"))
    )


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    """Raise if a key is not a row's own: a join would multiply its rows."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{what}: {', '.join(key)} is no key, {tuple(repeated[0])[:-1]} occurs {repeated[0]['n']} times")


def cell_audit(before: DataFrame, after: DataFrame, key: Sequence[str] = (ROW_ID,)) -> DataFrame:
    """(key, column, before, after, kind): every cell of a row present in both that differs.

    Joined on the row key; a key that repeats in a table is an error.
    """
    key = list(key)
    require_columns(before, key)
    require_unique(before, key, "before")
    require_unique(_originals(after), key, "after")
    columns = _shared(before, after, key)
    left = before.select(*key, *(as_text(before, c).alias(f"_b{i}") for i, c in enumerate(columns)))
    right = _originals(after).select(*key, *(as_text(after, c).alias(f"_a{i}") for i, c in enumerate(columns)))
    cells = F.array(
        *(
            F.when(
                ~F.col(f"_b{i}").eqNullSafe(F.col(f"_a{i}")),
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"_b{i}").alias("before"),
                    F.col(f"_a{i}").alias("after"),
                    kind_of_change(F.col(f"_b{i}"), F.col(f"_a{i}"), family_of(type_of(before, c))).alias("kind"),
                ),
            )
            for i, c in enumerate(columns)
        )
    )
    changed = left.join(right, key).select(*key, F.explode(F.array_compact(cells)).alias("_cell"))
    return changed.select(*key, "_cell.*")


def audit_counts(audit: DataFrame) -> DataFrame:
    """(column, kind, cells) of a cell audit."""
    return audit.groupBy("column", "kind").agg(F.count("*").alias("cells"))


def similarity(perfect: DataFrame, recovered: DataFrame, key: Sequence[str] = (ROW_ID,)) -> DataFrame:
    """(perfect_rows, recovered_rows, matched_rows, columns, equal_cells, similarity_pct).

    Cells are compared row by row on the key; the percentage is of all cells of
    the perfect table, so lost rows count as different. NULL equals nothing.
    """
    key = list(key)
    require_unique(perfect, key, "perfect table")
    require_unique(_originals(recovered), key, "recovered table")
    columns = _shared(perfect, recovered, key)
    left = perfect.select(*key, *(F.col(c).alias(f"_p{i}") for i, c in enumerate(columns)))
    right = _originals(recovered).select(*key, *(F.col(c).alias(f"_r{i}") for i, c in enumerate(columns)))
    equal = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        p, r = F.col(f"_p{i}"), F.col(f"_r{i}")
        if family_of(type_of(perfect, c)) != family_of(type_of(recovered, c)):
            p, r = as_text(perfect, c, f"_p{i}"), as_text(recovered, c, f"_r{i}")
        equal = equal + F.coalesce((p == r).cast("bigint"), F.lit(0))
    matched = left.join(right, key).agg(
        F.count("*").alias("matched_rows"), F.coalesce(F.sum(equal), F.lit(0)).alias("equal_cells")
    )
    sizes = perfect.agg(F.count("*").alias("n")).first()["n"], recovered.agg(F.count("*").alias("n")).first()["n"]
    cells = sizes[0] * len(data_columns(perfect, key))
    share = F.round(F.col("equal_cells") / F.lit(float(cells)) * F.lit(100.0), 2) if cells else F.lit(None).cast("double")
    return matched.select(
        F.lit(sizes[0]).cast("bigint").alias("perfect_rows"),
        F.lit(sizes[1]).cast("bigint").alias("recovered_rows"),
        "matched_rows",
        F.lit(len(columns)).alias("columns"),
        "equal_cells",
        share.alias("similarity_pct"),
    )


def new_values(dirty: DataFrame, recovered: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): texts of the recovered table that the dirty one does not hold.

    One grouping of both tables' (column, value) cells with a flag per side,
    instead of two distinct sets and a join: equal values combine before the
    shuffle, so a frequent value costs nothing extra.
    """
    columns = list(columns)

    def cells(df: DataFrame, side: int) -> DataFrame:
        return (
            df.select(*(as_text(df, c).alias(c) for c in columns))
            .unpivot([], columns, "column", "value")
            .filter(F.col("value").isNotNull())
            .withColumn("_dirty", F.lit(side == 0))
        )

    both = cells(dirty, 0).unionByName(cells(recovered, 1))
    return both.groupBy("column", "value").agg(F.max("_dirty").alias("_seen")).filter(~F.col("_seen")).drop("_seen")

