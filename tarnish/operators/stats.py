"""Table statistics: counts, profiles, frequencies, duplicates.

Every function is one or a few aggregations that combine before the shuffle;
results have one row per column (or per value for frequencies).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.convert import as_number
from tarnish.functions.families import (
    DATETIME,
    NUMERIC,
    TEXT,
    data_columns,
    family_of,
    numeric_columns,
    text_columns,
    type_of,
)
from tarnish.functions.quantiles import exact_quantiles
from tarnish.functions.text import strip


def _long(df: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]], by: Sequence[str] = ()) -> DataFrame:
    """One output row per entry of ``rows``, each a list of (name, expression), from a wide row."""
    entries = F.array(*(F.struct(*(e.alias(n) for n, e in row)) for row in rows))
    return df.select(*by, F.explode(entries).alias("_entry")).select(*by, "_entry.*")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * F.lit(100.0), 2))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(column, rows, missing, missing_pct), per group when ``by`` is given."""
    columns = list(columns or data_columns(df, by))
    wide = (df.groupBy(*by) if by else df).agg(
        F.count("*").alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns))
    )
    rows = [
        [
            ("column", F.lit(c)),
            ("rows", F.col("_rows")),
            ("missing", F.col(f"_m{i}")),
            ("missing_pct", _percent(F.col(f"_m{i}"), F.col("_rows"))),
        ]
        for i, c in enumerate(columns)
    ]
    return _long(wide, rows, by)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column, distinct); NULL is no value. ``approximate`` uses sketches and shuffles no values."""
    columns = list(columns or data_columns(df))
    if approximate:
        wide = df.agg(*(F.approx_count_distinct(F.col(c)).alias(f"_u{i}") for i, c in enumerate(columns)))
        return _long(wide, [[("column", F.lit(c)), ("distinct", F.col(f"_u{i}"))] for i, c in enumerate(columns)])
    # One row for each cell, of two hashes whatever its type and length, combined before the shuffle.
    cells = F.array(*(F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), *row_hashes([c]))) for i, c in enumerate(columns)))
    found = df.select(F.explode(cells).alias("_c")).where("_c is not null").select("_c.*").distinct()
    counts = found.groupBy("i").agg(F.count("*").alias("n"))
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column")) for i, c in enumerate(columns)))
    every = df.sparkSession.range(1).select(F.explode(names).alias("_n")).select("_n.*")
    return every.join(counts, "i", "left").select("column", F.coalesce("n", F.lit(0)).alias("distinct"))


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of some columns, with which of them are NULL; equal rows have equal ones.

    Both agree by chance for one in 10^15 tables of 10^12 rows.
    """
    nulls = F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in columns))
    return F.xxhash64(nulls, *columns).alias("_h1"), F.xxhash64(*columns, nulls, F.lit(1)).alias("_h2")


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(rows, distinct_rows, duplicates): rows that repeat an earlier one; NULLs are equal."""
    keys = [k for k in columns or data_columns(df, by) if k not in by]
    # Rows are told apart by two hashes, so whole texts aren't shuffled.
    hashed = df.select(*by, *row_hashes(keys)) if keys else df.select(*by, F.lit(0).alias("_h1"), F.lit(0).alias("_h2"))
    groups = hashed.groupBy(*by, "_h1", "_h2").agg(F.count("*").alias("_n"))
    counts = (groups.groupBy(*by) if by else groups).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows")
    )
    return counts.withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def value_counts(df: DataFrame, column: str, top: int | None = 10) -> DataFrame:
    """(value, count), most frequent first, ties by value; NULL is no value."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
    )
    return counts if top is None else counts.orderBy(F.desc("count"), F.asc("value")).limit(top)


def type_counts(df: DataFrame) -> dict[str, int]:
    """Number of columns per type."""
    out: dict[str, int] = {}
    for c in data_columns(df):
        name = type_of(df, c).simpleString()
        out[name] = out.get(name, 0) + 1
    return out


def mode_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(column, value, count): the most frequent value, the smallest of equals; columns of one type.

    Counted by (column, value) first, so a frequent value is combined before
    the shuffle and no task holds a column's whole value set.
    """
    cells = df.select(*by, *columns).unpivot(list(by), list(columns), "column", "value")
    counts = (
        cells.filter(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count("*").alias("count"))
    )
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col("value").alias("v")))
    return counts.groupBy(*by, "column").agg(best.alias("_best")).select(
        *by, "column", F.col("_best.v").alias("value"), (-F.col("_best.n")).alias("count")
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, stat, value) for count, mean, std, min, 25%, 50%, 75%, max of numeric columns."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])[()]
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).cast("double").alias(f"count{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
        cells = {s: F.col(f"{s}{i}") for s in ("count", "mean", "std", "min", "max")}
        cells |= {s: F.lit(q).cast("double") for s, q in zip(("25%", "50%", "75%"), quartiles[c], strict=True)}
        rows += [[("column", F.lit(c)), ("stat", F.lit(s)), ("value", v)] for s, v in cells.items()]
    return _long(df.agg(*aggregates), rows)


_PROFILE = (
    ("missing", "bigint"),
    ("unique", "bigint"),
    ("mean", "double"),
    ("std", "double"),
    ("min", "double"),
    ("max", "double"),
    ("avg_length", "double"),
    ("min_length", "int"),
    ("max_length", "int"),
    ("whitespace_issues", "bigint"),
    ("case_variations", "bigint"),
    ("bytes", "bigint"),
)
_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "boolean": 1}


def _profile_aggregates(df: DataFrame, column: str, as_numeric: bool, as_text: bool, unique: str) -> dict[str, Column]:
    c, data_type = F.col(column), type_of(df, column)
    out = {"missing": F.count_if(c.isNull())}
    if unique == "approximate":
        out["unique"] = F.approx_count_distinct(c)
    if as_numeric:
        x = as_number(c, data_type)
        out |= {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
    if isinstance(data_type, T.StringType):
        out["bytes"] = F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    else:
        out["bytes"] = F.count(c) * F.lit(_WIDTH.get(data_type.simpleString(), 8))
    if as_text:
        s = c.cast("string")
        length = F.char_length(s)
        out |= {
            "avg_length": F.avg(length),
            "min_length": F.min(length),
            "max_length": F.max(length),
            "whitespace_issues": F.count_if(s != strip(s)),
            "case_variations": F.count_if(s != F.lower(s)),
        }
    return out


def column_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
    text: Sequence[str] | None = None,
    unique: str = "exact",
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """One row per column: missing and distinct values, numeric and text measures.

    ``numeric`` columns get number statistics even when they hold text (values
    that are no numbers are left out); ``text`` columns get length statistics.
    ``unique`` is ``exact``, ``approximate`` or ``none``. Medians come from an
    exact quantile search unless given.
    """
    columns = list(columns or data_columns(df))
    numeric = [c for c in (numeric_columns(df) if numeric is None else numeric) if c in columns]
    text = [c for c in (text_columns(df) if text is None else text) if c in columns]
    if medians is None:
        values = {c: as_number(F.col(c), type_of(df, c)) for c in numeric}
        medians = {c: q[0] for c, q in exact_quantiles(df, values, [0.5])[()].items()} if values else {}
    aggregates, rows = [F.count("*").alias("_rows")], []
    # One number for each column, so that the other measures need no copy of each row for each column.
    distinct = {r["column"]: r["distinct"] for r in distinct_counts(df, columns).collect()} if unique == "exact" else {}
    for i, c in enumerate(columns):
        wanted = _profile_aggregates(df, c, c in numeric, c in text, unique)
        aggregates += [e.alias(f"{n}{i}") for n, e in wanted.items()]
        cells = {n: F.col(f"{n}{i}") if n in wanted else F.lit(None) for n, _ in _PROFILE}
        if c in distinct:
            cells["unique"] = F.lit(distinct[c])
        row = [
            ("column", F.lit(c)),
            ("type", F.lit(type_of(df, c).simpleString())),
            ("rows", F.col("_rows")),
            *((n, cells[n].cast(t)) for n, t in _PROFILE),
            ("missing_pct", _percent(cells["missing"], F.col("_rows"))),
            ("unique_pct", _percent(cells["unique"].cast("bigint"), F.col("_rows"))),
            ("median", F.lit(medians.get(c)).cast("double")),
        ]
        rows.append(row)
    return _long(df.agg(*aggregates), rows)


@dataclass
class TableFacts:
    """Everything reports and checks ask about one table, gathered once."""

    rows: int
    columns: list[str]
    types: dict[str, str]
    families: dict[str, str]
    duplicates: int
    profile: dict[str, dict] = field(default_factory=dict)
    quartiles: dict[str, list[float | None]] = field(default_factory=dict)

    @property
    def missing(self) -> int:
        return sum(p["missing"] for p in self.profile.values())

    @property
    def cells(self) -> int:
        return self.rows * len(self.columns)

    @property
    def shape(self) -> tuple[int, int]:
        return self.rows, len(self.columns)

    @property
    def bytes(self) -> int:
        return sum(p["bytes"] or 0 for p in self.profile.values())

    def missing_by_column(self) -> dict[str, int]:
        return {c: p["missing"] for c, p in self.profile.items() if p["missing"]}

    def in_family(self, family: str) -> list[str]:
        return [c for c in self.columns if self.families[c] == family]


def table_facts(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    text: Sequence[str] | None = None,
    unique: str = "exact",
) -> TableFacts:
    """Profile and duplicate count of ``df``: a quantile search and two aggregations."""
    columns = data_columns(df)
    numeric = [c for c in (numeric_columns(df) if numeric is None else numeric) if c in columns]
    values = {c: as_number(F.col(c), type_of(df, c)) for c in numeric}
    quartiles = exact_quantiles(df, values, [0.25, 0.5, 0.75])[()] if values else {}
    profile = column_profile(
        df, columns, numeric, text, unique, medians={c: q[1] for c, q in quartiles.items()}
    ).collect()
    counts = duplicate_count(df, columns).first()
    return TableFacts(
        rows=counts["rows"],
        columns=columns,
        types={c: type_of(df, c).simpleString() for c in columns},
        families={c: family_of(type_of(df, c)) for c in columns},
        duplicates=counts["duplicates"],
        profile={row["column"]: row.asDict() for row in profile},
        quartiles=quartiles,
    )


__all__ = [
    "TableFacts",
    "column_profile",
    "describe",
    "distinct_counts",
    "duplicate_count",
    "mode_values",
    "null_counts",
    "table_facts",
    "type_counts",
    "value_counts",
]
