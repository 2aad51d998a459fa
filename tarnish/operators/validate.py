"""Checks of a dirty/recovered pair.

A check yields findings: (check, column, level, n, detail), with level
``error``, ``warning`` or ``note``. The measures behind them come from the
gathered ``TableFacts`` and from a few aggregations over whole columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import astuple, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnish.functions.families import NUMERIC, TEXT, columns_in, data_columns, numeric_columns
from tarnish.functions.storage import small_table
from tarnish.operators.compare import new_values
from tarnish.operators.stats import TableFacts, table_facts
from tarnish.operators.types import parse_rates

# The operations a cleaner may use, and those that may drop rows.
VOCABULARY = (
    "handle_missing_values",
    "remove_duplicates",
    "remove_outliers",
    "clean_text_columns",
    "convert_data_types",
    "inspect_data",
)
ROW_REDUCING = ("remove_duplicates", "remove_outliers")
# How far recovered numbers may leave the dirty range, the share
# of readable values below which a conversion is doubtful, the largest usual
# outlier threshold, the rows a spread needs, the examples shown.
RANGE_TOLERANCE = 1.5
PARSE_SHARE = 0.5
MAX_THRESHOLD = 3.0
MIN_VALUES = 4
EXAMPLES = 5

ERROR, WARNING, NOTE = "error", "warning", "note"


@dataclass(frozen=True)
class Finding:
    check: str
    column: str | None
    level: str
    n: int | None
    detail: str


@dataclass
class Validation:
    findings: list[Finding] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors

    @property
    def errors(self) -> list[str]:
        return [f.detail for f in self.findings if f.level == ERROR]

    @property
    def warnings(self) -> list[str]:
        return [f.detail for f in self.findings if f.level != ERROR]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        ddl = "check string, column string, level string, n bigint, detail string"
        return small_table(spark, [astuple(f) for f in self.findings], ddl)


def operation_names(operations: Iterable[Mapping[str, Any] | str]) -> list[str]:
    return [o if isinstance(o, str) else o["operation"] for o in operations]


def expected_range(low: float, high: float) -> tuple[float, float]:
    """The range recovered numbers should stay in, from the dirty minimum and maximum."""
    return (low * RANGE_TOLERANCE if low < 0 else low / RANGE_TOLERANCE), high * RANGE_TOLERANCE


def out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(column, low, high, n): values outside their range; all columns in one pass."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
            F.col(f"n{i}").alias("n"),
        )
        for i, (c, (low, high)) in enumerate(ranges.items())
    ]
    counts = df.agg(
        *(
            F.count_if((F.col(c) < F.lit(float(low))) | (F.col(c) > F.lit(float(high)))).alias(f"n{i}")
            for i, (c, (low, high)) in enumerate(ranges.items())
        )
    )
    return counts.select(F.inline(F.array(*entries)))


def _check_columns(dirty: TableFacts, recovered: TableFacts) -> Iterable[Finding]:
    for c in sorted(set(dirty.columns) - set(recovered.columns)):
        yield Finding("columns", c, ERROR, 1, f"column {c!r} is missing in the recovered table")
    for c in sorted(set(recovered.columns) - set(dirty.columns)):
        yield Finding("columns", c, ERROR, 1, f"column {c!r} is new in the recovered table")


def _check_rows(dirty: TableFacts, recovered: TableFacts, names: Sequence[str]) -> Iterable[Finding]:
    removed = dirty.rows - recovered.rows
    if removed < 0:
        detail = f"the recovered table has more rows than the dirty one ({recovered.rows} > {dirty.rows})"
        yield Finding("row_count", None, ERROR, -removed, detail)
    elif removed > 0:
        reducing = [o for o in ROW_REDUCING if o in names]
        if reducing:
            yield Finding("row_count", None, NOTE, removed, f"{removed} rows removed by {', '.join(reducing)}")
        else:
            detail = f"{removed} rows are gone, but no operation removes rows"
            yield Finding("row_count", None, WARNING, removed, detail)


def _check_types(dirty: TableFacts, recovered: TableFacts, names: Sequence[str]) -> Iterable[Finding]:
    if "convert_data_types" in names:
        return
    for c in dirty.columns:
        before, after = dirty.types[c], recovered.types.get(c)
        if after is not None and before != after:
            yield Finding("type_change", c, WARNING, 1, f"column {c!r} went from {before} to {after} unplanned")


def _check_ranges(recovered_table: DataFrame, dirty: TableFacts, recovered: TableFacts) -> Iterable[Finding]:
    ranges = {}
    for c in recovered.in_family(NUMERIC):
        measured = dirty.profile.get(c)
        if measured and measured["min"] is not None and recovered.profile[c]["missing"] < recovered.rows:
            ranges[c] = expected_range(measured["min"], measured["max"])
    if not ranges:
        return
    for row in out_of_range(recovered_table, ranges).collect():
        if row["n"]:
            detail = f"column {row['column']!r}: {row['n']} values outside [{row['low']:.2f}, {row['high']:.2f}]"
            yield Finding("value_range", row["column"], WARNING, row["n"], detail)


def _check_new_values(
    dirty: DataFrame, recovered: DataFrame, names: Sequence[str], columns: Sequence[str]
) -> Iterable[Finding]:
    if not columns:
        return
    fresh = new_values(dirty, recovered, columns)
    counts = {r["column"]: r["n"] for r in fresh.groupBy("column").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return
    # A rank filter this small is cut per task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    examples: dict[str, list[str]] = {}
    for r in fresh.withColumn("_rank", rank).filter(F.col("_rank") <= EXAMPLES).collect():
        examples.setdefault(r["column"], []).append(r["value"])
    if "handle_missing_values" in names:
        level, why = WARNING, "likely imputed"
    elif "clean_text_columns" in names:
        level, why = WARNING, "expected from text cleaning"
    else:
        level, why = ERROR, "no operation explains them"
    for c in columns:
        if c in counts:
            detail = f"column {c!r}: {counts[c]} new values ({why}), such as {sorted(examples[c])}"
            yield Finding("new_values", c, level, counts[c], detail)


def _check_nulls(dirty: TableFacts, recovered: TableFacts) -> Iterable[Finding]:
    for c, n in dirty.missing_by_column().items():
        if c in recovered.profile and recovered.profile[c]["missing"] == 0:
            yield Finding("null_repair", c, WARNING, n, f"column {c!r}: all {n} missing values were filled")


def pair_facts(dirty: DataFrame, recovered: DataFrame, unique: str = "exact") -> tuple[TableFacts, TableFacts]:
    """Facts of both tables, with number statistics for columns that are numeric after recovery.

    Exact distinct counts shuffle every value of every column; for wide tables
    or long texts ``unique="approximate"`` counts with sketches instead.
    """
    numbers = numeric_columns(recovered)
    texts = [c for c in columns_in(dirty, TEXT) if c not in numbers]
    either = list(dict.fromkeys([*numeric_columns(dirty), *numbers]))
    before = table_facts(dirty, either, columns_in(dirty, TEXT), unique)
    return before, table_facts(recovered, numbers, texts, unique)


def validate_pair(
    dirty: DataFrame,
    recovered: DataFrame,
    operations: Iterable[Mapping[str, Any] | str],
    facts: tuple[TableFacts, TableFacts] | None = None,
) -> Validation:
    """Can the recovered table come from the dirty one by these operations?"""
    names = operation_names(operations)
    before, after = facts or pair_facts(dirty, recovered)
    shared_texts = [c for c in columns_in(recovered, TEXT) if c in data_columns(dirty)]
    return Validation(
        [
            *_check_columns(before, after),
            *_check_rows(before, after, names),
            *_check_types(before, after, names),
            *_check_ranges(recovered, before, after),
            *_check_new_values(dirty, recovered, names, shared_texts),
            *_check_nulls(before, after),
        ]
    )


def _solvable_missing(facts: TableFacts, names: Sequence[str]) -> Iterable[Finding]:
    if not facts.missing:
        return
    if "handle_missing_values" in names:
        detail = f"{facts.missing} missing values will be imputed"
        yield Finding("missing_values", None, NOTE, facts.missing, detail)
    else:
        detail = f"{facts.missing} missing values, but no imputation is planned"
        yield Finding("missing_values", None, ERROR, facts.missing, detail)


def _solvable_text(facts: TableFacts, names: Sequence[str]) -> Iterable[Finding]:
    if "clean_text_columns" in names:
        return
    for c in facts.in_family(TEXT):
        n = facts.profile[c]["whitespace_issues"]
        if n:
            detail = f"column {c!r}: {n} values with outer white space, but no text cleaning is planned"
            yield Finding("text_issues", c, WARNING, n, detail)


def _solvable_types(dirty: DataFrame, names: Sequence[str]) -> Iterable[Finding]:
    if "convert_data_types" not in names:
        return
    for row in parse_rates(dirty).collect():
        if not row["filled"]:
            continue
        c, number, stamp = row["column"], row["numeric"] / row["filled"], row["datetime"] / row["filled"]
        if number < PARSE_SHARE:
            detail = f"column {c!r}: only {number:.1%} of the values read as numbers"
            yield Finding("type_conversion", c, WARNING, row["numeric"], detail)
        if PARSE_SHARE < stamp < 1.0:
            detail = f"column {c!r}: {stamp:.1%} of the values read as datetimes, the rest would be lost"
            yield Finding("type_conversion", c, WARNING, row["datetime"], detail)


def _solvable_outliers(facts: TableFacts, operations: Sequence[Mapping[str, Any] | str]) -> Iterable[Finding]:
    planned = [o for o in operations if operation_names([o]) == ["remove_outliers"]]
    if not planned:
        return
    settings = planned[0] if isinstance(planned[0], Mapping) else {}
    method, threshold = settings.get("method", "iqr"), settings.get("threshold", 1.5)
    if threshold > MAX_THRESHOLD:
        detail = f"the {method} threshold {threshold} is very high (usual: up to {MAX_THRESHOLD})"
        yield Finding("outliers", None, WARNING, None, detail)
    if method != "iqr":
        return
    for c in facts.in_family(NUMERIC):
        q25, _, q75 = facts.quartiles.get(c, [None] * 3)
        if q25 is not None and q25 == q75 and facts.rows - facts.profile[c]["missing"] >= MIN_VALUES:
            detail = f"column {c!r}: the interquartile range is 0, outliers cannot be told"
            yield Finding("outliers", c, WARNING, None, detail)


def _solvable_duplicates(facts: TableFacts, names: Sequence[str]) -> Iterable[Finding]:
    if not facts.duplicates:
        return
    if "remove_duplicates" in names:
        yield Finding("duplicates", None, NOTE, facts.duplicates, f"{facts.duplicates} exact copies will be removed")
    else:
        detail = f"{facts.duplicates} exact copies, but no removal is planned"
        yield Finding("duplicates", None, WARNING, facts.duplicates, detail)


def validate_solvability(
    dirty: DataFrame,
    operations: Iterable[Mapping[str, Any] | str],
    facts: TableFacts | None = None,
) -> Validation:
    """Can the planned operations repair what is wrong with the dirty table?"""
    operations = list(operations)
    names = operation_names(operations)
    facts = facts or table_facts(dirty)
    unknown = [
        Finding("operations", None, ERROR, 1, f"operation {o!r} is not in the vocabulary")
        for o in names
        if o not in VOCABULARY
    ]
    return Validation(
        [
            *unknown,
            *_solvable_missing(facts, names),
            *_solvable_text(facts, names),
            *_solvable_types(dirty, names),
            *_solvable_outliers(facts, operations),
            *_solvable_duplicates(facts, names),
        ]
    )
