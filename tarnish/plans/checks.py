"""All checks of a dirty/recovered pair, for every dataset of a batch at once.

``check_datasets`` gives the findings that ``validate_pair`` and
``validate_solvability`` give for each dataset by itself, as a table (dataset,
check, column, level, n). The checks are compiled to one grouped aggregation of
each table, one of the recovered rows against their dataset's ranges, one grouping
of text values, one of row hashes and one of quartiles; results have one row for
each dataset and are joined as tables. So there may be any number of datasets,
and one may hold most of the rows.

Types belong to the table, so a column that has changed its type has done so in
every dataset. Datasets without a name (null) are left out. An empty batch gives
no findings.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.convert import as_number, looks_numeric, parse_timestamp
from tarnish.functions.families import NUMERIC, TEXT, columns_in, data_columns, numeric_columns, text_columns, type_of
from tarnish.functions.quantiles import group_quantiles
from tarnish.functions.text import strip
from tarnish.operators.compare import as_text
from tarnish.operators.stats import duplicate_count
from tarnish.operators.validate import (
    ERROR,
    MAX_THRESHOLD,
    MIN_VALUES,
    NOTE,
    PARSE_SHARE,
    RANGE_TOLERANCE,
    ROW_REDUCING,
    VOCABULARY,
    WARNING,
    operation_names,
)

FINDING = "struct<check: string, column: string, level: string, n: bigint>"
Operations = Iterable[Mapping[str, Any] | str]


def _operations_table(dirty: DataFrame, operations: Mapping[Any, Operations], by: str) -> DataFrame:
    """(by, ops, method, threshold): what is planned for each dataset."""
    rows = []
    for dataset, planned in operations.items():
        planned = list(planned)
        outliers = next((o for o in planned if operation_names([o]) == ["remove_outliers"]), None)
        told = outliers if isinstance(outliers, Mapping) else {}
        rows.append((dataset, operation_names(planned), told.get("method", "iqr"), float(told.get("threshold", 1.5))))
    kind = type_of(dirty, by).simpleString()
    return dirty.sparkSession.createDataFrame(rows, f"{by} {kind}, ops array<string>, method string, threshold double")


def _dirty_measures(dirty: DataFrame, numbers: Sequence[str], by: str) -> DataFrame:
    aggregates = [F.count("*").alias("rows")]
    for i, c in enumerate(data_columns(dirty, [by])):
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"missing{i}"))
        if c in numbers:
            x = as_number(F.col(c), type_of(dirty, c))
            aggregates += [F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}")]
        if c in text_columns(dirty, [by]):
            s = F.col(c)
            aggregates += [
                F.count_if(s != strip(s)).alias(f"untrimmed{i}"),
                F.count_if(s.isNotNull() & (F.btrim(s) != "")).alias(f"filled{i}"),
                F.count_if(looks_numeric(s)).alias(f"numeric{i}"),
                F.count_if(parse_timestamp(s).isNotNull()).alias(f"datetime{i}"),
            ]
    return dirty.groupBy(by).agg(*aggregates)


def _recovered_measures(recovered: DataFrame, measures: DataFrame, ranged: Mapping[str, int], by: str) -> DataFrame:
    """Rows and missing cells, and the numbers outside their dataset's range."""
    limits, aggregates = [], [F.count("*").alias("left_rows")]
    for c, i in ranged.items():
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        limits += [F.when(low < 0, low * RANGE_TOLERANCE).otherwise(low / RANGE_TOLERANCE).alias(f"least{i}"), (high * RANGE_TOLERANCE).alias(f"most{i}")]
        aggregates.append(F.count_if((F.col(c) < F.col(f"least{i}")) | (F.col(c) > F.col(f"most{i}"))).alias(f"outside{i}"))
    for j, c in enumerate(data_columns(recovered, [by])):
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"left_missing{j}"))
    named = measures.select(F.col(by).alias("_dataset"), *limits)
    return recovered.join(named, F.col(by) == F.col("_dataset")).groupBy(by).agg(*aggregates)


def _new_text_counts(dirty: DataFrame, recovered: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, fresh): for each column's number, how many texts of the recovered table the dirty one does not hold."""

    def cells(df: DataFrame, seen: bool) -> DataFrame:
        entries = F.array(*(F.struct(F.lit(i).alias("i"), as_text(df, c).alias("value")) for i, c in enumerate(columns)))
        return df.select(by, F.explode(entries).alias("_e")).select(by, "_e.*").where("value is not null").withColumn("_seen", F.lit(seen))

    both = cells(dirty, True).unionByName(cells(recovered, False))
    found = both.groupBy(by, "i", "value").agg(F.max("_seen").alias("_seen")).where(~F.col("_seen")).groupBy(by, "i").agg(F.count("*").alias("n"))
    return found.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("fresh"))


def check_datasets(dirty: DataFrame, recovered: DataFrame, operations: Mapping[Any, Operations] | Sequence, by: str = "dataset_id") -> DataFrame:
    """(by, check, column, level, n) of every finding; ``operations`` are those of all datasets, or of each by its name."""
    before, after = data_columns(dirty, [by]), data_columns(recovered, [by])
    place = {c: i for i, c in enumerate(before)}
    left = {c: j for j, c in enumerate(after)}
    numbers = [c for c in numeric_columns(recovered, [by]) if c in before]
    own_numbers = numeric_columns(dirty, [by])
    texts = [c for c in columns_in(recovered, TEXT, [by]) if c in before]
    ranged = {c: place[c] for c in columns_in(recovered, NUMERIC, [by]) if c in before}

    measures = _dirty_measures(dirty, [*dict.fromkeys([*own_numbers, *numbers])], by)
    wide = measures.join(_recovered_measures(recovered, measures, ranged, by), by, "left")
    wide = wide.join(duplicate_count(dirty, before, [by]).select(by, "duplicates"), by, "left")
    if texts:
        wide = wide.join(_new_text_counts(dirty, recovered, texts, by), by, "left")
    if own_numbers:
        values = {f"_q{place[c]}": F.col(c).cast("double") for c in own_numbers}
        wide = wide.join(group_quantiles(dirty, values, [0.25, 0.75], [by]), by, "left")
    if isinstance(operations, Mapping):
        wide = wide.join(_operations_table(dirty, operations, by), by)
    else:
        ((_, ops, method, threshold),) = _operations_table(dirty, {None: operations}, by).collect()
        wide = wide.withColumns({"ops": F.array(*map(F.lit, ops)).cast("array<string>"), "method": F.lit(method), "threshold": F.lit(threshold)})

    def planned(*names: str) -> Column:
        return F.arrays_overlap("ops", F.array(*map(F.lit, names)))

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    found: list[Column] = []

    def add(check: str, column: str | None, level: str | Column, n: Column | None, when: Column) -> None:
        level = F.lit(level) if isinstance(level, str) else level
        told = F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), level.alias("level"), (F.lit(None) if n is None else n).cast("bigint").alias("n"))
        found.append(F.when(when, told.cast(FINDING)))

    always, one = F.lit(True), F.lit(1)
    for c in sorted(set(before) ^ set(after)):
        add("columns", c, ERROR, one, always)
    removed = F.col("rows") - zero("left_rows")
    add("row_count", None, ERROR, -removed, removed < 0)
    add("row_count", None, F.when(planned(*ROW_REDUCING), NOTE).otherwise(WARNING), removed, removed > 0)
    for c in before:
        if c in left and type_of(dirty, c).simpleString() != type_of(recovered, c).simpleString():
            add("type_change", c, WARNING, one, ~planned("convert_data_types"))
    for c, i in ranged.items():
        n = zero(f"outside{i}")
        add("value_range", c, WARNING, n, (n > 0) & F.col(f"low{i}").isNotNull() & (zero(f"left_missing{left[c]}") < zero("left_rows")))
    for i, c in enumerate(texts):
        n = F.coalesce(F.col("fresh")[i], F.lit(0))
        add("new_values", c, F.when(planned("handle_missing_values", "clean_text_columns"), WARNING).otherwise(ERROR), n, n > 0)
    for c, i in place.items():
        if c in left:
            add("null_repair", c, WARNING, F.col(f"missing{i}"), (F.col(f"missing{i}") > 0) & (zero(f"left_missing{left[c]}") == 0))

    missing = sum((F.col(f"missing{i}") for i in place.values()), F.lit(0))
    add("missing_values", None, F.when(planned("handle_missing_values"), NOTE).otherwise(ERROR), missing, missing > 0)
    for c in text_columns(dirty, [by]):
        i = place[c]
        untrimmed, filled = F.col(f"untrimmed{i}"), F.col(f"filled{i}")
        number, stamp = F.col(f"numeric{i}") / filled, F.col(f"datetime{i}") / filled
        converted = planned("convert_data_types") & (filled > 0)
        add("text_issues", c, WARNING, untrimmed, (untrimmed > 0) & ~planned("clean_text_columns"))
        add("type_conversion", c, WARNING, F.col(f"numeric{i}"), converted & (number < PARSE_SHARE))
        add("type_conversion", c, WARNING, F.col(f"datetime{i}"), converted & (stamp > PARSE_SHARE) & (stamp < 1.0))
    bounded = planned("remove_outliers")
    add("outliers", None, WARNING, None, bounded & (F.col("threshold") > MAX_THRESHOLD))
    for c in own_numbers:
        i = place[c]
        q25, q75 = F.col(f"_q{i}")[0], F.col(f"_q{i}")[1]
        add("outliers", c, WARNING, None, bounded & (F.col("method") == "iqr") & (q25 == q75) & (F.col("rows") - F.col(f"missing{i}") >= MIN_VALUES))
    add("duplicates", None, F.when(planned("remove_duplicates"), NOTE).otherwise(WARNING), F.col("duplicates"), F.col("duplicates") > 0)

    unknown = F.transform(
        F.filter("ops", lambda o: ~o.isin(*VOCABULARY)),
        lambda o: F.struct(F.lit("operations"), F.lit(None).cast("string"), F.lit(ERROR), F.lit(1).cast("bigint")).cast(FINDING),
    )
    findings = F.concat(F.array_compact(F.array(*found)), unknown)
    return wide.select(by, F.explode(findings).alias("_f")).select(by, "_f.*")
