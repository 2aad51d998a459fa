"""Validation, reports and batches of dirty/recovered pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.families import ROW_ID
from tarnish.functions.storage import keep, new_path, small_table
from tarnish.operators import inject, stats
from tarnish.operators.clean import CleanText, Impute
from tarnish.operators.compare import audit_counts, cell_audit, similarity
from tarnish.operators.validate import expected_range, out_of_range, pair_facts, validate_pair, validate_solvability
from tarnish.plans import report
from tarnish.plans.batch import batch_quality, clean_batch, corrupt_batch, damaged_types, typed_again
from tarnish.plans.checks import check_datasets
from tarnish.plans.cleaning import cleaning_plan, run_cleaning
from tarnish.plans.dataset import recovery_summary, table_counts
from tarnish.plans.injection import InjectionConfig
from tarnish.plans.injection import inject as inject_all
from tarnish.queries import sql
from tarnish.queries.errors import AUDIT as CUSTOMER_AUDIT
from tarnish.queries.registry import draws, query, table
from tarnish.queries.relational import CUSTOMER, DIRTY_CUSTOMER, dirty_customer
from tarnish.sources.files import read_metadata, write_metadata

DATA = CUSTOMER[1:]
STRATEGIES = ("missing_values", "duplicates")

# m: damaged cells, t: with copies (the dirty table), i: imputed, r: without copies (the recovered table).
_FILLS = {
    "c_nationkey": "coalesce(c_nationkey::DOUBLE, (SELECT quantile_cont(c_nationkey::DOUBLE, 0.5) FROM t))",
    "c_acctbal": "coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM t))",
} | {
    c: f"coalesce({c}, (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1))"
    for c in ("c_name", "c_mktsegment")
}
PAIR = (
    f"WITH m AS ({DIRTY_CUSTOMER}), "
    f"t AS (SELECT m.*, unnest(range(0, 1 + {sql.copies('c_custkey')}))::INTEGER AS _copy FROM m), "
    f"i AS ({sql.replaced('t', (*CUSTOMER, '_copy'), _FILLS)}), "
    f"r AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY {', '.join(DATA)} ORDER BY c_custkey, _copy) = 1) "
)


def pair(spark, d):
    """customer with missing cells and copies, and the same table recovered."""
    perfect = table(spark, d, "customer").withColumnRenamed("c_custkey", ROW_ID)
    dirty = inject_all(perfect, InjectionConfig.custom(STRATEGIES), draws(ROW_ID))
    # Fits and reports read the dirty table many times: damage it once.
    dirty = keep(dirty, "table", "dirty")
    cleaning = run_cleaning(dirty, cleaning_plan(STRATEGIES))
    return perfect, dirty, cleaning.recovered, cleaning.log


def _count_nulls(source):
    return f"(SELECT CAST(sum({' + '.join(f'({c} IS NULL)::INT' for c in DATA)}) AS BIGINT) FROM {source})"


def _count_copies(source):
    return f"(SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(DATA)}))"


_MEASURES = (
    f"q AS (SELECT (SELECT count(*) FROM t) AS dr, (SELECT count(*) FROM r) AS rr, {_count_nulls('t')} AS dm, "
    f"{_count_nulls('r')} AS rm, {_count_copies('t')} AS dd, {_count_copies('r')} AS rd) "
)
_MISSING = "((dm - rm)::DOUBLE / greatest(dm, 1))"
_COPIES = "((dd - rd)::DOUBLE / greatest(dd, 1))"
_KEPT = "(rr::DOUBLE / dr)"


def _one_row(spark, values):
    names = {int: "bigint", float: "double", str: "string", bool: "boolean"}
    return small_table(spark, [tuple(values.values())], ", ".join(f"{k} {names[type(v)]}" for k, v in values.items()))


@query(
    "quality_score",
    PAIR
    + f", {_MEASURES} SELECT round({_MISSING} * 40 + {_COPIES} * 30 + {_KEPT} * 30, 2) AS overall_quality_score, "
    f"dr AS total_rows_dirty, rr AS total_rows_recovered, round({_KEPT} * 100, 2) AS row_retention_rate, dr - rr AS rows_lost, "
    f"dm AS missing_values_dirty, rm AS missing_values_recovered, round({_MISSING} * 100, 2) AS missing_reduction_rate, "
    f"dd AS duplicates_dirty, rd AS duplicates_recovered, round({_COPIES} * 100, 2) AS duplicate_reduction_rate, "
    "2::BIGINT AS strategies_applied, 2::BIGINT AS cleaning_operations, 'custom' AS difficulty FROM q",
)
def quality_score(spark, d):
    _, dirty, recovered, log = pair(spark, d)
    metadata = {
        "applied_strategies": STRATEGIES,
        "cleaning_operations": log,
        "corruption_config": {"difficulty": "custom"},
    }
    return _one_row(spark, report.summary(*pair_facts(dirty, recovered), metadata))


@query(
    "data_loss",
    PAIR
    + f", {_MEASURES} SELECT dr - rr AS rows_lost, round((dr - rr) * 100.0::DOUBLE / dr, 2) AS row_loss_percentage, "
    f"rr AS rows_retained, round({_KEPT} * 100, 2) AS retention_rate, dd AS duplicate_rows, "
    "(dr - rr) * 100.0::DOUBLE / dr < 20 AS is_acceptable FROM q",
)
def data_loss(spark, d):
    _, dirty, recovered, log = pair(spark, d)
    found = report.data_loss(*pair_facts(dirty, recovered), {"cleaning_operations": log})
    rows = {r["reason"]: r["estimated_rows"] for r in found.pop("loss_breakdown")}
    return _one_row(spark, {**found, "duplicate_rows": rows["Duplicate removal"]})


def _metadata(log):
    return {"applied_strategies": STRATEGIES, "cleaning_operations": log, "corruption_config": {"difficulty": "custom"}}


@query(
    "corruption_analysis",
    PAIR + f", {_MEASURES} SELECT 'missing_values' AS strategy, dm AS cells FROM q UNION ALL SELECT 'duplicates', dd FROM q",
)
def corruption_analysis(spark, d):
    _, dirty, recovered, log = pair(spark, d)
    found = report.corruption_analysis(pair_facts(dirty, recovered)[0], _metadata(log))
    return small_table(spark, list(found["estimated_corruptions_by_strategy"].items()), "strategy string, cells bigint")


_CELL_KINDS = {"missing_values": ("nulled", "emptied", "sentinel"), "outliers": ("value",)}


@query(
    "corruption_analysis_audited",
    f"WITH a AS ({CUSTOMER_AUDIT}) "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS strategy, count(*) AS cells FROM a WHERE kind IN ({', '.join(repr(k) for k in kinds)})" for s, kinds in _CELL_KINDS.items()
    ),
)
def corruption_analysis_audited(spark, d):
    perfect, dirty = table(spark, d, "customer"), dirty_customer(spark, d)
    audit = [r.asDict() for r in audit_counts(cell_audit(perfect, dirty, ["c_custkey"])).collect()]
    metadata = {"injection_log": audit}
    facts = stats.table_facts(dirty, unique="none")
    return small_table(spark, [(s, report.damaged_cells(s, facts, metadata)) for s in _CELL_KINDS], "strategy string, cells bigint")


@query(
    "cleaning_analysis",
    "SELECT * FROM (VALUES ('handle_missing_values', 1::BIGINT, 'c_acctbal,c_mktsegment,c_name,c_nationkey'), "
    "('remove_duplicates', 1::BIGINT, '')) AS t(operation, steps, columns)",
)
def cleaning_analysis(spark, d):
    log = pair(spark, d)[3]
    found = report.cleaning_analysis(_metadata(log))["operations_by_type"]
    rows = [(name, entry["count"], ",".join(entry["columns_affected"])) for name, entry in found.items()]
    return small_table(spark, rows, "operation string, steps bigint, columns string")


@query(
    "metadata_document",
    PAIR
    + f", {_MEASURES} SELECT 'dirty' AS name, dr AS rows, 4::BIGINT AS columns, dm AS missing, dd AS duplicates, 'custom' AS difficulty FROM q "
    "UNION ALL SELECT 'clean', rr, 4, rm, rd, 'custom' FROM q",
)
def metadata_document(spark, d):
    """Written as JSON and read back."""
    _, dirty, recovered, log = pair(spark, d)
    facts = pair_facts(dirty, recovered)
    path = write_metadata(spark, report.metadata_document(_metadata(log), *facts), new_path(spark, "metadata"))
    document = read_metadata(spark, path)
    rows = []
    for name, side in (("dirty", "dirty"), ("clean", "recovered")):
        shape, counts = document["datasets"][name]["shape"], document["statistics"]
        missing, copies = counts["missing_values"][side]["total"], counts["duplicates"][side]
        rows.append((name, shape["rows"], shape["columns"], missing, copies, document["corruption_details"]["difficulty_level"]))
    return small_table(spark, rows, "name string, rows bigint, columns bigint, missing bigint, duplicates bigint, difficulty string")


@query(
    "recommendations",
    PAIR
    + f", {_MEASURES}, a AS ("
    "SELECT 'warning' AS severity, 'data_loss' AS category FROM q WHERE (dr - rr) * 100.0 / dr > 20 UNION ALL "
    "SELECT 'info', 'data_loss' FROM q WHERE (dr - rr) * 100.0 / dr > 10 AND (dr - rr) * 100.0 / dr <= 20 UNION ALL "
    f"SELECT 'warning', 'missing_values' FROM q WHERE rm * 100.0 / (rr * {len(DATA)}) > 10 UNION ALL "
    "SELECT 'info', 'duplicates' FROM q WHERE rd > 0 UNION ALL "
    "SELECT 'info', 'data_types' FROM q UNION ALL SELECT 'info', 'data_types' FROM q) "
    "SELECT severity, category, count(*) AS n FROM a GROUP BY ALL",
)
def recommendations(spark, d):
    _, dirty, recovered, _ = pair(spark, d)
    advice = report.recommendations(*pair_facts(dirty, recovered))
    rows = small_table(spark, [(a["severity"], a["category"]) for a in advice], "severity string, category string")
    return rows.groupBy("severity", "category").agg(F.count("*").alias("n"))


def _quality_sql(c):
    parts = [f"SELECT '{c}' AS \"column\""]
    for side, s in (("dirty", "t"), ("recovered", "r")):
        parts += [
            f"(SELECT count(*) FILTER ({c} IS NULL) FROM {s}) AS {side}_missing",
            f"(SELECT count(DISTINCT {c}) FROM {s}) AS {side}_unique",
        ]
        if c in ("c_nationkey", "c_acctbal"):
            parts += [
                f"(SELECT round(avg({c}), 2) FROM {s}) AS {side}_mean",
                f"(SELECT round(quantile_cont({c}::DOUBLE, 0.5), 2) FROM {s}) AS {side}_median",
                f"(SELECT round(stddev_samp({c}), 2) FROM {s}) AS {side}_std",
                f"(SELECT max({c})::DOUBLE FROM {s}) AS {side}_max",
                f"NULL::DOUBLE AS {side}_avg_length",
                f"NULL::BIGINT AS {side}_case_variations",
            ]
        else:
            parts += [f"NULL::DOUBLE AS {side}_{n}" for n in ("mean", "median", "std", "max")]
            parts += [
                f"(SELECT round(avg(length({c})), 2) FROM {s}) AS {side}_avg_length",
                f"(SELECT count(*) FILTER ({c} <> lower({c})) FROM {s}) AS {side}_case_variations",
            ]
    parts.append(
        f"round(((SELECT count(*) FILTER ({c} IS NULL) FROM t) - (SELECT count(*) FILTER ({c} IS NULL) FROM r))::DOUBLE "
        f"/ greatest((SELECT count(*) FILTER ({c} IS NULL) FROM t), 1) * 100, 2) AS improvement_score"
    )
    return ", ".join(parts)


@query("column_quality", PAIR + " UNION ALL ".join(_quality_sql(c) for c in DATA))
def column_quality(spark, d):
    _, dirty, recovered, _ = pair(spark, d)
    measures = {
        "missing": "bigint",
        "unique": "bigint",
        "mean": "double",
        "median": "double",
        "std": "double",
        "max": "double",
        "avg_length": "double",
        "case_variations": "bigint",
    }
    rows = []
    for c, entry in report.column_quality(*pair_facts(dirty, recovered)).items():
        row = [c]
        for side in ("dirty", "recovered"):
            found = {**entry[side], **entry.get("numeric_stats", entry.get("text_stats"))[side]}
            row += [found.get(m) for m in measures]
        rows.append((*row, float(entry["improvement_score"])))
    ddl = ", ".join(f"{side}_{m} {t}" for side in ("dirty", "recovered") for m, t in measures.items())
    return small_table(spark, rows, f"column string, {ddl}, improvement_score double")


_BYTES = {"c_name": "strlen(c_name)", "c_mktsegment": "strlen(c_mktsegment)", "c_acctbal": "8", "c_nationkey": "{n}"}


def _bytes_sql(source, width):
    total = " + ".join(
        f"coalesce(sum(CASE WHEN {c} IS NOT NULL THEN {e.format(n='1')} END), 0)" + (f" * {width}" if '{n}' in e else "") for c, e in _BYTES.items()
    )
    return f"(SELECT CAST({total} AS BIGINT) FROM {source})"


@query(
    "metadata_statistics",
    PAIR
    + " UNION ALL ".join(
        f"SELECT '{side}' AS side, (SELECT count(*) FROM {s}) AS rows, {_count_nulls(s)} AS missing, "
        f"round({_count_nulls(s)} * 100.0::DOUBLE / ((SELECT count(*) FROM {s}) * {len(DATA)}), 2) AS missing_pct, "
        f"{_count_copies(s)} AS duplicates, {_bytes_sql(s, width)} AS bytes"
        for side, s, width in (
            ("dirty", "t", "4"),
            # A fraction in the fill value makes the column a double.
            ("recovered", "r", "(SELECT CASE WHEN median(c_nationkey) % 1 <> 0 THEN 8 ELSE 4 END FROM t)"),
        )
    ),
)
def metadata_statistics(spark, d):
    _, dirty, recovered, _ = pair(spark, d)
    facts = dict(zip(("dirty", "recovered"), pair_facts(dirty, recovered), strict=True))
    found = report.statistics(facts["dirty"], facts["recovered"], {})
    rows = [
        (
            side,
            found["row_counts"][side],
            found["missing_values"][side]["total"],
            float(found["missing_values"][side]["percentage"]),
            found["duplicates"][side],
            facts[side].bytes,
        )
        for side in facts
    ]
    ddl = "side string, rows bigint, missing bigint, missing_pct double, duplicates bigint, bytes bigint"
    return small_table(spark, rows, ddl)


@query(
    "recovery_summary",
    PAIR.replace("WITH m", "WITH p AS (SELECT * FROM customer), m")
    + ", ".join(
        ["SELECT (SELECT count(*) FROM p) AS perfect_rows", "(SELECT count(*) FROM t) AS dirty_rows"]
        + ["(SELECT count(*) FROM r) AS recovered_rows", "(SELECT count(*) FROM t) - (SELECT count(*) FROM r) AS rows_lost_in_recovery"]
        + [f"{_count_nulls(s)} AS {n}_missing" for n, s in (("perfect", "p"), ("dirty", "t"), ("recovered", "r"))]
        + [f"{_count_copies(s)} AS {n}_duplicates" for n, s in (("perfect", "p"), ("dirty", "t"), ("recovered", "r"))]
    ),
)
def recovery_summary_query(spark, d):
    perfect, dirty, recovered, _ = pair(spark, d)
    return _one_row(spark, recovery_summary(*map(table_counts, (perfect, dirty, recovered))))


@query(
    "perfect_similarity",
    PAIR
    + "SELECT (SELECT count(*) FROM customer) AS perfect_rows, (SELECT count(*) FROM r) AS recovered_rows, "
    "count(*) AS matched_rows, 4::INTEGER AS columns, CAST(sum(e) AS BIGINT) AS equal_cells, "
    "round(sum(e) * 100.0::DOUBLE / ((SELECT count(*) FROM customer) * 4), 2) AS similarity_pct FROM (SELECT "
    + " + ".join(f"coalesce((x.{c} = r.{c})::INT, 0)" for c in DATA)
    + " AS e FROM customer x JOIN r USING (c_custkey) WHERE _copy = 0)",
)
def perfect_similarity(spark, d):
    perfect, _, recovered, _ = pair(spark, d)
    return similarity(perfect, recovered)


def _cleaned(spark, d):
    """Dirty and imputed customer, without copies, and the operations."""
    dirty = dirty_customer(spark, d)
    trimmed = CleanText().fit(dirty).transform(dirty)
    return dirty, Impute(exclude=["c_custkey"]).fit(trimmed).transform(trimmed)


_CLEANED = (
    f"WITH d AS ({DIRTY_CUSTOMER}), t AS (SELECT c_custkey, lower({sql.strip('c_name')}) AS c_name, c_nationkey, c_acctbal, "
    f"lower({sql.strip('c_mktsegment')}) AS c_mktsegment FROM d), r AS ({sql.replaced('t', CUSTOMER, _FILLS)}) "
)


def _range_sql(c):
    low = f"(SELECT CASE WHEN min({c}) < 0 THEN min({c}) * 1.5::DOUBLE ELSE min({c}) / 1.5::DOUBLE END FROM d)"
    high = f"(SELECT max({c}) * 1.5::DOUBLE FROM d)"
    return low, high


@query(
    "range_check",
    _CLEANED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", lo AS low, hi AS high, (SELECT count(*) FROM r WHERE {c} + 5000 < lo OR {c} + 5000 > hi) AS n "
        f"FROM (SELECT {_range_sql(c)[0]} AS lo, {_range_sql(c)[1]} AS hi)"
        for c in ("c_nationkey", "c_acctbal")
    ),
)
def range_check(spark, d):
    dirty, recovered = _cleaned(spark, d)
    columns = ("c_nationkey", "c_acctbal")
    limits = dirty.agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max)))).first()
    ranges = {c: expected_range(limits[f"lo_{c}"], limits[f"hi_{c}"]) for c in columns}
    # Moved up, so that some values do leave the range.
    moved = recovered.withColumns({c: F.col(c) + 5000 for c in columns})
    return out_of_range(moved, ranges)


@query(
    "null_repair",
    _CLEANED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM d WHERE {c} IS NULL) AS dirty_missing, "
        f"(SELECT count(*) FROM r WHERE {c} IS NULL) AS recovered_missing"
        for c in CUSTOMER
    ),
)
def null_repair(spark, d):
    dirty, recovered = _cleaned(spark, d)
    before = stats.null_counts(dirty).select("column", F.col("missing").alias("dirty_missing"))
    after = stats.null_counts(recovered).select("column", F.col("missing").alias("recovered_missing"))
    return before.join(after, "column")


_FINDINGS = '("check", "column", level, n)'


@query(
    "validate_pair",
    _CLEANED
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'value_range' AS \"check\", '{c}' AS \"column\", 'warning' AS level, "
        f"(SELECT count(*) FROM r WHERE {c} < {_range_sql(c)[0]} OR {c} > {_range_sql(c)[1]}) AS n"
        for c in ("c_nationkey", "c_acctbal")
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'new_values', '{c}', 'warning', (SELECT count(*) FROM (SELECT {c} FROM r WHERE {c} IS NOT NULL EXCEPT SELECT {c} FROM d))"
        for c in ("c_name", "c_mktsegment")
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'null_repair', '{c}', 'warning', (SELECT count(*) FROM d WHERE {c} IS NULL)" for c in DATA
    )
    + " UNION ALL SELECT 'type_change', 'c_nationkey', 'warning', (SELECT (median(c_nationkey) % 1 <> 0)::BIGINT FROM d)"
    + ") WHERE n > 0",
)
def validate_pair_query(spark, d):
    dirty, recovered = _cleaned(spark, d)
    operations = ["clean_text_columns", "handle_missing_values"]
    return validate_pair(dirty, recovered, operations).to_frame(spark).drop("detail")


_SPACED = sql.replaced("m", CUSTOMER, {c: sql.whitespace(c, "c_custkey") for c in ("c_name", "c_mktsegment")})


@query(
    "validate_solvability",
    f"WITH m AS ({DIRTY_CUSTOMER}), s AS ({_SPACED}), t AS (SELECT s.*, unnest(range(0, 1 + {sql.copies('c_custkey')})) FROM s) "
    "SELECT * FROM ("
    f"SELECT 'missing_values' AS \"check\", NULL::VARCHAR AS \"column\", 'note' AS level, {_count_nulls('t')} AS n UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'text_issues', '{c}', 'warning', (SELECT count(*) FROM t WHERE {c} <> {sql.strip(c)})"
        for c in ("c_name", "c_mktsegment")
    )
    + f" UNION ALL SELECT 'duplicates', NULL, 'warning', {_count_copies('t')} "
    + "UNION ALL SELECT 'operations', NULL, 'error', 1) WHERE n > 0",
)
def validate_solvability_query(spark, d):
    customer = table(spark, d, "customer").withColumnRenamed("c_custkey", ROW_ID)
    config = InjectionConfig.custom(("missing_values", "text_whitespace", "duplicates"))
    dirty = inject_all(customer, config, draws(ROW_ID))
    operations = ["handle_missing_values", "fix_spelling"]
    return validate_solvability(dirty, operations).to_frame(spark).drop("detail")


BATCH = {
    "1-URGENT": ("missing_values",),
    "2-HIGH": ("text_whitespace", "text_case"),
    "3-MEDIUM": ("outliers",),
    "4-NOT SPECIFIED": ("duplicates",),
    "5-LOW": ("missing_values", "text_whitespace", "outliers", "duplicates"),
}
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _in(strategy):
    return "o_orderpriority IN (" + ", ".join(f"'{p}'" for p, s in BATCH.items() if strategy in s) + ")"


def _gated(strategy, column, damaged):
    return f"CASE WHEN {_in(strategy)} THEN {damaged} ELSE {column} END"


_BATCH_NUMBERS = ("o_custkey", "o_totalprice")


def _group_bounds(c, source):
    q25, q75 = f"quantile_cont({c}::DOUBLE, 0.25)", f"quantile_cont({c}::DOUBLE, 0.75)"
    return (
        f"(SELECT o_orderpriority AS g, {q25} - 1.5 * ({q75} - {q25}) AS lo, {q75} + 1.5 * ({q75} - {q25}) AS hi "
        f"FROM {source} GROUP BY 1)"
    )


_GROUP_MODE = (
    "(SELECT o_orderpriority AS g, o_orderstatus AS v FROM c WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2 "
    "QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC, o_orderstatus) = 1)"
)
BATCH_SQL = (
    "WITH m AS ("
    + sql.replaced(
        "orders",
        _ORDER_COLUMNS,
        {
            "o_custkey": _gated("missing_values", "o_custkey", sql.missing_number("o_custkey", "o_orderkey", "BIGINT")),
            "o_totalprice": _gated(
                "missing_values", "o_totalprice", sql.missing_number("o_totalprice", "o_orderkey", "DOUBLE")
            ),
            "o_orderstatus": _gated("missing_values", "o_orderstatus", sql.missing_text("o_orderstatus", "o_orderkey")),
        },
    )
    + "), w AS ("
    + sql.replaced(
        "m", _ORDER_COLUMNS, {"o_orderstatus": _gated("text_whitespace", "o_orderstatus", sql.whitespace("o_orderstatus", "o_orderkey"))}
    )
    + "), k AS ("
    + sql.replaced("w", _ORDER_COLUMNS, {"o_orderstatus": _gated("text_case", "o_orderstatus", sql.case("o_orderstatus", "o_orderkey"))})
    + f"), s AS ({sql.outlier_stats(_BATCH_NUMBERS, 'k').replace('SELECT ', 'SELECT o_orderpriority AS g, ', 1)} GROUP BY 1), o AS ("
    + sql.replaced(
        "k JOIN s ON g = o_orderpriority",
        _ORDER_COLUMNS,
        {
            "o_custkey": _gated("outliers", "o_custkey", sql.outlier("o_custkey", "o_orderkey", integer="BIGINT")),
            "o_totalprice": _gated("outliers", "o_totalprice", sql.outlier("o_totalprice", "o_orderkey", decimals=2)),
        },
    )
    + f"), t AS (SELECT o.*, unnest(range(0, 1 + CASE WHEN {_in('duplicates')} THEN {sql.copies('o_orderkey')} ELSE 0 END))::INTEGER AS _copy FROM o)"
    + ", c AS ("
    + sql.replaced(
        "t",
        (*_ORDER_COLUMNS, "_copy"),
        {
            "o_orderstatus": f"CASE WHEN {_in('text_whitespace')} AND {_in('text_case')} THEN lower({sql.strip('o_orderstatus')}) "
            f"WHEN {_in('text_whitespace')} THEN {sql.strip('o_orderstatus')} WHEN {_in('text_case')} THEN lower(o_orderstatus) ELSE o_orderstatus END"
        },
    )
    + "), f AS (SELECT o_orderpriority AS g, "
    + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS m_{c}" for c in _BATCH_NUMBERS)
    + f" FROM c GROUP BY 1), i AS (SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN {_in('missing_values')} THEN coalesce({c}, m_{c}) ELSE {c} END AS {c}" for c in _BATCH_NUMBERS)
    + f", CASE WHEN {_in('missing_values')} THEN coalesce(o_orderstatus, v) ELSE o_orderstatus END AS o_orderstatus, "
    f"o_orderdate, o_orderpriority, _copy FROM c JOIN f ON f.g = o_orderpriority JOIN {_GROUP_MODE} x ON x.g = o_orderpriority), "
    f"r1 AS (SELECT i.* FROM i JOIN {_group_bounds('o_custkey', 'i')} ON g = o_orderpriority WHERE NOT {_in('outliers')} OR o_custkey BETWEEN lo AND hi), "
    f"r2 AS (SELECT r1.* FROM r1 JOIN {_group_bounds('o_totalprice', 'r1')} ON g = o_orderpriority WHERE NOT {_in('outliers')} OR o_totalprice BETWEEN lo AND hi), "
    "z AS (SELECT DISTINCT ON (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
    f"CASE WHEN {_in('duplicates')} THEN 0 ELSE o_orderkey END) * FROM r2 ORDER BY o_orderkey, _copy) "
)


def batch_pair(spark, d) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", ROW_ID)
    injections = {p: InjectionConfig.custom(s) for p, s in BATCH.items()}
    dirty = corrupt_batch(
        orders, injections, draws(ROW_ID), by="o_orderpriority", decimals={"o_totalprice": 2}
    )
    dirty = keep(dirty, "table", "dirty")
    return dirty, clean_batch(dirty, injections, by="o_orderpriority")


TYPED = {"1-URGENT": ("type_corruption",), "2-HIGH": ("missing_values", "type_corruption"), "5-LOW": ("missing_values",)}
TYPE_COLUMNS = {"1-URGENT": ("o_totalprice",), "2-HIGH": ("o_custkey", "o_orderdate")}


@query(
    "batch_dirty",
    # Each dataset with its own types: text where it drew the strategy, numbers and times elsewhere.
    "WITH t AS (SELECT o_orderpriority AS p, CAST(o_orderkey AS BIGINT) AS _row_id, "
    + ", ".join(
        f"CASE WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN {sql.missing_number(c, 'o_orderkey', kind)} ELSE {c} END AS {c}"
        for c, kind in (("o_custkey", "BIGINT"), ("o_totalprice", "DOUBLE"))
    )
    + ", o_orderdate FROM orders) SELECT p AS o_orderpriority, _row_id, "
    "CASE WHEN p = '2-HIGH' THEN CAST(o_custkey AS VARCHAR) END AS custkey_text, CASE WHEN p <> '2-HIGH' THEN o_custkey END AS custkey, "
    "CASE WHEN p = '1-URGENT' THEN CAST(o_totalprice AS VARCHAR) END AS totalprice_text, CASE WHEN p <> '1-URGENT' THEN o_totalprice END AS totalprice, "
    "CASE WHEN p <> '2-HIGH' THEN o_orderdate END AS orderdate FROM t",
)
def batch_dirty(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", ROW_ID)
    injections = {p: InjectionConfig.custom(s, type_columns=TYPE_COLUMNS.get(p)) for p, s in TYPED.items()}
    dirty = corrupt_batch(orders, injections, draws(ROW_ID), by="o_orderpriority")
    own = damaged_types(orders, injections)

    def is_text(c):
        return F.col("o_orderpriority").isin([p for p, columns in own.items() if c in columns])

    return dirty.select(
        "o_orderpriority",
        ROW_ID,
        F.when(is_text("o_custkey"), F.col("o_custkey")).alias("custkey_text"),
        F.when(~is_text("o_custkey"), typed_again(dirty, "o_custkey", T.LongType())).alias("custkey"),
        F.when(is_text("o_totalprice"), F.col("o_totalprice")).alias("totalprice_text"),
        F.when(~is_text("o_totalprice"), typed_again(dirty, "o_totalprice", T.DoubleType())).alias("totalprice"),
        F.when(~is_text("o_orderdate"), typed_again(dirty, "o_orderdate", T.TimestampNTZType())).alias("orderdate"),
    )


def _stage_sql(source, name):
    nulls = " + ".join(f"({c} IS NULL)::INT" for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    return (
        f"(SELECT o_orderpriority, CAST(sum(n) AS BIGINT) AS {name}_rows, CAST(sum(n - 1) AS BIGINT) AS {name}_duplicates, "
        f"CAST(sum(k) AS BIGINT) AS {name}_missing FROM (SELECT o_orderpriority, count(*) AS n, sum({nulls}) AS k FROM {source} "
        "GROUP BY o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) GROUP BY 1)"
    )


@query(
    "batch_quality",
    BATCH_SQL
    + "SELECT *, round(least(greatest((dirty_missing - recovered_missing)::DOUBLE / greatest(dirty_missing, 1) * 40 "
    "+ (dirty_duplicates - recovered_duplicates)::DOUBLE / greatest(dirty_duplicates, 1) * 30 "
    "+ recovered_rows::DOUBLE / dirty_rows * 30, 0), 100), 2) AS quality_score "
    f"FROM {_stage_sql('t', 'dirty')} JOIN {_stage_sql('z', 'recovered')} USING (o_orderpriority)",
)
def batch_quality_query(spark, d):
    return batch_quality(*batch_pair(spark, d), by="o_orderpriority")


@query(
    "batch_recovered",
    BATCH_SQL
    + "SELECT o_orderkey AS _row_id, o_custkey::DOUBLE AS o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, "
    "o_orderdate, o_orderpriority, _copy FROM z",
)
def batch_recovered(spark, d):
    recovered = batch_pair(spark, d)[1]
    return recovered.withColumn("o_totalprice", F.round("o_totalprice", 6))


_PROFILE_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _flagship_sql(side, source):
    return " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing, "
        f"count(DISTINCT {c}) AS \"unique\", "
        + (
            f"round(avg({c}), 4) AS mean, NULL::BIGINT AS whitespace_issues"
            if c in ("c_custkey", "c_nationkey", "c_acctbal")
            else f"NULL::DOUBLE AS mean, count(*) FILTER ({c} <> {sql.strip(c)}) AS whitespace_issues"
        )
        + f" FROM {source}"
        for c in _PROFILE_COLUMNS
    )


_FLAG_DIRTY = (
    f"WITH m AS ({DIRTY_CUSTOMER}), d AS ({_SPACED}), t AS (SELECT c_custkey, lower({sql.strip('c_name')}) AS c_name, c_nationkey, "
    f"c_acctbal, lower({sql.strip('c_mktsegment')}) AS c_mktsegment FROM d), r AS ({sql.replaced('t', CUSTOMER, _FILLS)}) "
)


@query("damage_recover_profile", _FLAG_DIRTY + _flagship_sql("dirty", "d") + " UNION ALL " + _flagship_sql("recovered", "r"))
def flagship(spark, d):
    """Damage customer with missing cells and stray spaces, recover it, and profile both tables."""
    dirty = inject.inject_whitespace(dirty_customer(spark, d), draws("c_custkey"))
    recovered = dirty
    for operator in (CleanText(), Impute(exclude=["c_custkey"])):
        recovered = operator.fit(recovered).transform(recovered)
    sides = [
        stats.column_profile(df).select(
            F.lit(side).alias("side"),
            "column",
            "rows",
            "missing",
            "unique",
            F.round("mean", 4).alias("mean"),
            "whitespace_issues",
        )
        for side, df in (("dirty", dirty), ("recovered", recovered))
    ]
    return reduce(DataFrame.unionByName, sides)


_PLANNED = ("handle_missing_values", "clean_text_columns", "remove_outliers")
_UNPLANNED = ("convert_data_types", "tidy_up")
_PRIORITIES = {"1-URGENT": _PLANNED, "2-HIGH": _PLANNED, "3-MEDIUM": _UNPLANNED, "4-NOT SPECIFIED": _UNPLANNED, "5-LOW": _PLANNED}


@query(
    "batch_checks",
    f"""WITH d AS (
        SELECT o_orderpriority, o_orderkey, o_custkey, CASE WHEN NOT {sql.u("o_orderkey", "price")} < 0.03 THEN o_totalprice END AS price,
               CASE WHEN {sql.u("o_orderkey", "status")} < 0.1 THEN '  ' || o_orderstatus ELSE o_orderstatus END AS status FROM orders
    ),
    r AS (SELECT o_orderpriority, coalesce(price, -100.0) AS price, lower(trim(status)) AS status FROM d WHERE o_orderkey % 50 <> 0),
    p AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {str(v is _PLANNED).lower()})" for k, v in _PRIORITIES.items())}) AS t(o_orderpriority, planned)),
    g AS (
        SELECT o_orderpriority, planned, count(*) AS rows, count(*) - count(price) AS missing, count(*) FILTER (status <> trim(status)) AS untrimmed
        FROM d JOIN p USING (o_orderpriority) GROUP BY ALL
    ),
    left_ AS (SELECT o_orderpriority, count(*) AS left_rows, count(*) FILTER (price < 0) AS filled FROM r GROUP BY ALL),
    fresh AS (
        SELECT o_orderpriority, count(*) AS n FROM (SELECT DISTINCT o_orderpriority, status FROM r EXCEPT SELECT DISTINCT o_orderpriority, status FROM d) GROUP BY ALL
    ),
    w AS (SELECT * FROM g JOIN left_ USING (o_orderpriority) JOIN fresh USING (o_orderpriority)),
    f AS (
        SELECT o_orderpriority, 'row_count' AS "check", NULL AS "column", CASE WHEN planned THEN 'note' ELSE 'warning' END AS level, rows - left_rows AS n FROM w
        UNION ALL SELECT o_orderpriority, 'value_range', 'price', 'warning', filled FROM w
        UNION ALL SELECT o_orderpriority, 'new_values', 'status', CASE WHEN planned THEN 'warning' ELSE 'error' END, n FROM w
        UNION ALL SELECT o_orderpriority, 'null_repair', 'price', 'warning', missing FROM w
        UNION ALL SELECT o_orderpriority, 'missing_values', NULL, CASE WHEN planned THEN 'note' ELSE 'error' END, missing FROM w
        UNION ALL SELECT o_orderpriority, 'text_issues', 'status', 'warning', untrimmed FROM w WHERE NOT planned
        UNION ALL SELECT o_orderpriority, 'type_conversion', 'status', 'warning', 0 FROM w WHERE NOT planned
    )
    SELECT * FROM f WHERE n > 0 OR "check" = 'type_conversion'
    UNION ALL SELECT o_orderpriority, 'operations', NULL, 'error', 1 FROM w WHERE NOT planned""",
)
def batch_checks(spark, d):
    """Orders of each priority as a dataset, with plans that fit and plans that do not."""
    by = draws("o_orderkey")
    dirty = table(spark, d, "orders").select(
        "o_orderpriority",
        "o_orderkey",
        "o_custkey",
        F.when(~by.below(0.03, "price"), F.col("o_totalprice")).alias("price"),
        F.when(by.below(0.1, "status"), F.concat(F.lit("  "), "o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    recovered = dirty.where("o_orderkey % 50 <> 0").withColumns({"price": F.coalesce("price", F.lit(-100.0)), "status": F.lower(F.trim("status"))})
    return check_datasets(dirty, recovered, _PRIORITIES, "o_orderpriority")
