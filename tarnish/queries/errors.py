"""The error injectors, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnish.functions.families import ROW_ID
from tarnish.functions.storage import small_table
from tarnish.operators import inject
from tarnish.operators.compare import audit_counts, cell_audit
from tarnish.plans.dataset import corruption_summary, table_counts
from tarnish.plans.injection import InjectionConfig
from tarnish.plans.injection import inject as inject_all
from tarnish.queries import sql
from tarnish.queries.registry import draws, query, table
from tarnish.queries.relational import CUSTOMER, DIRTY_CUSTOMER, ORDERS, dirty_customer

PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
CONVERSATION_KEY = "conv_id,turn"


@query(
    "inject_missing_number",
    sql.replaced(
        "orders",
        ORDERS,
        {
            "o_totalprice": sql.missing_number("o_totalprice", "o_orderkey", "DOUBLE"),
            "o_custkey": sql.missing_number("o_custkey", "o_orderkey", "BIGINT"),
        },
    ),
)
def inject_missing_number(spark, d):
    orders = table(spark, d, "orders")
    return inject.inject_missing(orders, draws("o_orderkey"), columns=["o_totalprice", "o_custkey"])


@query("inject_missing_text", DIRTY_CUSTOMER)
def inject_missing_text(spark, d):
    return dirty_customer(spark, d)


_U = sql.u("o_orderkey", "o_orderstatus", "missing", "cell")


@query(
    "inject_missing_exact",
    f"WITH ranked AS (SELECT *, row_number() OVER (ORDER BY {_U}) AS r, count(*) OVER () AS n FROM orders) "
    + sql.replaced(
        "ranked",
        ORDERS,
        {
            "o_orderstatus": "CASE WHEN r <= CAST(floor(n * 0.15) AS BIGINT) THEN CASE WHEN "
            + sql.choice("o_orderkey", 3, "o_orderstatus", "missing", "kind")
            + " = 1 THEN '' END ELSE o_orderstatus END"
        },
    ),
)
def inject_missing_exact(spark, d):
    orders = table(spark, d, "orders")
    return inject.inject_missing(orders, draws("o_orderkey"), columns=["o_orderstatus"], sampling="exact")


@query(
    "inject_whitespace",
    sql.replaced(
        "conversations", ("conv_id", "turn", "role", "text"), {c: sql.whitespace(c, CONVERSATION_KEY) for c in ("role", "text")}
    ),
)
def inject_whitespace(spark, d):
    return inject.inject_whitespace(table(spark, d, "conversations"), draws("conv_id", "turn"))


@query(
    "inject_case",
    sql.replaced("part", PART, {c: sql.case(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")}),
)
def inject_case(spark, d):
    return inject.inject_case(table(spark, d, "part"), draws("p_partkey"))


DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


@query(
    "inject_case_long_text",
    sql.replaced("documents", DOCUMENTS, {c: sql.case(c, "doc_id") for c in ("text", "lang", "source")}),
)
def inject_case_long_text(spark, d):
    return inject.inject_case(table(spark, d, "documents"), draws("doc_id"))


@query(
    "inject_special_characters",
    sql.replaced("part", PART, {c: sql.special(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")}),
)
def inject_special_characters(spark, d):
    return inject.inject_special_characters(table(spark, d, "part"), draws("p_partkey"))


@query(
    "inject_types",
    sql.replaced(
        "orders",
        ORDERS,
        {
            "o_custkey": "CAST(o_custkey AS VARCHAR)",
            "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
            "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
        },
    ),
)
def inject_types(spark, d):
    orders = table(spark, d, "orders")
    return inject.inject_type_errors(orders, draws("o_orderkey"), columns=["o_custkey", "o_totalprice", "o_orderdate"])


@query(
    "inject_types_drawn",
    "SELECT event_id, CAST(ts AS VARCHAR)[:19] AS ts, user_id, event_type, value, props FROM events",
)
def inject_types_drawn(spark, d):
    # Of value and ts, the seeded choice takes one.
    events = table(spark, d, "events")
    return inject.inject_type_errors(events, draws("event_id"), exclude=["event_id", "user_id"])


@query(
    "inject_outliers",
    f"WITH s AS ({sql.outlier_stats(('p_size', 'p_retailprice'), 'part')}) "
    + sql.replaced(
        "part, s",
        PART,
        {
            "p_size": sql.outlier("p_size", "p_partkey", integer="INTEGER"),
            "p_retailprice": sql.outlier("p_retailprice", "p_partkey", decimals=2),
        },
    ),
)
def inject_outliers(spark, d):
    part = table(spark, d, "part")
    return inject.inject_outliers(part, draws("p_partkey"), exclude=["p_partkey"], decimals={"p_retailprice": 2})


@query(
    "inject_outliers_signed",
    f"WITH s AS ({sql.outlier_stats(('c_acctbal',), 'customer')}) "
    + sql.replaced("customer, s", CUSTOMER, {"c_acctbal": f"round({sql.outlier('c_acctbal', 'c_custkey')}, 4)"}),
)
def inject_outliers_signed(spark, d):
    customer = table(spark, d, "customer")
    damaged = inject.inject_outliers(customer, draws("c_custkey"), columns=["c_acctbal"])
    return damaged.withColumn("c_acctbal", F.round("c_acctbal", 4))


@query(
    "inject_duplicates",
    f"SELECT * REPLACE (_copy::INTEGER AS _copy) FROM (SELECT customer.*, unnest(range(0, 1 + {sql.copies('c_custkey')})) AS _copy FROM customer)",
)
def inject_duplicates(spark, d):
    return inject.inject_duplicates(table(spark, d, "customer"), draws("c_custkey"))


_ROW = sql.u("_draw", "duplicate", "row")


@query(
    "inject_duplicates_exact",
    "WITH n AS (SELECT count(*) AS n FROM customer), "
    "draws AS (SELECT unnest(range(0, (SELECT CAST(floor(n * 0.05) AS BIGINT) FROM n))) AS _draw), "
    f"picked AS (SELECT CAST(floor({_ROW} * (SELECT n FROM n)) AS BIGINT) AS _row_id, count(*) AS c FROM draws GROUP BY 1) "
    "SELECT c_custkey AS _row_id, c_name, c_nationkey, c_acctbal, c_mktsegment, "
    "unnest(range(0, 1 + coalesce(c, 0)))::INTEGER AS _copy FROM customer LEFT JOIN picked ON c_custkey = picked._row_id",
)
def inject_duplicates_exact(spark, d):
    customer = table(spark, d, "customer").withColumnRenamed("c_custkey", ROW_ID)
    return inject.inject_duplicates(customer, draws(ROW_ID), sampling="exact")


COMPOSED = ("text_whitespace", "text_case", "text_special_chars")


@query(
    "inject_composed",
    "WITH a AS ("
    + sql.replaced("part", PART, {c: sql.whitespace(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")})
    + "), b AS ("
    + sql.replaced("a", PART, {c: sql.case(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")})
    + ") "
    + sql.replaced("b", PART, {c: sql.special(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")}),
)
def inject_composed(spark, d):
    config = InjectionConfig.custom(COMPOSED)
    return inject_all(table(spark, d, "part"), config, draws("p_partkey"))


_KIND_NUMBER = (
    "CASE WHEN a IS NULL THEN 'nulled' WHEN b IS NULL THEN 'filled' "
    "WHEN a IN ('-999', '0', '999999', '-999.0', '0.0', '999999.0') THEN 'sentinel' ELSE 'value' END"
)
_KIND_TEXT = "CASE WHEN a IS NULL THEN 'nulled' WHEN b IS NULL THEN 'filled' WHEN a = '' THEN 'emptied' ELSE 'value' END"
AUDIT = f"WITH t AS ({DIRTY_CUSTOMER}), p AS (" + " UNION ALL ".join(
    f"SELECT x.c_custkey, '{c}' AS \"column\", CAST(x.{c} AS VARCHAR) AS b, CAST(t.{c} AS VARCHAR) AS a, "
    f"{'true' if c in ('c_name', 'c_mktsegment') else 'false'} AS is_text "
    f"FROM customer x JOIN t USING (c_custkey) WHERE x.{c} IS DISTINCT FROM t.{c}"
    for c in CUSTOMER[1:]
) + f') SELECT c_custkey, "column", b AS before, a AS after, CASE WHEN is_text THEN {_KIND_TEXT} ELSE {_KIND_NUMBER} END AS kind FROM p'


@query("cell_audit", AUDIT)
def cell_audit_query(spark, d):
    return cell_audit(table(spark, d, "customer"), dirty_customer(spark, d), ["c_custkey"])


@query("cell_audit_counts", f'SELECT "column", kind, count(*) AS cells FROM ({AUDIT}) GROUP BY ALL')
def cell_audit_counts(spark, d):
    return audit_counts(cell_audit_query(spark, d))


@query(
    "corruption_summary",
    f"WITH d AS ({DIRTY_CUSTOMER}), m AS (SELECT CAST(sum((c_name IS NULL)::INT + (c_nationkey IS NULL)::INT "
    "+ (c_acctbal IS NULL)::INT + (c_mktsegment IS NULL)::INT) AS BIGINT) AS missing, count(*) AS n FROM d), "
    "u AS (SELECT count(*) AS k FROM (SELECT DISTINCT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM d)) "
    "SELECT missing AS missing_values_added, round(missing * 100.0::DOUBLE / (n * 5), 2) AS missing_percentage, "
    "n - k AS duplicates_added, round((n - k) * 100.0::DOUBLE / n, 2) AS duplicate_percentage, "
    "CAST(0 AS BIGINT) AS rows_added FROM m, u",
)
def corruption_summary_query(spark, d):
    found = corruption_summary(table_counts(table(spark, d, "customer")), table_counts(dirty_customer(spark, d)))
    types = {int: "bigint", float: "double"}
    return small_table(spark, [tuple(found.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in found.items()))
