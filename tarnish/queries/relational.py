"""Profiles, counts, frequencies, duplicates, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnish.functions.families import ROW_ID
from tarnish.functions.quantiles import exact_quantiles, group_quantiles, kth_smallest
from tarnish.functions.storage import new_path, small_table
from tarnish.operators import inject, sampling, stats
from tarnish.operators.compare import new_values
from tarnish.operators.dedupe import remove_duplicates
from tarnish.operators.outliers import iqr_bounds
from tarnish.operators.profiles import DISTINCT_ERROR, RANK_ERROR, merge_profiles, profile_parts, read_profiles, store_profiles
from tarnish.queries import sql
from tarnish.queries.registry import draws, query, table

CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
DIRTY_CUSTOMER = sql.replaced(
    "customer",
    CUSTOMER,
    {
        "c_name": sql.missing_text("c_name", "c_custkey"),
        "c_nationkey": sql.missing_number("c_nationkey", "c_custkey", "INTEGER"),
        "c_acctbal": sql.missing_number("c_acctbal", "c_custkey", "DOUBLE"),
        "c_mktsegment": sql.missing_text("c_mktsegment", "c_custkey"),
    },
)


def dirty_customer(spark, d):
    """customer with 15 % of its cells damaged by the missing-value injector."""
    return inject.inject_missing(table(spark, d, "customer"), draws("c_custkey"), exclude=["c_custkey"])


def _union(parts):
    return " UNION ALL ".join(parts)


@query(
    "profile_missing_unique",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + _union(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS missing_pct, "
        f"count(DISTINCT {c}) AS \"unique\", round(count(DISTINCT {c}) * 100.0::DOUBLE / count(*), 2) AS unique_pct FROM t"
        for c in CUSTOMER
    ),
)
def profile_missing_unique(spark, d):
    profile = stats.column_profile(dirty_customer(spark, d), numeric=[], text=[])
    return profile.select("column", "rows", "missing", "missing_pct", "unique", "unique_pct")


LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "profile_numeric",
    _union(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median, "
        f"round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in LINEITEM_NUMBERS
    ),
)
def profile_numeric(spark, d):
    profile = stats.column_profile(table(spark, d, "lineitem"), LINEITEM_NUMBERS, unique="none")
    return profile.select(
        "column",
        F.round("mean", 4).alias("mean"),
        F.round("median", 4).alias("median"),
        F.round("std", 4).alias("std"),
        "min",
        "max",
    )


DOCUMENT_TEXTS = ("text", "lang", "source")


@query(
    "profile_text",
    _union(
        f"SELECT '{c}' AS \"column\", round(avg(length({c})), 4) AS avg_length, min(length({c}))::INTEGER AS min_length, "
        f"max(length({c}))::INTEGER AS max_length, count(*) FILTER ({c} <> {sql.strip(c)}) AS whitespace_issues, "
        f"count(*) FILTER ({c} <> lower({c})) AS case_variations FROM documents"
        for c in DOCUMENT_TEXTS
    ),
)
def profile_text(spark, d):
    profile = stats.column_profile(table(spark, d, "documents"), DOCUMENT_TEXTS, unique="none")
    return profile.select(
        "column",
        F.round("avg_length", 4).alias("avg_length"),
        "min_length",
        "max_length",
        "whitespace_issues",
        "case_variations",
    )


@query(
    "describe_table",
    _union(
        f"SELECT '{c}' AS \"column\", '{s}' AS stat, round(({e})::DOUBLE, 4) AS value FROM lineitem"
        for c in LINEITEM_NUMBERS
        for s, e in (
            ("count", f"count({c})"),
            ("mean", f"avg({c})"),
            ("std", f"stddev_samp({c})"),
            ("min", f"min({c})"),
            ("25%", f"quantile_cont({c}, 0.25)"),
            ("50%", f"quantile_cont({c}, 0.5)"),
            ("75%", f"quantile_cont({c}, 0.75)"),
            ("max", f"max({c})"),
        )
    ),
)
def describe_table(spark, d):
    described = stats.describe(table(spark, d, "lineitem"), LINEITEM_NUMBERS)
    return described.withColumn("value", F.round("value", 4))


@query(
    "value_counts_topn",
    "SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, value LIMIT 10",
)
def value_counts_topn(spark, d):
    return stats.value_counts(table(spark, d, "events"), "event_type", 10)


@query(
    "value_counts_all",
    "SELECT text AS value, count(*) AS count FROM documents GROUP BY 1",
)
def value_counts_all(spark, d):
    return stats.value_counts(table(spark, d, "documents"), "text", None)


@query(
    "missing_counts",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + _union(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM t"
        for c in CUSTOMER
    ),
)
def missing_counts(spark, d):
    return stats.null_counts(dirty_customer(spark, d))


ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "distinct_counts",
    _union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM orders" for c in ORDERS),
)
def distinct_counts(spark, d):
    return stats.distinct_counts(table(spark, d, "orders"))


@query(
    "mode_values",
    f"WITH t AS ({DIRTY_CUSTOMER}), c AS ("
    + _union(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM t WHERE {c} IS NOT NULL GROUP BY 2"
        for c in ("c_name", "c_mktsegment")
    )
    + ') SELECT "column", value, count FROM c '
    'QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) = 1',
)
def mode_values(spark, d):
    return stats.mode_values(dirty_customer(spark, d), ["c_name", "c_mktsegment"])


def _duplicates(name, source, columns):
    keys = ", ".join(columns)
    return (
        f"SELECT '{name}' AS source, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, "
        f"CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"
    )


LINEITEM = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


@query(
    "duplicate_count",
    _union(
        [
            _duplicates("documents", "documents", ("text", "lang", "source", "n_chars")),
            _duplicates("labels", "labels", ("quality", "toxic")),
            _duplicates("lineitem", "lineitem", LINEITEM),
            _duplicates("lineitem_key", "lineitem", ("l_orderkey", "l_linenumber")),
        ]
    ),
)
def duplicate_count(spark, d):
    wanted = {
        "documents": ("documents", ["text", "lang", "source", "n_chars"]),
        "labels": ("labels", ["quality", "toxic"]),
        "lineitem": ("lineitem", list(LINEITEM)),
        "lineitem_key": ("lineitem", ["l_orderkey", "l_linenumber"]),
    }
    frames = [
        stats.duplicate_count(table(spark, d, t), columns).withColumn("source", F.lit(name))
        for name, (t, columns) in wanted.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _quantiles(source, c):
    q = [f"quantile_cont({c}::DOUBLE, {p})" for p in (0.05, 0.25, 0.5, 0.75, 0.95)]
    return f"SELECT '{source}.{c}' AS \"column\", " + ", ".join(f"round({e}, 6) AS q{i}" for i, e in enumerate(q)) + f" FROM {source}"


QUANTILE_COLUMNS = {"events": ("value",), "lineitem": LINEITEM_NUMBERS, "orders": ("o_totalprice", "o_custkey")}


@query("quantiles", _union(_quantiles(s, c) for s, columns in QUANTILE_COLUMNS.items() for c in columns))
def quantiles(spark, d):
    rows = []
    for source, columns in QUANTILE_COLUMNS.items():
        found = exact_quantiles(
            table(spark, d, source), {c: F.col(c) for c in columns}, [0.05, 0.25, 0.5, 0.75, 0.95]
        )[()]
        rows += [(f"{source}.{c}", *found[c]) for c in columns]
    out = small_table(spark, rows, "column string, " + ", ".join(f"q{i} double" for i in range(5)))
    return out.select("column", *(F.round(f"q{i}", 6).alias(f"q{i}") for i in range(5)))


@query(
    "quantiles_by_group",
    "SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, "
    "round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75 "
    "FROM lineitem GROUP BY ALL",
)
def quantiles_by_group(spark, d):
    found = exact_quantiles(
        table(spark, d, "lineitem"),
        {"p": F.col("l_extendedprice")},
        [0.25, 0.5, 0.75],
        ["l_returnflag", "l_linestatus"],
    )
    rows = [(*group, *values["p"]) for group, values in found.items()]
    out = small_table(spark, rows, "l_returnflag string, l_linestatus string, q25 double, q50 double, q75 double")
    return out.select("l_returnflag", "l_linestatus", *(F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")))


@query(
    "quantiles_many_groups",
    "SELECT l_orderkey, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_quantity, 0.5), 6) AS q50 "
    "FROM lineitem GROUP BY 1",
)
def quantiles_many_groups(spark, d):
    values = {"p": F.col("l_extendedprice"), "q": F.col("l_quantity")}
    found = group_quantiles(table(spark, d, "lineitem"), values, [0.25, 0.5], ["l_orderkey"])
    return found.select("l_orderkey", F.round(F.col("p")[0], 6).alias("q25"), F.round(F.col("q")[1], 6).alias("q50"))


@query(
    "quantiles_infinity",
    "WITH t AS (SELECT CASE l_linenumber WHEN 7 THEN 'Infinity'::DOUBLE WHEN 6 THEN '-Infinity'::DOUBLE ELSE l_extendedprice END AS v FROM lineitem) "
    "SELECT quantile_cont(v, 0.0) AS q0, round(quantile_cont(v, 0.5), 6) AS q50, quantile_cont(v, 1.0) AS q100 FROM t",
)
def quantiles_infinity(spark, d):
    line, infinite = F.col("l_linenumber"), F.lit(float("inf"))
    v = F.when(line == 7, infinite).when(line == 6, -infinite).otherwise(F.col("l_extendedprice"))
    # A small limit, so that the search takes several passes.
    found = exact_quantiles(table(spark, d, "lineitem"), {"v": v}, [0.0, 0.5, 1.0], gather_rows=10)[()]["v"]
    return small_table(spark, [tuple(found)], "q0 double, q50 double, q100 double").withColumn("q50", F.round("q50", 6))


IQR_COLUMNS = {"events": ("value",), "documents": ("n_chars",), "lineitem": ("l_extendedprice", "l_quantity")}


@query(
    "iqr_bounds",
    _union(
        f"SELECT '{s}.{c}' AS \"column\", "
        f"round(quantile_cont({c}::DOUBLE, 0.25) - 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)), 6) AS low, "
        f"round(quantile_cont({c}::DOUBLE, 0.75) + 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)), 6) AS high "
        f"FROM {s}"
        for s, columns in IQR_COLUMNS.items()
        for c in columns
    ),
)
def iqr_bounds_query(spark, d):
    rows = []
    for source, columns in IQR_COLUMNS.items():
        bounds = iqr_bounds(table(spark, d, source), columns)
        rows += [(f"{source}.{c}", *bounds[c]) for c in columns]
    out = small_table(spark, rows, "column string, low double, high double")
    return out.select("column", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


LABEL_KEYS = "quality, toxic"


@query(
    "dedupe_first",
    f"SELECT * FROM labels QUALIFY row_number() OVER (PARTITION BY {LABEL_KEYS} ORDER BY doc_id) = 1",
)
def dedupe_first(spark, d):
    return remove_duplicates(table(spark, d, "labels"), "first", ["quality", "toxic"], ["doc_id"])


@query(
    "dedupe_last",
    f"SELECT * FROM labels QUALIFY row_number() OVER (PARTITION BY {LABEL_KEYS} ORDER BY doc_id DESC) = 1",
)
def dedupe_last(spark, d):
    return remove_duplicates(table(spark, d, "labels"), "last", ["quality", "toxic"], ["doc_id"])


@query(
    "dedupe_none",
    "SELECT * FROM documents QUALIFY count(*) OVER (PARTITION BY text) = 1",
)
def dedupe_none(spark, d):
    return remove_duplicates(table(spark, d, "documents"), False, ["text"], ["doc_id"])


@query("dedupe_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedupe_rows(spark, d):
    return remove_duplicates(table(spark, d, "documents").drop("doc_id"))


@query(
    "dedupe_keep_identity",
    "SELECT min(doc_id) AS _row_id, text, lang, source, n_chars FROM documents GROUP BY ALL",
)
def dedupe_keep_identity(spark, d):
    return remove_duplicates(table(spark, d, "documents").withColumnRenamed("doc_id", ROW_ID))


@query("filter_keep_nulls", f"WITH t AS ({DIRTY_CUSTOMER}) SELECT * FROM t WHERE c_acctbal <= 5000 OR c_acctbal IS NULL")
def filter_keep_nulls(spark, d):
    return dirty_customer(spark, d).filter(~F.coalesce(F.col("c_acctbal") > 5000, F.lit(False)))


@query("head_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def head_rows(spark, d):
    return sampling.head(table(spark, d, "orders"), 100, ["o_orderkey"])


@query(
    "sample_exact_k",
    f"SELECT * FROM orders ORDER BY {sql.u('o_orderkey', 'sample')} "
    "LIMIT (SELECT CAST(floor(count(*) * 0.15) AS BIGINT) FROM orders)",
)
def sample_exact_k(spark, d):
    return sampling.sample_exact(table(spark, d, "orders"), 0.15, draws("o_orderkey"))


@query("sample_rate", f"SELECT * FROM lineitem WHERE {sql.u(','.join(LINEITEM[:4]), 'sample')} < 0.1")
def sample_rate(spark, d):
    return sampling.sample_rate(table(spark, d, "lineitem"), 0.1, draws(*LINEITEM[:4]))


@query(
    "sample_with_replacement",
    f"SELECT orders.*, unnest(range(1, 1 + {sql.counted(sql.u('o_orderkey', 'sample', 'copies'), *sql.poisson_steps(0.3))}))"
    "::INTEGER AS draw FROM orders",
)
def sample_with_replacement(spark, d):
    return sampling.sample_with_replacement(table(spark, d, "orders"), 0.3, draws("o_orderkey"))


@query(
    "sample_with_replacement_often",
    f"SELECT supplier.*, unnest(range(1, 1 + {sql.counted(sql.u('s_suppkey', 'sample', 'copies'), *sql.poisson_steps(800.0))}))"
    "::INTEGER AS draw FROM supplier",
)
def sample_with_replacement_often(spark, d):
    return sampling.sample_with_replacement(table(spark, d, "supplier"), 800.0, draws("s_suppkey"))


@query(
    "shuffle_rows",
    f"SELECT o_orderkey, row_number() OVER (ORDER BY {sql.u('o_orderkey', 'shuffle')}, o_orderkey) - 1 AS position FROM orders",
)
def shuffle_rows(spark, d):
    return sampling.shuffled_positions(table(spark, d, "orders").select("o_orderkey"), draws("o_orderkey"))


@query(
    "kth_smallest",
    "SELECT (SELECT value FROM events ORDER BY value LIMIT 1 OFFSET (SELECT count(*) // 3 - 1 FROM events)) AS value, "
    "(SELECT l_extendedprice FROM lineitem ORDER BY 1 LIMIT 1 OFFSET (SELECT count(*) // 3 - 1 FROM lineitem)) AS price",
)
def kth_smallest_query(spark, d):
    events, lineitem = table(spark, d, "events"), table(spark, d, "lineitem")
    a = kth_smallest(events, {"v": F.col("value")}, {"v": events.count() // 3})["v"]
    b = kth_smallest(lineitem, {"v": F.col("l_extendedprice")}, {"v": lineitem.count() // 3})["v"]
    return small_table(spark, [(a, b)], "value double, price double")


@query("union_all", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_all(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


@query(
    "new_values",
    f"WITH t AS (SELECT {sql.whitespace('c_mktsegment', 'c_custkey')} AS c_mktsegment, "
    f"{sql.special('c_name', 'c_custkey')} AS c_name FROM customer), "
    "r AS (SELECT lower(c_mktsegment) AS c_mktsegment, c_name || '' AS c_name FROM customer) "
    "SELECT 'c_mktsegment' AS \"column\", c_mktsegment AS value FROM (SELECT c_mktsegment FROM r EXCEPT SELECT c_mktsegment FROM t) "
    "UNION ALL SELECT 'c_name', c_name FROM (SELECT c_name FROM r EXCEPT SELECT c_name FROM t)",
)
def new_values_query(spark, d):
    customer = table(spark, d, "customer")
    k = draws("c_custkey")
    dirty = inject.inject_special_characters(
        inject.inject_whitespace(customer, k, columns=["c_mktsegment"]), k, columns=["c_name"]
    )
    recovered = customer.withColumn("c_mktsegment", F.lower("c_mktsegment"))
    return new_values(dirty, recovered, ["c_mktsegment", "c_name"])


_PROFILED = ("l_quantity", "l_extendedprice", "l_linenumber")


@query(
    "profiles_merged",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, "
        f"round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std, true AS distinct_close, true AS median_close FROM lineitem"
        for c in _PROFILED
    ),
)
def profiles_merged(spark, d):
    """Profiles of each return flag, stored and merged; how far sketches err is held against exact counts."""
    columns, lines = list(_PROFILED), table(spark, d, "lineitem")
    path = store_profiles(profile_parts(lines, "l_returnflag", columns), new_path(spark, "profiles"))
    merged = merge_profiles(read_profiles(spark, path), probabilities=[0.5])
    exact = lines.agg(*(F.count_distinct(c).alias(c) for c in columns)).first()
    around = exact_quantiles(lines, {c: F.col(c) for c in columns}, [0.5 - RANK_ERROR, 0.5 + RANK_ERROR])[()]
    told = small_table(spark, [(c, exact[c], *around[c]) for c in columns], "column string, exact bigint, q_low double, q_high double")
    median = F.col("quantiles")[0]
    return merged.join(told, "column").select(
        "column",
        "rows",
        "missing",
        "low",
        "high",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.col("exact") * DISTINCT_ERROR, F.lit(1.0))).alias("distinct_close"),
        ((median >= F.col("q_low")) & (median <= F.col("q_high"))).alias("median_close"),
    )
