"""The cleaning operators, fitted and applied on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnish.functions.families import ROW_ID
from tarnish.functions.storage import keep
from tarnish.operators import inject
from tarnish.operators.clean import (
    CleanText,
    ConvertTypes,
    FillAlong,
    Impute,
    NullifySentinels,
    RemoveDuplicates,
    RemoveOutliers,
)
from tarnish.operators.neighbours import impute_nearest
from tarnish.operators.types import parse_rates
from tarnish.plans.cleaning import cleaning_plan, run_cleaning
from tarnish.plans.injection import InjectionConfig
from tarnish.plans.injection import inject as inject_all
from tarnish.queries import sql
from tarnish.queries.errors import DOCUMENTS, PART
from tarnish.queries.registry import draws, query, table
from tarnish.queries.relational import CUSTOMER, DIRTY_CUSTOMER, ORDERS, dirty_customer


def _apply(df, operator):
    return operator.fit(df).transform(df)


CONVERSATIONS = ("conv_id", "turn", "role", "text")
SPACED_CONVERSATIONS = sql.replaced(
    "conversations", CONVERSATIONS, {c: sql.whitespace(c, "conv_id,turn") for c in ("role", "text")}
)


def spaced_conversations(spark, d):
    return inject.inject_whitespace(table(spark, d, "conversations"), draws("conv_id", "turn"))


@query(
    "clean_text_strip_lower",
    f"WITH t AS ({SPACED_CONVERSATIONS}) "
    + sql.replaced("t", CONVERSATIONS, {c: f"lower({sql.strip(c)})" for c in ("role", "text")}),
)
def clean_text_strip_lower(spark, d):
    return _apply(spaced_conversations(spark, d), CleanText(("strip", "lower")))


@query(
    "clean_text_collapse",
    f"WITH t AS ({SPACED_CONVERSATIONS}) "
    + sql.replaced("t", CONVERSATIONS, {c: f"regexp_replace({sql.strip(c)}, ' {{2,}}', ' ', 'g')" for c in ("role", "text")}),
)
def clean_text_collapse(spark, d):
    return _apply(spaced_conversations(spark, d), CleanText(("strip", "collapse")))


SYMBOL_PART = sql.replaced("part", PART, {c: sql.special(c, "p_partkey") for c in ("p_name", "p_brand", "p_type")})


@query(
    "clean_text_remove_special",
    f"WITH t AS ({SYMBOL_PART}) "
    + sql.replaced("t", PART, {c: sql.remove_special(c) for c in ("p_name", "p_brand", "p_type")}),
)
def clean_text_remove_special(spark, d):
    damaged = inject.inject_special_characters(table(spark, d, "part"), draws("p_partkey"))
    return _apply(damaged, CleanText(("remove_special",)))


@query(
    "clean_text_remove_numbers",
    sql.replaced("customer", CUSTOMER, {c: sql.remove_numbers(c) for c in ("c_name", "c_mktsegment")}),
)
def clean_text_remove_numbers(spark, d):
    return _apply(table(spark, d, "customer"), CleanText(("remove_numbers",)))


@query(
    "clean_text_documents",
    sql.replaced(
        "documents", DOCUMENTS, {c: sql.remove_special(f"lower({sql.strip(c)})") for c in ("text", "lang", "source")}
    ),
)
def clean_text_documents(spark, d):
    return _apply(table(spark, d, "documents"), CleanText(("strip", "lower", "remove_special")))


@query("clean_text_upper", sql.replaced("part", PART, {c: f"upper({c})" for c in ("p_name", "p_brand", "p_type")}))
def clean_text_upper(spark, d):
    return _apply(table(spark, d, "part"), CleanText(("upper",)))


@query(
    "clean_text_keeps_null",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + sql.replaced("t", CUSTOMER, {c: f"lower({sql.strip(c)})" for c in ("c_name", "c_mktsegment")}),
)
def clean_text_keeps_null(spark, d):
    return _apply(dirty_customer(spark, d), CleanText())


TEXT_ORDERS = sql.replaced(
    "orders",
    ORDERS,
    {
        "o_custkey": "CAST(o_custkey AS VARCHAR)",
        "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
        "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    },
)
_TYPED = ["o_custkey", "o_totalprice", "o_orderdate"]


def text_orders(spark, d):
    return inject.inject_type_errors(table(spark, d, "orders"), draws("o_orderkey"), columns=_TYPED)


@query("type_recover", "SELECT * FROM orders")
def type_recover(spark, d):
    return _apply(text_orders(spark, d), ConvertTypes())


@query(
    "type_recover_mixed",
    "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events",
)
def type_recover_mixed(spark, d):
    events = inject.inject_type_errors(table(spark, d, "events"), draws("event_id"), columns=["value", "user_id"])
    return _apply(events, ConvertTypes()).withColumn("value", F.round("value", 6))


_NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
_INTEGER = r"'^\s*[+-]?\d{1,18}\s*$'"


@query(
    "type_parse_rate",
    f"WITH t AS ({TEXT_ORDERS}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (trim({c}) <> '') AS filled, "
        f"count(*) FILTER (regexp_matches({c}, {_NUMBER})) AS \"numeric\", "
        f"count(*) FILTER (regexp_matches({c}, {_INTEGER})) AS \"integer\", "
        f"count(*) FILTER (regexp_matches({c}, '^\\s*\\d{{4}}-') AND try_cast({c} AS TIMESTAMP) IS NOT NULL) AS datetime FROM t"
        for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ),
)
def type_parse_rate(spark, d):
    return parse_rates(text_orders(spark, d))


@query(
    "type_coerce_all",
    f"WITH t AS ({TEXT_ORDERS}) SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN regexp_matches({c}, {_NUMBER}) THEN try_cast({c} AS DOUBLE) END AS {c}" for c in ORDERS[1:]
    )
    + " FROM t",
)
def type_coerce_all(spark, d):
    return _apply(text_orders(spark, d), ConvertTypes(coerce_all=True))


@query(
    "type_explicit",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, "
    "CAST(round_even(c_acctbal, 0) AS BIGINT) AS c_acctbal, c_mktsegment FROM customer",
)
def type_explicit(spark, d):
    targets = {"c_custkey": "string", "c_nationkey": "float", "c_acctbal": "int", "c_mktsegment": "category"}
    return _apply(table(spark, d, "customer"), ConvertTypes(targets))


def _imputed(number, text, promote=False):
    nation = number.format("c_nationkey")
    return {
        "c_nationkey": f"coalesce(c_nationkey::DOUBLE, {nation})" if promote else f"coalesce(c_nationkey, CAST({nation} AS INTEGER))",
        "c_acctbal": f"coalesce(c_acctbal, {number.format('c_acctbal')})",
        "c_name": f"coalesce(c_name, {text.format(c='c_name')})",
        "c_mktsegment": f"coalesce(c_mktsegment, {text.format(c='c_mktsegment')})",
    }


_MODE = "(SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 6))
    return df


def _rounded_sql(inner, *columns):
    changed = ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changed}) FROM ({inner})"


@query(
    "impute_median",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + _rounded_sql(
        sql.replaced("t", CUSTOMER, _imputed("(SELECT quantile_cont({}::DOUBLE, 0.5) FROM t)", _MODE, True)),
        "c_nationkey",
        "c_acctbal",
    ),
)
def impute_median(spark, d):
    return _rounded(_apply(dirty_customer(spark, d), Impute()), "c_nationkey", "c_acctbal")


@query(
    "impute_mean",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + _rounded_sql(
        sql.replaced("t", CUSTOMER, _imputed("(SELECT avg({}) FROM t)", "'Unknown'", True)), "c_nationkey", "c_acctbal"
    ),
)
def impute_mean(spark, d):
    operator = Impute(numeric="mean", categorical="unknown")
    return _rounded(_apply(dirty_customer(spark, d), operator), "c_nationkey", "c_acctbal")


@query(
    "impute_mode",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + sql.replaced("t", CUSTOMER, _imputed(_MODE.replace("{c}", "{0}"), _MODE)),
)
def impute_mode(spark, d):
    return _apply(dirty_customer(spark, d), Impute(numeric="most_frequent"))


@query(
    "impute_zero",
    f"WITH t AS ({DIRTY_CUSTOMER}) " + sql.replaced("t", CUSTOMER, _imputed("0", "'Missing'")),
)
def impute_zero(spark, d):
    return _apply(dirty_customer(spark, d), Impute(numeric="zero", categorical="missing"))


@query(
    "impute_constant",
    f"WITH t AS ({DIRTY_CUSTOMER}) " + sql.replaced("t", CUSTOMER, _imputed("-1", "'none given'")),
)
def impute_constant(spark, d):
    operator = Impute("constant", "constant", numeric_constant=-1, categorical_constant="none given")
    return _apply(dirty_customer(spark, d), operator)


EVENTS = ("event_id", "ts", "user_id", "event_type", "value", "props")
HOLED_EVENTS = sql.replaced(
    "events",
    EVENTS,
    {
        "value": sql.missing_number("value", "event_id", "DOUBLE", 0.5),
        "event_type": sql.missing_text("event_type", "event_id", 0.5),
    },
)


def holed_events(spark, d):
    return inject.inject_missing(table(spark, d, "events"), draws("event_id"), 0.5, ["value", "event_type"])


def _along(order, frame, pick):
    window = f"OVER ({order} ROWS BETWEEN {frame})"
    return {c: f"{pick}({c} IGNORE NULLS) {window}" for c in ("value", "event_type")}


@query(
    "impute_forward_fill",
    f"WITH t AS ({HOLED_EVENTS}) "
    + sql.replaced(
        "t", EVENTS, _along("PARTITION BY user_id ORDER BY ts, event_id", "UNBOUNDED PRECEDING AND CURRENT ROW", "last_value")
    ),
)
def impute_forward_fill(spark, d):
    operator = FillAlong("forward_fill", ["value", "event_type"], ["ts", "event_id"], ["user_id"])
    return _apply(holed_events(spark, d), operator)


@query(
    "impute_back_fill",
    f"WITH t AS ({HOLED_EVENTS}) "
    + sql.replaced("t", EVENTS, _along("ORDER BY event_id", "CURRENT ROW AND UNBOUNDED FOLLOWING", "first_value")),
)
def impute_back_fill(spark, d):
    return _apply(holed_events(spark, d), FillAlong("back_fill", ["value", "event_type"], ["event_id"]))


@query(
    "impute_interpolate",
    f"WITH t AS (SELECT *, row_number() OVER (ORDER BY event_id) AS p FROM ({HOLED_EVENTS})), s AS (SELECT *, "
    "last_value(value IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER b AS p0, "
    "first_value(value IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER a AS p1 "
    "FROM t WINDOW b AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "a AS (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) "
    + sql.replaced(
        "s",
        EVENTS,
        {
            "value": "round(CASE WHEN value IS NOT NULL THEN value WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0 "
            "ELSE v0 + (v1 - v0) * ((p - p0)::DOUBLE / (p1 - p0)) END, 6)"
        },
    ),
)
def impute_interpolate(spark, d):
    filled = _apply(holed_events(spark, d), FillAlong("interpolate", ["value"], ["event_id"]))
    return filled.withColumn("value", F.round("value", 6))


@query(
    "sentinel_to_null",
    f"WITH t AS ({DIRTY_CUSTOMER}) "
    + sql.replaced(
        "t",
        CUSTOMER,
        {c: f"CASE WHEN {c} NOT IN (-999, 999999) THEN {c} END" for c in ("c_nationkey", "c_acctbal")}
        | {c: f"nullif({c}, '')" for c in ("c_name", "c_mktsegment")},
    ),
)
def sentinel_to_null(spark, d):
    return _apply(dirty_customer(spark, d), NullifySentinels(exclude=["c_custkey"]))


def _bounds(c, source, threshold=1.5):
    q25, q75 = f"quantile_cont({c}::DOUBLE, 0.25)", f"quantile_cont({c}::DOUBLE, 0.75)"
    return f"(SELECT {q25} - {threshold} * ({q75} - {q25}) AS lo, {q75} + {threshold} * ({q75} - {q25}) AS hi FROM {source})"


@query(
    "remove_outliers_iqr",
    f"SELECT events.* FROM events, {_bounds('value', 'events')} WHERE value IS NULL OR value BETWEEN lo AND hi",
)
def remove_outliers_iqr(spark, d):
    return _apply(table(spark, d, "events"), RemoveOutliers(columns=["value"]))


@query(
    "remove_outliers_long_texts",
    f"SELECT documents.* FROM documents, {_bounds('n_chars', 'documents')} WHERE n_chars BETWEEN lo AND hi",
)
def remove_outliers_long_texts(spark, d):
    return _apply(table(spark, d, "documents"), RemoveOutliers(columns=["n_chars"]))


WILD_PART = f"WITH s AS ({sql.outlier_stats(('p_size', 'p_retailprice'), 'part')}), t AS (" + sql.replaced(
    "part, s",
    PART,
    {
        "p_size": sql.outlier("p_size", "p_partkey", integer="INTEGER"),
        "p_retailprice": sql.outlier("p_retailprice", "p_partkey", decimals=2),
    },
) + ")"


def wild_part(spark, d):
    part = table(spark, d, "part")
    return inject.inject_outliers(part, draws("p_partkey"), exclude=["p_partkey"], decimals={"p_retailprice": 2})


@query(
    "remove_outliers_sequential",
    f"{WILD_PART}, a AS (SELECT t.* FROM t, {_bounds('p_size', 't')} WHERE p_size BETWEEN lo AND hi) "
    f"SELECT a.* FROM a, {_bounds('p_retailprice', 'a')} WHERE p_retailprice BETWEEN lo AND hi",
)
def remove_outliers_sequential(spark, d):
    return _apply(wild_part(spark, d), RemoveOutliers(exclude=["p_partkey"]))


@query(
    "remove_outliers_simultaneous",
    f"{WILD_PART} SELECT t.* FROM t, {_bounds('p_size', 't')} x, {_bounds('p_retailprice', 't')} y "
    "WHERE p_size BETWEEN x.lo AND x.hi AND p_retailprice BETWEEN y.lo AND y.hi",
)
def remove_outliers_simultaneous(spark, d):
    return _apply(wild_part(spark, d), RemoveOutliers(mode="simultaneous", exclude=["p_partkey"]))


_Z = ("l_quantity", "l_extendedprice", "l_tax")


@query(
    "remove_outliers_zscore",
    "SELECT lineitem.* FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _Z)
    + " FROM lineitem) WHERE "
    + " AND ".join(f"abs({c} - m_{c}) <= 1.6 * s_{c}" for c in _Z),
)
def remove_outliers_zscore(spark, d):
    lineitem = table(spark, d, "lineitem")
    return _apply(lineitem, RemoveOutliers("zscore", 1.6, "simultaneous", columns=_Z))


@query(
    "remove_injected_duplicates",
    "SELECT c_custkey AS _row_id, c_name, c_nationkey, c_acctbal, c_mktsegment, 0::INTEGER AS _copy FROM customer",
)
def remove_injected_duplicates(spark, d):
    customer = table(spark, d, "customer").withColumnRenamed("c_custkey", ROW_ID)
    return _apply(inject.inject_duplicates(customer, draws(ROW_ID)), RemoveDuplicates())


# The whole cleaning plan on orders with missing cells, untidy texts, wrong types and outliers.
_STRATEGIES = ("missing_values", "text_whitespace", "text_case", "outliers", "duplicates")
_TEXTS = ("o_orderstatus", "o_orderpriority")
RECOVERY_DIRTY = (
    "m AS ("
    + sql.replaced(
        "orders",
        ORDERS,
        {
            "o_custkey": sql.missing_number("o_custkey", "o_orderkey", "BIGINT"),
            "o_totalprice": sql.missing_number("o_totalprice", "o_orderkey", "DOUBLE"),
            **{c: sql.missing_text(c, "o_orderkey") for c in _TEXTS},
        },
    )
    + "), w AS ("
    + sql.replaced("m", ORDERS, {c: sql.whitespace(c, "o_orderkey") for c in _TEXTS})
    + "), k AS ("
    + sql.replaced("w", ORDERS, {c: sql.case(c, "o_orderkey") for c in _TEXTS})
    + f"), s AS ({sql.outlier_stats(('o_custkey', 'o_totalprice'), 'k')}), o AS ("
    + sql.replaced(
        "k, s",
        ORDERS,
        {
            "o_custkey": sql.outlier("o_custkey", "o_orderkey", integer="BIGINT"),
            "o_totalprice": sql.outlier("o_totalprice", "o_orderkey", decimals=2),
        },
    )
    + f"), t AS (SELECT o.*, unnest(range(0, 1 + {sql.copies('o_orderkey')}))::INTEGER AS _copy FROM o)"
)
RECOVERY_CLEAN = (
    ", c AS ("
    + sql.replaced("t", (*ORDERS, "_copy"), {x: f"lower({sql.strip(x)})" for x in _TEXTS})
    + "), i AS ("
    + sql.replaced(
        "c",
        (*ORDERS, "_copy"),
        {x: f"coalesce({x}::DOUBLE, (SELECT quantile_cont({x}::DOUBLE, 0.5) FROM c))" for x in ("o_custkey", "o_totalprice")}
        | {x: f"coalesce({x}, {_MODE.format(c=x).replace('FROM t', 'FROM c')})" for x in _TEXTS},
    )
    + f"), r1 AS (SELECT i.* FROM i, {_bounds('o_custkey', 'i')} WHERE o_custkey BETWEEN lo AND hi)"
    + f", r2 AS (SELECT r1.* FROM r1, {_bounds('o_totalprice', 'r1')} WHERE o_totalprice BETWEEN lo AND hi)"
    + ", z AS (SELECT DISTINCT ON (o_orderkey) * FROM r2 ORDER BY o_orderkey, _copy)"
)


def recovery_dirty(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", ROW_ID)
    config = InjectionConfig.custom(_STRATEGIES, decimals={"o_totalprice": 2})
    return inject_all(orders, config, draws(ROW_ID))


def recovered_orders(spark, d):
    # Every fit reads the dirty table: damage it once.
    dirty = keep(recovery_dirty(spark, d), "table", "dirty")
    return run_cleaning(dirty, cleaning_plan(_STRATEGIES)).recovered


@query(
    "recover_end_to_end",
    f"WITH {RECOVERY_DIRTY}{RECOVERY_CLEAN} SELECT o_orderkey AS _row_id, o_custkey::DOUBLE AS o_custkey, o_orderstatus, "
    "round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority, _copy FROM z",
)
def recover_end_to_end(spark, d):
    recovered = recovered_orders(spark, d)
    return recovered.withColumn("o_custkey", F.col("o_custkey").cast("double")).withColumn(
        "o_totalprice", F.round("o_totalprice", 6)
    )


@query(
    "dirty_end_to_end",
    f"WITH {RECOVERY_DIRTY} SELECT o_orderkey AS _row_id, o_custkey, o_orderstatus, "
    "round(o_totalprice, 2) AS o_totalprice, o_orderdate, o_orderpriority, _copy FROM t",
)
def dirty_end_to_end(spark, d):
    return recovery_dirty(spark, d).withColumn("o_totalprice", F.round("o_totalprice", 2))


_HOLE = sql.u("o_orderkey", "nearest") + " < 0.05"


def _with_holes(spark, d, value):
    hole = draws("o_orderkey").below(0.05, "nearest")
    return table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.when(~hole, value).alias("v"))


@query(
    "impute_nearest",
    f"""WITH t AS (SELECT o_orderkey, o_totalprice AS price, CASE WHEN NOT {_HOLE} THEN o_custkey::DOUBLE END AS v FROM orders),
    points AS (SELECT price, count(v) AS n, avg(v) AS v FROM t WHERE v IS NOT NULL GROUP BY price),
    holes AS (SELECT DISTINCT price FROM t WHERE v IS NULL),
    near AS (
        SELECT h.price, p.n, p.v, row_number() OVER (PARTITION BY h.price ORDER BY abs(p.price - h.price), p.price) AS place FROM holes h, points p
        QUALIFY place <= 5
    ),
    taken AS (SELECT price, v, least(n, 5 - (sum(n) OVER (PARTITION BY price ORDER BY place) - n)) AS take FROM near),
    answers AS (SELECT price, sum(v * take) / sum(take) AS answer FROM taken WHERE take > 0 GROUP BY price)
    SELECT o_orderkey, round(coalesce(t.v, answer), 6) AS v FROM t LEFT JOIN answers USING (price)""",
)
def impute_nearest_number(spark, d):
    """One feature, where the windows hold all that is nearest; recall with more is measured in the tests."""
    filled = impute_nearest(_with_holes(spark, d, F.col("o_custkey").cast("double")), ["v"], ["price"], k=5)
    return filled.select("o_orderkey", F.round("v", 6).alias("v"))


@query(
    "impute_nearest_text",
    f"""WITH t AS (SELECT o_orderkey, o_totalprice AS price, CASE WHEN NOT {_HOLE} THEN o_orderpriority END AS v FROM orders),
    points AS (SELECT price, v, count(v) AS n FROM t WHERE v IS NOT NULL GROUP BY price, v),
    holes AS (SELECT DISTINCT price FROM t WHERE v IS NULL),
    near AS (
        SELECT h.price, p.n, p.v, row_number() OVER (PARTITION BY h.price ORDER BY abs(p.price - h.price), p.price, p.v) AS place FROM holes h, points p
        QUALIFY place <= 5
    ),
    taken AS (SELECT price, v, least(n, 5 - (sum(n) OVER (PARTITION BY price ORDER BY place) - n)) AS take FROM near),
    votes AS (SELECT price, v, sum(take) AS votes FROM taken WHERE take > 0 GROUP BY price, v),
    answers AS (SELECT price, v AS answer FROM votes QUALIFY row_number() OVER (PARTITION BY price ORDER BY votes DESC, v) = 1)
    SELECT o_orderkey, coalesce(t.v, answer) AS v FROM t LEFT JOIN answers USING (price)""",
)
def impute_nearest_text(spark, d):
    return impute_nearest(_with_holes(spark, d, F.col("o_orderpriority")), ["v"], ["price"], k=5).select("o_orderkey", "v")
