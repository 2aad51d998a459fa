"""The column generators, over the keys of orders."""

from __future__ import annotations

from tarnish.queries import sql
from tarnish.queries.registry import draws, query, table
from tarnish.sources.builtin import ecommerce_spec, finance_spec, healthcare_spec
from tarnish.sources.generate import generate_columns, verify_generated
from tarnish.sources.spec import CategoricalColumn, DatetimeColumn, NumericColumn, TableSpec, spec_from_config

# As a user would write it: words in any case, defaults left out, one column of no known type.
LOOSE = {
    "name": "loose",
    "columns": [
        {"name": "count", "type": "Numeric_Int", "distribution": "zipf"},
        {"name": "amount", "type": "numeric_float", "distribution": "Exponential", "mean": 20, "min_value": 1},
        {"name": "colour", "type": "categorical", "categories": ["red", "green", "blue"], "frequencies": [0.5, 0.3, 0.2]},
        {"name": "day", "type": "datetime", "start_date": "2024-01-01"},
        {"name": "photo", "type": "picture"},
    ],
}

SPECS = {
    "gen_from_config": spec_from_config(LOOSE).columns,
    "gen_uniform": [
        NumericColumn("x", distribution="uniform", min_value=-5, max_value=20, decimals=3),
        NumericColumn("k", integer=True, distribution="uniform", min_value=1000, max_value=999999),
        NumericColumn("plain", distribution="uniform", decimals=6),
    ],
    "gen_normal": [
        NumericColumn("x", mean=35, std=12, min_value=18, max_value=80),
        NumericColumn("k", integer=True, mean=120, std=15, min_value=90, max_value=180),
        NumericColumn("magnitude", allow_negative=False, decimals=4),
    ],
    "gen_exponential": [
        NumericColumn("x", distribution="exponential", mean=150, min_value=10, max_value=5000),
        NumericColumn("free", distribution="exponential", decimals=3),
    ],
    "gen_poisson": [
        NumericColumn("few", integer=True, distribution="poisson", mean=3, min_value=1, max_value=20),
        NumericColumn("many", integer=True, distribution="poisson", mean=80),
        NumericColumn("more", integer=True, distribution="poisson", mean=500),
        NumericColumn("most", integer=True, distribution="poisson", mean=5000),
    ],
    "gen_binomial": [
        NumericColumn("ten", integer=True, distribution="binomial", mean=3, max_value=10),
        NumericColumn("hundred", integer=True, distribution="binomial", mean=40, max_value=100),
        NumericColumn("often", integer=True, distribution="binomial", mean=150, max_value=1500),
        NumericColumn("seldom", integer=True, distribution="binomial", mean=40, max_value=2000),
    ],
    "gen_categorical": [
        CategoricalColumn("weighted", ["a", "b", "c", "d"], [0.4, 0.35, 0.15, 0.1]),
        CategoricalColumn("even", [f"value {i}" for i in range(7)]),
    ],
    "gen_timestamp": [
        DatetimeColumn("at", "2023-01-01", "2024-12-31", include_time=True),
        DatetimeColumn("day", "2015-01-01", "2024-12-31"),
    ],
    "gen_business_hours": [
        DatetimeColumn("at", "2023-01-01", "2024-12-31", include_time=True, business_hours_only=True)
    ],
    "gen_weekday": [
        DatetimeColumn("at", "2023-01-01", "2024-12-31", include_time=True, weekdays_only=True),
        DatetimeColumn("day", "2024-06-01", "2024-06-30", weekdays_only=True),
        DatetimeColumn(
            "visit", "2023-01-01", "2024-12-31", include_time=True, business_hours_only=True, weekdays_only=True
        ),
    ],
    "gen_ecommerce": ecommerce_spec().columns,
    "gen_healthcare": healthcare_spec().columns,
    "gen_finance": finance_spec().columns,
}


# Each kind of relationship, and chains of them: age, income and savings are drawn together, the tier hangs
# on the age, the rebate on the tier, and sums hang on what was drawn before them.
RELATED = TableSpec(
    "related",
    [
        NumericColumn("total", decimals=2),
        NumericColumn("age", integer=True, mean=42, std=13, min_value=18, max_value=90),
        NumericColumn("income", distribution="exponential", mean=30000, min_value=12000, max_value=900000),
        NumericColumn("savings", distribution="uniform", min_value=0, max_value=50000),
        CategoricalColumn("tier", ["basic", "silver", "gold"], [0.7, 0.2, 0.1]),
        NumericColumn("rebate", integer=True, distribution="uniform", min_value=0, max_value=2),
        NumericColumn("visits", integer=True, distribution="poisson", mean=4),
        NumericColumn("quantity", integer=True, distribution="uniform", min_value=1, max_value=50),
        NumericColumn("price", distribution="uniform", min_value=1, max_value=99),
        CategoricalColumn("size", ["small", "middle", "large"]),
        # Days, as the engines' exponentials differ in the last bit, which would show in microseconds.
        DatetimeColumn("opened", "2020-01-01", "2024-12-31"),
        DatetimeColumn("closed", "2025-01-01", "2025-06-30"),
    ],
    relationships=[
        {"type": "correlation", "source_columns": ["age"], "target_column": "income", "parameters": {"strength": 0.6}},
        {"type": "correlation", "source_columns": ["income"], "target_column": "savings", "parameters": {"strength": 0.5}},
        {"type": "correlation", "source_columns": ["age"], "target_column": "savings", "parameters": {"strength": 0.4}},
        {"type": "correlation", "source_columns": ["visits"], "target_column": "opened", "parameters": {"strength": -0.8}},
        {
            "type": "conditional",
            "source_columns": ["age"],
            "target_column": "tier",
            "parameters": {"cases": [{"when": "age >= 65", "values": ["silver", "gold"], "frequencies": [0.4, 0.6]}, {"when": "age < 21", "value": "basic"}]},
        },
        {
            "type": "conditional",
            "source_columns": ["tier"],
            "target_column": "rebate",
            "parameters": {"cases": [{"if_value": "gold", "min_value": 10, "max_value": 20}, {"if_value": ["silver"], "min_value": 3, "max_value": 9}]},
        },
        {"type": "conditional", "source_columns": ["tier"], "target_column": "closed", "parameters": {"cases": [{"if_value": ["gold", "silver"], "null": True}]}},
        {
            "type": "derived",
            "source_columns": ["quantity", "price", "rebate"],
            "target_column": "total",
            "parameters": {"expression": "quantity * price * (100 - rebate) / 100.0"},
        },
        {
            "type": "derived",
            "source_columns": ["total"],
            "target_column": "size",
            "parameters": {"expression": "CASE WHEN total < 300 THEN 'small' WHEN total < 1500 THEN 'middle' ELSE 'large' END"},
        },
    ],
)


@query("gen_related", sql.related(RELATED, "o_orderkey", "orders"))
def gen_related(spark, d):
    return generate_columns(table(spark, d, "orders"), RELATED, draws("o_orderkey"))


def _register(name, columns):
    spec = TableSpec(name, columns)

    @query(name, sql.generated(spec, "o_orderkey", "orders"))
    def generated(spark, d):
        return generate_columns(table(spark, d, "orders"), spec, draws("o_orderkey"))


for _name, _columns in SPECS.items():
    _register(_name, _columns)


@query(
    "gen_verify",
    # The SQL makes the cells itself and counts those it left empty.
    f"WITH g AS ({sql.generated(ecommerce_spec(), 'o_orderkey', 'orders')}) SELECT (SELECT count(*) FROM orders) AS expected_rows, "
    "count(*) AS rows, 10 AS expected_columns, 10 AS columns, "
    f"CAST(sum({' + '.join(f'({c.name} IS NULL)::INT' for c in ecommerce_spec().columns)}) AS BIGINT) AS nulls FROM g",
)
def gen_verify(spark, d):
    orders = table(spark, d, "orders")
    spec = ecommerce_spec(orders.count())
    return verify_generated(generate_columns(orders, spec, draws("o_orderkey"), keep=[]), spec)
