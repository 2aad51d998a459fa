import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnish import Draws, TableSpec, ecommerce_spec, generate_columns, generate_table, healthcare_spec
from tarnish.sources.generate import check_generated, verify_generated
from tarnish.sources.spec import CategoricalColumn, DatetimeColumn, NumericColumn


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_values_do_not_depend_on_partitions(spark, method):
    spec = ecommerce_spec(400)
    one = generate_table(spark, spec, seed=3, method=method, partitions=1)
    many = generate_table(spark, spec, seed=3, method=method, partitions=7)
    assert rows_of(one) == rows_of(many)
    assert rows_of(one) != rows_of(generate_table(spark, spec, seed=4, method=method))


def test_ecommerce_invariants(spark):
    df = generate_table(spark, ecommerce_spec(4000)).cache()
    found = verify_generated(df, ecommerce_spec(4000)).first()
    assert (found["rows"], found["columns"], found["nulls"]) == (4000, 10, 0)
    limits = df.agg(
        F.min("customer_age"), F.max("customer_age"), F.min("order_amount"), F.max("quantity"), F.min("order_date")
    ).first()
    assert limits[0] >= 18 and limits[1] <= 80 and limits[2] >= 10 and limits[3] <= 20
    assert limits[4] >= dt.datetime(2023, 1, 1)
    shares = {r["order_status"]: r["count"] / 4000 for r in df.groupBy("order_status").count().collect()}
    for value, expected in zip(
        ("Pending", "Processing", "Shipped", "Delivered", "Cancelled"), (0.05, 0.10, 0.15, 0.65, 0.05), strict=True
    ):
        assert abs(shares[value] - expected) < 3.5 * (expected * (1 - expected) / 4000) ** 0.5


def test_visits_are_on_working_days_in_business_hours(spark):
    df = generate_table(spark, healthcare_spec(3000))
    bad = df.filter((F.weekday("visit_date") >= 5) | ~F.hour("visit_date").between(9, 16)).count()
    assert bad == 0


def test_every_working_day_can_be_drawn(spark):
    spec = TableSpec("t", [DatetimeColumn("d", "2024-06-01", "2024-06-16", weekdays_only=True)], num_rows=2000)
    days = {r["d"].day for r in generate_table(spark, spec).select("d").distinct().collect()}
    assert days == {3, 4, 5, 6, 7, 10, 11, 12, 13, 14}


def test_a_range_without_working_days_is_an_error(spark):
    spec = TableSpec("t", [DatetimeColumn("d", "2024-06-01", "2024-06-03", weekdays_only=True)])
    with pytest.raises(ValueError, match="no working day"):
        generate_table(spark, spec)


@pytest.mark.parametrize(
    ("column", "mean", "std"),
    [
        (NumericColumn("x", mean=50, std=5, decimals=6), 50, 5),
        (NumericColumn("x", distribution="uniform", min_value=0, max_value=12, decimals=6), 6, 12 / 12**0.5),
        (NumericColumn("x", distribution="exponential", mean=4, min_value=1, decimals=6), 5, 4),
        (NumericColumn("x", integer=True, distribution="poisson", mean=7), 7, 7**0.5),
        (NumericColumn("x", integer=True, distribution="poisson", mean=900), 900, 30),
        (NumericColumn("x", integer=True, distribution="binomial", mean=6, max_value=20), 6, (20 * 0.3 * 0.7) ** 0.5),
    ],
)
def test_distributions_have_their_moments(spark, column, mean, std):
    n = 20000
    row = generate_table(spark, TableSpec("t", [column], num_rows=n)).agg(F.avg("x"), F.stddev("x")).first()
    assert abs(row[0] - mean) < 4 * std / n**0.5
    assert abs(row[1] - std) < 0.05 * std


def test_unique_ids_and_even_choices(spark):
    spec = TableSpec(
        "t",
        [NumericColumn("id", integer=True, unique=True, min_value=100), CategoricalColumn("c", [f"v{i}" for i in range(90)])],
        num_rows=500,
    )
    df = generate_table(spark, spec)
    assert df.select("id").distinct().count() == 500
    assert df.select("c").distinct().count() > 80


def test_columns_for_an_existing_key(spark):
    keys = spark.range(10, 15).withColumnRenamed("id", "k")
    df = generate_columns(keys, ecommerce_spec(), Draws(1, ("k",)))
    assert df.columns[0] == "k" and df.count() == 5


def test_wrong_shape_is_an_error(spark):
    with pytest.raises(ValueError, match="expected"):
        check_generated(generate_table(spark, ecommerce_spec(5)), ecommerce_spec(6))
