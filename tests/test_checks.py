"""The checks of a whole batch against those of each dataset by itself."""

import random

import pytest
from pyspark.sql import functions as F

from tarnish.operators.validate import validate_pair, validate_solvability
from tarnish.plans.checks import check_datasets

SCHEMA = "dataset_id string, a double, n int, t string, s string"


def by_each(dirty, recovered, operations, names):
    out = []
    for name in names:
        own = [df.where(F.col("dataset_id") == name).drop("dataset_id") for df in (dirty, recovered)]
        planned = operations[name] if isinstance(operations, dict) else operations
        for found in (validate_pair(*own, planned), validate_solvability(own[0], planned)):
            out += [(name, f.check, f.column, f.level, f.n) for f in found.findings]
    return sorted(out, key=repr)


def batch(spark):
    rng = random.Random(4)
    rows = []
    for name, n in (("a", 60), ("b", 25), ("c", 8)):
        for _ in range(n):
            same = name == "b"
            rows.append((name, None if rng.random() < 0.1 else 5.0 if same else rng.gauss(0, 9), rng.randrange(3), rng.choice(["x ", "Y", None, "z"]), rng.choice(["1", "2", "q", "2024-01-01"])))
    rows += [("a", 1.0, 1, "x ", "1")] * 3
    return spark.createDataFrame(rows, SCHEMA)


OPERATIONS = {
    "a": ["handle_missing_values", "clean_text_columns", {"operation": "remove_outliers", "method": "iqr", "threshold": 4.5}],
    "b": ["convert_data_types", {"operation": "remove_outliers"}, "polish", "polish"],
    "c": ["remove_duplicates"],
}


@pytest.mark.parametrize("operations", [OPERATIONS, OPERATIONS["b"]])
def test_findings_are_those_of_each_dataset(spark, operations):
    dirty = batch(spark)
    recovered = dirty.where("NOT (dataset_id = 'a' AND n = 0)").select(
        "dataset_id",
        F.coalesce("a", F.lit(10000.0)).alias("a"),
        F.when(F.col("dataset_id") == "c", F.col("n") * 100).otherwise(F.col("n")).cast("double").alias("n"),
        F.lower(F.trim("t")).alias("t"),
        "s",
    )
    recovered = recovered.unionByName(recovered.where("dataset_id = 'b'"))
    got = check_datasets(dirty, recovered, operations)
    assert got.columns == ["dataset_id", "check", "column", "level", "n"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_each(dirty, recovered, operations, "abc")


def test_lost_datasets_and_columns(spark):
    dirty = batch(spark)
    recovered = dirty.where("dataset_id <> 'b'").drop("s").withColumn("more", F.lit(1))
    got = check_datasets(dirty, recovered, ["handle_missing_values"])
    assert sorted(map(tuple, got.collect()), key=repr) == by_each(dirty, recovered, ["handle_missing_values"], "abc")


def test_an_empty_batch(spark):
    nothing = batch(spark).where("a > 1e9")
    assert check_datasets(nothing, nothing, OPERATIONS).collect() == []
