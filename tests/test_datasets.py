import json
import os

import pytest
from pyspark.sql import functions as F

from tarnish import (
    DatasetConfig,
    Draws,
    InjectionConfig,
    cleaning_plan,
    corrupt_dataset,
    ecommerce_spec,
    generate_batch,
    generate_dataset,
    generate_table,
    generate_training_set,
    quality_report,
    read_table,
    run_cleaning,
    with_row_ids,
)
from tarnish.functions.families import COPY, ROW_ID, data_columns
from tarnish.functions.storage import held, new_path, release, through_table
from tarnish.operators.compare import cell_audit
from tarnish.plans import dataset as plans
from tarnish.plans.batch import corrupt_batch, generate_batches
from tarnish.plans.injection import STRATEGIES, register_strategy
from tarnish.plans.report import metadata_document, quality_score
from tarnish.operators.stats import TableFacts
from tarnish.sources.files import export_summary, read_metadata, write_table


def test_dataset_end_to_end(spark):
    path = new_path(spark, "dataset")
    triple = generate_dataset(
        spark,
        {"name": "all", "domain": "ecommerce", "num_rows": 600, "difficulty": "custom", "strategies": list(STRATEGIES), "seed": 7},
        path,
        include_perfect=True,
        formats=["csv", "parquet"],
        audit=True,
    )
    meta = triple.metadata
    assert meta["perfect_shape"] == [600, 10]
    assert meta["dirty_shape"][0] == triple.dirty.count() > 600
    assert meta["recovered_clean_shape"][0] == triple.recovered.count() < meta["dirty_shape"][0]
    assert meta["recovery_summary"]["recovered_missing"] == 0
    assert meta["recovery_summary"]["recovered_duplicates"] == 0
    assert set(meta["required_operations"]) == {o["operation"] for o in meta["cleaning_operations"]}
    summary = meta["quality_report"]["summary"]
    assert 0 <= summary["overall_quality_score"] <= 100
    assert summary["difficulty"] == "custom"
    assert meta["quality_report"]["perfect_comparison"]["columns_match"]
    assert {r["kind"] for r in meta["injection_log"]} >= {"nulled", "sentinel", "whitespace", "case"}
    # The files hold the tables.
    back = read_table(spark, f"{path}/dirty.parquet")
    assert back.columns == data_columns(triple.dirty)
    assert back.count() == triple.dirty.count()
    assert read_metadata(spark, f"{path}/metadata.json")["schema_info"]["name"] == "all"
    sizes = {r["path"].rsplit("/", 1)[-1]: r["size_bytes"] for r in export_summary(spark, triple.exported).collect()}
    assert set(sizes) == {
        "dirty.csv", "clean.csv", "perfect_synthetic.csv",
        "dirty.parquet", "clean.parquet", "perfect_synthetic.parquet", "metadata.json",
    }
    assert all(size > 0 for size in sizes.values())
    triple.release()


def test_text_errors_alone_lose_no_rows(spark):
    triple = generate_dataset(spark, "ecommerce_text_only")
    assert triple.metadata["recovered_clean_shape"] == [1000, 10]
    lowered = triple.perfect.select(ROW_ID, F.lower("order_status").alias("s"))
    same = triple.recovered.select(ROW_ID, F.trim("order_status").alias("r")).join(lowered, ROW_ID).filter("r = s").count()
    assert same == 1000
    triple.release()


def test_a_users_own_table_and_key(spark):
    df = spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") % 50).cast("double").alias("v"), F.lit("some text").alias("t")
    )
    config = InjectionConfig.custom(["missing_values", "duplicates"], 3, {"missing_rate": 0.3})
    triple = corrupt_dataset(df, config, key=["k"], hold="table", unique="approximate")
    keys = triple.dirty.filter(F.col(COPY) == 0).select("k")
    assert keys.distinct().count() == 300 and keys.filter("k is null").count() == 0
    assert triple.metadata["corruption_summary"]["missing_values_added"] > 0
    report = quality_report(triple.dirty, triple.recovered, triple.metadata, df, ["k"])
    assert report["perfect_comparison"]["matched_rows"] == 300
    json.dumps(report)
    json.dumps(metadata_document(triple.metadata, *triple.facts), default=str)
    triple.release()


def test_row_ids_stay_the_same(spark):
    df = with_row_ids(spark.range(50).select(F.lit("same").alias("t")).repartition(4))
    assert df.select(ROW_ID).distinct().count() == 50
    assert sorted(df.collect()) == sorted(df.repartition(2).collect())


def test_unknown_strategies_and_domains_are_errors(spark):
    perfect = generate_table(spark, ecommerce_spec(10))
    with pytest.raises(ValueError, match="duplicate_rows"):
        corrupt_dataset(perfect, InjectionConfig.custom(["duplicate_rows"]))
    with pytest.raises(ValueError, match="domain"):
        generate_dataset(spark, {"name": "x", "domain": "weather"})


def test_a_registered_strategy_runs(spark):
    register_strategy("hide_city", lambda df, draws, config: df.withColumn("city", F.lit(None).cast("string")), "handle_missing_values")
    df = spark.createDataFrame([(1, "a")], f"{ROW_ID} long, city string")
    triple = corrupt_dataset(df, InjectionConfig.custom(["hide_city"]))
    assert triple.dirty.first()["city"] is None
    assert triple.metadata["required_operations"] == ["handle_missing_values"]


def test_validation_errors_stop_the_run(spark, monkeypatch):
    monkeypatch.setattr(plans, "cleaning_plan", lambda *a, **k: [])
    config = {"name": "x", "domain": "finance", "num_rows": 50, "strategies": ["missing_values"]}
    with pytest.raises(plans.ValidationFailed, match="no imputation"):
        generate_dataset(spark, config)


def test_row_counts_per_step_and_compatible_defects(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, "A"), (1.0, "A"), (2.0, "b")], "v double, s string")
    plan = cleaning_plan(["duplicates", "text_case", "type_corruption"], compatible=True)
    result = run_cleaning(df.withColumn(ROW_ID, F.monotonically_increasing_id()), plan, hold="persist", count_rows=True)
    # Every text column is coerced to numbers, so all texts are lost, and rows alike in v fall together.
    assert [step["rows_affected"] for step in result.log] == [0, 0, 2]
    assert result.recovered.filter("s is not null").count() == 0


def _facts(rows, missing, duplicates):
    return TableFacts(rows, ["c"], {"c": "int"}, {"c": "numeric"}, duplicates, {"c": {"missing": missing, "bytes": 0}})


def test_score_stays_between_0_and_100():
    assert quality_score(_facts(10, 4, 2), _facts(8, 0, 0)) == 94.0
    assert quality_score(_facts(10, 0, 0), _facts(10, 10, 0)) == 0.0
    assert quality_score(_facts(10, 0, 0), _facts(10, 10, 0), "raw") < 0
    assert quality_score(_facts(0, 0, 0), _facts(0, 0, 0)) == 0.0


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_tables_survive_writing(spark, fmt):
    rows = [(1, '  quoted "x", y  ', None), (2, "", 1.5), (3, None, -0.25), (4, "line\nbreak\\", 1e300)]
    df = spark.createDataFrame(rows, "k long, s string, v double").withColumn(
        "at", F.lit("2024-03-31 02:30:00.123456").cast("timestamp_ntz")
    )
    path = write_table(df, new_path(spark, "files"), fmt, lossless=True)
    assert sorted(map(tuple, read_table(spark, path, fmt, df.schema, lossless=True).collect())) == sorted(map(tuple, df.collect()))
    if fmt != "parquet":
        with pytest.raises(ValueError, match="schema"):
            read_table(spark, path, fmt)


def test_training_set_is_one_batch(spark):
    path = new_path(spark, "batch")
    batch = generate_training_set(spark, "finance", 1, 1, 2, 200, path, formats="parquet")
    quality = {r["dataset_id"]: r for r in batch.quality.collect()}
    assert set(quality) == {"finance_easy_1", "finance_medium_1", "finance_hard_1", "finance_hard_2"}
    assert batch.perfect.groupBy("dataset_id").count().filter("count = 200").count() == 4
    for name, row in quality.items():
        strategies = batch.injections[name].strategies
        assert (row["dirty_missing"] > 0) == ("missing_values" in strategies)
        assert (row["dirty_duplicates"] > 0) == ("duplicates" in strategies)
        assert row["recovered_missing"] == 0 or "missing_values" in strategies
        assert 0 <= row["quality_score"] <= 100
    assert spark.read.parquet(f"{path}/clean.parquet").select("dataset_id").distinct().count() == 4
    assert len(read_metadata(spark, f"{path}/metadata.json")["datasets"]) == 4


def test_a_batch_holds_the_datasets_that_single_runs_make(spark):
    batch_order = ["missing_values", "text_whitespace", "outliers", "type_corruption", "duplicates"]
    configs = [
        DatasetConfig("plain", "finance", 120, "custom", ("missing_values", "text_whitespace"), seed=5),
        DatasetConfig("typed", "finance", 60, "custom", tuple(batch_order), seed=9),
    ]
    batch = generate_batch(spark, configs, hold="table", validate=False)
    for config in configs:
        dirty, _ = batch.dataset(config.name)
        single = generate_dataset(spark, config, validate=False, include_quality_report=False).dirty
        kept = [c for c in dirty.columns if c in single.columns]
        assert dirty.select(kept).dtypes == single.select(kept).dtypes
        rows = [sorted(map(repr, df.select(kept).collect())) for df in (dirty.where("_copy = 0"), single.where("_copy = 0") if COPY in single.columns else single)]
        assert rows[0] == rows[1], config.name
    assert {r["dataset_id"] for r in batch.types.collect()} == {"typed"}
    assert batch.validation.count() == 2


def test_batches_of_several_domains_and_sizes(spark):
    path = new_path(spark, "batches")
    configs = [
        DatasetConfig("a", "finance", 50, "easy", seed=1),
        DatasetConfig("b", "ecommerce", 80, "easy", seed=2),
        DatasetConfig("c", "finance", 20, "medium", seed=3),
    ]
    batches = generate_batches(spark, configs, path, formats="parquet", validate=False)
    sizes = {r["dataset_id"]: r["count"] for b in batches.values() for r in b.perfect.groupBy("dataset_id").count().collect()}
    assert sizes == {"a": 50, "b": 80, "c": 20}
    documents = {r["dataset_id"]: r for r in spark.read.json(f"{path}/finance/datasets.json").collect()}
    assert set(documents) == {"a", "c"} and documents["a"]["num_rows"] == 50 and documents["c"]["seed"] == 3


def test_a_batch_refuses_what_it_cannot_do(spark):
    perfect = generate_table(spark, ecommerce_spec(10)).withColumn("dataset_id", F.lit("x"))
    for options in ({"sampling": "exact"}, {"exclude": ("quantity",)}):
        with pytest.raises(ValueError, match="x: "):
            corrupt_batch(perfect, {"x": InjectionConfig.custom(["missing_values"], **options)}, Draws())


def test_released_tables_are_gone(spark, tmp_path):
    df = spark.range(10)
    before = set(held(spark))
    through_table(df, "one")
    through_table(df, "two")
    own = [p for p in held(spark) if p not in before]
    assert len(own) == 2 and all(os.path.isdir(p.removeprefix("file://")) for p in own)
    release(spark, own)
    assert set(held(spark)) == before and not any(os.path.exists(p.removeprefix("file://")) for p in own)


def test_filters_reach_the_scan_by_default(spark, capsys):
    lineitem = read_table(spark, "/root/testdata/sf0.001/lineitem.parquet")
    lineitem.filter("l_quantity > 49").select("l_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(l_quantity,49.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_a_lossless_csv_has_a_row_in_each_line(spark):
    df = spark.createDataFrame([(1, "a\nb%0A%"), (2, "\r\n"), (3, None), (4, "")], "k long, s string")
    path = write_table(df.coalesce(1), new_path(spark, "lines"), "csv", lossless=True)
    assert spark.read.text(path).count() == 5
    assert sorted(read_table(spark, path, "csv", df.schema, lossless=True).collect()) == sorted(df.collect())


def test_a_repeated_key_is_an_error(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    with pytest.raises(ValueError, match="no key"):
        cell_audit(lineitem, lineitem, ["l_orderkey", "l_linenumber"])


def test_a_csv_comes_back_with_its_line_breaks(spark):
    docs = read_table(spark, "/root/testdata/sf0.001/documents.parquet")
    assert docs.where("text LIKE '%\n%'").count()
    path = write_table(docs, new_path(spark, "documents"), "csv")
    back = read_table(spark, path, "csv", docs.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    odd = spark.createDataFrame([(1, "a\nb"), (2, "a\r\nb"), (3, "a\rb"), (4, '"x"\n,"y"\n'), (5, "\n"), (6, " c%0A "), (7, None)], "k int, t string")
    path = write_table(odd.coalesce(1), new_path(spark, "odd"), "csv")
    assert sorted(map(tuple, read_table(spark, path, "csv", odd.schema).collect())) == sorted(map(tuple, odd.collect()))


def test_a_batch_keeps_to_each_datasets_max_rate(spark):
    df = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 2).alias("dataset"))
    free = InjectionConfig.custom(["outliers"], rates={"outlier_rate": 0.2}, max_rate=None)
    bound = InjectionConfig.custom(["outliers"], rates={"outlier_rate": 0.2})
    assert (free.to_dict()["rates"]["outlier_rate"], bound.to_dict()["rates"]["outlier_rate"]) == (0.2, 0.05)
    with pytest.warns(UserWarning, match="max_rate"):
        dirty = corrupt_batch(df, {0: free, 1: bound}, Draws(42, ("k",)), by="dataset")
    hit = dict(map(tuple, dirty.join(df.select("k", F.col("v").alias("was")), "k").where("v <> was").groupBy("dataset").count().collect()))
    assert 480 < hit[0] < 720 and 90 < hit[1] < 210
