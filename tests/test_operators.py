import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnish import CleanText, ConvertTypes, Draws, Impute, NullifySentinels, RemoveOutliers
from tarnish.functions import text
from tarnish.functions.convert import number_text, parse_number, parse_timestamp
from tarnish.functions.families import COPY, ROW_ID
from tarnish.functions.quantiles import exact_quantiles, kth_smallest
from tarnish.operators import inject, sampling
from tarnish.operators.compare import audit_counts, cell_audit, new_values, similarity
from tarnish.operators.dedupe import remove_duplicates
from tarnish.operators.fill import fill_along, fill_constants
from tarnish.operators.stats import column_profile, duplicate_count, mode_values, table_facts, value_counts
from tarnish.operators.validate import validate_pair, validate_solvability
from tarnish.sources.files import normalise_missing

D = Draws(11, (ROW_ID,))


def people(spark, n=2000):
    return spark.range(n, numPartitions=5).select(
        F.col("id").alias(ROW_ID),
        (F.col("id") % 90 + 10).alias("age"),
        (F.col("id") * 1.5 + 100).alias("pay"),
        F.concat(F.lit("New Town "), (F.col("id") % 7).cast("string")).alias("city"),
    )


def one(df, expression):
    return df.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("gather_rows", [5, 100000])
def test_quantiles_match_numpy_on_skewed_data(spark, gather_rows):
    rng = np.random.default_rng(1)
    # A third of the rows share one value, and a few are far out.
    values = np.concatenate([np.full(3000, 7.0), rng.exponential(50, 5990), [1e12, -1e12, 5e-9] * 3])
    rows = [(float(v), ["a", "b", None][i % 3]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, g string").repartition(6)
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df, {"v": F.col("v")}, ps, gather_rows=gather_rows)[()]["v"]
    assert np.allclose(found, np.quantile(values, ps), rtol=1e-12)
    by_group = exact_quantiles(df, {"v": F.col("v")}, ps, ["g"], gather_rows=gather_rows)
    for i, g in enumerate(["a", "b", None]):
        assert np.allclose(by_group[(g,)]["v"], np.quantile(values[i::3], ps), rtol=1e-12)


def test_quantiles_leave_out_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "v double, w double")
    found = exact_quantiles(df, {"v": F.col("v"), "w": F.col("w")}, [0.5])[()]
    assert found == {"v": [2.0], "w": [None]}
    assert kth_smallest(df, {"w": F.col("w")}, {"w": 3}) == {"w": None}


def test_text_steps(spark):
    df = spark.createDataFrame([("\t fol-low ÇA o'neil\xa0",)], "s string")
    s = F.col("s")
    assert one(df, text.strip(s)) == "fol-low ÇA o'neil"
    assert one(df, text.title(text.strip(s))) == "Fol-Low Ça O'Neil"
    assert one(df, text.remove_special(text.strip(s))) == "follow A oneil"
    assert one(df, text.collapse(F.lit("a   b  c"))) == "a b c"
    assert one(df, text.remove_numbers(F.lit("a12b٣"))) == "ab"
    for sample in ("", "straße", "a1b", "ßx", "it's OK-ish"):
        assert one(df, text.title(F.lit(sample))) == sample.title()


def test_mixed_case_changes_case_only(spark):
    word = "The quick brown fox jumps over the lazy dog and runs away"
    df = spark.createDataFrame([(1, word)], "_row_id long, s string")
    mixed = one(df, text.mixed_case(F.col("s"), D.coins(F.length("s"), "t")))
    assert mixed.lower() == word.lower() and mixed not in (word, word.upper(), word.lower())


def test_number_and_datetime_texts(spark):
    df = spark.createDataFrame([(12345678.9, 12.5)], "big double, small double")
    kind = df.schema["big"].dataType
    assert one(df, number_text(F.col("big"), kind)) == "12345678.9"
    assert one(df, number_text(F.col("small"), kind)) == "12.5"
    texts = [" 12 ", "1d", "1e3", "abc", "", "-3.5", "nan", None, "2024"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(parse_number(F.col("s"))).collect()] == [12, None, 1000, None, None, -3.5, None, None, 2024]
    stamps = ["2024-02-29", "2024-02-30", "2024-01-01 10:00:00", "2024", "x"]
    df = spark.createDataFrame([(t,) for t in stamps], "s string")
    assert [r[0] is not None for r in df.select(parse_timestamp(F.col("s"))).collect()] == [True, False, True, False, False]


@pytest.mark.parametrize("sampling_mode", ["bernoulli", "exact"])
def test_missing_rate_and_kinds(spark, sampling_mode):
    df = people(spark)
    dirty = inject.inject_missing(df, D, 0.15, sampling=sampling_mode)
    audit = cell_audit(df, dirty).cache()
    counts = {r["column"]: r["n"] for r in audit.groupBy("column").agg(F.count("*").alias("n")).collect()}
    for c in ("age", "pay", "city"):
        if sampling_mode == "exact":
            # A pay or age of 0 or 999999 would hide a hit; there is none.
            assert counts[c] == int(2000 * 0.15)
        else:
            assert abs(counts[c] - 300) < 4 * (2000 * 0.15 * 0.85) ** 0.5
    kinds = {r["kind"] for r in audit.collect() if r["column"] == "city"}
    assert kinds == {"nulled", "emptied"}
    assert {r["kind"] for r in audit.collect() if r["column"] == "pay"} == {"nulled", "sentinel"}


def test_injection_does_not_depend_on_partitions(spark):
    df = people(spark, 300)
    for injector in (inject.inject_missing, inject.inject_whitespace, inject.inject_case, inject.inject_special_characters, inject.inject_outliers):
        a = sorted(map(repr, injector(df.repartition(1), D).collect()))
        b = sorted(map(repr, injector(df.repartition(9), D).collect()))
        assert a == b


def test_exact_text_rate_counts_values_only(spark):
    df = people(spark).withColumn("city", F.when(F.col(ROW_ID) % 2 == 0, F.col("city")))
    dirty = inject.inject_whitespace(df, D, 0.2, sampling="exact")
    hits = cell_audit(df, dirty)
    assert hits.count() == int(1000 * 0.2)
    assert {r["kind"] for r in audit_counts(hits).collect()} == {"whitespace"}


def test_outliers_lie_beyond_the_bounds(spark):
    df = people(spark)
    dirty = inject.inject_outliers(df, D, 0.9, decimals={"pay": 2})
    hits = cell_audit(df, dirty).collect()
    # The rate is capped at 5 %.
    assert 0 < len(hits) < 2 * 2000 * 0.08
    low, high, _, _ = inject.outlier_bounds(df, ["pay"], 2.5)[()]["pay"]
    for r in hits:
        if r["column"] == "pay":
            assert not low <= float(r["after"]) <= high
            assert float(r["after"]) >= 0
    assert dict(dirty.dtypes) == dict(df.dtypes)


@pytest.mark.parametrize("sampling_mode", ["bernoulli", "exact"])
def test_duplicates_come_back_out(spark, sampling_mode):
    df = people(spark)
    dirty = inject.inject_duplicates(df, D, 0.05, sampling_mode)
    added = dirty.count() - 2000
    assert added == 100 if sampling_mode == "exact" else 50 < added < 150
    assert duplicate_count(dirty).first()["duplicates"] == added
    clean = remove_duplicates(dirty)
    assert sorted(map(tuple, clean.drop(COPY).collect())) == sorted(map(tuple, df.collect()))
    assert clean.filter(F.col(COPY) > 0).count() == 0


def test_type_errors_are_undone(spark):
    df = people(spark).withColumn("at", F.timestamp_add("SECOND", F.col(ROW_ID), F.lit("2024-01-01").cast("timestamp_ntz")))
    dirty = inject.inject_type_errors(df, D, columns=["age", "pay", "at"])
    assert {t for c, t in dirty.dtypes if c in ("age", "pay", "at")} == {"string"}
    back = ConvertTypes().fit(dirty).transform(dirty)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert len(inject.choose_type_columns(df, 1, 0.3, [ROW_ID])) == 1


def test_strip_undoes_outer_spaces(spark):
    df = people(spark).withColumn("city", F.replace("city", F.lit(" "), F.lit("_")))
    dirty = inject.inject_whitespace(df, D, 0.5)
    clean = CleanText(("strip",)).fit(dirty).transform(dirty)
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, df.collect()))


def test_null_stays_null_and_numbers_in_text_are_left_alone(spark):
    rows = [(" A.b ", "1.5"), (None, "-2.5"), ("", "3")]
    df = spark.createDataFrame(rows, "t string, n string")
    clean = CleanText(("strip", "lower", "remove_special")).fit(df).transform(df).collect()
    assert [r["t"] for r in clean] == ["ab", None, ""]
    assert [r["n"] for r in clean] == ["1.5", "-2.5", "3"]
    as_text = CleanText(("lower",), null_as_text=True).fit(df).transform(df).collect()
    assert as_text[1]["t"] == "none"


def test_sentinels_and_nan_become_null(spark):
    df = spark.createDataFrame([(-999.0, ""), (float("nan"), "x"), (0.0, None), (999999.0, "nan")], "v double, s string")
    clean = NullifySentinels().fit(df).transform(normalise_missing(df)).collect()
    assert [r["v"] for r in clean] == [None, None, 0.0, None]
    assert [r["s"] for r in clean] == [None, "x", None, "nan"]


def test_impute_promotes_integers_only_for_fractions(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 3, "b"), (None, None, "a"), (None, 2, "b"), (None, None, "a")], "v long, w long, s string")
    fitted = Impute().fit(df)
    assert fitted.values == {"v": 1.5, "w": 2.0, "s": "a"}
    out = fitted.transform(df)
    assert dict(out.dtypes) == {"v": "double", "w": "bigint", "s": "string"}
    assert fill_constants(df, {"s": ""}).filter("s = ''").count() == 1
    empty = spark.createDataFrame([(None, None)], "v double, s string")
    assert Impute().fit(empty).transform(empty).first().asDict() == {"v": None, "s": ""}
    with pytest.raises(ValueError):
        Impute(numeric="knn").fit(df)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert mode_values(df, ["s"]).first().asDict() == {"column": "s", "value": "a", "count": 2}
    assert [tuple(r) for r in value_counts(df, "s", 2).collect()] == [("a", 2), ("b", 2)]


def test_outlier_filter_keeps_nulls_and_works_in_sequence(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 400), rng.normal(0, 1, 400)
    a[:20] *= 50
    b[10:40] *= 30
    rows = [(i, float(x) if i % 9 else None, float(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, f"{ROW_ID} long, a double, b double")
    expected = df.toPandas()
    for c in ("a", "b"):
        q1, q3 = expected[c].quantile(0.25), expected[c].quantile(0.75)
        outside = (expected[c] < q1 - 1.5 * (q3 - q1)) | (expected[c] > q3 + 1.5 * (q3 - q1))
        expected = expected[~outside]
    found = RemoveOutliers().fit(df).transform(df)
    assert sorted(r[ROW_ID] for r in found.collect()) == sorted(expected[ROW_ID])
    with pytest.raises(ValueError):
        RemoveOutliers("forest").fit(df)


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_dedupe_with_a_hot_key_matches_pandas(spark, keep):
    # One key holds a third of the rows.
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}" if i % 3 == 1 else f"u{i}", i % 4) for i in range(1500)]
    df = spark.createDataFrame(rows, f"{ROW_ID} long, k string, v int").repartition(7)
    expected = pd.DataFrame(rows, columns=[ROW_ID, "k", "v"])
    for subset in (["k"], None):
        want = expected.drop_duplicates(subset or ["k", "v"], keep=keep)
        got = remove_duplicates(df, keep, subset)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.itertuples(index=False)))


@pytest.mark.parametrize("how", ["forward_fill", "back_fill", "interpolate"])
def test_fills_along_an_order_match_pandas(spark, how):
    rows = [(i, "hot" if i % 3 else f"k{i % 4}", None if i % 5 else float(i * i)) for i in range(300)]
    df = spark.createDataFrame(rows, f"{ROW_ID} long, k string, v double")
    step = {"forward_fill": pd.Series.ffill, "back_fill": pd.Series.bfill, "interpolate": pd.Series.interpolate}[how]
    frame = pd.DataFrame(rows, columns=[ROW_ID, "k", "v"])
    for keys in ([], ["k"]):
        expected = frame.groupby("k")["v"].transform(step) if keys else step(frame["v"])
        got = fill_along(df, ["v"], how, [ROW_ID], keys, slices=6).toPandas().sort_values(ROW_ID)
        np.testing.assert_allclose(got["v"].to_numpy(), expected.to_numpy())


def test_profile_and_facts(spark):
    df = spark.createDataFrame([(1.0, " Ab", "1"), (None, "ab", "x"), (3.0, None, "3"), (1.0, " Ab", "1")], "v double, s string, n string")
    profile = {r["column"]: r for r in column_profile(df, numeric=["v", "n"]).collect()}
    assert (profile["v"]["missing"], profile["v"]["unique"], profile["v"]["median"]) == (1, 2, 1.0)
    assert (profile["s"]["whitespace_issues"], profile["s"]["case_variations"], profile["s"]["max_length"]) == (2, 2, 3)
    assert profile["n"]["mean"] == pytest.approx(5 / 3)
    facts = table_facts(df)
    assert (facts.rows, facts.duplicates, facts.missing, facts.cells) == (4, 1, 2, 12)


def test_similarity_and_new_values(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0)], f"{ROW_ID} long, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "q", None)], f"{ROW_ID} long, s string, v double")
    found = similarity(a, b).first()
    assert (found["matched_rows"], found["equal_cells"], found["similarity_pct"]) == (2, 2, 33.33)  # NULL equals nothing
    assert [tuple(r) for r in new_values(a, b, ["s"]).collect()] == [("s", "q")]


def test_validation_levels(spark):
    dirty = spark.createDataFrame([(1.0, "a "), (None, "b"), (1.0, "b"), (1.0, "b")], "v double, s string")
    recovered = spark.createDataFrame([(1.0, "a"), (9.0, "b")], "v double, s string")
    bad = validate_pair(dirty, recovered, [])
    assert [f.check for f in bad.findings] == ["row_count", "value_range", "new_values", "null_repair"]
    assert not bad.ok and len(bad.errors) == 1
    assert validate_pair(dirty, recovered, ["clean_text_columns", "remove_duplicates"]).ok
    grown = validate_pair(recovered, dirty, ["clean_text_columns"])
    assert any("more rows" in e for e in grown.errors)
    assert validate_pair(dirty, recovered.drop("s"), []).errors
    hard = validate_solvability(dirty, [{"operation": "remove_outliers", "threshold": 4.0}, {"operation": "guess"}])
    assert {(f.check, f.level) for f in hard.findings} == {
        ("operations", "error"),
        ("missing_values", "error"),
        ("text_issues", "warning"),
        ("outliers", "warning"),
        ("duplicates", "warning"),
    }
    assert validate_solvability(dirty, ["handle_missing_values", "convert_data_types"]).ok


def test_samples_are_repeatable(spark):
    df = people(spark)
    exact = sampling.sample_exact(df, 0.1, D)
    assert exact.count() == 200
    assert sorted(exact.collect()) == sorted(sampling.sample_exact(df.repartition(3), 0.1, D).collect())
    positions = sampling.shuffled_positions(df, D).collect()
    assert sorted(r["position"] for r in positions) == list(range(2000))
    assert [r["position"] for r in positions] != [r[ROW_ID] for r in positions]
    assert sampling.head(df, 3, [ROW_ID]).count() == 3
