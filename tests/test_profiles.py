"""Stored profiles: merged ones against the whole table, and what a new part costs."""

import bisect
import random
import statistics

import pytest

from tarnish.functions.storage import new_path
from tarnish.operators.profiles import DISTINCT_ERROR, PROBABILITIES, RANK_ERROR, merge_profiles, profile_parts, read_profiles, share_below, store_profiles

SCHEMA = "day string, v double, n int, t string, empty double"


def rows_of(day, n, seed):
    rng = random.Random(seed)
    return [(day, None if rng.random() < 0.1 else 1e6 + rng.gauss(ord(day), 3), rng.randrange(500), None if rng.random() < 0.2 else f"t{rng.randrange(3000)}", None) for _ in range(n)]


def check(profile, rows):
    told = {r["column"]: r for r in profile.collect()}
    for i, c in ((1, "v"), (2, "n"), (3, "t"), (4, "empty")):
        r, values = told[c], [x[i] for x in rows if x[i] is not None]
        assert (r.rows, r.missing) == (len(rows), len(rows) - len(values))
        assert abs(r.distinct - len(set(values))) <= max(DISTINCT_ERROR * len(set(values)), 1)
        numbers = sorted(values) if c in "vn" else []
        if not numbers:
            assert r.numbers == 0 and r["mean"] is r.quantiles is r.low is None
            continue
        assert (r.low, r.high, r.numbers) == (numbers[0], numbers[-1], len(numbers))
        assert r["mean"] == pytest.approx(statistics.fmean(numbers))
        assert r["std"] == (pytest.approx(statistics.stdev(numbers), rel=1e-4) if len(numbers) > 1 else None)
        for p, q in zip(PROBABILITIES, r.quantiles, strict=True):
            low, high = bisect.bisect_left(numbers, q), bisect.bisect_right(numbers, q)
            assert low / len(numbers) - RANK_ERROR <= p <= high / len(numbers) + RANK_ERROR
    lengths = [len(x[3]) for x in rows if x[3] is not None]
    assert told["t"].avg_length == (pytest.approx(statistics.fmean(lengths)) if lengths else None)


def test_merged_parts_are_the_whole(spark):
    parts = {d: rows_of(d, n, d) for d, n in (("a", 5000), ("b", 300), ("c", 1))}
    rows = [r for p in parts.values() for r in p]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = store_profiles(profile_parts(df, "day"), new_path(spark, "profiles"))
    check(merge_profiles(read_profiles(spark, path)), rows)
    by_part = merge_profiles(read_profiles(spark, path), ["part"])
    for d, own in parts.items():
        check(by_part.where(by_part.part == d), own)


def test_a_new_part_costs_only_itself_and_a_second_writing_replaces(spark):
    path = new_path(spark, "profiles")
    days = {d: rows_of(d, 400, d) for d in "abc"}
    for d in "abc":
        store_profiles(profile_parts(spark.createDataFrame(days[d], SCHEMA), "day"), path)
    days["b"] = rows_of("b", 250, "again")
    store_profiles(profile_parts(spark.createDataFrame(days["b"], SCHEMA), "day"), path)
    check(merge_profiles(read_profiles(spark, path)), [r for p in days.values() for r in p])
    plan = merge_profiles(read_profiles(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_shares_and_empty_tables(spark):
    df = spark.range(1000).selectExpr("'x' AS day", "double(id) AS v")
    profiles = profile_parts(df, "day")
    shares = {r.value: r.share for r in share_below(profiles, "v", [-1.0, 249.0, 999.0]).collect()}
    assert shares[-1.0] == 0 and shares[999.0] == 1 and abs(shares[249.0] - 0.25) <= RANK_ERROR
    assert share_below(profiles, "w", [1.0]).collect() == []
    assert profile_parts(df.where("v < 0"), "day").collect() == []
