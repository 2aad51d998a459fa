"""Cells filled from nearest rows, against all distances."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarnish.operators.neighbours import coordinates, impute_nearest, nearest_points


def scaled(rows, width):
    x = np.array([[np.nan if v is None else v for v in r[:width]] for r in rows], float)
    std = np.nanstd(x, axis=0)
    out = np.where(std > 0, (x - np.nanmean(x, axis=0)) / np.where(std > 0, std, 1), 0.0)
    return np.nan_to_num(out)


def by_all_distances(rows, width, k):
    """The mean (or vote) for each row with a missing last value."""
    x, values = scaled(rows, width), [r[width] for r in rows]
    points = defaultdict(list)
    for p, v in zip(map(tuple, x), values):
        if v is not None:
            points[p].append(v)
    out = {}
    for i, (p, v) in enumerate(zip(map(tuple, x), values)):
        if v is not None:
            continue
        left, total, votes = k, 0.0, Counter()
        for q in sorted(points, key=lambda q: (sum((a - b) ** 2 for a, b in zip(p, q)), q)):
            own = sorted(points[q]) if isinstance(points[q][0], str) else points[q]
            take = min(left, len(own))
            if isinstance(own[0], str):
                votes.update(own[:take])
            else:
                total += take * np.mean(own)
            left -= take
            if not left:
                break
        out[i] = min(votes, key=lambda t: (-votes[t], t)) if votes else total / (k - left)
    return out


def table_of(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.choice([rng.gauss(0, 1), rng.gauss(30, 9), 7.0])
        rows.append((a, None if rng.random() < 0.2 else 3 * a + rng.gauss(0, 0.5), "low" if a < 5 else "high"))
    return rows


def test_one_feature_is_exact(spark):
    rows = table_of(600)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, b double, c string").repartition(6)
    got = {r.id: r.b for r in impute_nearest(df, ["b"], ["a"], k=4).collect()}
    wanted = by_all_distances([(r[0], r[1]) for r in rows], 1, 4)
    assert set(got) == set(range(600))
    for i, r in enumerate(rows):
        assert got[i] == pytest.approx(wanted[i] if r[1] is None else r[1])


def test_votes_of_texts(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1), None if rng.random() < 0.3 else rng.choice("xyz")) for _ in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, c string").repartition(4)
    got = {r.id: r.c for r in impute_nearest(df, ["c"], ["a"], k=3).collect()}
    wanted = by_all_distances(rows, 1, 3)
    assert {i: got[i] for i in wanted} == wanted


@pytest.mark.parametrize("width", [2, 4, 6])
def test_recall_with_more_features(spark, width):
    rng = np.random.default_rng(width)
    n, k = 6000, 10
    centres = rng.normal(0, 4, (20, width))
    x = centres[rng.integers(0, 20, n)] + rng.normal(0, 1, (n, width))
    holes = rng.random(n) < 0.05
    names = [f"f{j}" for j in range(width)]
    rows = [(i, *map(float, x[i]), None if holes[i] else float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names) + ", v double").repartition(8)
    near = nearest_points(df, "v", coordinates(df, names), k).collect()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    known = np.flatnonzero(~holes)
    found = wanted = 0
    for r in near:
        p = np.array([r[f"x{j}"] for j in range(width)])
        true = set(known[np.argsort(((z[known] - p) ** 2).sum(axis=1))[:k]].tolist())
        found += len(true & {int(e.value) for e in r.near})
        wanted += k
    assert len(near) == holes.sum() and found / wanted >= 0.9, found / wanted


def test_many_equal_rows_and_odd_features(spark):
    rows = [(1.0, 2.0)] * 3000 + [(1.0, None)] * 2000 + [(None, 5.0), (None, None), (float("nan"), None), (9.0, None), (9.5, 4.0)]
    df = spark.createDataFrame([(i, *r, 3) for i, r in enumerate(rows)], "id long, a double, v double, same int")
    got = {r.id: r.v for r in impute_nearest(df, ["v"], ["a", "same"], k=3).collect()}
    assert all(got[i] == 2.0 for i in range(5000)) and len(got) == len(rows)
    # The mean of a: the missing feature's place, where one row knows 5 and the many are next.
    assert got[5001] == got[5002] == pytest.approx((5.0 + 2 * 2.0) / 3)
    assert got[5003] == pytest.approx((4.0 + 5.0 + 2.0) / 3) or got[5003] == pytest.approx((4.0 + 2 * 2.0) / 3)


def test_integers_nothing_known_and_wrong_arguments(spark):
    df = spark.createDataFrame([(1.0, 3, None), (2.0, 4, None), (1.4, None, None)], "a double, n int, never double")
    got = impute_nearest(df, ["n", "never"], ["a"], k=2)
    assert got.dtypes == df.dtypes
    assert sorted(map(tuple, got.collect())) == [(1.0, 3, None), (1.4, 4, None), (2.0, 4, None)]
    for wrong in ({"features": []}, {"features": ["n"]}, {"k": 0}, {"k": 100}):
        with pytest.raises(ValueError):
            impute_nearest(df, ["n"], **{"features": ["a"], "k": 2, **wrong})
    assert impute_nearest(df.where("a > 9"), ["n"], ["a"]).collect() == []


def test_no_cross_join_and_bounded_blocks(spark):
    df = spark.createDataFrame([(float(i), None if i % 9 == 0 else 1.0) for i in range(2000)], "a double, v double")
    plan = impute_nearest(df, ["v"], ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
