"""Relationships of generated columns: what they promise, and what they refuse."""

import numpy as np
import pytest

from tarnish.functions.draws import Draws
from tarnish.queries.generated import RELATED
from tarnish.sources.generate import generate_columns, generate_table
from tarnish.sources.relationships import plan_of
from tarnish.sources.spec import CategoricalColumn, NumericColumn, TableSpec


def spec_of(relationships, columns=("a", "b", "c", "d")):
    return TableSpec("t", [NumericColumn(c) for c in columns], num_rows=100, relationships=relationships)


def link(kind, target, *sources, **parameters):
    return {"type": kind, "target_column": target, "source_columns": list(sources), "parameters": parameters}


def derived(target, *sources):
    return link("derived", target, *sources, expression=" + ".join(sources))


def test_projections_are_in_order():
    plan = plan_of(spec_of([derived("a", "b", "c"), derived("b", "c"), derived("d", "a")]))
    assert plan.levels == [["c"], ["b"], ["a"], ["d"]]


@pytest.mark.parametrize(
    "relationships, told",
    [
        ([derived("a", "b"), derived("b", "c"), derived("c", "a")], "circle: a -> b -> c -> a"),
        ([derived("a", "a")], "circle"),
        ([derived("a", "b"), derived("a", "c")], "two relationships"),
        ([derived("a", "z")], "no column 'z'"),
        ([link("derived", "a", "b")], "expression"),
        ([link("conditional", "a", "b")], "cases"),
        ([link("correlation", "a", "b", strength=1.5)], "strength"),
        ([link("correlation", "a", "a", strength=0.5)], "itself"),
        ([link("correlation", "a", "b", strength=0.9), link("correlation", "b", "c", strength=0.9), link("correlation", "a", "c", strength=-0.9)], "contradict"),
        ([link("correlation", "a", "b", strength=0.9), derived("a", "c")], "derived"),
        ([link("causal", "a", "b")], "unknown relationship"),
    ],
)
def test_what_cannot_hold_is_refused(relationships, told):
    with pytest.raises(ValueError, match=told):
        plan_of(spec_of(relationships))


def test_strengths_and_marginals(spark):
    """Correlations of the normal scores are the strengths; each distribution is what it was without them."""
    columns = [
        NumericColumn("n", mean=10, std=2, decimals=8),
        NumericColumn("u", distribution="uniform", decimals=8),
        NumericColumn("e", distribution="exponential", mean=3, decimals=8),
        NumericColumn("alone", decimals=8),
    ]
    strengths = {("n", "u"): 0.7, ("u", "e"): -0.3, ("n", "e"): 0.2}
    spec = TableSpec("t", columns, num_rows=40000, relationships=[link("correlation", b, a, strength=r) for (a, b), r in strengths.items()])
    got = generate_table(spark, spec).toPandas()

    def scores(name):
        from statistics import NormalDist

        ranks = got[name].rank(method="first").to_numpy()
        return np.array([NormalDist().inv_cdf((r - 0.5) / len(got)) for r in ranks])

    for (a, b), r in strengths.items():
        assert abs(np.corrcoef(scores(a), scores(b))[0, 1] - r) < 0.02
    assert abs(np.corrcoef(scores("n"), scores("alone"))[0, 1]) < 0.02
    assert abs(got.n.mean() - 10) < 0.05 and abs(got.n.std() - 2) < 0.05
    assert abs(got.u.mean() - 0.5) < 0.01 and abs(got.u.var() - 1 / 12) < 0.002
    assert abs(got.e.mean() - 3) < 0.08 and abs(got.e.quantile(0.9) - 3 * np.log(10)) < 0.25


def test_conditions_and_derivations_hold(spark):
    from dataclasses import replace

    got = generate_table(spark, replace(RELATED, num_rows=5000)).toPandas()
    assert set(got.tier[got.age >= 65]) == {"silver", "gold"} and set(got.tier[got.age < 21]) == {"basic"}
    assert got.rebate[got.tier == "gold"].between(10, 20).all() and got.rebate[got.tier == "basic"].between(0, 2).all()
    assert got.closed[got.tier != "basic"].isna().all() and got.closed[got.tier == "basic"].notna().all()
    assert np.allclose(got.total, got.quantity * got.price * (100 - got.rebate) / 100, atol=0.0051)
    assert (got["size"][got.total >= 1500] == "large").all()
    assert list(got.columns)[1:] == [c.name for c in RELATED.columns]


def test_one_map_only_job_and_repeatable(spark):
    ids = spark.range(500).withColumnRenamed("id", "k")
    made = generate_columns(ids, RELATED, Draws(3, ("k",)))
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    again = generate_columns(ids.repartition(7), RELATED, Draws(3, ("k",)))
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_a_derived_null_stays_null(spark):
    spec = TableSpec(
        "t",
        [CategoricalColumn("c", ["x"]), NumericColumn("v", min_value=1, max_value=5)],
        num_rows=10,
        relationships=[link("derived", "v", "c", expression="CASE WHEN c = 'y' THEN 1 END")],
    )
    assert {r.v for r in generate_table(spark, spec).collect()} == {None}


def test_kept_columns_must_not_clash(spark):
    with pytest.raises(ValueError, match="kept"):
        generate_columns(spark.range(3).withColumnRenamed("id", "a"), spec_of([derived("b", "c")]), Draws(1, ("a",)))
