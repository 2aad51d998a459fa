"""The search for quantiles of large groups: one sketch of a value, and passes over keys and numbers only."""

import numpy as np
from pyspark.sql import functions as F

from tarnish.functions.quantiles import _Search, group_quantiles


def test_all_ranks_share_the_first_sketch(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.exponential(3, 4000), np.full(900, 2.0), [np.inf, -np.inf] * 50])
    df = spark.createDataFrame([("ab"[i % 2], float(v)) for i, v in enumerate(values)], "g string, v double")
    search = _Search(df, {"v": F.col("v")}, ["g"], 10)
    state = search.start(lambda _, n: [F.lit(1000).cast("long"), F.lit(1001).cast("long")])
    assert search.of == [0, 0]
    # The first places are values of the sketch, not the whole line.
    assert all(r["in0"] < 500 and np.isfinite(r["lo0"]) and np.isfinite(r["hi0"]) for r in state.collect())
    found = {r["g"]: r["v"] for r in group_quantiles(df, {"v": F.col("v")}, [0.3, 0.5], ["g"], gather_rows=10).collect()}
    for i, g in enumerate("ab"):
        assert np.allclose(found[g], np.quantile(values[i::2], [0.3, 0.5]))
