"""Fills that look ahead take linear time: no frame that reaches to the end of a slice."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnish.operators.fill import fill_along


@pytest.mark.parametrize("how", ["back_fill", "interpolate"])
def test_no_frame_runs_from_each_row_to_the_end(spark, how):
    n = 300
    rows = [(i, None if i % 7 or i > 280 else float(i * i)) for i in range(1, n)]
    df = spark.createDataFrame(rows, "id long, v double")
    filled = fill_along(df, ["v"], how, ["id"], slices=1)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RowFrame, currentrow$(), unboundedfollowing$())" not in plan
    v = pd.DataFrame(rows, columns=["id", "v"])["v"]
    expected = v.bfill() if how == "back_fill" else v.interpolate()
    got = filled.toPandas().sort_values("id")["v"]
    np.testing.assert_allclose(got.to_numpy(), expected.to_numpy())


def test_the_frame_is_named_so(spark):
    """What the test above looks for is what Spark prints."""
    frame = Window.orderBy("id").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    plan = spark.range(3).withColumn("x", F.first("id").over(frame))._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RowFrame, currentrow$(), unboundedfollowing$())" in plan
