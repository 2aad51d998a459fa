"""Row samples, shuffles and heads that give the same rows on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnish.functions.draws import Draws
from tarnish.functions.quantiles import kth_smallest
from tarnish.functions.storage import through_table
from tarnish.sources.generate import drawn_count, poisson_steps


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps ``n`` rows at most."""
    return df.orderBy(*order_by).limit(n)


def sample_rate(df: DataFrame, rate: float, draws: Draws) -> DataFrame:
    """Each row with probability ``rate``, in one pass."""
    return df.filter(draws.below(rate, "sample"))


def sample_exact(df: DataFrame, rate: float, draws: Draws) -> DataFrame:
    """Exactly ``int(n * rate)`` rows, without replacement and without a sort."""
    size = int(df.count() * rate)
    draw = draws.uniform("sample")
    limit = kth_smallest(df, {"u": draw}, {"u": size})["u"]
    return df.limit(0) if limit is None else df.filter(draw <= F.lit(limit))


def sample_with_replacement(df: DataFrame, rate: float, draws: Draws) -> DataFrame:
    """About ``n * rate`` draws; a row drawn several times comes with ``draw`` 1, 2, ..."""
    staged = draws.staged()
    times = drawn_count(staged.uniform("sample", "copies"), *poisson_steps(rate)).cast("int")
    drawn = staged.select(df, *df.columns, times.alias("_times")).filter(F.col("_times") > 0)
    return drawn.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("draw"))


def shuffle(df: DataFrame, draws: Draws) -> DataFrame:
    """Rows in random order (a range-partitioned sort on a draw)."""
    return df.orderBy(draws.uniform("shuffle"), *draws.key)


def shuffled_positions(df: DataFrame, draws: Draws) -> DataFrame:
    """``df`` with the position (0..n-1) of each row in a random order.

    Ranked inside range partitions, then moved up by the rows of the partitions
    before; a global rank would put the whole table into one task.
    """
    parted = (
        df.withColumn("_u", draws.uniform("shuffle"))
        .repartitionByRange("_u", *draws.key)
        .withColumn("_slice", F.spark_partition_id())
    )
    # Written down, so that ranks and sizes refer to one slicing.
    sliced = through_table(parted, "shuffle")
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice in this window.
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy("_u", *draws.key))
    return (
        sliced.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_slice")
        .select(*df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("bigint").alias("position"))
    )
