"""Missing cells filled from the nearest rows.

Rows with the same features are one point, so a point that a third of all rows
share costs as much as any other. Points are laid along curves: their standardised
features are turned and shifted at random, and the bits of the coordinates are
woven together (each curve walks through the nested cells of a 2^d-tree). Along
each curve the known points get positions and blocks of ``window`` of them; a
point with missing cells meets the known ones of its own block and of the blocks
before and after. So a join matches at most ``3 * window`` known points for each
point and curve, however the data are spread, and their exact distances decide.
There is no cross join, and with one feature the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.families import is_integer, require_columns, type_of
from tarnish.functions.storage import through_table

CURVES = 6
WINDOW = 64
#: A curve's key has 62 bits; with more features a coordinate would have less than four of them.
MAX_FEATURES = 15


def _turned(features: int, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A rotation and a shift for each curve; the first curve has neither."""
    rng = np.random.default_rng(seed)
    out = [(np.eye(features), np.zeros(features))]
    for _ in range(curves - 1):
        out.append((np.linalg.qr(rng.normal(size=(features, features)))[0], rng.random(features)))
    return out


def _curve_key(coordinates: Sequence[Column], turn: np.ndarray, shift: np.ndarray) -> Column:
    """The place on one curve: woven bits of squashed, shifted coordinates."""
    bits = min(62 // len(coordinates), 20) if len(coordinates) > 1 else 52
    cells = []
    for row, by in zip(turn, shift, strict=True):
        at = sum((F.lit(float(w)) * x for w, x in zip(row[1:], coordinates[1:], strict=True)), F.lit(float(row[0])) * coordinates[0])
        squashed = (at / (F.lit(1.0) + F.abs(at)) + F.lit(1.0)) / F.lit(2.0)
        cells.append(F.floor((squashed + F.lit(float(by))) / F.lit(2.0) * F.lit(float(2**bits))).cast("bigint"))
    if len(cells) == 1:
        return cells[0]
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(cells) + i))
    return key


def coordinates(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """The standardised features; one that is missing, no number or the same everywhere says nothing."""
    raw = [F.col(c).cast("double") for c in features]
    fair = [F.when(~F.isnan(x), x) for x in raw]
    row = df.agg(*(f(x) for x in fair for f in (F.avg, F.stddev_pop))).first()
    out = []
    for i, x in enumerate(fair):
        mean, std = row[2 * i], row[2 * i + 1]
        out.append(F.coalesce((x - F.lit(mean)) / F.lit(std), F.lit(0.0)) if std and math.isfinite(std) else F.lit(0.0))
    return out


def _points(df: DataFrame, target: str, at: Sequence[Column]) -> DataFrame:
    """Distinct coordinates as ``x0``, ``x1``..., with the number and mean of the known values there, and of the missing ones.

    A text target has a row for each value instead of a mean.
    """
    names = [f"x{i}" for i in range(len(at))]
    known = df.select(*(x.alias(n) for x, n in zip(at, names, strict=True)), F.col(target).alias("value"))
    holes = F.count_if(F.col("value").isNull()).alias("holes")
    if isinstance(type_of(df, target), T.StringType):
        return known.groupBy(*names, "value").agg(F.count("value").alias("n"), holes)
    return known.groupBy(*names).agg(F.count("value").alias("n"), F.avg(F.col("value").cast("double")).alias("value"), holes)


def _placed(points: DataFrame, names: Sequence[str], curves: int, window: int, seed: int) -> DataFrame:
    """Each point on each curve, with ``block``: how many known points lie before it, by ``window``."""
    turned = _turned(len(names), curves, seed)
    keys = F.array(*(_curve_key([F.col(n) for n in names], *t) for t in turned))
    laid = points.select("*", F.posexplode(keys).alias("curve", "key"))
    order = ["curve", "key", *names]
    # Range partitions cut the curves into slices, which are written down once.
    parted = laid.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    sliced = through_table(parted.withColumn("known", (F.col("n") > 0).cast("int")), "curves")
    sizes = sliced.groupBy("curve", "slice").agg(F.sum("known").alias("size"))
    before = Window.partitionBy("curve").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each slice of a curve.
    offsets = sizes.select("curve", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    here = Window.partitionBy("curve", "slice").orderBy("key", *names).rowsBetween(Window.unboundedPreceding, -1)
    counted = sliced.withColumn("place", F.coalesce(F.sum("known").over(here), F.lit(0)))
    placed = counted.join(offsets, ["curve", "slice"])
    return placed.withColumn("block", F.floor((F.col("place") + F.col("offset")) / F.lit(window)).cast("bigint"))


def nearest_points(
    df: DataFrame, target: str, at: Sequence[Column], k: int, curves: int = CURVES, window: int = WINDOW, seed: int = 42
) -> DataFrame:
    """For each point with missing cells: its coordinates and ``near``, known points by distance (``distance``, ``at``, ``value``, ``n``).

    ``near`` has the points needed for ``k`` rows; points at one distance come in the order of their coordinates.
    """
    if not 1 <= len(at) <= MAX_FEATURES:
        raise ValueError(f"{target}: 1 to {MAX_FEATURES} features are needed")
    if k < 1 or window < k:
        raise ValueError(f"{target}: k must be 1 to {window}, the window")
    names = [f"x{i}" for i in range(len(at))]
    placed = through_table(_placed(_points(df, target, at), names, curves if len(names) > 1 else 1, window, seed), "placed")
    known = placed.where("n > 0").select(
        "curve", F.explode(F.array(*(F.col("block") + F.lit(d) for d in (-1, 0, 1)))).alias("block"), *(F.col(n).alias(f"y{i}") for i, n in enumerate(names)), "n", "value"
    )
    wanted = placed.where("holes > 0").select("curve", "block", *names).distinct()
    met = wanted.join(known, ["curve", "block"], "left")
    distance = sum(((F.col(n) - F.col(f"y{i}")) * (F.col(n) - F.col(f"y{i}")) for i, n in enumerate(names)), F.lit(0.0))
    one = F.struct(distance.alias("distance"), F.array(*(F.col(f"y{i}") for i in range(len(names)))).alias("at"), "value", "n")
    # Curves may give the same point again; a set holds it once. At most 3 * window points for each curve.
    found = met.groupBy(*names).agg(F.sort_array(F.collect_set(F.when(F.col("n").isNotNull(), one))).alias("near"))
    # A text's values at one point are entries of their own, so k entries may be a few too many, never too few.
    return found.withColumn("near", F.slice("near", 1, k))


def _taken(k: int) -> Column:
    """Entries of ``near`` with ``take``: how many of their rows are among the k nearest."""
    start = F.struct(F.lit(k).cast("bigint").alias("left"), F.array().cast("array<struct<take: bigint, value: string>>").alias("out"))

    def step(done: Column, x: Column) -> Column:
        take = F.least(done["left"], x["n"])
        return F.struct((done["left"] - take).alias("left"), F.concat(done["out"], F.array(F.struct(take.alias("take"), x["value"].cast("string").alias("value")))).alias("out"))

    return F.aggregate("near", start, step, lambda done: F.filter(done["out"], lambda x: x["take"] > 0))


def _mean(k: int) -> Column:
    """Mean of the k nearest rows; the rows of one point count by their mean."""
    start = F.struct(F.lit(k).cast("bigint").alias("left"), F.lit(0.0).alias("total"))

    def step(done: Column, x: Column) -> Column:
        take = F.least(done["left"], x["n"])
        return F.struct((done["left"] - take).alias("left"), (done["total"] + take * x["value"]).alias("total"))

    return F.aggregate("near", start, step, lambda done: F.when(done["left"] < k, done["total"] / (F.lit(k) - done["left"])))


def impute_nearest(
    df: DataFrame, columns: Sequence[str], features: Sequence[str], k: int = 5, curves: int = CURVES, window: int = WINDOW, seed: int = 42
) -> DataFrame:
    """Missing cells of ``columns`` filled from the ``k`` rows with the nearest ``features`` that have a value.

    Numbers get the mean (an integer column the nearest integer), texts the most
    frequent value (of equally frequent ones the least). Distances are Euclidean
    over standardised features; a missing feature counts as the mean. The rows of
    one point count by their mean. Where no row has a value, cells stay missing.
    Found are the k nearest of all points with one feature, and nearly all with more.
    """
    require_columns(df, [*columns, *features])
    if any(not [f for f in features if f != c] for c in columns):
        raise ValueError("a column needs features other than itself")
    for target in columns:
        df = _filled(df, target, [f for f in features if f != target], k, curves, window, seed)
    return df


def _filled(df: DataFrame, target: str, features: Sequence[str], k: int, curves: int, window: int, seed: int) -> DataFrame:
    at = coordinates(df, features)
    names = [f"x{i}" for i in range(len(at))]
    near = nearest_points(df, target, at, k, curves, window, seed)
    kind = type_of(df, target)
    if isinstance(kind, T.StringType):
        votes = near.select(*names, F.explode(_taken(k)).alias("vote")).groupBy(*names, "vote.value").agg(F.sum("vote.take").alias("votes"))
        best = F.min(F.struct((-F.col("votes")).alias("order"), "value"))["value"]
        answers = votes.groupBy(*names).agg(best.alias("answer"))
    else:
        mean = F.rint(_mean(k)) if is_integer(kind) else _mean(k)
        answers = near.select(*names, mean.cast(kind).alias("answer"))
    # Written, so that a point which many rows share is split in the join.
    answers = through_table(answers.where("answer IS NOT NULL").select(*(F.col(n).alias(f"_a{n}") for n in names), F.col("answer").alias("_answer")), "answers")
    own = df.withColumns({"_hole": F.col(target).isNull()} | {f"_{n}": x for n, x in zip(names, at, strict=True)})
    same = [F.col(f"_{n}") == F.col(f"_a{n}") for n in names]
    joined = own.join(answers, [F.col("_hole"), *same], "left")
    return joined.select(*(F.coalesce(c, "_answer").alias(c) if c == target else F.col(c) for c in df.columns))
