"""Profiles that are stored for each part of a table and merged, so a new part costs only itself.

A part (a day, a dataset, a source) has one row for each column: exact counts,
extremes and moments, an HLL sketch of its distinct values and a KLL sketch of its
numbers. All of these merge: the profile of any set of parts is one aggregation
over their rows, however large the parts were. Parts lie in a folder by their
name, and writing a part again replaces it.

Counts, extremes and means of merged profiles are those of the whole table (means
and deviations up to rounding). Distinct counts err by ``DISTINCT_ERROR`` or less
in 99 of 100 cases, quantiles by ``RANK_ERROR`` of the rows likewise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.families import NUMERIC, data_columns, family_of, require_columns, type_of

#: Buckets of the HLL sketches, as a power of two, and values the KLL sketches keep.
HLL_BITS = 14
KLL_VALUES = 400
#: Three standard errors of the one, the stated error of the other with room for merges.
DISTINCT_ERROR = 0.025
RANK_ERROR = 0.01

PART = "part"
PROBABILITIES = (0.05, 0.25, 0.5, 0.75, 0.95)

_FIELDS = (
    "column string, rows bigint, missing bigint, low double, high double, mean double, "
    "squares double, numbers bigint, lengths bigint, distinct_sketch binary, quantile_sketch binary"
)


def _measures(df: DataFrame, c: str, i: int) -> list[Column]:
    value = F.col(c)
    # Values of any type are told apart by a hash; numbers without NaN have the rest.
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double")) if family_of(type_of(df, c)) == NUMERIC else F.lit(None).cast("double")
    text = value if isinstance(type_of(df, c), T.StringType) else F.lit(None).cast("string")
    return [
        F.count("*").alias(f"rows{i}"),
        F.count_if(value.isNull()).alias(f"missing{i}"),
        F.min(number).alias(f"low{i}"),
        F.max(number).alias(f"high{i}"),
        F.avg(number).alias(f"mean{i}"),
        # Sum of squared differences from the part's own mean.
        (F.var_pop(number) * F.count(number)).alias(f"squares{i}"),
        F.count(number).alias(f"numbers{i}"),
        F.sum(F.length(text)).alias(f"lengths{i}"),
        F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), HLL_BITS).alias(f"distinct_sketch{i}"),
        F.kll_sketch_agg_double(number, KLL_VALUES).alias(f"quantile_sketch{i}"),
    ]


def profile_parts(df: DataFrame, part: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each part and column; ``part`` names a column or is an expression. One aggregation over ``df``."""
    named = df.withColumn(f"_{PART}", F.col(part) if isinstance(part, str) else part)
    chosen = list(columns or [c for c in data_columns(df) if c != part])
    require_columns(df, chosen)
    wide = named.groupBy(F.col(f"_{PART}").alias(PART)).agg(*(m for i, c in enumerate(chosen) for m in _measures(df, c, i)))
    names = [f.split()[0] for f in _FIELDS.split(", ")][1:]
    entries = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{n}{i}").alias(n) for n in names)) for i, c in enumerate(chosen)))
    return wide.select(PART, F.explode(entries).alias("_entry")).select(PART, "_entry.*")


def store_profiles(profiles: DataFrame, path: str) -> str:
    """Write parts to the folder; those it has already are replaced, the others stay as they are."""
    profiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return path


def read_profiles(spark: SparkSession, path: str, part_type: str = "string") -> DataFrame:
    return spark.read.schema(f"{_FIELDS}, {PART} {part_type}").parquet(path)


def merge_profiles(profiles: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """The profile of all parts together, or of each group of ``by`` columns of ``profiles``.

    (column, rows, missing, distinct, numbers, low, high, mean, std, avg_length, quantiles): NULL where a column has none.
    """
    keys = [*by, "column"]
    n, mean = F.col("numbers"), F.col("mean")
    whole = profiles.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.sum("numbers").alias("numbers"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        (F.sum(mean * n) / F.sum(n)).alias("mean"),
        # Within the parts, and between their means (weighted by how many numbers each has).
        F.sum("squares").alias("_within"),
        F.sum(n * mean * mean).alias("_means"),
        F.sum("lengths").alias("_lengths"),
        F.kll_merge_agg_double("quantile_sketch", KLL_VALUES).alias("_sketch"),
    )
    between = F.greatest(F.col("_means") - F.col("numbers") * F.col("mean") * F.col("mean"), F.lit(0.0))
    has_numbers = F.col("numbers") > 0
    return whole.select(
        *keys,
        "rows",
        "missing",
        "distinct",
        "numbers",
        "low",
        "high",
        F.when(has_numbers, F.col("mean")).alias("mean"),
        F.when(F.col("numbers") > 1, F.sqrt((F.col("_within") + between) / (F.col("numbers") - 1))).alias("std"),
        (F.col("_lengths") / (F.col("rows") - F.col("missing"))).alias("avg_length"),
        F.when(has_numbers, F.kll_sketch_get_quantile_double(F.col("_sketch"), F.array(*(F.lit(float(p)) for p in probabilities)))).alias("quantiles"),
    )


def share_below(profiles: DataFrame, column: str, values: Sequence[float]) -> DataFrame:
    """(value, share): about what share of a column's numbers is at or below each value, from the stored sketches."""
    sketch = profiles.where((F.col("column") == column) & (F.col("numbers") > 0)).agg(F.kll_merge_agg_double("quantile_sketch", KLL_VALUES).alias("s"), F.count("*").alias("n"))
    asked = F.array(*(F.lit(float(v)) for v in values))
    shares = F.kll_sketch_get_rank_double(F.col("s"), asked)
    return sketch.where("n > 0").select(F.explode(F.arrays_zip(asked.alias("value"), shares.alias("share"))).alias("e")).select("e.*")
