"""Synthetic columns as expressions over row keys.

Each value is a function of (seed, column name, row key), so a table of any
size is one map-only job: no shuffle, no state, the same rows under any
partitioning. ``generate_table`` numbers the rows with ``spark.range``;
``generate_columns`` adds the same columns to a table that has keys already.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnish.functions.draws import Draws, StagedDraws
from tarnish.functions.families import ROW_ID, data_columns
from tarnish.sources.relationships import generate_related
from tarnish.sources.spec import CategoricalColumn, ColumnSpec, DatetimeColumn, NumericColumn, TableSpec

#: Steps a lookup may have as nested conditions; longer ones are nested by blocks.
TREE_STEPS = 64
_DAY = timedelta(days=1)
_SECONDS_PER_DAY = 86400


def step(u: Column, bounds: Sequence[float], leaves: Sequence[Column]) -> Column:
    """``leaves[i]`` for the number ``i`` of bounds at or below ``u``, by halving."""
    if not bounds:
        return leaves[0]
    middle = len(bounds) // 2
    return F.when(u < F.lit(bounds[middle]), step(u, bounds[:middle], leaves[: middle + 1])).otherwise(
        step(u, bounds[middle + 1 :], leaves[middle + 1 :])
    )


def count_below(u: Column, bounds: Sequence[float]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``u``, as a double.

    Many bounds are halved down to a block, and the block is counted.
    """
    if len(bounds) <= TREE_STEPS:
        return step(u, bounds, [F.lit(float(i)) for i in range(len(bounds) + 1)])
    size = math.ceil(len(bounds) / TREE_STEPS)
    blocks = [(i, bounds[i : i + size]) for i in range(0, len(bounds), size)]

    def counted(before: int, block: Sequence[float]) -> Column:
        held = F.array(*(F.lit(b) for b in block))
        return F.lit(float(before)) + F.size(F.filter(held, lambda b: b <= u)).cast("double")

    return step(u, [block[0] for _, block in blocks[1:]], [counted(*b) for b in blocks])


def _cumulative(mode: int, last: float, log_term: Callable[[int], float]) -> tuple[int, list[float]]:
    """The first value whose probability counts at the resolution of a draw, and the sums from there on.

    Terms are taken from the most likely value outwards, so that none underflows
    before it is too small to matter.
    """
    least = math.log(2.0**-53) - 12
    low, high = mode, mode
    while low > 0 and log_term(low - 1) > least:
        low -= 1
    while high < last and log_term(high + 1) > least:
        high += 1
    out, total = [], 0.0
    for k in range(low, high + 1):
        total += math.exp(log_term(k))
        out.append(min(total, 1.0))
        if total >= 1.0 - 1e-15:
            break
    return low, out


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """The first value, and the cumulative probabilities from it up to the resolution of a draw."""
    if rate <= 0:
        return 0, []
    return _cumulative(int(rate), math.inf, lambda k: k * math.log(rate) - rate - math.lgamma(k + 1))


def binomial_steps(n: int, p: float) -> tuple[int, list[float]]:
    """The first number of successes, and the cumulative probabilities from it, below ``n``."""
    if p <= 0 or n <= 0:
        return 0, []
    if p >= 1:
        return n, []
    ways = math.lgamma(n + 1)

    def log_term(k: int) -> float:
        return ways - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)

    low, out = _cumulative(min(n, int((n + 1) * p)), n, log_term)
    # The last value needs no bound: what is left is its own.
    return low, out[: n - low]


def drawn_count(u: Column, first: int, bounds: Sequence[float]) -> Column:
    """The value that a uniform draw stands for, as a double."""
    counted = count_below(u, bounds)
    return counted + F.lit(float(first)) if first else counted


def _normal(c: NumericColumn, draws: StagedDraws) -> Column:
    mean = 0.0 if c.mean is None else float(c.mean)
    std = 1.0 if c.std is None else float(c.std)
    return F.lit(mean) + F.lit(std) * draws.normal(c.name)


def _uniform(c: NumericColumn, draws: StagedDraws) -> Column:
    low = 0.0 if c.min_value is None else float(c.min_value)
    high = 1.0 if c.max_value is None else float(c.max_value)
    return F.lit(low) + F.lit(high - low) * draws.uniform(c.name, "value")


def _exponential(c: NumericColumn, draws: StagedDraws) -> Column:
    """Scale ``mean``, moved up by the minimum (so the mean is minimum + scale)."""
    scale = 1.0 if c.mean is None else float(c.mean)
    shift = 0.0 if c.min_value is None else float(c.min_value)
    return F.lit(shift) - F.lit(scale) * F.log(F.lit(1.0) - draws.uniform(c.name, "value"))


def _poisson(c: NumericColumn, draws: StagedDraws) -> Column:
    rate = 5.0 if c.mean is None else float(c.mean)
    return drawn_count(draws.uniform(c.name, "value"), *poisson_steps(rate))


def _binomial(c: NumericColumn, draws: StagedDraws) -> Column:
    n = 10 if c.max_value is None else int(c.max_value)
    p = 0.5 if c.mean is None else min(max(c.mean / n, 0.0), 1.0)
    return drawn_count(draws.uniform(c.name, "value"), *binomial_steps(n, p))


DISTRIBUTION_COLUMNS = {
    "normal": _normal,
    "uniform": _uniform,
    "exponential": _exponential,
    "poisson": _poisson,
    "binomial": _binomial,
}


def _within_limits(c: NumericColumn, x: Column) -> Column:
    if c.min_value is not None:
        x = F.greatest(x, F.lit(float(c.min_value)))
    if c.max_value is not None:
        x = F.least(x, F.lit(float(c.max_value)))
    if not c.allow_negative:
        x = F.abs(x)
        if c.min_value is not None:
            x = F.greatest(x, F.lit(float(c.min_value)))
    return x


def numeric_expression(c: NumericColumn, draws: StagedDraws) -> Column:
    if c.unique:
        if len(draws.key) != 1:
            raise ValueError(f"{c.name}: a unique column needs a single integer row key")
        return (F.col(draws.key[0]) + F.lit(int(c.min_value or 0))).cast("bigint")
    x = _within_limits(c, DISTRIBUTION_COLUMNS[c.distribution](c, draws))
    if c.integer:
        return F.rint(x).cast("bigint")
    scale = F.lit(float(10**c.decimals))
    return F.rint(x * scale) / scale


def _stamp(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _weekday_date(c: DatetimeColumn, draws: StagedDraws) -> Column:
    """A Monday-to-Friday date of the range, drawn by its number.

    Counting from the Monday on or before the start, working day ``k`` lies
    ``k // 5`` weeks and ``k % 5`` days later, so no draw has to be repeated.
    """
    first = datetime(c.start.year, c.start.month, c.start.day)
    last = c.end - timedelta(microseconds=1)
    days = (datetime(last.year, last.month, last.day) - first).days + 1
    working = sum(1 for d in range(min(days % 7, days)) if (first + d * _DAY).weekday() < 5) + days // 7 * 5
    if working == 0:
        raise ValueError(f"{c.name}: no working day between {c.start_date} and {c.end_date}")
    while first.weekday() >= 5:
        first += _DAY
    monday = first - first.weekday() * _DAY
    k = F.lit(first.weekday()) + draws.choice(working, c.name, "day")
    return F.date_add(F.lit(monday.date()), F.floor(k / F.lit(5)).cast("int") * F.lit(7) + k % F.lit(5))


def datetime_expression(c: DatetimeColumn, draws: StagedDraws) -> Column:
    """Uniform over [start, end); date only unless ``include_time``."""
    if c.weekdays_only:
        micros = F.floor(draws.uniform(c.name, "value") * F.lit(float(_SECONDS_PER_DAY * 10**6)))
        start = _weekday_date(c, draws).cast("timestamp_ntz")
    else:
        span = (c.end - c.start) // timedelta(microseconds=1)
        micros = F.floor(draws.uniform(c.name, "value") * F.lit(float(span)))
        start = _stamp(c.start)
    at = F.timestamp_add("MICROSECOND", micros.cast("bigint"), start)
    midnight = at.cast("date").cast("timestamp_ntz")
    if not c.include_time:
        return midnight
    if c.business_hours_only:
        hour = F.lit(9) + draws.choice(8, c.name, "hour")
        seconds = hour * F.lit(3600) + F.minute(at) * F.lit(60) + F.second(at)
        return F.timestamp_add("SECOND", seconds.cast("bigint"), midnight)
    return at


def categorical_expression(c: CategoricalColumn, draws: StagedDraws) -> Column:
    bounds, total = [], 0.0
    for weight in c.weights[:-1]:
        total += weight
        bounds.append(total)
    u = draws.uniform(c.name, "value")
    if len(bounds) <= TREE_STEPS:
        return step(u, bounds, [F.lit(v) for v in c.values])
    return F.element_at(F.array(*(F.lit(v) for v in c.values)), count_below(u, bounds).cast("int") + 1)


def column_expression(c: ColumnSpec, draws: StagedDraws) -> Column:
    if isinstance(c, NumericColumn):
        return numeric_expression(c, draws)
    if isinstance(c, DatetimeColumn):
        return datetime_expression(c, draws)
    return categorical_expression(c, draws)


def generate_columns(df: DataFrame, spec: TableSpec, draws: Draws, keep: Sequence[str] | None = None) -> DataFrame:
    """The spec's columns for every row of ``df``, after its ``keep`` columns (default: the key).

    Relationships between the columns are applied; without them all is one projection.
    """
    if spec.relationships:
        return generate_related(df, spec, draws, keep)
    kept = list(draws.key if keep is None else keep)
    staged = draws.staged()
    made = [column_expression(c, staged).alias(c.name) for c in spec.columns]
    return staged.select(df, *kept, *made)


def generate_table(
    spark: SparkSession,
    spec: TableSpec,
    seed: int = 42,
    method: str = "xxhash64",
    partitions: int | None = None,
) -> DataFrame:
    """A table of ``spec.num_rows`` rows with a ``_row_id`` key of 0..n-1."""
    ids = spark.range(0, spec.num_rows, 1, partitions).withColumnRenamed("id", ROW_ID)
    return generate_columns(ids, spec, Draws(seed, (ROW_ID,), method))


def verify_generated(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: expected and actual rows and columns, and the nulls found."""
    columns = data_columns(df)
    nulls = F.lit(0).cast("bigint")
    for c in columns:
        nulls = nulls + F.count_if(F.col(c).isNull())
    return df.agg(
        F.lit(spec.num_rows).cast("bigint").alias("expected_rows"),
        F.count("*").alias("rows"),
        F.lit(len(spec.columns)).alias("expected_columns"),
        F.lit(len(columns)).alias("columns"),
        nulls.alias("nulls"),
    )


def check_generated(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` itself, after raising if its shape is not the spec's; nulls are warned of."""
    found = verify_generated(df, spec).first()
    if found["nulls"]:
        warnings.warn(f"{spec.name}: {found['nulls']} generated cells are null", stacklevel=2)
    if found["rows"] != spec.num_rows or found["columns"] != len(spec.columns):
        raise ValueError(
            f"{spec.name}: {found['rows']} rows x {found['columns']} columns, "
            f"expected {spec.num_rows} x {len(spec.columns)}"
        )
    return df
