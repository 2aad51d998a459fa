"""Error injectors: controlled, repeatable damage to chosen cells and rows.

Each injector is a map-only projection; which cells it hits and what it does to
them are functions of (seed, column, injector, row key). Only the outlier
injector looks at the data first, for its bounds.

``sampling="bernoulli"`` hits each cell with the given probability in the same
pass. ``sampling="exact"`` hits exactly ``int(n * rate)`` cells per column: it
first searches the draw that cuts off that many, still without a sort (rows that
share the very draw at the cut would all be hit; with 52-bit draws that takes a
hash collision exactly there).
"""

from __future__ import annotations

import random
import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions import text
from tarnish.functions.convert import datetime_text, number_text
from tarnish.functions.draws import Draws
from tarnish.functions.families import (
    COPY,
    ROW_ID,
    TEXT,
    datetime_columns,
    family_of,
    is_integer,
    numeric_columns,
    require_columns,
    text_columns,
    type_of,
)
from tarnish.functions.quantiles import exact_quantiles, group_quantiles, kth_smallest
from tarnish.sources.generate import drawn_count, poisson_steps

# What a damaged numeric cell holds instead of a number.
SENTINELS = (-999, 0, 999999)
# Default rates of the injectors.
DEFAULT_RATES = {
    "missing_rate": 0.15,
    "whitespace_rate": 0.20,
    "case_rate": 0.25,
    "special_char_rate": 0.10,
    "duplicate_rate": 0.05,
    "outlier_rate": 0.03,
    "outlier_severity": 2.5,
    "type_corruption_rate": 0.30,
}
# The largest outlier rate, and how far beyond the bounds values go
# (in interquartile ranges, times 0.5 .. 1.5).
MAX_OUTLIER_RATE = 0.05
OUTLIER_MARGIN = 1.2


def _replace(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    return df.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in df.columns))


def _hit_cells(
    df: DataFrame,
    draws: Draws,
    injector: str,
    rate: float,
    columns: Sequence[str],
    sampling: str,
    share_of: str,
    where: Column | None = None,
) -> dict[str, Column]:
    """Per column, a condition that is true for the cells to damage.

    ``share_of`` says what the rate refers to: ``rows`` (any row may be hit),
    ``values`` (non-null cells) or ``rows_with_value`` (as many cells as that
    share of the rows, but only cells that hold a value). ``where`` limits the
    damage to some rows.
    """
    tags = {c: (c, injector, "cell") for c in columns}
    present = {c: F.lit(True) if share_of == "rows" else F.col(c).isNotNull() for c in columns}
    if where is not None:
        if sampling != "bernoulli":
            raise ValueError("a row condition goes with bernoulli sampling only")
        present = {c: where & present[c] for c in columns}
    if sampling == "bernoulli":
        return {c: present[c] & draws.below(rate, *tags[c]) for c in columns}
    if sampling != "exact":
        raise ValueError(f"unknown sampling {sampling!r}; use bernoulli or exact")
    if not columns:
        return {}
    counts = df.agg(F.count("*").alias("rows"), *(F.count_if(present[c]).alias(f"n{i}") for i, c in enumerate(columns))).first()
    sizes = {}
    for i, c in enumerate(columns):
        base = counts[f"n{i}"] if share_of == "values" else counts["rows"]
        sizes[c] = min(int(base * rate), counts[f"n{i}"])
    eligible = {c: F.when(present[c], draws.uniform(*tags[c])) for c in columns}
    limits = kth_smallest(df, eligible, sizes)
    return {
        c: F.lit(False) if limits[c] is None else present[c] & (draws.uniform(*tags[c]) <= F.lit(limits[c]))
        for c in columns
    }


def _pick(draws: Draws, tags: Sequence[str], options: Sequence[Column]) -> Column:
    """One of the options, each as likely, evaluating that option only."""
    n = len(options)
    out = options[-1]
    for i in range(n - 2, -1, -1):
        out = F.when(draws.below((i + 1) / n, *tags), options[i]).otherwise(out)
    return out


def inject_missing(
    df: DataFrame,
    draws: Draws,
    rate: float = DEFAULT_RATES["missing_rate"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    sampling: str = "bernoulli",
    where: Column | None = None,
) -> DataFrame:
    """Numbers become NULL or a sentinel, texts become NULL (two of three) or empty."""
    numbers = [c for c in numeric_columns(df, exclude) if columns is None or c in columns]
    texts = [c for c in text_columns(df, exclude) if columns is None or c in columns]
    hit = _hit_cells(df, draws, "missing", rate, numbers + texts, sampling, "rows", where)
    changed = {}
    for c in numbers:
        as_type = type_of(df, c)
        options = [F.lit(None).cast(as_type), *(F.lit(s).try_cast(as_type) for s in SENTINELS)]
        changed[c] = F.when(hit[c], _pick(draws, (c, "missing", "kind"), options)).otherwise(F.col(c))
    for c in texts:
        emptied = F.when(draws.choice(3, c, "missing", "kind") == F.lit(1), F.lit(""))
        changed[c] = F.when(hit[c], emptied).otherwise(F.col(c))
    return _replace(df, changed)


def _inject_text(df, draws, injector, rate, columns, exclude, sampling, where, damage) -> DataFrame:
    chosen = [c for c in text_columns(df, exclude) if columns is None or c in columns]
    hit = _hit_cells(df, draws, injector, rate, chosen, sampling, "values", where)
    return _replace(df, {c: F.when(hit[c], damage(c, F.col(c))).otherwise(F.col(c)) for c in chosen})


def inject_whitespace(
    df: DataFrame,
    draws: Draws,
    rate: float = DEFAULT_RATES["whitespace_rate"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    sampling: str = "bernoulli",
    where: Column | None = None,
) -> DataFrame:
    """Two spaces before, after or on both sides, or every inner space doubled."""

    def damage(name: str, c: Column) -> Column:
        gap = F.lit("  ")
        options = [F.concat(gap, c), F.concat(c, gap), F.concat(gap, c, gap), F.replace(c, F.lit(" "), gap)]
        return _pick(draws, (name, "whitespace", "kind"), options)

    return _inject_text(df, draws, "whitespace", rate, columns, exclude, sampling, where, damage)


def inject_case(
    df: DataFrame,
    draws: Draws,
    rate: float = DEFAULT_RATES["case_rate"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    sampling: str = "bernoulli",
    where: Column | None = None,
) -> DataFrame:
    """Upper, lower, title or mixed case."""

    def damage(name: str, c: Column) -> Column:
        mixed = text.mixed_case(c, draws.coins(F.char_length(c), name, "case", "coins"))
        return _pick(draws, (name, "case", "kind"), [F.upper(c), F.lower(c), text.title(c), mixed])

    return _inject_text(df, draws, "case", rate, columns, exclude, sampling, where, damage)


def inject_special_characters(
    df: DataFrame,
    draws: Draws,
    rate: float = DEFAULT_RATES["special_char_rate"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    sampling: str = "bernoulli",
    where: Column | None = None,
) -> DataFrame:
    """One symbol three times before or after the text, or twice on both sides."""
    symbols = F.array(*(F.lit(s) for s in text.SPECIAL_CHARACTERS))

    def damage(name: str, c: Column) -> Column:
        symbol = F.element_at(symbols, draws.choice(len(text.SPECIAL_CHARACTERS), name, "special", "symbol") + 1)
        three, two = F.repeat(symbol, F.lit(3)), F.repeat(symbol, F.lit(2))
        options = [F.concat(three, c), F.concat(c, three), F.concat(two, c, two)]
        return _pick(draws, (name, "special", "kind"), options)

    return _inject_text(df, draws, "special", rate, columns, exclude, sampling, where, damage)


def choose_type_columns(
    df: DataFrame, seed: int, rate: float = DEFAULT_RATES["type_corruption_rate"], exclude: Iterable[str] = ()
) -> list[str]:
    """The numeric and datetime columns to turn into text: a share of them, at least one."""
    candidates = numeric_columns(df, exclude) + datetime_columns(df, exclude)
    if not candidates:
        return []
    size = min(len(candidates), max(1, int(len(candidates) * rate)))
    return random.Random(f"{seed}:type_corruption").sample(candidates, size)


def inject_type_errors(
    df: DataFrame,
    draws: Draws,
    rate: float = DEFAULT_RATES["type_corruption_rate"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Whole numeric or datetime columns become text; NULL stays NULL."""
    chosen = choose_type_columns(df, draws.seed, rate, exclude) if columns is None else list(columns)
    require_columns(df, chosen)
    changed = {}
    for c in chosen:
        as_type = type_of(df, c)
        if isinstance(as_type, T.NumericType):
            changed[c] = number_text(F.col(c), as_type)
        elif family_of(as_type) != TEXT:
            changed[c] = datetime_text(F.col(c), as_type)
    return _replace(df, changed)


def outlier_bounds(
    df: DataFrame, columns: Sequence[str], severity: float, by: Sequence[str] = ()
) -> dict[tuple, dict[str, tuple[float, float, float, float]]]:
    """Per group and column: lower bound, upper bound, interquartile range, minimum."""
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.0, 0.25, 0.75], by)
    bounds: dict[tuple, dict[str, tuple[float, float, float, float]]] = {group: {} for group in found}
    for group, quartiles in found.items():
        for c, (smallest, q25, q75) in quartiles.items():
            if smallest is not None:
                iqr = q75 - q25
                bounds.setdefault(group, {})[c] = (q25 - severity * iqr, q75 + severity * iqr, iqr, smallest)
    return bounds


def inject_outliers(
    df: DataFrame,
    draws: Draws,
    rate: float | Column = DEFAULT_RATES["outlier_rate"],
    severity: float | Column = DEFAULT_RATES["outlier_severity"],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    sampling: str = "bernoulli",
    decimals: Mapping[str, int] | None = None,
    where: Column | None = None,
    by: Sequence[str] = (),
    max_rate: float | None = MAX_OUTLIER_RATE,
) -> DataFrame:
    """Values beyond the quartile bounds, high or low by a coin flip.

    A column without negative values gets a high value where the low one would
    be negative. ``decimals`` rounds the new values of a column. With ``by``
    each group has its own bounds, joined to its rows; there may be any number
    of groups. A ``rate`` above ``max_rate`` is lowered to it with a warning;
    None allows any rate.
    """
    if isinstance(rate, Column):
        rate = rate if max_rate is None else F.least(rate, F.lit(max_rate))
    elif max_rate is not None and rate > max_rate:
        warnings.warn(f"outlier rate {rate} is lowered to max_rate {max_rate}", stacklevel=2)
        rate = max_rate
    chosen = [c for c in numeric_columns(df, [*exclude, *by]) if columns is None or c in columns]
    if not chosen:
        return df
    original = df.columns
    if by:
        named = {f"_q{i}": F.col(c) for i, c in enumerate(chosen)}
        found = group_quantiles(df, named, [0.0, 0.25, 0.75], by)
        table = found.select(*(F.col(b).alias(f"_by{i}") for i, b in enumerate(by)), *named)
        same = [F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)]
        df = df.join(table, same, "left")
        parts = []
        for q in named:
            smallest, q25, q75 = (F.col(q)[k] for k in range(3))
            iqr = q75 - q25
            parts += [q25 - F.lit(severity) * iqr, q75 + F.lit(severity) * iqr, iqr, smallest]
    else:
        bounds = outlier_bounds(df, chosen, severity)[()] if chosen else {}
        chosen = [c for c in chosen if c in bounds]
        if not chosen:
            return df
        parts = [F.lit(v) for c in chosen for v in bounds[c]]
    hit = _hit_cells(df, draws, "outlier", rate, chosen, sampling, "rows_with_value", where)
    changed = {}
    for i, c in enumerate(chosen):
        lower, upper, iqr, smallest = parts[4 * i : 4 * i + 4]

        def beyond(which: str, c=c, iqr=iqr) -> Column:
            return iqr * F.lit(OUTLIER_MARGIN) * (F.lit(0.5) + draws.uniform(c, "outlier", which))

        high, low = upper + beyond("margin"), lower - beyond("margin")
        low = F.when((smallest >= 0) & (low < 0), upper + beyond("again")).otherwise(low)
        value = F.when(draws.uniform(c, "outlier", "side") > 0.5, high).otherwise(low)
        as_type = type_of(df, c)
        if is_integer(as_type):
            value = F.rint(value).try_cast(as_type)
        elif decimals and c in decimals:
            scale = F.lit(float(10 ** decimals[c]))
            value = (F.rint(value * scale) / scale).cast(as_type)
        else:
            value = value.cast(as_type)
        changed[c] = F.when(hit[c], value).otherwise(F.col(c))
    return _replace(df, changed).select(*original)


def inject_duplicates(
    df: DataFrame,
    draws: Draws,
    rate: float | Mapping[float, Column] = DEFAULT_RATES["duplicate_rate"],
    sampling: str = "bernoulli",
    where: Column | None = None,
) -> DataFrame:
    """Rows repeated as if drawn with replacement; ``_copy`` numbers the copies (0: the original).

    Drawing ``n * rate`` rows with replacement gives each row a Poisson number
    of copies, so every row can decide alone: no join and no shuffle. With
    ``exact`` the draws are made one by one and counted per row; the row key
    must then be ``_row_id`` with the values 0..n-1. A mapping gives each rate
    the rows it applies to; others are not repeated.
    """
    if COPY in df.columns:
        raise ValueError("the table holds copies already")
    if sampling == "bernoulli":
        staged = draws.staged()
        u, copies = staged.uniform("duplicate", "copies"), F.lit(0)
        rates = rate if isinstance(rate, Mapping) else {rate: F.lit(True)}
        for r, rows in rates.items():
            rows = rows if where is None else rows & where
            copies = F.when(rows, drawn_count(u, *poisson_steps(r)).cast("int")).otherwise(copies)
        return staged.select(df, *df.columns, F.explode(F.sequence(F.lit(0), copies)).alias(COPY))
    if sampling != "exact":
        raise ValueError(f"unknown sampling {sampling!r}; use bernoulli or exact")
    if list(draws.key) != [ROW_ID]:
        raise ValueError("exact duplicates need _row_id as the row key")
    shape = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.min(ROW_ID), F.lit(0)).alias("low"),
        F.coalesce(F.max(ROW_ID), F.lit(-1)).alias("high"),
    ).first()
    if shape["low"] != 0 or shape["high"] != shape["n"] - 1:
        raise ValueError("exact duplicates need row ids of 0..n-1")
    drawn = Draws(draws.seed, ("_draw",), draws.method)
    picked = (
        df.sparkSession.range(int(shape["n"] * rate))
        .withColumnRenamed("id", "_draw")
        .select(F.floor(drawn.uniform("duplicate", "row") * F.lit(float(shape["n"]))).alias(ROW_ID))
        .groupBy(ROW_ID)
        .agg(F.count("*").cast("int").alias("_copies"))
    )
    # Both sides are unique on the row id, so no key can be hot.
    joined = df.join(picked, ROW_ID, "left")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(0)))
    return joined.select(*df.columns, F.explode(copies).alias(COPY))


__all__ = [
    "DEFAULT_RATES",
    "MAX_OUTLIER_RATE",
    "OUTLIER_MARGIN",
    "SENTINELS",
    "choose_type_columns",
    "inject_case",
    "inject_duplicates",
    "inject_missing",
    "inject_outliers",
    "inject_special_characters",
    "inject_type_errors",
    "inject_whitespace",
    "outlier_bounds",
]
