"""Outlier bounds and the row filter they give."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.families import numeric_columns
from tarnish.functions.quantiles import exact_quantiles

Bounds = dict[str, tuple[float, float]]


def iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> Bounds:
    """Quartiles minus / plus ``threshold`` interquartile ranges, all columns in one search."""
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.75])[()]
    out = {}
    for c in columns:
        q25, q75 = found[c]
        if q25 is not None:
            out[c] = (q25 - threshold * (q75 - q25), q75 + threshold * (q75 - q25))
    return out


def zscore_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> Bounds:
    """Mean minus / plus ``threshold`` sample standard deviations, all columns in one pass."""
    if not columns:
        return {}
    row = df.agg(
        *(F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    return {
        c: (row[f"m{i}"] - threshold * row[f"s{i}"], row[f"m{i}"] + threshold * row[f"s{i}"])
        for i, c in enumerate(columns)
        if row[f"s{i}"] is not None
    }


def is_inside(column: str, low: float, high: float) -> Column:
    """True within the bounds and for NULL, in a form Parquet scans can use to skip data."""
    c = F.col(column)
    return c.isNull() | ((c >= F.lit(low)) & (c <= F.lit(high)))


def within_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    if not bounds:
        return df
    return df.filter(reduce(Column.__and__, (is_inside(c, *b) for c, b in bounds.items())))


def fit_bounds(
    df: DataFrame,
    method: str = "iqr",
    threshold: float = 1.5,
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    mode: str = "sequential",
) -> Bounds:
    """Bounds per numeric column.

    ``sequential`` works column by column: the bounds of a column are taken
    after the rows outside earlier columns' bounds are gone, which needs one
    search per column. ``simultaneous`` takes all bounds from the whole table
    in one search.
    """
    chosen = [c for c in numeric_columns(df, exclude) if columns is None or c in columns]
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method {method!r}; use iqr or zscore")
    find = iqr_bounds if method == "iqr" else zscore_bounds
    if mode == "simultaneous":
        return find(df, chosen, threshold)
    if mode != "sequential":
        raise ValueError(f"unknown mode {mode!r}; use sequential or simultaneous")
    bounds: Bounds = {}
    for c in chosen:
        bounds.update(find(within_bounds(df, bounds), [c], threshold))
    return bounds


def remove_outliers(
    df: DataFrame,
    method: str = "iqr",
    threshold: float = 1.5,
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    mode: str = "sequential",
) -> DataFrame:
    return within_bounds(df, fit_bounds(df, method, threshold, columns, exclude, mode))
