"""Cleaning operators in two steps: ``fit`` looks at a table, ``transform`` changes one.

``fit`` returns a fitted operator that holds a few numbers and names. Its
``transform`` is made of literals only, so it can be applied to another table
of the same shape, or to a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.families import numeric_columns, text_columns, type_of
from tarnish.functions.text import TEXT_STEPS
from tarnish.operators import dedupe, fill, neighbours, outliers, types


class Fitted(Protocol):
    operation: str

    def transform(self, df: DataFrame) -> DataFrame: ...

    def describe(self) -> dict[str, Any]: ...


class _Described:
    operation = ""

    def describe(self) -> dict[str, Any]:
        return {"operation": self.operation, **asdict(self)}


@dataclass(frozen=True)
class FittedText(_Described):
    columns: Sequence[str]
    operations: Sequence[str]
    null_as_text: bool = False
    operation = "clean_text_columns"

    def transform(self, df: DataFrame) -> DataFrame:
        def cleaned(name: str):
            c = F.coalesce(F.col(name), F.lit("None")) if self.null_as_text else F.col(name)
            # The steps run in their own order, whatever order they are listed in.
            for step, function in TEXT_STEPS.items():
                if step in self.operations:
                    c = function(c)
            return c.alias(name)

        return df.select(*(cleaned(c) if c in self.columns else F.col(c) for c in df.columns))


@dataclass(frozen=True)
class CleanText:
    """Normalise text columns.

    Columns whose values mostly read as numbers or datetimes are left alone by
    default: removing '.', '-' and ':' would make them unreadable. NULL stays
    NULL unless ``null_as_text`` asks for the text "None".
    """

    operations: Sequence[str] = ("strip", "lower")
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()
    protect_parseable: bool = True
    null_as_text: bool = False

    def __post_init__(self) -> None:
        unknown = [o for o in self.operations if o not in TEXT_STEPS]
        if unknown:
            raise ValueError(f"unknown text steps {unknown}; use {', '.join(TEXT_STEPS)}")

    def fit(self, df: DataFrame) -> FittedText:
        chosen = [c for c in text_columns(df, self.exclude) if self.columns is None or c in self.columns]
        if self.protect_parseable and chosen:
            typed = types.infer_targets(df, columns=chosen)
            chosen = [c for c in chosen if c not in typed]
        return FittedText(chosen, list(self.operations), self.null_as_text)


@dataclass(frozen=True)
class FittedTypes(_Described):
    targets: Mapping[str, str]
    operation = "convert_data_types"

    def transform(self, df: DataFrame) -> DataFrame:
        return types.convert_types(df, self.targets)


@dataclass(frozen=True)
class ConvertTypes:
    """Give text columns the type their values have.

    ``targets`` names types outright. Otherwise a column is converted when the
    share ``threshold`` of its non-blank values reads as that type; with
    ``coerce_all`` every text column becomes a number, readable or not.
    """

    targets: Mapping[str, str] | None = None
    threshold: float = 0.5
    coerce_all: bool = False
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FittedTypes:
        if self.targets is not None:
            return FittedTypes(dict(self.targets))
        if self.coerce_all:
            chosen = [c for c in text_columns(df, self.exclude) if self.columns is None or c in self.columns]
            return FittedTypes(dict.fromkeys(chosen, "float"))
        return FittedTypes(types.infer_targets(df, self.threshold, self.columns, self.exclude))


@dataclass(frozen=True)
class FittedImpute(_Described):
    values: Mapping[str, Any]
    operation = "handle_missing_values"

    def transform(self, df: DataFrame) -> DataFrame:
        return fill.fill_constants(df, self.values)


@dataclass(frozen=True)
class FittedOrderedFill(_Described):
    """A fill along an order needs the neighbouring rows, so it fits no stream."""

    columns: Sequence[str]
    how: str
    order_by: Sequence[str]
    partition_by: Sequence[str] = ()
    operation = "handle_missing_values"

    def transform(self, df: DataFrame) -> DataFrame:
        return fill.fill_along(df, self.columns, self.how, self.order_by, self.partition_by)


@dataclass(frozen=True)
class Impute:
    """Fill missing numbers and texts; datetimes are left alone.

    numeric: median, mean, most_frequent, zero, constant
    categorical: most_frequent, unknown, missing, empty_string, constant
    """

    numeric: str = "median"
    categorical: str = "most_frequent"
    numeric_constant: float | None = None
    categorical_constant: str | None = None
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FittedImpute:
        def wanted(names: Sequence[str]) -> list[str]:
            return [c for c in names if self.columns is None or c in self.columns]

        numbers, texts = wanted(numeric_columns(df, self.exclude)), wanted(text_columns(df, self.exclude))
        holes = set(fill.columns_with_nulls(df, numbers + texts))
        values: dict[str, Any] = fill.numeric_fill_values(
            df, [c for c in numbers if c in holes], self.numeric, self.numeric_constant
        )
        values |= fill.text_fill_values(
            df, [c for c in texts if c in holes], self.categorical, self.categorical_constant
        )
        return FittedImpute(values)


@dataclass(frozen=True)
class FillAlong:
    """Forward fill, back fill or interpolation along an order."""

    how: str
    columns: Sequence[str]
    order_by: Sequence[str]
    partition_by: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FittedOrderedFill:
        return FittedOrderedFill(
            list(self.columns), self.how, list(self.order_by), list(self.partition_by)
        )


@dataclass(frozen=True)
class FittedNearest(_Described):
    """Neighbours are rows of the same table, so it fits no stream."""

    columns: Sequence[str]
    features: Sequence[str]
    k: int = 5
    operation = "handle_missing_values"

    def transform(self, df: DataFrame) -> DataFrame:
        return neighbours.impute_nearest(df, self.columns, self.features, self.k)


@dataclass(frozen=True)
class FillNearest:
    """Fill missing numbers and texts from the ``k`` rows with the nearest features."""

    columns: Sequence[str]
    features: Sequence[str]
    k: int = 5

    def fit(self, df: DataFrame) -> FittedNearest:
        return FittedNearest(fill.columns_with_nulls(df, list(self.columns)), list(self.features), self.k)


@dataclass(frozen=True)
class FittedSentinels(_Described):
    columns: Sequence[str]
    values: Sequence[float]
    empty_text: bool
    operation = "handle_missing_values"

    def transform(self, df: DataFrame) -> DataFrame:
        def cleared(name: str):
            c = F.col(name)
            if isinstance(type_of(df, name), T.StringType):
                return (F.when(c != "", c) if self.empty_text else c).alias(name)
            return F.when(c.isin(*(F.lit(v) for v in self.values)), F.lit(None)).otherwise(c).alias(name)

        return df.select(*(cleared(c) if c in self.columns else F.col(c) for c in df.columns))


@dataclass(frozen=True)
class NullifySentinels:
    """Turn stand-ins for 'missing' into NULL. Zero is a fair value and not one by default."""

    values: Sequence[float] = (-999, 999999)
    empty_text: bool = True
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FittedSentinels:
        names = numeric_columns(df, self.exclude) + text_columns(df, self.exclude)
        return FittedSentinels(
            [c for c in names if self.columns is None or c in self.columns], list(self.values), self.empty_text
        )


@dataclass(frozen=True)
class FittedOutliers(_Described):
    bounds: Mapping[str, tuple[float, float]]
    method: str
    threshold: float
    operation = "remove_outliers"

    def transform(self, df: DataFrame) -> DataFrame:
        return outliers.within_bounds(df, self.bounds)


@dataclass(frozen=True)
class RemoveOutliers:
    method: str = "iqr"
    threshold: float = 1.5
    mode: str = "sequential"
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FittedOutliers:
        bounds = outliers.fit_bounds(df, self.method, self.threshold, self.columns, self.exclude, self.mode)
        return FittedOutliers(bounds, self.method, self.threshold)


@dataclass(frozen=True)
class FittedDuplicates(_Described):
    keep: str | bool = "first"
    subset: Sequence[str] | None = None
    order_by: Sequence[str] | None = None
    operation = "remove_duplicates"

    def transform(self, df: DataFrame) -> DataFrame:
        return dedupe.remove_duplicates(df, self.keep, self.subset, self.order_by)


@dataclass(frozen=True)
class RemoveDuplicates:
    keep: str | bool = "first"
    subset: Sequence[str] | None = None
    order_by: Sequence[str] | None = None

    def fit(self, df: DataFrame) -> FittedDuplicates:
        return FittedDuplicates(self.keep, self.subset, self.order_by)


Operator = CleanText | ConvertTypes | Impute | FillAlong | FillNearest | NullifySentinels | RemoveOutliers | RemoveDuplicates
