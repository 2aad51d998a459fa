"""The cleaning plan for a set of injected errors, and running it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from tarnish.functions.storage import keep
from tarnish.operators.clean import (
    CleanText,
    ConvertTypes,
    Fitted,
    Impute,
    NullifySentinels,
    Operator,
    RemoveDuplicates,
    RemoveOutliers,
)

# The vocabulary, in the order the operations run (texts before
# types, types before imputation, imputation before outliers, duplicates last).
OPERATION_ORDER = (
    "clean_text_columns",
    "convert_data_types",
    "handle_missing_values",
    "remove_outliers",
    "remove_duplicates",
)
# The text step that undoes each text strategy.
TEXT_STEP = {"text_whitespace": "strip", "text_case": "lower", "text_special_chars": "remove_special"}


@dataclass(frozen=True)
class PlannedOperation:
    operation: str
    rationale: str
    operator: Operator

    def to_dict(self) -> dict[str, Any]:
        settings = {k: v for k, v in vars(self.operator).items() if v is not None and k != "exclude"}
        return {"operation": self.operation, "rationale": self.rationale, **settings}


def cleaning_plan(
    strategies: Sequence[str],
    outlier_mode: str = "sequential",
    nullify_sentinels: bool = False,
    compatible: bool = False,
    exclude: Sequence[str] = (),
) -> list[PlannedOperation]:
    """The operations that repair ``strategies``, one each, in running order.

    ``nullify_sentinels`` first turns stand-ins such as -999 and empty texts
    into NULL so that they are imputed too. ``compatible`` keeps two known
    defects for comparison with results made elsewhere: missing texts become
    the word "None" when cleaned, and every text column is coerced to numbers.
    """
    planned: dict[str, PlannedOperation] = {}
    steps = [TEXT_STEP[s] for s in TEXT_STEP if s in strategies]
    if steps:
        operator = CleanText(steps, exclude=exclude, protect_parseable=not compatible, null_as_text=compatible)
        planned["clean_text_columns"] = PlannedOperation(
            "clean_text_columns", f"clean text columns: {', '.join(steps)}", operator
        )
    if "type_corruption" in strategies:
        planned["convert_data_types"] = PlannedOperation(
            "convert_data_types",
            "give text columns the type their values have",
            ConvertTypes(coerce_all=compatible, exclude=exclude),
        )
    if "missing_values" in strategies:
        planned["handle_missing_values"] = PlannedOperation(
            "handle_missing_values",
            "fill numbers with the median and texts with the most frequent value",
            Impute(exclude=exclude),
        )
    if "outliers" in strategies:
        planned["remove_outliers"] = PlannedOperation(
            "remove_outliers",
            "drop rows beyond 1.5 interquartile ranges",
            RemoveOutliers(mode=outlier_mode, exclude=exclude),
        )
    if "duplicates" in strategies:
        planned["remove_duplicates"] = PlannedOperation(
            "remove_duplicates", "drop exact copies, keeping the first", RemoveDuplicates()
        )
    plan = [planned[o] for o in OPERATION_ORDER if o in planned]
    if nullify_sentinels and "handle_missing_values" in planned:
        sentinels = PlannedOperation(
            "handle_missing_values", "read sentinels and empty texts as missing", NullifySentinels(exclude=exclude)
        )
        plan.insert(plan.index(planned["handle_missing_values"]), sentinels)
    return plan


@dataclass
class CleaningResult:
    recovered: DataFrame
    fitted: list[Fitted]
    #: One entry per operation: its settings and what it was fitted to.
    log: list[dict[str, Any]]


def run_cleaning(
    df: DataFrame, plan: Sequence[PlannedOperation], hold: str = "recompute", count_rows: bool = False
) -> CleaningResult:
    """Fit each operation on the output of the one before it, and chain them.

    ``hold`` says how the table between two operations is kept (see
    ``functions.storage.keep``): every fit reads it, so a long plan over an
    expensive source is better held in a table. ``count_rows`` logs how many
    rows each operation removed, at the price of a count per operation.
    """
    fitted: list[Fitted] = []
    log: list[dict[str, Any]] = []
    rows = df.count() if count_rows else None
    for step in plan:
        operator = step.operator.fit(df)
        df = operator.transform(df)
        if hold != "recompute":
            df = keep(df, hold, step.operation)
        entry = {**step.to_dict(), "fitted": operator.describe()}
        if rows is not None:
            left = df.count()
            entry["rows_affected"], rows = rows - left, left
        fitted.append(operator)
        log.append(entry)
    return CleaningResult(df, fitted, log)


def transform_all(df: DataFrame, fitted: Sequence[Fitted]) -> DataFrame:
    """Apply fitted operations to another table, or to a stream."""
    for operator in fitted:
        df = operator.transform(df)
    return df
