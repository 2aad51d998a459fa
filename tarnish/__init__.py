"""Paired dirty and clean tables on Spark: generate, damage, clean, check, report."""

from tarnish.functions.draws import Draws
from tarnish.operators.clean import (
    CleanText,
    ConvertTypes,
    FillAlong,
    Impute,
    NullifySentinels,
    RemoveDuplicates,
    RemoveOutliers,
)
from tarnish.operators.validate import validate_pair, validate_solvability
from tarnish.plans.batch import generate_batch, generate_batches, generate_training_set
from tarnish.plans.cleaning import cleaning_plan, run_cleaning, transform_all
from tarnish.plans.dataset import corrupt_dataset, generate_dataset, generate_datasets, with_row_ids
from tarnish.plans.injection import InjectionConfig, inject, register_strategy
from tarnish.plans.report import metadata_document, quality_report
from tarnish.sources.builtin import (
    DatasetConfig,
    ecommerce_spec,
    finance_spec,
    get_config,
    healthcare_spec,
    list_configs,
    list_configs_by_domain,
)
from tarnish.sources.files import export_dataset, export_summary, read_table
from tarnish.sources.generate import generate_columns, generate_table
from tarnish.sources.spec import (
    CategoricalColumn,
    DatetimeColumn,
    NumericColumn,
    TableSpec,
    spec_from_columns,
    spec_from_config,
)

__all__ = [name for name in dir() if not name.startswith("_")]
