"""From a config or a table to a perfect / dirty / recovered triple."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnish.functions.draws import Draws
from tarnish.functions.families import ROW_ID, data_columns
from tarnish.functions.storage import held, keep, release, through_table
from tarnish.operators.compare import audit_counts, cell_audit
from tarnish.operators.stats import TableFacts, duplicate_count, null_counts, type_counts
from tarnish.operators.validate import Validation, pair_facts, validate_pair, validate_solvability
from tarnish.plans.cleaning import cleaning_plan, run_cleaning
from tarnish.plans.injection import InjectionConfig, inject, required_operations
from tarnish.plans.report import metadata_document, quality_report
from tarnish.sources.builtin import DatasetConfig, get_config, spec_for_domain
from tarnish.sources.files import export_dataset
from tarnish.sources.generate import check_generated, generate_table
from tarnish.sources.spec import NumericColumn

DEFAULT_SEED = 42


class ValidationFailed(RuntimeError):
    def __init__(self, errors: Sequence[str]) -> None:
        super().__init__("validation failed: " + "; ".join(errors))
        self.errors = list(errors)


@dataclass
class DatasetTriple:
    perfect: DataFrame
    dirty: DataFrame
    recovered: DataFrame
    metadata: dict[str, Any]
    facts: tuple[TableFacts, TableFacts]
    exported: dict[str, list[str]] = field(default_factory=dict)
    #: Tables of the shared folder that were written for this triple.
    paths: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Free cached tables, and delete this triple's own ones in the shared folder."""
        for df in (self.perfect, self.dirty, self.recovered):
            df.unpersist()
        release(self.dirty.sparkSession, self.paths)


def with_row_ids(df: DataFrame) -> DataFrame:
    """Give a table without a key row ids that stay the same on every read.

    The ids are numbered per task without a shuffle and written down once, as
    a second run could number the rows differently.
    """
    return through_table(df.withColumn(ROW_ID, F.monotonically_increasing_id()), "row_ids")


@dataclass(frozen=True)
class TableCounts:
    rows: int
    missing: int
    duplicates: int
    columns: int

    @property
    def shape(self) -> list[int]:
        return [self.rows, self.columns]


def table_counts(df: DataFrame) -> TableCounts:
    columns = data_columns(df)
    nulls = null_counts(df, columns).collect()
    copies = duplicate_count(df, columns).first()
    return TableCounts(copies["rows"], sum(r["missing"] for r in nulls), copies["duplicates"], len(columns))


def corruption_summary(perfect: TableCounts | TableFacts, dirty: TableCounts | TableFacts) -> dict[str, Any]:
    cells = dirty.rows * (len(dirty.columns) if isinstance(dirty, TableFacts) else dirty.columns)
    return {
        "missing_values_added": dirty.missing - perfect.missing,
        "missing_percentage": round(dirty.missing / cells * 100, 2) if cells else 0.0,
        "duplicates_added": dirty.duplicates - perfect.duplicates,
        "duplicate_percentage": round(dirty.duplicates / dirty.rows * 100, 2) if dirty.rows else 0.0,
        "rows_added": dirty.rows - perfect.rows,
    }


def recovery_summary(
    perfect: TableCounts | TableFacts, dirty: TableCounts | TableFacts, recovered: TableCounts | TableFacts
) -> dict[str, Any]:
    stages = {"perfect": perfect, "dirty": dirty, "recovered": recovered}
    out: dict[str, Any] = {f"{name}_rows": t.rows for name, t in stages.items()}
    out["rows_lost_in_recovery"] = dirty.rows - recovered.rows
    out |= {f"{name}_missing": t.missing for name, t in stages.items()}
    out |= {f"{name}_duplicates": t.duplicates for name, t in stages.items()}
    return out


def corrupt_dataset(
    perfect: DataFrame,
    config: InjectionConfig | None = None,
    seed: int | None = None,
    key: Sequence[str] = (ROW_ID,),
    method: str = "xxhash64",
    outlier_mode: str = "sequential",
    nullify_sentinels: bool = False,
    compatible: bool = False,
    audit: bool = False,
    hold: str = "persist",
    unique: str = "exact",
) -> DatasetTriple:
    """Inject errors into a table, clean it again, and describe both steps.

    ``key`` names the columns that identify a row; they are left undamaged.
    ``hold`` says how the dirty and the recovered table are kept, as both are
    read many times: ``persist`` for data that fits the cluster's memory and
    disks, ``table`` to write them to the shared folder. ``unique`` says how
    distinct values are counted for the report: ``exact`` or ``approximate``.
    """
    before = set(held(perfect.sparkSession))
    config = config or InjectionConfig.from_difficulty("medium", seed)
    draws = Draws(config.seed if seed is None else seed, tuple(key), method)
    dirty = keep(inject(perfect, config, draws), hold, "dirty")
    exclude = tuple(k for k in key if k != ROW_ID)
    plan = cleaning_plan(config.strategies, outlier_mode, nullify_sentinels, compatible, exclude)
    cleaning = run_cleaning(dirty, plan)
    recovered = keep(cleaning.recovered, hold, "recovered")

    facts = pair_facts(dirty, recovered, unique)
    clean_counts = table_counts(perfect)
    metadata: dict[str, Any] = {
        "corruption_config": config.to_dict(),
        "applied_strategies": list(config.strategies),
        "required_operations": required_operations(config.strategies),
        "perfect_shape": clean_counts.shape,
        "dirty_shape": list(facts[0].shape),
        "corruption_summary": {
            **corruption_summary(clean_counts, facts[0]),
            "type_changes": {"clean_types": type_counts(perfect), "corrupt_types": type_counts(dirty)},
        },
        "recovered_clean_shape": list(facts[1].shape),
        "cleaning_operations": cleaning.log,
        "recovery_summary": recovery_summary(clean_counts, *facts),
    }
    if audit:
        counts = audit_counts(cell_audit(perfect, dirty, key)).collect()
        metadata["injection_log"] = [r.asDict() for r in sorted(counts, key=lambda r: (r["column"], r["kind"]))]
    own = [p for p in held(perfect.sparkSession) if p not in before]
    return DatasetTriple(perfect, dirty, recovered, metadata, facts, paths=own)


def resolve_config(config: str | DatasetConfig | Mapping[str, Any]) -> DatasetConfig:
    if isinstance(config, str):
        return get_config(config)
    return config if isinstance(config, DatasetConfig) else DatasetConfig.from_dict(config)


def injection_for(config: DatasetConfig, **options: Any) -> InjectionConfig:
    seed = DEFAULT_SEED if config.seed is None else config.seed
    if config.strategies:
        return InjectionConfig.custom(config.strategies, seed, difficulty=config.difficulty, **options)
    return InjectionConfig.from_difficulty(config.difficulty, seed, **options)


def generate_dataset(
    spark: SparkSession,
    config: str | DatasetConfig | Mapping[str, Any],
    output_dir: str | None = None,
    include_perfect: bool = False,
    validate: bool = True,
    formats: str | Iterable[str] = "csv",
    include_quality_report: bool = True,
    sampling: str = "bernoulli",
    write_mode: str = "error",
    verify: bool = True,
    **options: Any,
) -> DatasetTriple:
    """Generate, damage, clean, check, report and (with ``output_dir``) write one dataset.

    ``verify`` counts rows and nulls of the generated table, one more pass over
    it. ``options`` are those of ``corrupt_dataset``.
    """
    config = resolve_config(config)
    spec = spec_for_domain(config.domain, config.num_rows)
    decimals = {c.name: c.decimals for c in spec.columns if isinstance(c, NumericColumn) and not c.integer}
    injection = injection_for(config, sampling=sampling, decimals=decimals)
    perfect = generate_table(spark, spec, injection.seed, options.get("method", "xxhash64"))
    if verify:
        check_generated(perfect, spec)
    triple = corrupt_dataset(perfect, injection, **options)
    triple.metadata["dataset_config"] = config.to_dict()

    if validate:
        check_dataset(triple)
    if include_quality_report:
        triple.metadata["quality_report"] = quality_report(
            triple.dirty,
            triple.recovered,
            triple.metadata,
            perfect if include_perfect else None,
            (ROW_ID,),
            triple.facts,
        )
    if output_dir is not None:
        triple.exported = export_dataset(
            _without_ids(triple.dirty),
            _without_ids(triple.recovered),
            metadata_document(triple.metadata, *triple.facts),
            output_dir,
            formats,
            _without_ids(perfect) if include_perfect else None,
            mode=write_mode,
        )
    return triple


def _without_ids(df: DataFrame) -> DataFrame:
    return df.select(*data_columns(df))


def check_dataset(triple: DatasetTriple) -> tuple[Validation, Validation]:
    """Both validations of a triple; raises when either finds an error."""
    operations = triple.metadata["cleaning_operations"]
    pair = validate_pair(triple.dirty, triple.recovered, operations, triple.facts)
    solvable = validate_solvability(triple.dirty, operations, triple.facts[0])
    if not (pair.ok and solvable.ok):
        raise ValidationFailed([*pair.errors, *solvable.errors])
    return pair, solvable


def generate_datasets(
    spark: SparkSession,
    configs: Sequence[str | DatasetConfig | Mapping[str, Any]],
    output_dir: str | None = None,
    **options: Any,
) -> list[DatasetTriple]:
    """One triple per config, for configs of different shapes.

    For many datasets of one shape use ``plans.batch``, which makes them all in
    one job.
    """
    triples = []
    for config in map(resolve_config, configs):
        target = f"{output_dir.rstrip('/')}/{config.name}" if output_dir is not None else None
        triples.append(generate_dataset(spark, config, target, **options))
    return triples
