"""Many datasets of one shape in one job instead of one job each.

All datasets share a table with a dataset column. A strategy applies to the
rows of the datasets that drew it, at their rates and by their seeds; statistics
are taken per dataset. Groups may differ in size by any factor: every
aggregation combines before the shuffle, and what goes back to the rows is a
table with a row per dataset, joined as the optimizer sees fit.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.draws import Draws
from tarnish.functions.families import (
    COPY,
    ROW_ID,
    data_columns,
    is_integer,
    numeric_columns,
    text_columns,
    type_of,
)
from tarnish.functions.quantiles import group_quantiles
from tarnish.functions.storage import keep, small_table
from tarnish.functions.text import TEXT_STEPS
from tarnish.operators import inject as I
from tarnish.operators.dedupe import default_order, remove_duplicates
from tarnish.operators.stats import mode_values, row_hashes
from tarnish.operators.types import convert_types, infer_targets
from tarnish.plans.cleaning import TEXT_STEP

from tarnish.plans.dataset import DEFAULT_SEED, ValidationFailed, injection_for
from tarnish.plans.injection import DIFFICULTY, InjectionConfig, required_operations
from tarnish.plans.report import SCORE_WEIGHTS
from tarnish.sources.builtin import DatasetConfig, spec_for_domain
from tarnish.sources.files import export_dataset
from tarnish.sources.generate import generate_columns
from tarnish.sources.spec import NumericColumn

DATASET = "dataset_id"
#: Rows that one row of the plan of a batch stands for until they are made.
CHUNK_ROWS = 100_000

# The order strategies run in: cells while they are typed, types after that, copies last.
BATCH_STRATEGIES = (
    "missing_values",
    "text_whitespace",
    "text_case",
    "text_special_chars",
    "outliers",
    "type_corruption",
    "duplicates",
)
_CELLS = {
    "missing_values": (I.inject_missing, "missing_rate"),
    "text_whitespace": (I.inject_whitespace, "whitespace_rate"),
    "text_case": (I.inject_case, "case_rate"),
    "text_special_chars": (I.inject_special_characters, "special_char_rate"),
}


@dataclass
class Batch:
    """The datasets of a batch in shared tables.

    A column is text in ``dirty`` if it was turned to text in some dataset;
    ``types`` says in which, and ``dataset`` gives a dataset with its own types.
    """

    configs: list[DatasetConfig]
    injections: dict[str, InjectionConfig]
    perfect: DataFrame
    dirty: DataFrame
    recovered: DataFrame
    quality: DataFrame
    types: DataFrame
    validation: DataFrame

    def dataset(self, name: str) -> tuple[DataFrame, DataFrame]:
        """The dirty and the recovered table of one dataset."""
        own = set(damaged_types(self.perfect, self.injections, [DATASET, ROW_ID])[name])
        dirty = self.dirty.filter(F.col(DATASET) == name)
        back = {c: f.dataType for c in dirty.columns if c not in own for f in self.perfect.schema if f.name == c}
        typed = [typed_again(dirty, c, back[c]).alias(c) if c in back else F.col(c) for c in dirty.columns]
        return dirty.select(*typed).drop(DATASET), self.recovered.filter(F.col(DATASET) == name).drop(DATASET)


def typed_again(df: DataFrame, c: str, as_type: T.DataType) -> Column:
    return F.col(c) if type_of(df, c) == as_type else F.col(c).try_cast(as_type)


def training_configs(
    domain: str = "ecommerce",
    num_easy: int = 5,
    num_medium: int = 5,
    num_hard: int = 5,
    rows_per_dataset: int = 1000,
    base_seed: int = DEFAULT_SEED,
) -> list[DatasetConfig]:
    """One config per dataset, levels in order, each with the next seed."""
    counts = dict(zip(DIFFICULTY, (num_easy, num_medium, num_hard), strict=True))
    levels = [(level, i + 1) for level, n in counts.items() for i in range(n)]
    return [
        DatasetConfig(
            f"{domain}_{level}_{i}",
            domain,
            rows_per_dataset,
            level,
            seed=base_seed + offset,
        )
        for offset, (level, i) in enumerate(levels)
    ]


def damaged_types(
    df: DataFrame, injections: Mapping[Any, InjectionConfig], exclude: Sequence[str] = ()
) -> dict[Any, list[str]]:
    """For each dataset, the columns that its type strategy turns to text: given ones, or drawn by its seed."""
    out = {}
    for dataset, config in injections.items():
        chosen: Sequence[str] = ()
        if "type_corruption" in config.strategies:
            chosen = config.type_columns
            if chosen is None:
                rate = config.rates["type_corruption_rate"]
                chosen = I.choose_type_columns(df, config.seed, rate, [*exclude, *config.exclude])
        out[dataset] = list(chosen)
    return out


def plan_table(df: DataFrame, injections: Mapping[Any, InjectionConfig], by: str) -> DataFrame:
    """One row for each dataset: its seed, whether it has a strategy, and its rates.

    As long as the list of configs it is made of; the optimizer broadcasts it if that is small.
    """
    for name, config in injections.items():
        if config.sampling != "bernoulli" or config.exclude:
            raise ValueError(f"{name}: a batch samples cells independently and damages all columns; run it as a dataset of its own")
        if not config.duplicates_last and "duplicates" in config.strategies:
            raise ValueError(f"{name}: a batch makes copies last")
        unknown = [s for s in config.strategies if s not in BATCH_STRATEGIES]
        if unknown:
            raise ValueError(f"{name}: a batch cannot run {unknown}")
        if "outliers" in config.strategies and config.used_rates != config.rates:
            warnings.warn(f"{name}: outlier rate {config.rates['outlier_rate']} is lowered to max_rate {config.max_rate}", stacklevel=2)
    rates = sorted(I.DEFAULT_RATES)
    rows = [
        (name, config.seed, *(s in config.strategies for s in BATCH_STRATEGIES), *(float(config.used_rates[r]) for r in rates))
        for name, config in injections.items()
    ]
    flags = ", ".join(f"_has_{s} boolean" for s in BATCH_STRATEGIES)
    kind = type_of(df, by).simpleString()
    return small_table(df.sparkSession, rows, f"_dataset {kind}, _seed bigint, {flags}, {', '.join(f'_{r} double' for r in rates)}")


def _planned(df: DataFrame, injections: Mapping[Any, InjectionConfig], by: str) -> DataFrame:
    plan = plan_table(df, injections, by)
    flags = {f"_has_{s}": F.coalesce(f"_has_{s}", F.lit(False)) for s in BATCH_STRATEGIES}
    joined = df.join(plan, F.col(by).eqNullSafe(F.col("_dataset")), "left").drop("_dataset")
    return joined.withColumns({**flags, "_seed": F.coalesce("_seed", F.lit(DEFAULT_SEED))})


def _used(injections: Mapping[Any, InjectionConfig]) -> set[str]:
    return {s for config in injections.values() for s in config.strategies}


def corrupt_batch(
    perfect: DataFrame,
    injections: Mapping[Any, InjectionConfig],
    draws: Draws,
    by: str = DATASET,
    exclude: Iterable[str] = (),
    decimals: Mapping[str, int] | None = None,
) -> DataFrame:
    """Damage the rows of each dataset by its own strategies, rates and seed.

    ``draws`` gives the row key and the method; each dataset draws by its own
    seed, so its rows are those that a run of its own makes with the strategies
    in the order of ``BATCH_STRATEGIES``. A column that some dataset turns to
    text is text in the shared table; see ``damaged_types``.
    """
    exclude = [*exclude, by, *draws.key]
    types = damaged_types(perfect, injections, exclude)
    used = _used(injections)
    df = _planned(perfect, injections, by)
    draws = Draws(F.col("_seed"), draws.key, draws.method)
    # The plan's columns ride along and are no data.
    exclude += [c for c in df.columns if c not in perfect.columns]
    for strategy, (operator, rate) in _CELLS.items():
        if strategy in used:
            df = operator(df, draws, F.col(f"_{rate}"), exclude=exclude, where=F.col(f"_has_{strategy}"))
    if "outliers" in used:
        df = I.inject_outliers(
            df, draws, F.col("_outlier_rate"), F.col("_outlier_severity"), exclude=exclude, where=F.col("_has_outliers"), by=[by], decimals=decimals,
            max_rate=None,  # the plan has the rates as lowered
        )
    turned = sorted({c for columns in types.values() for c in columns})
    if turned:
        df = I.inject_type_errors(df, draws, columns=turned)
    if "duplicates" in used:
        rates = sorted({float(c.rates["duplicate_rate"]) for c in injections.values() if "duplicates" in c.strategies})
        df = I.inject_duplicates(df, draws, {r: F.col("_has_duplicates") & (F.col("_duplicate_rate") == r) for r in rates})
    return df.select(*(c for c in df.columns if c in perfect.columns or c == COPY))


def _impute(df: DataFrame, by: str, where: Column, exclude: Sequence[str]) -> DataFrame:
    numbers, texts = numeric_columns(df, exclude), text_columns(df, exclude)
    scope, fills = df.filter(where), []
    if numbers:
        medians = group_quantiles(scope, {f"_fill_{c}": F.col(c) for c in numbers}, [0.5], [by])
        fills.append(medians.select(F.col(by).alias("_group"), *(F.get(f"_fill_{c}", F.lit(0)).alias(f"_fill_{c}") for c in numbers)))
    if texts:
        modes = mode_values(scope, texts, [by]).groupBy(F.col(by).alias("_group"))
        fills.append(modes.agg(*(F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_fill_{c}") for c in texts)))
    joined = df
    for found in fills:
        joined = joined.join(found, F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")

    def filled(c: str) -> Column:
        if c not in numbers and c not in texts:
            return F.col(c)
        cell = F.col(c).cast("double") if c in numbers and is_integer(type_of(df, c)) else F.col(c)
        return F.when(where, F.coalesce(cell, F.col(f"_fill_{c}"))).otherwise(cell).alias(c)

    return joined.select(*(filled(c) for c in df.columns))


def _drop_outliers(df: DataFrame, by: str, where: Column, exclude: Sequence[str], mode: str, threshold: float = 1.5) -> DataFrame:
    columns = numeric_columns(df, exclude)
    steps = [[c] for c in columns] if mode == "sequential" else [columns]
    for step in steps:
        quartiles = group_quantiles(df.filter(where), {f"_q{i}": F.col(c) for i, c in enumerate(step)}, [0.25, 0.75], [by])
        joined = df.join(quartiles.withColumnRenamed(by, "_group"), F.col(by).eqNullSafe(F.col("_group")), "left")
        outside = F.lit(False)
        for i, c in enumerate(step):
            q25, q75 = F.col(f"_q{i}")[0], F.col(f"_q{i}")[1]
            margin = F.lit(threshold) * (q75 - q25)
            outside = outside | F.coalesce((F.col(c) < q25 - margin) | (F.col(c) > q75 + margin), F.lit(False))
        df = joined.filter(~(where & outside)).select(*df.columns)
    return df


def clean_batch(
    dirty: DataFrame,
    injections: Mapping[Any, InjectionConfig],
    by: str = DATASET,
    exclude: Iterable[str] = (),
    outlier_mode: str = "sequential",
) -> DataFrame:
    """Recover each dataset by the plan its strategies call for, fitted on its own rows."""
    used = _used(injections)
    df = _planned(dirty, injections, by)
    exclude = [*exclude, by, *(c for c in df.columns if c not in dirty.columns)]
    has = {s: F.col(f"_has_{s}") for s in BATCH_STRATEGIES}
    targets = infer_targets(dirty, exclude=exclude) if "type_corruption" in used else {}
    steps = [(has[s], TEXT_STEPS[TEXT_STEP[s]]) for s in TEXT_STEP if s in used]
    if steps:

        def cleaned(name: str) -> Column:
            c = F.col(name)
            for where, function in steps:
                c = F.when(where, function(c)).otherwise(c)
            return c.alias(name)

        texts = [c for c in text_columns(df, exclude) if c not in targets]
        df = df.select(*(cleaned(c) if c in texts else F.col(c) for c in df.columns))
    if targets:
        df = convert_types(df, targets)
    if "missing_values" in used:
        df = _impute(df, by, has["missing_values"], exclude)
    if "outliers" in used:
        df = _drop_outliers(df, by, has["outliers"], exclude, outlier_mode)
    if "duplicates" in used:
        # Datasets without the strategy keep their natural copies: their rows stay apart.
        plain = df.select(*dirty.columns, "_has_duplicates")
        order = default_order(plain)
        marked = plain.withColumn("_apart", F.when(F.col("_has_duplicates"), F.lit(0)).otherwise(F.col(order[0])))
        df = remove_duplicates(marked, order_by=order)
    return df.select(*dirty.columns)


def _stage_counts(df: DataFrame, by: str, stage: str) -> DataFrame:
    columns = data_columns(df, [by])
    nulls = F.lit(0).cast("bigint")
    for c in columns:
        nulls = nulls + F.col(c).isNull().cast("bigint")
    # One grouping for both: equal rows have equally many nulls.
    groups = df.select(by, nulls.alias("_nulls"), *row_hashes(columns)).groupBy(by, "_h1", "_h2").agg(F.count("*").alias("_n"), F.sum("_nulls").alias("_m"))
    return groups.groupBy(by).agg(
        F.sum("_n").alias(f"{stage}_rows"), (F.sum("_n") - F.count("*")).alias(f"{stage}_duplicates"), F.sum("_m").alias(f"{stage}_missing")
    )


def validate_batch(quality: DataFrame, injections: Mapping[Any, InjectionConfig], by: str = DATASET) -> DataFrame:
    """(dataset, ok, errors): what each dataset's recovery must not do."""
    planned = _planned(quality, injections, by)
    checks = {
        "rows were added": F.col("recovered_rows") > F.col("dirty_rows"),
        "no rows are left": (F.col("recovered_rows") == 0) & (F.col("dirty_rows") > 0),
        "cells went missing": F.col("_has_missing_values") & (F.col("recovered_missing") > F.col("dirty_missing")),
        "copies are left": F.col("_has_duplicates") & (F.col("recovered_duplicates") > 0),
    }
    errors = F.array_compact(F.array(*(F.when(failed, F.lit(message)) for message, failed in checks.items())))
    return planned.select(by, (F.size(errors) == 0).alias("ok"), errors.alias("errors"))


def batch_quality(dirty: DataFrame, recovered: DataFrame, by: str = DATASET) -> DataFrame:
    """Per dataset: rows, missing cells and duplicates of both tables, and the 0..100 score."""
    both = _stage_counts(dirty, by, "dirty").join(_stage_counts(recovered, by, "recovered"), by, "left")
    counted = [f"recovered_{n}" for n in ("rows", "duplicates", "missing")]
    both = both.fillna(0, counted)

    def improvement(name: str) -> Column:
        before, after = F.col(f"dirty_{name}"), F.col(f"recovered_{name}")
        return (before - after) / F.greatest(before, F.lit(1)).cast("double")

    retention = F.col("recovered_rows") / F.col("dirty_rows").cast("double")
    score = (
        improvement("missing") * SCORE_WEIGHTS["missing"]
        + improvement("duplicates") * SCORE_WEIGHTS["duplicates"]
        + retention * SCORE_WEIGHTS["retention"]
    )
    return both.withColumn("quality_score", F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)), 2))


def _row_ids(spark: SparkSession, configs: Sequence[DatasetConfig]) -> DataFrame:
    """(dataset_id, _seed, _row_id) with row ids of 0..n-1 for each dataset, made in parallel however sizes differ."""
    rows = [(c.name, DEFAULT_SEED if c.seed is None else c.seed, c.num_rows) for c in configs]
    plan = small_table(spark, rows, f"{DATASET} string, _seed bigint, _n bigint").where("_n > 0")
    last = F.floor((F.col("_n") - 1) / F.lit(CHUNK_ROWS))
    chunks = plan.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).repartition(DATASET, "_chunk")
    first = F.col("_chunk") * CHUNK_ROWS
    ids = F.sequence(first, F.least(first + CHUNK_ROWS, F.col("_n")) - 1)
    return chunks.select(DATASET, "_seed", F.explode(ids).alias(ROW_ID))


def generate_batch(
    spark: SparkSession,
    configs: Sequence[DatasetConfig],
    output_dir: str | None = None,
    formats: str | Iterable[str] = "csv",
    method: str = "xxhash64",
    outlier_mode: str = "sequential",
    hold: str = "persist",
    write_mode: str = "error",
    validate: bool = True,
) -> Batch:
    """All datasets of one domain together, of any sizes; tables are written one directory per dataset."""
    domains = {c.domain for c in configs}
    if len(domains) != 1:
        raise ValueError("a batch needs configs of one domain; use generate_batches for several")
    if len({c.name for c in configs}) != len(configs):
        raise ValueError("dataset names must differ")
    spec = spec_for_domain(domains.pop(), max(c.num_rows for c in configs))
    injections = {c.name: injection_for(c) for c in configs}
    decimals = {c.name: c.decimals for c in spec.columns if isinstance(c, NumericColumn) and not c.integer}

    draws = Draws(F.col("_seed"), (ROW_ID,), method)
    perfect = generate_columns(_row_ids(spark, configs), spec, draws, keep=[DATASET, ROW_ID])
    dirty = keep(corrupt_batch(perfect, injections, draws, decimals=decimals), hold, "dirty")
    recovered = keep(clean_batch(dirty, injections, outlier_mode=outlier_mode), hold, "recovered")
    quality = keep(batch_quality(dirty, recovered), hold, "quality")
    types = damaged_types(perfect, injections, [DATASET, ROW_ID])
    type_table = small_table(spark, [(d, c) for d, columns in types.items() for c in columns], f"{DATASET} string, column string")
    validation = validate_batch(quality, injections)
    if validate and (failed := validation.where("not ok").limit(5).collect()):
        raise ValidationFailed([f"{r[DATASET]}: {e}" for r in failed for e in r["errors"]])
    if output_dir is not None:
        base = output_dir.rstrip("/")

        def bare(df: DataFrame) -> DataFrame:
            # Rows of a dataset together, so that it comes in few files.
            return df.select(*data_columns(df)).repartitionByRange(DATASET)

        export_dataset(bare(dirty), bare(recovered), {"datasets": [c.to_dict() for c in configs]}, base, formats, mode=write_mode, by=[DATASET])
        batch_documents(configs, injections, types, quality, validation).write.mode(write_mode).json(f"{base}/datasets.json")
    return Batch(list(configs), injections, perfect, dirty, recovered, quality, type_table, validation)


def batch_documents(
    configs: Sequence[DatasetConfig],
    injections: Mapping[str, InjectionConfig],
    types: Mapping[str, Sequence[str]],
    quality: DataFrame,
    validation: DataFrame,
) -> DataFrame:
    """One row for each dataset: its config, what was done to it, its counts and score, and its validation."""
    rows = [
        (
            c.name, c.domain, c.num_rows, c.difficulty, injections[c.name].seed, json.dumps(injections[c.name].used_rates),
            [s for s in BATCH_STRATEGIES if s in injections[c.name].strategies], required_operations(injections[c.name].strategies), list(types[c.name]),
        )
        for c in configs
    ]
    ddl = f"{DATASET} string, domain string, num_rows bigint, difficulty string, seed bigint, rates string, strategies array<string>, required_operations array<string>, type_columns array<string>"
    plan = quality.sparkSession.createDataFrame(rows, ddl)
    return plan.join(quality, DATASET).join(validation, DATASET)


def generate_batches(spark: SparkSession, configs: Sequence[DatasetConfig], output_dir: str | None = None, **options: Any) -> dict[str, Batch]:
    """A batch for each domain of the configs."""
    by_domain: dict[str, list[DatasetConfig]] = {}
    for c in configs:
        by_domain.setdefault(c.domain, []).append(c)
    base = output_dir.rstrip("/") if output_dir is not None else None
    return {d: generate_batch(spark, own, f"{base}/{d}" if base else None, **options) for d, own in by_domain.items()}


def generate_training_set(
    spark: SparkSession,
    domain: str = "ecommerce",
    num_easy: int = 5,
    num_medium: int = 5,
    num_hard: int = 5,
    rows_per_dataset: int = 1000,
    output_dir: str | None = None,
    base_seed: int = DEFAULT_SEED,
    **options: Any,
) -> Batch:
    """A set of easy, medium and hard datasets in one batch."""
    configs = training_configs(domain, num_easy, num_medium, num_hard, rows_per_dataset, base_seed)
    return generate_batch(spark, configs, output_dir, **options)
