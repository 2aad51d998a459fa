"""Which errors go into a table, in what order, and what repairs them."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame

from tarnish.functions.draws import Draws
from tarnish.functions.families import COPY
from tarnish.operators import inject as I

# The strategy names, the cleaning operation each one calls for,
# and how many strategies a difficulty level draws (lowest, highest).
STRATEGIES = (
    "missing_values",
    "text_whitespace",
    "text_case",
    "text_special_chars",
    "type_corruption",
    "outliers",
    "duplicates",
)
REQUIRED_OPERATION = {
    "missing_values": "handle_missing_values",
    "text_whitespace": "clean_text_columns",
    "text_case": "clean_text_columns",
    "text_special_chars": "clean_text_columns",
    "type_corruption": "convert_data_types",
    "outliers": "remove_outliers",
    "duplicates": "remove_duplicates",
}
DIFFICULTY = {"easy": (1, 2), "medium": (3, 4), "hard": (5, 7)}

Injector = Callable[[DataFrame, Draws, "InjectionConfig"], DataFrame]


@dataclass(frozen=True)
class InjectionConfig:
    """Strategies in order, seed and rates of one injection."""

    strategies: Sequence[str]
    seed: int = 42
    rates: Mapping[str, float] = field(default_factory=dict)
    difficulty: str = "custom"
    sampling: str = "bernoulli"
    exclude: Sequence[str] = ()
    #: Columns whose new values are rounded, with their decimals.
    decimals: Mapping[str, int] = field(default_factory=dict)
    #: Columns the type strategy turns to text; None draws them.
    type_columns: Sequence[str] | None = None
    #: Copies made before a cell-level strategy are damaged apart from their
    #: originals and are exact copies no more; so they are made last by default.
    duplicates_last: bool = True
    #: Outlier rates above it are lowered to it with a warning; None allows any.
    max_rate: float | None = I.MAX_OUTLIER_RATE

    def __post_init__(self) -> None:
        object.__setattr__(self, "strategies", tuple(self.strategies))
        object.__setattr__(self, "rates", {**I.DEFAULT_RATES, **self.rates})

    @classmethod
    def from_difficulty(cls, level: str, seed: int | None = None, **options: Any) -> InjectionConfig:
        """Strategies drawn without replacement and in random order, as many as the level says."""
        if level not in DIFFICULTY:
            raise ValueError(f"unknown difficulty {level!r}; use one of {', '.join(DIFFICULTY)}")
        seed = 42 if seed is None else seed
        dice = random.Random(f"{seed}:{level}")
        return cls(dice.sample(STRATEGIES, dice.randint(*DIFFICULTY[level])), seed, difficulty=level, **options)

    @classmethod
    def custom(
        cls, strategies: Sequence[str], seed: int | None = None, rates: Mapping[str, float] | None = None, **options: Any
    ) -> InjectionConfig:
        return cls(strategies, 42 if seed is None else seed, rates or {}, **options)

    def with_options(self, **options: Any) -> InjectionConfig:
        return replace(self, **options)

    @property
    def order(self) -> list[str]:
        if not self.duplicates_last:
            return list(self.strategies)
        return sorted(self.strategies, key=lambda s: s == "duplicates")

    @property
    def used_rates(self) -> dict[str, float]:
        """The rates as they are injected."""
        rate = self.rates["outlier_rate"]
        return {**self.rates, "outlier_rate": rate if self.max_rate is None else min(rate, self.max_rate)}

    def to_dict(self) -> dict[str, Any]:
        return {
            "strategies": list(self.strategies),
            "seed": self.seed,
            "rates": self.used_rates,
            "difficulty": self.difficulty,
            "sampling": self.sampling,
        }


def _cells(operator: Callable[..., DataFrame], rate: str) -> Injector:
    return lambda df, draws, config: operator(
        df, draws, config.rates[rate], exclude=config.exclude, sampling=config.sampling
    )


_INJECTORS: dict[str, Injector] = {
    "missing_values": _cells(I.inject_missing, "missing_rate"),
    "text_whitespace": _cells(I.inject_whitespace, "whitespace_rate"),
    "text_case": _cells(I.inject_case, "case_rate"),
    "text_special_chars": _cells(I.inject_special_characters, "special_char_rate"),
    "type_corruption": lambda df, draws, config: I.inject_type_errors(
        df, draws, config.rates["type_corruption_rate"], config.type_columns, config.exclude
    ),
    "outliers": lambda df, draws, config: I.inject_outliers(
        df,
        draws,
        config.rates["outlier_rate"],
        config.rates["outlier_severity"],
        exclude=config.exclude,
        sampling=config.sampling,
        decimals=config.decimals,
        max_rate=config.max_rate,
    ),
    "duplicates": lambda df, draws, config: I.inject_duplicates(
        df, draws, config.rates["duplicate_rate"], config.sampling
    ),
}


def register_strategy(name: str, injector: Injector, operation: str) -> None:
    """Add a strategy: a function (df, draws, config) -> df and the operation that repairs it."""
    _INJECTORS[name] = injector
    REQUIRED_OPERATION[name] = operation


def inject(df: DataFrame, config: InjectionConfig, draws: Draws) -> DataFrame:
    """Apply the strategies of ``config`` one after the other."""
    unknown = [s for s in config.strategies if s not in _INJECTORS]
    if unknown:
        raise ValueError(f"unknown strategies {unknown}; available: {', '.join(_INJECTORS)}")
    exclude = tuple(dict.fromkeys([*config.exclude, *draws.key]))
    config = config.with_options(exclude=exclude)
    for strategy in config.order:
        if COPY in df.columns and COPY not in draws.key:
            draws = Draws(draws.seed, (*draws.key, COPY), draws.method)
        df = _INJECTORS[strategy](df, draws, config)
    return df


def required_operations(strategies: Iterable[str]) -> list[str]:
    """The cleaning operations the strategies call for, each once, in first-seen order."""
    return list(dict.fromkeys(REQUIRED_OPERATION[s] for s in strategies))
