"""Repeatable random numbers that depend on the row key only.

``rand(seed)`` depends on how rows fall into partitions, so a retried task or a
second read of the same plan may see other values. Here each draw is a hash of
(seed, tags, row key): the same cell gets the same number under any
partitioning, any plan and any retry, and no state moves between tasks.

``xxhash64`` is the fast method. ``md5`` costs more, but any SQL engine can
recompute it, so results can be compared with another engine value by value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.families import ROW_ID

METHODS = ("xxhash64", "md5")


@dataclass(frozen=True)
class Draws:
    #: A number, or a column that gives each row's.
    seed: int | Column = 42
    key: Sequence[str] = (ROW_ID,)
    method: str = "xxhash64"

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"unknown draw method {self.method!r}; use one of {METHODS}")
        if not self.key:
            raise ValueError("draws need at least one key column")

    def _digest(self, tags: Sequence[object], extra: Sequence[Column] = ()) -> Column:
        parts = [self._seed_text(), *(F.lit(str(t)) for t in tags)]
        keys = [F.col(k).cast("string") for k in self.key]
        return F.md5(F.concat_ws(":", *parts, *keys, *extra))

    def _seed_text(self) -> Column:
        return self.seed.cast("string") if isinstance(self.seed, Column) else F.lit(str(self.seed))

    def uniform(self, *tags: object) -> Column:
        """A double in [0, 1)."""
        if self.method == "md5":
            digits = F.substring(self._digest(tags), 1, 13)
            return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))
        tag = F.concat_ws(":", self._seed_text(), *(F.lit(str(t)) for t in tags))
        bits = F.shiftrightunsigned(F.xxhash64(tag, *self.key), 11)
        return bits.cast("double") / F.lit(float(2**53))

    def staged(self) -> StagedDraws:
        return StagedDraws(self)

    def below(self, rate: float | Column, *tags: object) -> Column:
        """True for a share ``rate`` of the keys: ``uniform(*tags) < rate``."""
        if isinstance(rate, Column):
            return self.uniform(*tags) < rate
        if self.method == "md5":
            # Hex digits sort like the number they spell, so no conversion is needed.
            limit = math.ceil(rate * 2**52)
            return F.lit(True) if limit >= 2**52 else self._digest(tags) < F.lit(f"{limit:013x}")
        return self.uniform(*tags) < F.lit(float(rate))

    def choice(self, n: int, *tags: object) -> Column:
        """An integer in 0..n-1."""
        return F.floor(self.uniform(*tags) * F.lit(float(n))).cast("int")

    def coins(self, length: Column, *tags: object) -> Column:
        """An array of at least ``length`` hex digits: one coin flip per element.

        One md5 gives 32 flips, so a text of n characters needs n/32 hashes.
        """
        blocks = F.sequence(F.lit(0), F.floor(length / F.lit(32)).cast("int"))
        text = F.array_join(F.transform(blocks, lambda b: self._digest(tags, [b.cast("string")])), "")
        return F.split(text, "")


class StagedDraws:
    """Draws computed once per row as columns of their own, for expressions that read them often.

    Spark computes a repeated subexpression again in each branch of a
    condition. Expressions made from staged draws refer to columns instead;
    ``select`` puts the projection that computes them underneath.
    """

    def __init__(self, draws: Draws) -> None:
        self._draws = draws
        self._columns: dict[tuple[object, ...], str] = {}

    @property
    def key(self) -> Sequence[str]:
        return self._draws.key

    def uniform(self, *tags: object) -> Column:
        name = self._columns.setdefault(tags, f"_draw{len(self._columns)}")
        return F.col(name)

    def normal(self, name: str) -> Column:
        """A standard normal draw."""
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - self.uniform(name, "radius")))
        return radius * F.cos(F.lit(2 * math.pi) * self.uniform(name, "angle"))

    def choice(self, n: int, *tags: object) -> Column:
        return F.floor(self.uniform(*tags) * F.lit(float(n))).cast("int")

    def select(self, df: DataFrame, *columns: Column | str) -> DataFrame:
        drawn = {name: self._draws.uniform(*tags) for tags, name in self._columns.items()}
        return (df.withColumns(drawn) if drawn else df).select(*columns)
