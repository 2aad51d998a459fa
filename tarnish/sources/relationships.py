"""Relationships between the columns of a spec, compiled to ordered projections.

``derived``: the target is a SQL expression of its source columns.
``conditional``: the target's own spec is changed by cases, each a condition on
its source columns. ``correlation``: source and target are drawn together, by a
Gaussian copula that leaves the distribution of each as it is.

Columns form a dependency graph: what depends on nothing is made first, each
later projection makes the columns whose sources are there. A cycle is refused,
and so are strengths that no joint distribution has. Like other generated
columns these are functions of (seed, column, row key): no shuffle, no state.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.draws import Draws
from tarnish.sources.spec import CategoricalColumn, ColumnSpec, DatetimeColumn, NumericColumn, TableSpec

RELATIONSHIP_TYPES = ("correlation", "conditional", "derived")

# The polynomial of Abramowitz and Stegun 26.2.17 for the tail of the normal distribution.
TAIL_SCALE = 0.2316419
TAIL_TERMS = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

#: The largest draw below one, so that no logarithm meets a zero.
BELOW_ONE = 1.0 - 2.0**-53


@dataclass(frozen=True)
class Relationship:
    type: str
    target: str
    sources: Sequence[str] = ()
    parameters: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.type not in RELATIONSHIP_TYPES:
            raise ValueError(f"unknown relationship {self.type!r}; use one of {RELATIONSHIP_TYPES}")
        if self.type == "derived" and not self.parameters.get("expression"):
            raise ValueError(f"{self.target}: a derived column needs its expression")
        if self.type == "conditional" and not self.parameters.get("cases"):
            raise ValueError(f"{self.target}: a conditional column needs its cases")
        if self.type == "correlation":
            if len(self.sources) != 1:
                raise ValueError(f"{self.target}: a correlation has one source column")
            if not -1 < float(self.parameters.get("strength", 2)) < 1:
                raise ValueError(f"{self.target}: a correlation needs a strength between -1 and 1")

    @classmethod
    def from_dict(cls, data: Mapping[str, Any]) -> Relationship:
        return cls(data["type"], data["target_column"], tuple(data.get("source_columns", ())), dict(data.get("parameters", {})))


@dataclass(frozen=True)
class Case:
    """Rows where ``condition`` holds: a column spec of their own, a constant, or nothing."""

    condition: str
    column: ColumnSpec | None = None
    constant: Any = None


def quoted(value: Any) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def cases_of(relationship: Relationship, column: ColumnSpec) -> list[Case]:
    """The cases in order; the first that holds counts.

    A case says ``when`` (a SQL condition), or ``if_value`` (one value of the
    source, or a list of them), and then fields of the column's spec that differ,
    ``value`` for a constant, or ``null``.
    """
    out = []
    for given in relationship.parameters["cases"]:
        told = dict(given)
        condition = told.pop("when", None)
        if condition is None:
            if "if_value" not in told or len(relationship.sources) != 1:
                raise ValueError(f"{relationship.target}: a case needs when, or if_value and one source column")
            values = told.pop("if_value")
            values = values if isinstance(values, list | tuple) else [values]
            condition = f"{relationship.sources[0]} IN ({', '.join(map(quoted, values))})"
        if told.pop("null", False):
            out.append(Case(condition))
        elif "value" in told:
            out.append(Case(condition, constant=told["value"]))
        else:
            if "values" in told and "frequencies" not in told:
                told["frequencies"] = None
            out.append(Case(condition, replace(column, **told)))
    return out


@dataclass(frozen=True)
class Plan:
    """What is drawn together, and what is made after what."""

    #: Groups of correlated columns, each with the lower triangle that mixes independent normals.
    groups: list[tuple[list[str], list[list[float]]]]
    #: Columns of each projection, in order.
    levels: list[list[str]]
    made_by: Mapping[str, Relationship]


def _lower_triangle(names: Sequence[str], strengths: Mapping[frozenset, float]) -> list[list[float]]:
    """The Cholesky factor of the correlation matrix; pairs without a strength are uncorrelated."""
    n = len(names)
    out = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(i + 1):
            wanted = 1.0 if i == j else strengths.get(frozenset((names[i], names[j])), 0.0)
            rest = wanted - sum(out[i][k] * out[j][k] for k in range(j))
            if i == j:
                if rest <= 1e-12:
                    raise ValueError(f"no columns can be correlated like {sorted(names)}: the strengths contradict each other")
                out[i][i] = math.sqrt(rest)
            else:
                out[i][j] = rest / out[j][j]
    return out


def _correlated(spec: TableSpec, relationships: Sequence[Relationship]) -> list[tuple[list[str], list[list[float]]]]:
    strengths: dict[frozenset, float] = {}
    group_of = {}
    for r in relationships:
        pair = frozenset((r.sources[0], r.target))
        if len(pair) == 1 or pair in strengths:
            raise ValueError(f"{r.target}: correlated with itself, or twice with the same column")
        strengths[pair] = float(r.parameters["strength"])
        merged = group_of.get(r.sources[0], {r.sources[0]}) | group_of.get(r.target, {r.target})
        for name in merged:
            group_of[name] = merged
    groups, seen = [], set()
    for c in spec.columns:
        if c.name in group_of and c.name not in seen:
            names = [x.name for x in spec.columns if x.name in group_of[c.name]]
            seen |= set(names)
            groups.append((names, _lower_triangle(names, strengths)))
    return groups


def plan_of(spec: TableSpec) -> Plan:
    """Check the relationships of a spec and put its columns in order."""
    relationships = [r if isinstance(r, Relationship) else Relationship.from_dict(r) for r in spec.relationships]
    names = {c.name for c in spec.columns}
    made_by: dict[str, Relationship] = {}
    for r in relationships:
        for name in (r.target, *r.sources):
            if name not in names:
                raise ValueError(f"relationship of {r.target}: no column {name!r} in {spec.name}")
        if r.type == "correlation":
            continue
        if r.target in made_by:
            raise ValueError(f"{r.target}: the target of two relationships")
        made_by[r.target] = r
    groups = _correlated(spec, [r for r in relationships if r.type == "correlation"])
    for names_, _ in groups:
        for name in names_:
            column = spec.column(name)
            if made_by.get(name, None) is not None and made_by[name].type == "derived":
                raise ValueError(f"{name}: a derived column cannot be correlated too")
            if isinstance(column, NumericColumn) and column.unique:
                raise ValueError(f"{name}: a unique column cannot be correlated")
    levels, done = [], set()
    waiting = [c.name for c in spec.columns]
    while waiting:
        ready = [n for n in waiting if n not in made_by or set(made_by[n].sources) <= done]
        if not ready:
            raise ValueError(f"the relationships go round in a circle: {' -> '.join(_circle(waiting, made_by))}")
        levels.append(ready)
        done |= set(ready)
        waiting = [n for n in waiting if n not in done]
    return Plan(groups, levels, made_by)


def _circle(waiting: Sequence[str], made_by: Mapping[str, Relationship]) -> list[str]:
    path = [waiting[0]]
    while path[-1] not in path[:-1]:
        path.append(next(s for s in made_by[path[-1]].sources if s in waiting))
    return path[path.index(path[-1]) :]


def normal_share(z: Column) -> Column:
    """The share of a standard normal below ``z``, to 1e-7, in [0, 1)."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(TAIL_SCALE) * F.abs(z))
    terms = F.lit(TAIL_TERMS[-1])
    for b in reversed(TAIL_TERMS[:-1]):
        terms = F.lit(b) + t * terms
    tail = F.exp(z * z / F.lit(-2.0)) / F.lit(math.sqrt(2 * math.pi)) * t * terms
    return F.when(z < 0, tail).otherwise(F.least(F.lit(1.0) - tail, F.lit(BELOW_ONE)))


class LinkedDraws:
    """Draws of which some columns' come from the copula."""

    def __init__(self, draws: Any, shares: Mapping[str, str], normals: Mapping[str, str]) -> None:
        self._draws, self._shares, self._normals = draws, shares, normals

    @property
    def key(self) -> Sequence[str]:
        return self._draws.key

    def uniform(self, *tags: object) -> Column:
        if tags[0] in self._shares and tags[1] in ("value", "day"):
            return F.col(self._shares[tags[0]])
        return self._draws.uniform(*tags)

    def normal(self, name: str) -> Column:
        return F.col(self._normals[name]) if name in self._normals else self._draws.normal(name)

    def choice(self, n: int, *tags: object) -> Column:
        return F.floor(self.uniform(*tags) * F.lit(float(n))).cast("int")


def _typed(c: ColumnSpec, value: Column) -> Column:
    """A derived value with the limits, rounding and type of its column."""
    if isinstance(c, DatetimeColumn):
        at = value.cast("timestamp_ntz")
        return at if c.include_time else at.cast("date").cast("timestamp_ntz")
    if isinstance(c, CategoricalColumn):
        return value.cast("string")
    x = value.cast("double")
    # A null stays one, which greatest and least would pass over.
    for limit, bounded in ((c.min_value, F.greatest), (c.max_value, F.least)):
        if limit is not None:
            x = F.when(x.isNotNull(), bounded(x, F.lit(float(limit))))
    if c.integer:
        return F.rint(x).cast("bigint")
    scale = F.lit(float(10**c.decimals))
    return F.rint(x * scale) / scale


def generate_related(df: DataFrame, spec: TableSpec, draws: Draws, keep: Sequence[str] | None = None) -> DataFrame:
    """The spec's columns with their relationships, after the ``keep`` columns (default: the key) of ``df``."""
    from tarnish.sources.generate import column_expression

    plan, staged = plan_of(spec), draws.staged()
    shares, normals, mixed = {}, {}, {}
    for names, triangle in plan.groups:
        independent = [staged.normal(n) for n in names]
        for name, row in zip(names, triangle, strict=True):
            at = len(normals)
            shares[name], normals[name] = f"_share{at}", f"_normal{at}"
            mixed[normals[name]] = sum((F.lit(w) * e for w, e in zip(row[1:], independent[1:], strict=True) if w), F.lit(row[0]) * independent[0])
    linked = LinkedDraws(staged, shares, normals)

    def made(name: str) -> Column:
        column, relationship = spec.column(name), plan.made_by.get(name)
        if relationship is None:
            return column_expression(column, linked)
        if relationship.type == "derived":
            return _typed(column, F.expr(relationship.parameters["expression"]))
        value = column_expression(column, linked)
        for case in reversed(cases_of(relationship, column)):
            own = column_expression(case.column, linked) if case.column is not None else F.lit(case.constant)
            value = F.when(F.expr(case.condition), own).otherwise(value)
        return value

    # All expressions first: they say which draws there are.
    levels = [{name: made(name) for name in level} for level in plan.levels]
    kept = list(draws.key if keep is None else keep)
    clash = sorted(set(kept) & {c.name for c in spec.columns})
    if clash:
        raise ValueError(f"the spec makes columns that are kept: {clash}")
    out = staged.select(df.select(*dict.fromkeys([*kept, *draws.key])), "*")
    if mixed:
        out = out.withColumns(mixed).withColumns({shares[n]: normal_share(F.col(normals[n])) for n in normals})
    for level in levels:
        out = out.withColumns(level)
    return out.select(*kept, *(c.name for c in spec.columns))
