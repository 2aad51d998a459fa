"""Exact order statistics without gathering the values.

The built-in exact ``percentile`` keeps every distinct value of a column in one
reducer. Here each wanted rank is enclosed between two values of a quantile
sketch, what lies at and below the two is counted, and the search goes on
strictly between them: a pass keeps a few hundredths of the rows, and always
drops the two values themselves, so ties and infinities end it sooner. Once few enough rows
lie between, they are sorted in the pass that counts them. All columns share
the passes; after the extent, a table of some million rows takes two. With groups the
first sketch comes with the extent, and the rows' keys and numbers are written once before.

With groups the places are columns of a table with one row for each group, joined
back for the next pass, so there may be as many groups as rows, and one may hold
most of them: all aggregates combine before the shuffle.

Without groups, whole numbers and decimals are compared as they are; with groups, as doubles.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.storage import through_table

#: Values of a sketch that a pass chooses from, and its accuracy.
GRID = 128
ACCURACY = 4096
#: The same for a column without groups, whose sketch is one value on the driver.
FINE_GRID = 512
FINE_ACCURACY = 8192
#: Rows between two values from which on they are sorted at once. Changes no result.
GATHER_ROWS = 65_536

Group = tuple


def _rank_columns(n: Column, probabilities: Sequence[float]) -> list[tuple[Column, Column]]:
    """The lower rank and the share of the way to the next one, for each probability."""
    out = []
    for p in probabilities:
        position = F.lit(float(p)) * (n - F.lit(1)).cast("double")
        out.append((F.floor(position).cast("long"), position - F.floor(position)))
    return out


def _grid(value: Column) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY)


class _Search:
    """The ranks of one call: a row for each group, with five columns for each rank.

    ``r`` the rank, ``lo`` and ``hi`` the values it lies between, ``found`` the value once it is
    known, ``in`` how many rows lie between at most.
    """

    def __init__(self, df: DataFrame, values: Mapping[str, Column], by: Sequence[str], gather_rows: int) -> None:
        self.by, self.gather_rows = list(by), gather_rows
        self.keys = [f"_by{i}" for i in range(len(by))]
        named = [F.col(b).alias(k) for b, k in zip(by, self.keys, strict=True)]
        self.values = [f"_v{i}" for i in range(len(values))]
        self.df = df.select(*named, *(v.alias(n) for v, n in zip(values.values(), self.values, strict=True)))

    def _grouped(self, df: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
        return df.groupBy(*self.keys).agg(*aggregates)

    def start(self, ranks) -> DataFrame:
        """Extent and sketch of all values, and the places of the ranks ``ranks(i, n)`` gives for value ``i``.

        All ranks of a value share its one sketch here; a sketch for each of them costs most of the search.
        """
        aggregates = []
        for i, v in enumerate(self.values):
            c = F.col(v)
            aggregates += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"), _grid(c).alias(f"grid{i}")]
        extent = self._grouped(self.df, aggregates)
        columns, self.of, ends = [], [], F.lit(float("inf"))
        for i in range(len(self.values)):
            n, low, high = F.col(f"n{i}"), F.col(f"min{i}"), F.col(f"max{i}")
            for r in ranks(i, n):
                j = len(self.of)
                self.of.append(i)
                known = F.when(r <= 0, low).when(r >= n - 1, high)
                lo, hi = self._between(r, n, F.col(f"grid{i}"), low, high)
                columns += [
                    r.alias(f"r{j}"), F.coalesce(lo, -ends).alias(f"lo{j}"), F.coalesce(hi, ends).alias(f"hi{j}"),
                    known.alias(f"found{j}"), self._most(n).alias(f"in{j}"),
                ]
        return extent.select(*self.keys, *(f"n{i}" for i in range(len(self.values))), *columns)

    @staticmethod
    def _between(rank: Column, n: Column, grid: Column, low: Column, high: Column) -> tuple[Column, Column]:
        """The values of the sketch around a rank, further away than the sketch may err."""
        slack = F.lit(2.0 * GRID / ACCURACY)
        place = rank.cast("double") / F.greatest(n, F.lit(1)).cast("double") * F.lit(float(GRID))
        below = F.floor(place - slack).cast("int") - F.lit(1)
        above = F.ceil(place + slack + F.lit(float(GRID)) / F.greatest(n, F.lit(1)).cast("double")).cast("int") + F.lit(1)
        lo = F.when(below >= 0, F.get(grid, below)).otherwise(low)
        hi = F.when(above <= GRID, F.get(grid, above)).otherwise(high)
        return F.coalesce(lo, low), F.coalesce(hi, high)

    @staticmethod
    def _most(n: Column) -> Column:
        return F.ceil(n.cast("double") * F.lit(6.0 / GRID)).cast("long") + F.lit(8)

    def step(self, state: DataFrame, gather: bool) -> DataFrame:
        """One pass: counts at the two values, and between them the rows or another sketch."""
        count = len(self.of)
        right = state.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)), *(f"{x}{j}" for j in range(count) for x in ("lo", "hi", "found")))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        rows = self.df.join(right, same)
        place = {f"{x}{j}": F.col(f"{x}{j}") for j in range(count) for x in ("lo", "hi", "found")}
        aggregates = []
        for j, i in enumerate(self.of):
            v, lo, hi = F.col(self.values[i]), place[f"lo{j}"], place[f"hi{j}"]
            between = F.when(place[f"found{j}"].isNull() & (v > lo) & (v < hi), v)
            aggregates += [
                F.count_if(v < lo).alias(f"below{j}"), F.count_if(v == lo).alias(f"at{j}"),
                F.count(between).alias(f"now{j}"), F.count_if((v == hi) & (hi > lo)).alias(f"top{j}"),
                (F.sort_array(F.collect_list(between)) if gather else F.struct(_grid(between).alias("g"), F.min(between).alias("a"), F.max(between).alias("b"))).alias(f"inner{j}"),
            ]
        counted = self._grouped(rows, aggregates)
        left = state.select(*self.keys, *(f"n{i}" for i in range(len(self.values))), *(f"{x}{j}" for j in range(count) for x in ("r", "lo", "hi", "found")))
        counted = counted.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)), *(c for c in counted.columns if c not in self.keys))
        joined = left.join(counted, same)
        columns = []
        for j in range(count):
            r, lo, hi, found = (F.col(f"{x}{j}") for x in ("r", "lo", "hi", "found"))
            below, at, now, top, inner = (F.col(f"{x}{j}") for x in ("below", "at", "now", "top", "inner"))
            # The rank among the rows strictly between; before them it is the lower value, after them the upper one.
            own = r - below - at
            enclosed = (r >= below) & (own < now + top)
            known = F.when(found.isNotNull(), found).when(enclosed & (own < 0), lo).when(enclosed & (own >= now), hi)
            n = F.col(f"n{self.of[j]}")
            if gather:
                known = F.coalesce(known, F.when(enclosed, F.get(inner, own.cast("int"))))
                next_lo, next_hi, most = lo, hi, now
            else:
                # The least and the greatest row between are the new ends, so each pass drops two values.
                known = F.coalesce(known, F.when(enclosed & (own == 0), inner["a"]).when(enclosed & (own == now - 1), inner["b"]))
                next_lo, next_hi = self._between(own, now, inner["g"], inner["a"], inner["b"])
                next_lo, next_hi, most = F.coalesce(next_lo, lo), F.coalesce(next_hi, hi), self._most(now)
            # Should a sketch err by more than it promises, the search starts again from the ends.
            ends = F.lit(float("inf"))
            columns += [
                r, F.when(enclosed, next_lo).otherwise(-ends).alias(f"lo{j}"), F.when(enclosed, next_hi).otherwise(ends).alias(f"hi{j}"),
                known.alias(f"found{j}"), F.when(enclosed, most).otherwise(n).alias(f"in{j}"),
            ]
        return joined.select(*self.keys, *(f"n{i}" for i in range(len(self.values))), *columns)

    def run(self, ranks) -> DataFrame:
        """(keys, n of each value, found of each rank)."""
        state = through_table(self.start(ranks), "quantiles")
        while self.of:
            # One number: the most rows between the two values of a rank that is open.
            sizes = [F.when(F.col(f"found{j}").isNull() & (F.col(f"n{i}") > 0), F.col(f"in{j}")).otherwise(F.lit(0)) for j, i in enumerate(self.of)]
            most = state.agg(F.max(F.greatest(*sizes, F.lit(0)))).first()[0]
            if not most:
                break
            state = through_table(self.step(state, gather=most <= self.gather_rows), "quantiles")
        return state


def _as_doubles(values: Mapping[str, Column]) -> dict[str, Column]:
    return {name: F.nanvl(c.cast("double"), F.lit(None).cast("double")) for name, c in values.items()}


def _as_numbers(df: DataFrame, values: Mapping[str, Column]) -> dict[str, Column]:
    """Whole numbers and decimals as they are, all else as doubles without NaN."""
    types = df.select(*(c.alias(f"_v{i}") for i, c in enumerate(values.values()))).schema.fields
    exact = [isinstance(f.dataType, T.IntegralType | T.DecimalType) for f in types]
    return {name: c if e else d for (name, c), d, e in zip(values.items(), _as_doubles(values).values(), exact, strict=True)}


def group_quantiles(
    df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float], by: Sequence[str], gather_rows: int = GATHER_ROWS
) -> DataFrame:
    """One row for each group: its columns and, named as in ``values``, an array of quantiles (NULL without values)."""
    shares = list(probabilities)
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= gather_rows:
        # Written, so that plans which join it again and again stay short.
        return through_table(_gathered_groups(df, values, shares, by), "quantiles")
    search = _Search(df, _as_doubles(values), by, gather_rows)
    # Each pass reads keys and numbers, not what made them.
    search.df = through_table(search.df, "quantiles")

    def ranks(_: int, n: Column) -> list[Column]:
        return [r for low, _ in _rank_columns(n, shares) for r in (low, F.least(low + 1, F.greatest(n - 1, F.lit(0))))]

    found = search.run(ranks)
    columns = []
    for i, name in enumerate(values):
        n = F.col(f"n{i}")
        pairs = [(F.col(f"found{2 * (i * len(shares) + k)}"), F.col(f"found{2 * (i * len(shares) + k) + 1}")) for k in range(len(shares))]
        out = [_interpolated(low, high, share) for (low, high), (_, share) in zip(pairs, _rank_columns(n, shares), strict=True)]
        columns.append(F.when(n > 0, F.array(*out)).alias(name))
    return found.select(*(F.col(k).alias(b) for k, b in zip(search.keys, by, strict=True)), *columns)


def _interpolated(low: Column, high: Column, share: Column) -> Column:
    # Two equal values are one, infinite ones too; nothing is added for a whole rank.
    infinite = F.lit(float("inf"))
    whole = (share == 0) | (low == high) | (low == -infinite)
    return F.when(whole, low).when(high == infinite, high).otherwise(low + (high - low) * share)


def _gathered_groups(df: DataFrame, values: Mapping[str, Column], shares: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Groups of a bounded size, each column's values sorted in one aggregation."""
    lists = {f"_l{i}": F.sort_array(F.collect_list(c)) for i, c in enumerate(_as_doubles(values).values())}
    sorted_ = df.groupBy(*by).agg(*(c.alias(n) for n, c in lists.items()))
    columns = []
    for n, name in zip(lists, values, strict=True):
        size = F.size(n)
        out = [
            _interpolated(F.get(n, low.cast("int")), F.get(n, F.least(low.cast("int") + 1, size - 1)), share)
            for low, share in _rank_columns(size, shares)
        ]
        columns.append(F.when(size > 0, F.array(*out)).alias(name))
    return sorted_.select(*by, *columns)


class _Column:
    """What is known of one column: values with the rows below and at them."""

    def __init__(self, name: str, n: int, low, high) -> None:
        self.name, self.n, self.low, self.high = name, n, low, high
        self.counted: dict = {}
        self.found: dict[int, object] = {}

    def place(self, rank: int) -> tuple:
        """(lo, hi, rows at or below lo, rows strictly between): counted values around a rank, or the value itself as both."""
        at = sorted(self.counted)
        i = bisect.bisect_right(at, rank, key=lambda v: self.counted[v][0]) - 1
        lo, before = None, 0
        if i >= 0:
            lo = at[i]
            below, equal = self.counted[lo]
            before = below + equal
            if rank < before:
                return lo, lo, before, 0
        hi = at[i + 1] if i + 1 < len(at) else None
        return lo, hi, before, (self.n if hi is None else self.counted[hi][0]) - before


def _strictly_between(c: Column, lo, hi) -> Column:
    inside = c.isNotNull()
    if lo is not None:
        inside = inside & (c > F.lit(lo))
    return inside if hi is None else inside & (c < F.lit(hi))


def _nearby(rank: int, n: int, grid: Sequence) -> list:
    """The values of a sketch of ``n`` rows around a rank, further away than the sketch may err."""
    place, slack = rank / n * FINE_GRID, 2.0 * FINE_GRID / FINE_ACCURACY
    below, above = math.floor(place - slack) - 1, math.ceil(place + slack + FINE_GRID / n) + 1
    return [grid[i] for i in (below, above) if 0 <= i <= FINE_GRID]


def _fine_grid(value: Column) -> Column:
    return F.percentile_approx(value, [i / FINE_GRID for i in range(FINE_GRID + 1)], FINE_ACCURACY)


def order_statistics(
    df: DataFrame, values: Mapping[str, Column], wanted: Callable[[str, int], Sequence[int]], gather_rows: int = GATHER_ROWS
) -> dict[str, tuple[int, dict[int, object]]]:
    """For each column, how many values it has and those at the ranks that ``wanted(name, n)`` gives.

    A sketch of each column comes with its extent; the values it names around the
    ranks are counted in one plain aggregation, and what lies between them is
    gathered once for each column. Where too much lies between, that is sketched and
    counted again. The counts are exact whatever the sketch says, in the column's
    own type. The places are a few numbers for each rank and stay on the driver.
    """
    columns = {f"_v{i}": name for i, name in enumerate(values)}
    rows = df.select(*(values[name].alias(v) for v, name in columns.items()))
    extent = rows.agg(
        *(e for v in columns for e in (F.count(v).alias(f"n{v}"), F.min(v).alias(f"a{v}"), F.max(v).alias(f"b{v}"), _fine_grid(F.col(v)).alias(f"g{v}")))
    ).first()
    known = {v: _Column(v, extent[f"n{v}"], extent[f"a{v}"], extent[f"b{v}"]) for v in columns}
    open_: dict[str, set[int]] = {}
    for v, name in columns.items():
        c = known[v]
        for r in set(wanted(name, c.n)) if c.n else ():
            if r <= 0 or r >= c.n - 1:
                c.found[r] = c.low if r <= 0 else c.high
            else:
                open_.setdefault(v, set()).add(r)
    sketches = {(v, None, None): (c.n, extent[f"g{v}"], c.low, c.high) for v, c in known.items()}
    while open_:
        spans = {(v, *known[v].place(r)): None for v, ranks in open_.items() for r in ranks}
        if max(inside for *_, inside in spans) <= gather_rows:
            _gather(rows, known, open_, list(spans))
            break
        fresh: dict[str, set] = {}
        for v, ranks in open_.items():
            for r in ranks:
                lo, hi, before, inside = known[v].place(r)
                if inside > gather_rows:
                    n, grid, low, high = sketches[v, lo, hi]
                    near = [g for g in _nearby(r - before, n, grid) if (lo is None or g > lo) and (hi is None or g < hi)]
                    # The least and the greatest row between end any span of few values.
                    fresh.setdefault(v, set()).update([*near, low, high])
        asked = [(v, b) for v, bounds in fresh.items() for b in bounds if b not in known[v].counted]
        counts = rows.agg(*(e for i, (v, b) in enumerate(asked) for e in (F.count_if(F.col(v) < F.lit(b)).alias(f"b{i}"), F.count_if(F.col(v) == F.lit(b)).alias(f"e{i}")))).first()
        for i, (v, b) in enumerate(asked):
            known[v].counted[b] = counts[f"b{i}"], counts[f"e{i}"]
        large = []
        for v in list(open_):
            for r in list(open_[v]):
                lo, hi, _, inside = known[v].place(r)
                if lo is not None and lo == hi:
                    known[v].found[r] = lo
                    open_[v].discard(r)
                elif inside > gather_rows:
                    large.append((v, lo, hi))
            if not open_[v]:
                del open_[v]
        if large:
            large = list(dict.fromkeys(large))
            between = [F.when(_strictly_between(F.col(v), lo, hi), F.col(v)) for v, lo, hi in large]
            row = rows.agg(*(e for i, x in enumerate(between) for e in (F.count(x).alias(f"n{i}"), _fine_grid(x).alias(f"g{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")))).first()
            sketches = {span: (row[f"n{i}"], row[f"g{i}"], row[f"a{i}"], row[f"b{i}"]) for i, span in enumerate(large)}
    return {name: (known[v].n, known[v].found) for v, name in columns.items()}


def _gather(rows: DataFrame, known: Mapping[str, _Column], open_: Mapping[str, set[int]], spans: Sequence[tuple]) -> None:
    """The rows of all spans of a column in one sorted list, from which only the wanted ones leave the job."""
    lists, picks, order = [], [], []
    for v, ranks in open_.items():
        own = sorted((s for s in spans if s[0] == v), key=lambda s: s[3])
        inside = F.lit(False)
        for _, lo, hi, _, _ in own:
            inside = inside | _strictly_between(F.col(v), lo, hi)
        lists.append(F.sort_array(F.collect_list(F.when(inside, F.col(v)))).alias(v))
        # Where each span begins in the list.
        begin = {s[1:3]: sum(t[4] for t in own[:i]) for i, s in enumerate(own)}
        for r in sorted(ranks):
            lo, hi, before, _ = known[v].place(r)
            picks.append(F.get(v, F.lit(begin[lo, hi] + r - before)).alias(f"p{len(picks)}"))
            order.append((v, r))
    row = rows.agg(*lists).select(*picks).first()
    for i, (v, r) in enumerate(order):
        known[v].found[r] = row[f"p{i}"]


def _interpolate(low, high, share: float):
    """A double, or the exact value where a double would not hold it."""
    if share == 0 or low == high or low == -math.inf:
        return float(low) if float(low) == low else low
    if high == math.inf:
        return math.inf
    if isinstance(low, float):
        return low + (high - low) * share
    return float(Fraction(low) + Fraction(high - low) * Fraction(share))


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    gather_rows: int = GATHER_ROWS,
) -> dict[Group, dict[str, list[float | None]]]:
    """Quantiles with linear interpolation; NULL and NaN are left out.

    Returns ``{group: {name: [quantile, ...]}}``; without ``by`` the only group
    is ``()``. A name without any value gets ``None``. With many groups use
    ``group_quantiles``: this brings one row for each to the driver.
    """
    if not values:
        return {(): {}}
    if not by:
        places = lambda n: [(math.floor(p * (n - 1)), p * (n - 1) - math.floor(p * (n - 1))) for p in probabilities]
        found = order_statistics(df, _as_numbers(df, values), lambda _, n: [r for low, share in places(n) for r in (low, low + (share > 0))], gather_rows)
        return {
            (): {
                name: [_interpolate(at[low], at[low + (share > 0)], share) for low, share in places(n)] if n else [None] * len(probabilities)
                for name, (n, at) in found.items()
            }
        }
    out = {}
    names = {f"q{i}": name for i, name in enumerate(values)}
    for row in group_quantiles(df, dict(zip(names, values.values(), strict=True)), probabilities, by, gather_rows).collect():
        group = tuple(row[: len(by)])
        out[group] = {name: list(row[q]) if row[q] is not None else [None] * len(probabilities) for q, name in names.items()}
    return out


def kth_smallest(
    df: DataFrame, values: Mapping[str, Column], sizes: Mapping[str, int], gather_rows: int = GATHER_ROWS
) -> dict[str, float | None]:
    """The ``sizes[name]``-th smallest value of each column (1-based), exact."""
    found = order_statistics(df, {n: c.cast("double") for n, c in values.items()}, lambda name, n: [min(sizes[name], n) - 1] if sizes[name] > 0 else [], gather_rows)
    return {name: next(iter(at.values()), None) for name, (_, at) in found.items()}
