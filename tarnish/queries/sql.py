"""SQL fragments that restate draws, injectors and generators for the comparison engine."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import timedelta

from tarnish.functions.text import DIGIT_RUN, NOT_ALPHANUMERIC, SPECIAL_CHARACTERS, WHITESPACE
from tarnish.operators.inject import DEFAULT_RATES, OUTLIER_MARGIN
from tarnish.queries.registry import SEED
from tarnish.sources.generate import binomial_steps, poisson_steps
from tarnish.sources.relationships import BELOW_ONE, TAIL_SCALE, TAIL_TERMS, cases_of, plan_of
from tarnish.sources.spec import CategoricalColumn, ColumnSpec, DatetimeColumn, NumericColumn, TableSpec


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def digest(key: str, *tags: str, extra: str | None = None) -> str:
    parts = [quoted(str(SEED)), *(quoted(t) for t in tags), *(f"CAST({k} AS VARCHAR)" for k in key.split(","))]
    return f"md5(concat_ws(':', {', '.join(parts + ([extra] if extra else []))}))"


def u(key: str, *tags: str) -> str:
    """The draw in [0, 1) of a row key."""
    return f"(CAST('0x' || substr({digest(key, *tags)}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def choice(key: str, n: int, *tags: str) -> str:
    return f"CAST(floor({u(key, *tags)} * {n}) AS INTEGER)"


def strip(c: str) -> str:
    return f"trim({c}, {quoted(WHITESPACE)})"


def remove_special(c: str) -> str:
    return f"regexp_replace({c}, {quoted(NOT_ALPHANUMERIC)}, '', 'g')"


def remove_numbers(c: str) -> str:
    return f"regexp_replace({c}, {quoted(DIGIT_RUN)}, '', 'g')"


def missing_number(c: str, key: str, sql_type: str, rate: float = DEFAULT_RATES["missing_rate"]) -> str:
    kind = choice(key, 4, c, "missing", "kind")
    damaged = f"CASE {kind} WHEN 0 THEN NULL WHEN 1 THEN -999 WHEN 2 THEN 0 ELSE 999999 END"
    return f"CAST(CASE WHEN {u(key, c, 'missing', 'cell')} < {rate} THEN {damaged} ELSE {c} END AS {sql_type})"


def missing_text(c: str, key: str, rate: float = DEFAULT_RATES["missing_rate"]) -> str:
    kind = choice(key, 3, c, "missing", "kind")
    return f"CASE WHEN {u(key, c, 'missing', 'cell')} < {rate} THEN CASE WHEN {kind} = 1 THEN '' END ELSE {c} END"


def whitespace(c: str, key: str, rate: float = DEFAULT_RATES["whitespace_rate"], value: str | None = None) -> str:
    v = value or c
    kind = choice(key, 4, c, "whitespace", "kind")
    damaged = f"CASE {kind} WHEN 0 THEN '  ' || {v} WHEN 1 THEN {v} || '  ' WHEN 2 THEN '  ' || {v} || '  ' ELSE replace({v}, ' ', '  ') END"
    return f"CASE WHEN {v} IS NOT NULL AND {u(key, c, 'whitespace', 'cell')} < {rate} THEN {damaged} ELSE {v} END"


def upper(c: str) -> str:
    """Upper case as Spark (and Python) have it: sharp s becomes two letters."""
    return f"replace(upper({c}), 'ẞ', 'SS')"


def title(c: str) -> str:
    chars = f"string_split({c}, '')"
    cased = f"CASE WHEN i = 1 OR upper({chars}[i - 1]) = lower({chars}[i - 1]) THEN replace(upper(ch), 'ẞ', 'Ss') ELSE lower(ch) END"
    return f"array_to_string(list_transform({chars}, lambda ch, i: {cased}), '')"


def mixed_case(c: str, key: str, *tags: str) -> str:
    block = digest(key, *tags, extra="CAST((i - 1) // 32 AS VARCHAR)")
    cased = f"CASE WHEN substr({block}, (i - 1) % 32 + 1, 1) >= '8' THEN {upper('ch')} ELSE lower(ch) END"
    return f"array_to_string(list_transform(string_split({c}, ''), lambda ch, i: {cased}), '')"


def case(c: str, key: str, rate: float = DEFAULT_RATES["case_rate"], value: str | None = None) -> str:
    v = value or c
    kind = choice(key, 4, c, "case", "kind")
    damaged = (
        f"CASE {kind} WHEN 0 THEN {upper(v)} WHEN 1 THEN lower({v}) "
        f"WHEN 2 THEN {title(v)} ELSE {mixed_case(v, key, c, 'case', 'coins')} END"
    )
    return f"CASE WHEN {v} IS NOT NULL AND {u(key, c, 'case', 'cell')} < {rate} THEN {damaged} ELSE {v} END"


def special(c: str, key: str, rate: float = DEFAULT_RATES["special_char_rate"], value: str | None = None) -> str:
    v = value or c
    symbols = "[" + ", ".join(quoted(s) for s in SPECIAL_CHARACTERS) + "]"
    symbol = f"{symbols}[{choice(key, len(SPECIAL_CHARACTERS), c, 'special', 'symbol')} + 1]"
    kind = choice(key, 3, c, "special", "kind")
    damaged = (
        f"CASE {kind} WHEN 0 THEN repeat({symbol}, 3) || {v} WHEN 1 THEN {v} || repeat({symbol}, 3) "
        f"ELSE repeat({symbol}, 2) || {v} || repeat({symbol}, 2) END"
    )
    return f"CASE WHEN {v} IS NOT NULL AND {u(key, c, 'special', 'cell')} < {rate} THEN {damaged} ELSE {v} END"


def outlier_stats(columns: Sequence[str], source: str, severity: float = DEFAULT_RATES["outlier_severity"]) -> str:
    """One row with the bounds of each column, for ``outlier`` below."""
    parts = []
    for c in columns:
        q25, q75 = f"quantile_cont({c}::DOUBLE, 0.25)", f"quantile_cont({c}::DOUBLE, 0.75)"
        parts += [
            f"{q25} - {severity} * ({q75} - {q25}) AS {c}_lower",
            f"{q75} + {severity} * ({q75} - {q25}) AS {c}_upper",
            f"{q75} - {q25} AS {c}_iqr",
            f"min({c})::DOUBLE AS {c}_min",
        ]
    return f"SELECT {', '.join(parts)} FROM {source}"


def outlier(
    c: str, key: str, rate: float = DEFAULT_RATES["outlier_rate"], integer: str | None = None, decimals: int | None = None
) -> str:
    def beyond(which: str) -> str:
        return f"({c}_iqr * {OUTLIER_MARGIN} * (0.5 + {u(key, c, 'outlier', which)}))"

    high, low = f"({c}_upper + {beyond('margin')})", f"({c}_lower - {beyond('margin')})"
    low = f"CASE WHEN {c}_min >= 0 AND {low} < 0 THEN {c}_upper + {beyond('again')} ELSE {low} END"
    value = f"CASE WHEN {u(key, c, 'outlier', 'side')} > 0.5 THEN {high} ELSE {low} END"
    if integer:
        value = f"CAST(round_even({value}, 0) AS {integer})"
    elif decimals is not None:
        value = f"round_even(({value}) * {10**decimals}, 0) / {10**decimals}"
    return f"CASE WHEN {c} IS NOT NULL AND {u(key, c, 'outlier', 'cell')} < {rate} THEN {value} ELSE {c} END"


def copies(key: str, rate: float = DEFAULT_RATES["duplicate_rate"]) -> str:
    """How often a row is repeated."""
    return counted(u(key, "duplicate", "copies"), *poisson_steps(rate))


def counted(draw: str, first: int, bounds: Sequence[float]) -> str:
    """The value a draw stands for; many steps are looked up in a list."""
    if len(bounds) <= 64:
        return _steps(draw, bounds, [str(first + i) for i in range(len(bounds) + 1)])
    return f"({first} + len(list_filter([{', '.join(map(repr, bounds))}], lambda b: b <= {draw})))"


def _steps(draw: str, bounds: Sequence[float], values: Sequence[str] | None = None) -> str:
    values = values or [str(i) for i in range(len(bounds) + 1)]
    steps = " ".join(f"WHEN {draw} < {b!r} THEN {v}" for b, v in zip(bounds, values))
    return f"(CASE {steps} ELSE {values[len(bounds)]} END)"


def _numeric(c: NumericColumn, key: str, share: str | None = None, normal: str | None = None) -> str:
    """``share`` and ``normal`` name the columns of a correlated draw."""
    low = 0.0 if c.min_value is None else float(c.min_value)
    draw = share or u(key, c.name, "value")
    if c.distribution == "uniform":
        high = 1.0 if c.max_value is None else float(c.max_value)
        x = f"({low!r}::DOUBLE + {high - low!r}::DOUBLE * {draw})"
    elif c.distribution == "exponential":
        scale = 1.0 if c.mean is None else float(c.mean)
        x = f"({low!r}::DOUBLE - {scale!r}::DOUBLE * ln(1.0 - {draw}))"
    elif c.distribution == "poisson":
        x = f"{counted(draw, *poisson_steps(float(c.mean)))}::DOUBLE"
    elif c.distribution == "binomial":
        n = int(c.max_value)
        x = f"{counted(draw, *binomial_steps(n, c.mean / n))}::DOUBLE"
    else:
        mean = 0.0 if c.mean is None else float(c.mean)
        std = 1.0 if c.std is None else float(c.std)
        x = f"({mean!r}::DOUBLE + {std!r}::DOUBLE * {normal or standard_normal(key, c.name)})"
    if c.min_value is not None:
        x = f"greatest({x}, {float(c.min_value)!r}::DOUBLE)"
    if c.max_value is not None:
        x = f"least({x}, {float(c.max_value)!r}::DOUBLE)"
    if not c.allow_negative:
        x = f"abs({x})"
    if c.integer:
        return f"CAST(round_even({x}, 0) AS BIGINT)"
    return f"(round_even({x} * {10**c.decimals}, 0) / {10**c.decimals})"


def standard_normal(key: str, name: str) -> str:
    return f"sqrt(-2.0 * ln(1.0 - {u(key, name, 'radius')})) * cos(2 * pi() * {u(key, name, 'angle')})"


def _datetime(c: DatetimeColumn, key: str, share: str | None = None, normal: str | None = None) -> str:
    draw = share or u(key, c.name, "value")
    if c.weekdays_only:
        first = c.start
        while first.weekday() >= 5:
            first += timedelta(days=1)
        days = (c.end - c.start).days
        working = sum(1 for d in range(days) if (c.start + timedelta(days=d)).weekday() < 5)
        monday = first - timedelta(days=first.weekday())
        k = f"({first.weekday()} + {choice(key, working, c.name, 'day')})"
        base = f"CAST(DATE '{monday.date()}' + CAST({k} // 5 * 7 + {k} % 5 AS INTEGER) AS TIMESTAMP)"
        span = 86400 * 10**6
    else:
        base, span = f"TIMESTAMP '{c.start}'", (c.end - c.start) // timedelta(microseconds=1)
    at = f"({base} + to_microseconds(CAST(floor({draw} * {span}) AS BIGINT)))"
    midnight = f"CAST(CAST({at} AS DATE) AS TIMESTAMP)"
    if not c.include_time:
        return midnight
    if c.business_hours_only:
        hour = f"(9 + {choice(key, 8, c.name, 'hour')})"
        seconds = f"({hour} * 3600 + extract('minute' FROM {at}) * 60 + extract('second' FROM {at}))"
        return f"({midnight} + to_microseconds(CAST({seconds} AS BIGINT) * 1000000))"
    return at


def _categorical(c: CategoricalColumn, key: str, share: str | None = None, normal: str | None = None) -> str:
    bounds, total = [], 0.0
    for w in c.weights[:-1]:
        total += w
        bounds.append(total)
    return _steps(share or u(key, c.name, "value"), bounds, [quoted(v) for v in c.values])


def generated(spec: TableSpec, key: str, source: str) -> str:
    """The SQL of ``generate_columns``."""
    parts = [key, *(f"{_drawn(c, key)} AS {c.name}" for c in spec.columns)]
    return f"SELECT {', '.join(parts)} FROM {source}"


def _drawn(c: ColumnSpec, key: str, share: str | None = None, normal: str | None = None) -> str:
    build = _numeric if isinstance(c, NumericColumn) else _datetime if isinstance(c, DatetimeColumn) else _categorical
    return build(c, key, share, normal)


def _share_below(z: str) -> str:
    t, terms = f"(1.0 / (1.0 + {TAIL_SCALE} * abs({z})))", repr(TAIL_TERMS[-1])
    for b in reversed(TAIL_TERMS[:-1]):
        terms = f"({b!r}::DOUBLE + {t} * {terms})"
    tail = f"(exp({z} * {z} / -2.0) / {math.sqrt(2 * math.pi)!r}::DOUBLE * {t} * {terms})"
    return f"CASE WHEN {z} < 0 THEN {tail} ELSE least(1.0 - {tail}, {BELOW_ONE!r}::DOUBLE) END"


def _derived(c: ColumnSpec, expression: str) -> str:
    if not isinstance(c, NumericColumn):
        return expression
    x = f"CAST({expression} AS DOUBLE)"
    for limit, bound in ((c.min_value, "greatest"), (c.max_value, "least")):
        if limit is not None:
            x = f"CASE WHEN ({expression}) IS NOT NULL THEN {bound}({x}, {float(limit)!r}::DOUBLE) END"
    return f"CAST(round_even({x}, 0) AS BIGINT)" if c.integer else f"(round_even({x} * {10**c.decimals}, 0) / {10**c.decimals})"


def related(spec: TableSpec, key: str, source: str) -> str:
    """The SQL of ``generate_related``: a nested query for each projection."""
    plan = plan_of(spec)
    parts, correlated = [key], []
    for names, triangle in plan.groups:
        correlated += names
        for name, row in zip(names, triangle):
            mixed = " + ".join(f"{w!r}::DOUBLE * {standard_normal(key, e)}" for w, e in zip(row, names) if w)
            parts.append(f"{mixed} AS _normal_{name}")
    text = f"SELECT {', '.join(parts)} FROM {source}"
    if correlated:
        text = f"SELECT *, {', '.join(f'{_share_below(f"_normal_{n}")} AS _share_{n}' for n in correlated)} FROM ({text})"
    for level in plan.levels:
        made = []
        for name in level:
            c, relationship = spec.column(name), plan.made_by.get(name)
            linked = (f"_share_{name}", f"_normal_{name}") if name in correlated else (None, None)
            if relationship is None:
                made.append(f"{_drawn(c, key, *linked)} AS {name}")
            elif relationship.type == "derived":
                made.append(f"{_derived(c, relationship.parameters['expression'])} AS {name}")
            else:
                cases = " ".join(
                    f"WHEN {case.condition} THEN {_drawn(case.column, key, *linked) if case.column else 'NULL' if case.constant is None else quoted(case.constant) if isinstance(case.constant, str) else case.constant}"
                    for case in cases_of(relationship, c)
                )
                made.append(f"CASE {cases} ELSE {_drawn(c, key, *linked)} END AS {name}")
        text = f"SELECT *, {', '.join(made)} FROM ({text})"
    return f"SELECT {', '.join([key, *(c.name for c in spec.columns)])} FROM ({text})"


def replaced(source: str, columns: Sequence[str], changed: Mapping[str, str]) -> str:
    parts = [f"{changed[c]} AS {c}" if c in changed else c for c in columns]
    return f"SELECT {', '.join(parts)} FROM {source}"


