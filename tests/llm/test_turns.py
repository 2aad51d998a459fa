"""Operator 11 against plain dynamic programming over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnish.llm.turns import ENDS, NEVER, START, STATES, STEPS, SLICE_BITS, _Joined, joined, matrix, repair_report, search

SCHEMA = "conv_id long, turn long, role string, text string, cost long, slice string"
WHITE = " \t\n\x0b\x0c\r"


def plain_search(codes, entry=START, exits=ENDS):
    """Least (cost, audit) over all paths, boundary by boundary."""
    rows = [(codes[i], codes[i + 1]) for i in range(0, len(codes), 2)]

    def insert(best):
        for _ in range(4):
            for q, (c, a) in list(best.items()):
                for r in "ua":
                    to = STEPS.get((q, r))
                    if to is not None and (to not in best or (c + 3, a + "I") < best[to]):
                        best[to] = (c + 3, a + "I")
        return best

    best = insert({entry: (0, "")})
    for role, fault in rows:
        now = {}
        for q, (c, a) in best.items():
            options = [(q, c + 4, a + "D")]
            if fault not in "bd":
                more = 3 if fault == "t" else 0
                options += [(STEPS[q, role], c + more, a + "K")] if (q, role) in STEPS else []
                options += [(STEPS[q, r], c + more + 3, a + "R") for r in "ua" if (q, r) in STEPS]
            for to, cost, audit in options:
                if to not in now or (cost, audit) < now[to]:
                    now[to] = (cost, audit)
        best = insert(now)
    return min((best[q] for q in exits if q in best), default=(NEVER, ""))


def by_plain_repair(rows):
    """The contract row by row, for conversations without two different rows of one turn."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        convs[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, codes = set(), ""
        for _, role, text in own:
            end = text.rstrip(WHITE)
            fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "-"
            seen.add((role, text))
            codes += (role[:1] if role[:1] in tuple("sua") else "x") + fault
        cost, audit = plain_search(codes) if own else (0, "")
        turns = {t for t, _, _ in own if t is not None}
        left, at, state = [], 0, START
        for e in audit:
            role, text = ("", "") if e == "I" else own[at][1:]
            at += e != "I"
            if e == "D":
                continue
            if e != "K":
                role = {"u": "user", "a": "assistant"}[next(r for r in "ua" if (state, r) in STEPS)]
            state = STEPS[state, role[0]]
            left.append(f"{role}:{text}")
        initials = [r[1][:1] for r in own]
        faults = codes[1::2]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in left))
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(faults.count(f) for f in "bdt"),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256("\n".join(left).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


CODES = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from("---bdt")).map("".join), max_size=14).map("".join)


@settings(max_examples=800, deadline=None)
@given(codes=CODES)
def test_both_ends_meet_at_the_least_audit(codes):
    assert search(codes, START, ENDS) == plain_search(codes)


@settings(max_examples=60, deadline=None)
@given(codes=CODES)
def test_from_every_state_to_every_state(codes):
    assert list(matrix(codes)) == [plain_search(codes, p, (q,)) for p in range(STATES) for q in range(STATES)]


@settings(max_examples=150, deadline=None)
@given(codes=CODES, cuts=st.lists(st.integers(0, 14), max_size=4))
def test_slices_make_the_whole(codes, cuts):
    at = sorted({0, len(codes), *(min(len(codes), 2 * c) for c in cuts)})
    parts = [codes[a:b] for a, b in zip(at, at[1:])] or [""]
    cells = joined([_Joined.of([c for c, _ in matrix(p)], [a for _, a in matrix(p)]) for p in parts]).cells
    assert min(cells[START * STATES + q][:2] for q in ENDS) == plain_search(codes)


def test_report_as_plain_repair(spark):
    rng = random.Random(11)
    texts = ["Yes.", "No!", "why", "", " \t", None, "é?", "long " * 900 + ".", "same."]
    rows = []
    for conv in [*range(60), None]:
        turns = [t for t in range(rng.randrange(12)) if rng.random() < 0.85]
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]), rng.choice(texts)) for t in turns]
    rows += [(77, None, "user", "Hm."), (77, None, "user", "Hm."), (78, None, None, None), (79, 5, "user", "a.")]
    # One long conversation, of many slices.
    n = 9 << SLICE_BITS
    rows += [(500, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"{t}.", f"{t}", f"{t}!"])) for t in range(n)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = repair_report(frame)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_plain_repair(rows)


def test_rows_of_one_turn_and_empty_tables(spark):
    rows = [(1, 0, "user", "b."), (1, 0, "user", "a."), (1, 0, "assistant", "c."), (1, 1, "assistant", "d.")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, repair_report(frame).collect()), key=repr) == by_plain_repair(rows)
    assert repair_report(frame.where("conv_id > 9")).collect() == []


def test_query_as_plain_repair(spark):
    from __spark_entry__ import queries

    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries()["op11_turn_repair"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got), key=repr) == by_plain_repair(list(map(tuple, rows)))


@pytest.mark.parametrize("codes,audit", [("", ""), ("u-", "KI"), ("a-", "IK"), ("s-", "D"), ("u-u-", "KR"), ("s-u-a-", "KKK")])
def test_small_cases(codes, audit):
    assert search(codes, START, ENDS)[1] == audit
