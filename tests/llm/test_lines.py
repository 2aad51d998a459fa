"""Operator 13 against plain counting."""

import random
from collections import Counter

import pytest

from tarnish.llm.lines import _suspects, drop_repeated_lines, keyed_by_content, keys_of


def by_counting(rows, min_docs, min_chars=1):
    holds = Counter(k for _, t in rows for k in set(keys_of(t)) if len(k.decode()) >= min_chars)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x, k in zip(lines, keys_of(t), strict=True) if not (len(k.decode()) >= min_chars and holds[k] >= min_docs)]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def rows_of(n, seed=3):
    rng = random.Random(seed)
    pool = ["License", " LICENSE\t", "license\r", "é", "É", "", "   ", "x" * 3000, *(f"line {i}" for i in range(40))]
    return [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own {i} {j}" for j in range(rng.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("filter_bits", [20, 23])
def test_as_plain_counting(spark, docs_of, odd_rows, filter_bits):
    rows = rows_of(300) + list(odd_rows) + [(9, "same\nrow")] * 4
    for min_docs, min_chars in ((2, 1), (10, 1), (4, 7)):
        got = drop_repeated_lines(docs_of(rows, 7), min_docs, min_chars, filter_bits=filter_bits).collect()
        assert sorted(map(tuple, got), key=repr) == by_counting(rows, min_docs, min_chars)


def test_only_repeats_are_shuffled(spark, docs_of):
    rows = [(i, f"own {i}\nshared\nown also {i}") for i in range(2000)]
    found = _suspects(keyed_by_content(docs_of(rows, 5)), spark, 23, 1).collect()
    assert 2000 <= len(found) < 2040


def test_the_first_one_stays(spark, docs_of):
    rows = [(5, "a\nb\na"), (3, "x\na\nA"), (None, "b"), (7, "c\na")]
    got = {r.doc_id: r.kept for r in drop_repeated_lines(docs_of(rows), 2, keep="first").collect()}
    assert got == {5: "", 3: "x\na", None: "b", 7: "c"}


def test_empty_and_wrong(spark, empty):
    assert drop_repeated_lines(empty).collect() == []
    with pytest.raises(ValueError):
        drop_repeated_lines(empty, min_docs=1)
    with pytest.raises(ValueError):
        drop_repeated_lines(empty, keep="last")
