"""Operator 5 against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarnish.llm.links import components
from tarnish.llm.simhash import drop_near_copies, fingerprint, near_copies, trie_join


def plainly(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius, lead=0):
    """The smallest index that each value reaches."""
    of = list(range(len(values)))

    def find(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius and a >> 64 - lead == values[j] >> 64 - lead:
                x, y = sorted((find(i), find(j)))
                of[y] = x
    return [find(i) for i in range(len(values))]


def balls(r, n, spread, centres=4):
    out = set()
    middle = [r.getrandbits(64) for _ in range(centres)]
    while len(out) < n:
        v = r.choice(middle)
        for _ in range(r.randint(0, spread)):
            v ^= 1 << r.randrange(64)
        out.add(v)
    return sorted(out)


def test_fingerprints(spark):
    r = random.Random(1)
    for _ in range(300):
        text = " ".join(r.choice(["a", "B", "É", "word", "x\ty", " "]) for _ in range(r.randint(0, 12)))
        assert fingerprint(text) == plainly(text)
    assert fingerprint(None) == fingerprint(" \n") == 0
    # Spark's own hash is the one that is asked for.
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("lead", [0, 3, 16])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_trie_join_has_the_classes_of_all_pairs(lead, radius):
    r = random.Random(lead * 10 + radius)
    for n, spread in ((0, 1), (1, 1), (40, 2), (150, 3), (200, 6)):
        values = balls(r, n, spread)
        got = trie_join(np.array(values, np.uint64), lead, radius, frontier=r.choice([3, 1 << 20]))
        assert got.tolist() == classes(values, radius, lead)


def test_components(spark):
    r = random.Random(3)
    pairs = [(r.randrange(120), r.randrange(120)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    of = {n: n for p in pairs if p[0] != p[1] for n in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and of[a] != of[b]:
                of[a] = of[b] = min(of[a], of[b])
                changed = True
    assert got == of


def test_near_copies(docs_of, odd, odd_rows, empty):
    r = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(30):
        base = [r.choice(words) for _ in range(400)]
        for k in range(4):
            own = list(base)
            own[r.randrange(400)] = "changed" if k else own[0]
            rows.append((i * 10 + k, " ".join(own)))
    rows += [(900, ""), (901, None), (902, rows[0][1]), (None, rows[5][1])]
    got = {(x.doc_id, x.fingerprint): x.component_id for x in near_copies(docs_of(rows)).collect()}
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, classes(distinct, 3), strict=True))
    least = {}
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    assert got == {(d, p - (1 << 64) if p >> 63 else p): least[root[p]] for (d, _), p in zip(rows, prints, strict=True)}
    assert near_copies(odd).count() == len(odd_rows)
    assert near_copies(empty).collect() == []


def test_drop_near_copies(docs_of, odd, empty):
    text = " ".join(f"w{i}" for i in range(300))
    other = " ".join(f"v{i}" for i in range(300))
    docs = docs_of([(5, text), (3, text), (3, text), (9, text.replace("w7 ", "w8 ")), (None, text), (4, other), (3, other), (None, "alone here now")])
    kept = drop_near_copies(docs)
    assert kept.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(rows, key=str) == sorted([(3, text), (3, other), (None, "alone here now")], key=str)
    assert drop_near_copies(empty).collect() == []
    # Empty, null and blank texts are one class.
    left = drop_near_copies(odd)
    assert left.where(F.coalesce(F.trim("text"), F.lit("")) == "").count() <= 1
    assert left.where("doc_id = 4").count() == 1
