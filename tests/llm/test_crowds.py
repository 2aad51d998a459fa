"""Large groups of texts that are somewhat alike cost rows as their size: classes of prints, and crowds dealt into blocks."""

import random

import numpy as np
import pytest

from tarnish.llm import minhash, simhash
from tarnish.llm.minhash import shingle_set
from tarnish.llm.simhash import drop_near_copies


def varied(r, copies, words, least, most):
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        own = list(base)
        for i in r.sample(range(words), r.randint(least, most)):
            own[i] = f"x{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def classes(n, near):
    of = np.arange(n)
    for i in range(n):
        for j in np.flatnonzero(near[i]):
            low, high = sorted((of[i], of[j]))
            of[of == high] = low
    return of


def near_sets(texts):
    sets = [shingle_set(t) for t in texts]
    same = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    return np.array([[9 * s >= 4 * (len(a) + len(b)) for b, s in zip(sets, row, strict=True)] for a, row in zip(sets, same, strict=True)])


def test_64_bits_do_not_chain_texts_that_are_not_alike(docs_of):
    texts = varied(random.Random(3), 300, 200, 12, 12)
    found = simhash.candidates(simhash.wide_prints(docs_of(list(enumerate(texts)))))
    # By the classes of the tries alone it is thousands of rows.
    assert found.count() < 30


@pytest.mark.parametrize(("few", "rows"), [(64, 4096), (3, 4096), (3, 30)])
def test_classes_of_prints_are_those_of_all_pairs(monkeypatch, few, rows):
    monkeypatch.setattr(simhash, "FEW_ROWS", few)
    monkeypatch.setattr(simhash, "CLASS_ROWS", rows)
    dice = np.random.default_rng(4)
    buckets = np.repeat(np.arange(60), dice.integers(1, 40, 60))
    bits = dice.integers(0, 2, (len(buckets), 512), dtype=np.uint8)
    for i in range(1, len(bits)):
        if dice.random() < 0.7:
            bits[i] = bits[dice.integers(0, i)] ^ (dice.random(512) < dice.choice([0.1, 0.235]))
    near = (buckets[:, None] == buckets) & ((bits[:, None] != bits).sum(axis=2) <= simhash.WIDE_RADIUS)
    for b, n in zip(*np.unique(buckets, return_counts=True), strict=True):
        if n > rows:
            near |= (buckets[:, None] == b) & (buckets == b)
    got = simhash.print_classes(buckets, np.packbits(bits, axis=1).view(np.uint64))
    assert got.tolist() == classes(len(buckets), near).tolist()
    assert simhash.print_classes(buckets[:0], np.zeros((0, 8), np.uint64)).tolist() == []


@pytest.mark.parametrize("work", [1 << 26, 1 << 14])
def test_a_crowd_meets_once_whatever_its_blocks(spark, docs_of, monkeypatch, work):
    monkeypatch.setattr(minhash, "BLOCK_WORK", work)
    r = random.Random(5)
    texts = list(dict.fromkeys(varied(r, 120, 150, 1, 6) + varied(r, 5, 80, 1, 2)))
    of = classes(len(texts), near_sets(texts))
    assert 10 < len(set(of)) < len(texts) - 10
    assert {x.doc_id for x in drop_near_copies(docs_of(list(enumerate(texts)))).collect()} == set(of.tolist())
    sets = spark.createDataFrame([(i, shingle_set(t).view(np.int64).tolist()) for i, t in enumerate(texts)], "word_key long, shingles array<long>")
    members = spark.createDataFrame([(0, i, i) for i in range(len(texts))], "crowd long, word_key long, root long")
    dealt = minhash._block_pairs(members, sets).collect()
    pairs = {(x.crowd, x.x, x.y) for x in dealt}
    blocks = {x for _, *xy in pairs for x in xy}
    assert len(dealt) == len(texts) * max(1, len(blocks) - 1)
    assert (len(blocks) > 1) == (work == 1 << 14)
    together = [{x.word_key for x in dealt if (x.crowd, x.x, x.y) == p} for p in pairs]
    assert all(any({i, j} <= t for t in together) for i in range(len(texts)) for j in range(i))
    two = members.where("word_key < 2")
    assert minhash._block_pairs(two, sets).count() == 0
