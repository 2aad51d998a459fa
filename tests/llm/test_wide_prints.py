"""The pipeline's near copies come from SimHash tries: candidates against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from tarnish.llm import simhash
from tarnish.llm.minhash import shingle_set


def changed(r, words, most):
    out = []
    for _ in range(60):
        base = [f"w{r.randrange(5000)}" for _ in range(words)]
        out.append(" ".join(base))
        own = list(base)
        for i in r.sample(range(words), r.randint(1, most)):
            own[i] = f"x{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def similarity(a, b):
    shared = len(np.intersect1d(a, b))
    return shared / (len(a) + len(b) - shared)


def test_bits_differ_as_the_similarity_says():
    r = random.Random(1)
    texts = changed(r, 250, 5)
    prints = [np.unpackbits(np.frombuffer(simhash.wide_print(shingle_set(t)), np.uint8)) for t in texts]
    for i in range(0, len(texts), 2):
        s = similarity(shingle_set(texts[i]), shingle_set(texts[i + 1]))
        assert abs((prints[i] != prints[i + 1]).mean() - np.arccos(2 * s / (1 + s)) / np.pi) < 0.08
        assert (prints[i] != prints[i - 1]).mean() > 0.35
    assert simhash.wide_print(shingle_set("")) is None
    # A bit is the majority: one shingle's own bits, and those of the same shingle many times over 255.
    assert len(simhash.wide_print(shingle_set("one"))) * 8 == simhash.WIDE


def test_more_tries_for_more_leading_bits():
    counts = [simhash.tries_for(lead) for lead in range(10, 20)]
    assert counts == sorted(counts) and counts[-1] > 2 * counts[0]


def test_candidates_hold_all_near_pairs(docs_of):
    r = random.Random(2)
    texts = list(dict.fromkeys(changed(r, 120, 3) + changed(r, 12, 1) + [" ".join(f"s{k}x{i}" for i in range(n)) for k in range(40) for n in (8, 9)]))
    sets = [shingle_set(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if similarity(sets[i], sets[j]) >= 0.8]
    assert len(near) > 70
    made = simhash.wide_prints(docs_of(list(enumerate(texts))))
    # Small tries, so that several shards hold each.
    found = simhash.candidates(made, trie_size=50).join(made.select("word_key", "doc_id"), "word_key").groupBy("bucket").agg(F.collect_set("doc_id").alias("ids"))
    buckets = [set(x.ids) for x in found.collect()]
    assert all(len(b) > 1 for b in buckets)
    assert [p for p in near if not any({*p} <= b for b in buckets)] == []
    # And not much else: unlike texts share no bucket but by chance.
    pairs = {(i, j) for b in buckets for i in b for j in b if j < i}
    assert len(pairs - set(near)) < len(texts)
