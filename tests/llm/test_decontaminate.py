"""Operator 6 against every window of every document."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tarnish.llm.decontaminate import Benchmark, drop_leaks, find_leaks


def words_of(text):
    return [w for w in ("".join(c for c in t.lower() if c.isalnum()) for t in (text or "").split()) if w]


def shingles(words, k):
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def similar(item, text):
    """The best similarity of an item-sized window."""
    a, b = words_of(item), words_of(text)
    if not a:
        return 0.0
    k = min(5, len(a))
    x, y = shingles(a, k), shingles(b, k)
    m = min(len(x), len(y))
    best = 0.0
    for i in range(len(y) - m + 1 if m else 0):
        shared = sum((Counter(x) & Counter(y[i : i + m])).values())
        best = max(best, shared / (m + len(x) - shared))
    return best


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(r.randint(14, 59)))) for i in range(40)] + [(40, "Two words"), (41, ""), (42, None)]
    rows = []
    for i in range(160):
        words = draw(r.randint(0, 200))
        if i % 2:
            passage = words_of(r.choice(items)[1])
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                if passage:
                    passage[r.randrange(len(passage))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = [w.upper() + r.choice(["", ",", "!"]) for w in passage]
        rows.append((i, " ".join(words)))
    return items, rows


def test_finds_what_all_windows_find(spark, docs_of, corpus):
    items, rows = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in find_leaks(docs_of(rows), bench).collect()}
    wanted = {(d, i): s for d, t in rows for i, x in items if (s := similar(x, t)) >= 0.8}
    # Small items at the very edge of the similarity may lie beyond the radius.
    missed = [k for k in wanted if k not in got]
    assert all(wanted[k] < 0.85 for k in missed) and len(missed) <= 0.02 * len(wanted)
    assert all(abs(got[k] - wanted[k]) < 1e-12 for k in got if k in wanted) and set(got) <= set(wanted)


def test_blocks_change_nothing(spark, docs_of, corpus):
    items, rows = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows)
    from tarnish.llm import decontaminate

    whole = sorted(map(tuple, find_leaks(docs, bench).collect()))
    before, decontaminate.benchmark_blocks.__defaults__ = decontaminate.benchmark_blocks.__defaults__, ("item_id", "text", 700)
    try:
        assert sorted(map(tuple, find_leaks(docs, bench).collect())) == whole
    finally:
        decontaminate.benchmark_blocks.__defaults__ = before


def test_drop_leaks(spark, docs_of, corpus, odd, odd_rows, empty):
    items, rows = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows)
    leaks = {r.doc_id for r in find_leaks(docs, bench).collect()}
    kept = drop_leaks(docs, bench)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - leaks
    assert drop_leaks(odd, bench).count() == len(odd_rows) and drop_leaks(empty, bench).collect() == []
    # Benchmarks of several blocks, with null and repeated texts and a column of another use.
    odd_too = docs.withColumn("leak_1", F.lit("x")).unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("leak_1", F.lit("y")))
    again = drop_leaks(odd_too, bench, block_bytes=700)
    assert again.schema == odd_too.schema
    assert sorted(r.doc_id for r in again.where("leak_1 = 'x'").collect()) == sorted(r.doc_id for r in kept.collect())
    assert again.where("leak_1 = 'y'").count() == 3
    nothing = bench.limit(0)
    assert find_leaks(docs, nothing).collect() == [] and drop_leaks(docs, nothing).count() == len(rows)


def test_best_window(spark):
    item = " ".join(f"q{i}" for i in range(20))
    found = Benchmark([(1, item)]).matches(f"a b {item} c")
    assert found == [(1, 2, 20, 1.0)]
    # A document shorter than the item is one window.
    assert Benchmark([(1, item)]).matches(" ".join(item.split()[:19]))[0][0] == 1
