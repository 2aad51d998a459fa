"""The registered queries over the smallest tables, against plain computing."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tarnish.functions.storage import through_table
from tarnish.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


def test_secrets(spark, texts):
    patterns = (
        ("assign", r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    )
    got = result(spark, "op3_secrets")
    assert set(got) == set(texts)
    for d, t in texts.items():
        found = sorted((m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, p, ok) in enumerate(patterns) for m in re.finditer(p, t) if ok(m))
        base = ",".join(x for _, _, x in found)
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(i == k for _, i, _ in found) for k in range(3))
        assert [s for s in got[d].spans.split(",") if s and not s.startswith("entropy")] == [x for _, _, x in found]


def test_near_copies(spark, texts):
    got = result(spark, "op5_near_copies")
    prints = {}
    for d, t in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[d].fingerprint == f"{prints[d]:016x}"
    of = {d: d for d in prints}
    for _ in prints:
        new = {a: min(of[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3) for a in prints}
        if new == of:
            break
        of = new
    assert {d: r.component_id for d, r in got.items()} == of


def test_repeats(spark, texts):
    got = result(spark, "op10_repeats")
    seen = set()
    for d in sorted(texts):
        b = texts[d].encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            w = hash(b[i : i + 100])
            if w in seen:
                gone[i : i + 100] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        assert tuple(got[d])[1:] == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_folds(spark, texts):
    for name, by, out in (("op2_quality", 3, 1), ("op7_language", 4, 2)):
        got = result(spark, name)
        assert {d: r.held_out for d, r in got.items()} == {d: zlib.crc32(str(d).encode()) % by == out for d in texts}
        assert all(0 <= r.score <= 1 for r in got.values())
        if name == "op2_quality":
            assert all(r.predicted == int(r.score >= 0.5) for r in got.values())


@pytest.mark.parametrize("name", ["op1_token_files", "op4_host_rules", "op6_decontamination", "op8_packing"])
def test_queries_cover_their_tables(spark, texts, name):
    ids = {r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").distinct().collect()}
    assert ids == set(texts) if name != "op6_decontamination" else ids < set(texts)


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema, before = docs.schema, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = through_table(stage(spark, docs, SF), name)
        assert docs.schema == schema, name
        assert 0.5 * before <= docs.count() <= before, name
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == before
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    # What the stages are for is done: no copies, no leaks and no secrets are left.
    copies = {r.doc_id: r.component_id for r in QUERIES["op5_near_copies"](spark, SF).collect()}
    leaks = {r.doc_id for r in QUERIES["op6_decontamination"](spark, SF).collect()}
    assert len({copies[d] for d in ids}) == len(ids) and not ids & leaks
    assert not docs.where("text rlike 'AKIA[A-Z0-9]{16}'").count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, pieces.drop("sequence_id", "offset").collect()))


def test_stages_take_odd_tables(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).collect() == [], name
        assert stage(spark, odd, SF).schema == odd.schema, name
        assert stage(spark, odd, SF).count() <= odd.count()
