"""Operator 12 against plain alignment, token by token."""

import hashlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarnish.llm import alignment
from tarnish.llm.alignment import Aligner, _pack, _unpack, align_tokens, byte_alphabet

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\x00", "▁", "a", "B", "é", "'s", "1", "<|endoftext|>", "</s>", "<0x41>", "́", "漢", "😀", "word", ".\n", "The", "ing", " "])


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = byte_alphabet()
    of_a = {i: bytes(alphabet.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    return a, b, of_a


def groups_by_ends(text):
    """[(A ids, B ids)...] cut where tokens of both end; nothing if the bytes differ."""
    a, b, of_a = libraries()
    wanted = (" " + (text or "")).encode()
    ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    spelled_a = [of_a[i] for i in ids_a]
    spelled_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(spelled_a) != wanted or b"".join(spelled_b) != wanted:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in spelled_a]), np.cumsum([len(x) for x in spelled_b])
    both, out = set(ends_a.tolist()) & set(ends_b.tolist()), [([], [])]
    for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
        at = 0
        for i, e in zip(ids, ends.tolist()):
            if at == len(out):
                out.append(([], []))
            out[at][side].append(i)
            at += e in both
    return out


def spelled(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def by_plain_alignment(rows):
    found = [(d, groups_by_ends(t)) for d, t in rows]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for _, groups in found]
    holders = Counter(p for own in links for p in own)
    highest = defaultdict(int)
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    out = []
    for (d, groups), own in zip(found, links, strict=True):
        text = spelled(groups)
        out.append(
            (
                d,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(own.values()),
                sum(n for p, n in own.items() if holders[p] == highest[p[0]]),
                sum(n * holders[p] for p, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(out, key=repr)


@cache
def aligner():
    return Aligner(A, B)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=20).map("".join), min_size=1, max_size=4))
def test_groups_are_cut_where_both_end(texts):
    found = aligner().align(texts)
    assert [bytes(g).decode() if len(g) else "" for g in found["groups"]] == [spelled(groups_by_ends(t)) for t in texts]


@pytest.mark.parametrize("wide", [1, 1 << 12])
def test_wide_groups_give_the_same_links(monkeypatch, wide):
    monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
    text = "漢字" * 50 + " the words 😀😀😀 " + "\t\t\n" * 30
    found = aligner().align([text, "a", None, ""])
    links = Counter((a, b) for x, y in groups_by_ends(text) for a in x for b in y)
    n = int(found["entries"][0])
    pairs = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in found["pairs"]]
    assert {pairs[i]: int(t) for i, t in zip(found["index"][:n], found["times"][:n])} == links
    assert found["n_links"][0] == sum(links.values())


def test_packed_links_come_back():
    entries = np.array([0, 3, 0, 2, 1, 0])
    index, times = np.array([2, 5, 90000, 0, 7, 3]), np.array([1, 255, 1 << 40, 254, 2, 1])
    back = _unpack(_pack(entries, index, times), entries)
    assert back[0].tolist() == index.tolist() and back[1].tolist() == times.tolist()
    none = np.zeros(2, np.int64)
    assert [x.tolist() for x in _unpack(_pack(none, none[:0], none[:0]), none)] == [[], []]


def test_as_plain_alignment(spark, docs_of, odd_rows):
    rows = list(odd_rows) + [(100 + i, f"the {i} words of text {i % 7}, and more") for i in range(60)] + [(200, "▁x"), (201, "<|endoftext|>")]
    for block_chars in (200, 1 << 24):
        got = align_tokens(docs_of(rows, 4), A, B, groups="sha256", block_chars=block_chars).collect()
        assert sorted(map(tuple, got), key=repr) == by_plain_alignment(rows)


def test_groups_as_text_and_empty_table(spark, docs_of, empty):
    (row,) = align_tokens(docs_of([(1, "some words here")], 1), A, B).collect()
    assert row.groups == spelled(groups_by_ends("some words here"))
    assert align_tokens(empty, A, B).collect() == []
    with pytest.raises(ValueError):
        align_tokens(empty, A, B, groups="list")


def test_query_as_plain_alignment(spark):
    from __spark_entry__ import queries

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op12_alignment"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_plain_alignment(list(map(tuple, rows)))
