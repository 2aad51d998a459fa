"""Windows are hashed in short pieces of the text, suffixes sorted as short numbers; neither changes what repeats."""

from __future__ import annotations

import hashlib

import numpy as np

from tarnish.llm import repeats
from tarnish.llm.repeats import Anchors, remove_repeats
from tarnish.llm.suffixes import Texts, suffix_array


def _text(rng: np.random.Generator, size: int) -> str:
    return "".join(map(chr, rng.integers(97, 123, size).tolist()))


def _brute(texts: list[str], size: int) -> list[bytes]:
    seen, kept = set(), []
    for text in texts:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            if window in seen:
                gone[i : i + size] = True
            seen.add(window)
        kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
    return kept


def test_pieces_are_short():
    at = np.array([0, 100, 5 * repeats.PIECE_BYTES, 5 * repeats.PIECE_BYTES + 60_000])
    pieces = list(repeats._pieces(at, repeats.SIZE))
    assert max(b - a for a, b, _ in pieces) < 2 * repeats.PIECE_BYTES <= 1 << 18


def test_anchors_cover_each_window_once_over_cuts():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 101, 3 * repeats.PIECE_BYTES + 777).astype(np.uint8)
    at = np.array([0, 50, 2 * repeats.PIECE_BYTES + 333, len(data)])
    anchors = Anchors(data, at)
    covered = np.zeros(len(data), np.int64)
    for b, n in zip(anchors.begin.tolist(), anchors.count.tolist(), strict=True):
        covered[b : b + n] += 1
    wanted = np.zeros(len(data), np.int64)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        wanted[a : max(a, b - repeats.SIZE + 1)] = 1
    assert (covered == wanted).all()


def test_repeats_over_the_cut_of_a_long_text(spark):
    rng = np.random.default_rng(7)
    cut = repeats.PIECE_BYTES
    long = _text(rng, 2 * cut + 5000)
    texts = [long, _text(rng, 500) + long[cut - 300 : cut + 300] + _text(rng, 99), long[2 * cut - 150 : 2 * cut + 150], _text(rng, cut - 130) + long[10:400]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: bytes(r["kept"]) for r in remove_repeats(docs).collect()}
    digests = [hashlib.sha256(k).hexdigest() for k in _brute(texts, repeats.SIZE)]
    assert [hashlib.sha256(found[i]).hexdigest() for i in range(len(texts))] == digests


def test_suffixes_are_short_numbers():
    order = suffix_array(Texts([b"banana", b"", b"anan"]))
    assert order.dtype == np.int32
    assert sorted(order.tolist()) == list(range(len(order)))


def test_distinct_values_are_in_order():
    values = np.array([5, 1, 5, 2**63, 0, 1], np.uint64)
    assert repeats._distinct(values).tolist() == np.unique(values).tolist()
    assert len(repeats._distinct(values[:0])) == 0
