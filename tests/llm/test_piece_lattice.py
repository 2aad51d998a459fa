"""The lattice of a word's pieces comes from one walk of all words, not from a lookup of each substring."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from tarnish.llm.language import Pieces, _by_length, words_of

WORDS = ["the", "international", "été", "漢字", "a", "", "xyzzyqj", "a▁b", "ǆ𐐷", "x" * 64, "ñandú"]


class _Refuses(dict):
    def get(self, *_):
        raise AssertionError("a substring was looked up")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_every_piece_is_found_by_walking(pieces):
    number, pieces.number = pieces.number, _Refuses()
    try:
        sizes, grid = pieces.lattice(WORDS)
    finally:
        pieces.number = number
    assert sizes.tolist() == [len(w) + 1 for w in WORDS]
    for k, w in enumerate(WORDS):
        w = "▁" + w
        for end in range(1, grid.shape[0]):
            for length in range(1, grid.shape[1]):
                wanted = number.get(w[end - length : end], -1) if length <= end <= len(w) else -1
                if wanted < 0 and length == 1 and end <= len(w):
                    wanted = pieces.other
                assert grid[end, length, k] == wanted


def test_no_words_have_an_empty_lattice(pieces):
    sizes, grid = pieces.lattice([])
    assert len(sizes) == 0 and grid.shape[2] == 0


def test_parts_hold_words_of_like_length_once():
    words = ["a" * (i % 23) for i in range(1000)]
    parts = list(_by_length(words, 50))
    assert sorted(np.concatenate(parts).tolist()) == list(range(1000))
    for part in parts:
        lengths = [len(words[i]) for i in part]
        assert len(part) <= 50 and max(lengths) <= 1.25 * min(lengths) + 2


@pytest.mark.parametrize(
    ("token", "words"),
    [("Word", ["word"]), ("end.)", ["end"]), ("Stop!?", ["stop"]), ("don't", ["don", "t"]), ("a.b.", ["a", "b"]), ("...", []), ("A" * 70, ["a" * 64, "a" * 6]), ("É.", ["é"])],
)
def test_words_of_a_token(token, words):
    assert words_of(token) == words
