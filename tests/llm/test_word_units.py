"""Distinct words of a tokenizer that takes all white space for a blank and letters in lower case."""

from __future__ import annotations

import public_tokenizers
import pytest

from tarnish.llm import tokens
from tarnish.llm.tokens import WordEncoder

TEXTS = [
    "Alpha beta.\nGamma ALPHA\tbeta\r\nÉté ÉTÉ été.\n\nBeta, alpha",
    "\n leads\x0band\x0c trails \n",
    "",
    None,
    "\n",
    "it's\n's don't\n't T̈ x\ny Ḱ naïve İstanbul ß\x85end of",
    "a <|endoftext|>\nb <|ENDOFTEXT|> ",
    "日本\n語 ÀÖØÞÿ×÷ 12\n34",
]


def _library(path: str, texts: list) -> list[list[int]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_library_s(name):
    path = public_tokenizers.path(name)
    ids, counts = WordEncoder(path).encode(TEXTS)
    ends = counts.cumsum()
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == _library(path, TEXTS)


def test_lines_and_capitals_make_no_new_words():
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.encode([TEXTS[0]])
    assert not encoder.units.numbers[tokens._WORD].keys() - {""}
    assert sorted(encoder.units.numbers[tokens._CORE]) == ["alpha", "beta", "gamma", "été"]


def test_letters_are_spelled_as_the_tokenizer_spells_them():
    encoder = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.signs
    for letter in tokens._LETTERS:
        assert encoder._spell(letter) == letter.translate(encoder.spelling)
