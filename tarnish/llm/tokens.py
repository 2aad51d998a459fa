"""Token ids of whole texts with the ``tokenizers`` library, each distinct core of letters encoded once.

A public BPE tokenizer never joins what a blank parts: a token holds at most the
blank before its word. So the ids of a text are the ids of its words (each with
its blank) in a row, and those of a plain word are the ids of its letters and of
the punctuation behind them. A task encodes a core or tail it has met before by
looking it up; Arrow parts the texts and finds the distinct words of a call. Only white space beside a blank breaks the rule; such texts are
encoded whole. A tokenizer to which all white space is one blank, or a letter its lower case, has fewer distinct words: lines are parted
as words are, and cores are taken in lower case.

A text that spells a special token gets the id that the library gives it, unless
``special_as_text`` is set: then it is ordinary text.

What is remembered is bounded and kept in two generations: when the younger is
full it becomes the older, and what is met again moves over without being
encoded again. This changes no result.
"""

from __future__ import annotations

import os
import re
from codecs import charmap_decode
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarnish.llm.common import ranges, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Units (cores, tails, other words) of one generation.
CACHE_UNITS = 200_000
#: Characters of text to hand over at once; more of them share more words, and take more memory.
ENCODE_CHARS = 1 << 20

# Letters of one script, composed, whose lower case is one letter; then marks that never join a letter.
_LETTER_CLASS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = "".join(c for c in map(chr, range(256)) if re.match(f"[{_LETTER_CLASS}]", c))
_PLAIN = rf"\A[{_LETTER_CLASS}]+\z"
_TAIL = ".,!?;:#*$%&|<>@()\"-"
_LONG_TAIL = 8

_WHITE = "\t\n\v\f\r"
_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[ord(c) for c in _WHITE]] = ord(" ")

_CORE, _BEHIND, _WORD, _FIRST = range(4)
MARKS = _BEHIND


class _Numbers(dict):
    """Numbers the keys of one kind as they come, with those of the other kinds."""

    def __init__(self, units: _Units) -> None:
        super().__init__()
        self.units, self.new = units, []

    def __missing__(self, key):
        self[key] = number = self.units.size
        self.units.size += 1
        self.new.append(key)
        return number


class _Units:
    """Ids of numbered units in one flat pool; unit 0 has none."""

    def __init__(self) -> None:
        self.size = 1
        self.numbers = [_Numbers(self) for _ in range(4)]
        self.pool, self.filled = np.zeros(1 << 12, np.uint32), 0
        self.begin, self.count = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)
        self.white_first, self.white_last = np.zeros(1 << 10, bool), np.zeros(1 << 10, bool)

    def find(self, kind: int, keys: list) -> np.ndarray:
        return np.fromiter(map(self.numbers[kind].__getitem__, keys), np.int64, len(keys))

    def grow(self) -> None:
        if self.size > len(self.begin):
            for name in ("begin", "count", "white_first", "white_last"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(max(self.size, 2 * len(old)) - len(old), old.dtype)]))

    def put(self, at: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        if self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), np.uint32)])
        self.pool[self.filled : self.filled + len(flat)] = flat
        self.begin[at], self.count[at] = self.filled + np.cumsum(counts) - counts, counts
        self.filled += len(flat)

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.count[at]
        return self.pool[np.repeat(self.begin[at], counts) + ranges(counts)], counts


def crosses_to_marks(piece: str) -> bool:
    """Whether a piece of a vocabulary holds a letter with a mark behind it."""
    return re.search(f"[{_LETTER_CLASS}][{re.escape(_TAIL)}]", piece) is not None


def strings(column: pa.Array) -> list[str]:
    """As ``to_pylist`` gives them, in a fraction of its time; no nulls."""
    return column.to_numpy(zero_copy_only=False).tolist()


def blanked(column: pa.Array) -> pa.Array:
    """The texts with a blank for each other ASCII white space."""
    data, at = utf8(column)
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(at), pa.py_buffer(_BLANKED[data])])


def code_words(units: _Units, column: pa.Array, lowers: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.DictionaryArray]:
    """Two units for each blank-parted word of all texts: letters and the marks behind them, or the whole word and none.

    Also where each text's words end, their numbers, and the words themselves, plain and by their distinct ones.
    ``lowers``: letters are taken in lower case.
    """
    parted = pc.split_pattern(column, " ")
    sizes = pc.list_value_length(parted).to_numpy(zero_copy_only=False).astype(np.int64)
    all_words = parted.flatten()
    coded = all_words.dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy()
    cores, tails = pc.utf8_rtrim(words, _TAIL), pc.utf8_ltrim(words, _LETTERS)
    plain = pc.and_(pc.match_substring_regex(cores, _PLAIN), pc.less_equal(pc.binary_length(tails), _LONG_TAIL))
    is_plain = plain.to_numpy(zero_copy_only=False)
    front, behind = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for kind, column, into, rows in ((_CORE, cores, front, is_plain), (_BEHIND, tails, behind, is_plain), (_WORD, words, front, ~is_plain)):
        some = column.filter(pa.array(rows))
        some = (pc.utf8_lower(some) if lowers and kind == _CORE else some).dictionary_encode()
        keys = strings(some.dictionary)
        found = units.find(kind, keys)
        if kind == _BEHIND:
            found[[not k for k in keys]] = 0
        into[rows] = found[some.indices.to_numpy()]
    both = np.empty(2 * len(at), np.int64)
    both[::2], both[1::2] = front[at], behind[at]
    return both, np.cumsum(sizes), sizes, all_words, coded


class WordEncoder:
    def __init__(self, path: str, special_as_text: bool = False, cache_units: int = CACHE_UNITS) -> None:
        from tokenizers import Tokenizer

        self.special_as_text = special_as_text
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.special = "|".join(map(re.escape, added)) if added and not special_as_text else None
        self.keeps_blanks = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        self.lowers = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        # How the byte-level alphabet spells the blank and each letter, as the tokenizer itself says.
        spelled = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        # Whether it makes no difference which white space parts letters and marks.
        like = [self.tokenizer.encode(f"a{c}b.{c}{c}c,{c}", add_special_tokens=False).ids for c in f" {_WHITE}"]
        self.blanks = not self.keeps_blanks and all(x == like[0] for x in like)
        self.blank = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][0] if self.keeps_blanks else ""
        self.spelling = str.maketrans({c: s for c, s in spelled.items() if c != s})
        # Where each byte has a sign, a table of them spells faster; U+FFFE stands for none.
        signs = {b: x for c, s in spelled.items() for b, x in zip(c.encode(), s, strict=False)}
        bytewise = all("".join(signs[b] for b in c.encode() if b in signs) == s for c, s in spelled.items())
        self.signs = "".join(signs.get(b, "\ufffe") for b in range(256)) if bytewise else None
        self.cache_units = cache_units
        self.units, self.older = _Units(), _Units()

    def _spell(self, letters: str) -> str:
        return charmap_decode(letters.encode(), "strict", self.signs)[0] if self.signs else letters.translate(self.spelling)

    def _encode_new(self, kind: int, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if kind == _CORE:
            tokenize, blank, out = self.model.tokenize, self.blank, []
            for x in keys:
                # Letters alone are one piece to the model.
                out.append([t.id for t in tokenize(blank + (x if x.isascii() else self._spell(x)))])
        else:
            blank = " " if kind == _WORD and self.keeps_blanks else ""
            out = [e.ids for e in self.tokenizer.encode_batch_fast([blank + x for x in keys], add_special_tokens=False)]
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return counts, np.fromiter(chain.from_iterable(out), np.uint32, int(counts.sum()))

    def _learn(self) -> None:
        units, older = self.units, self.older
        units.grow()
        for kind, numbers in enumerate(units.numbers):
            keys = numbers.new
            if not keys:
                continue
            at = units.find(kind, keys)
            if older.size > 1:
                old = np.fromiter((older.numbers[kind].get(k, 0) for k in keys), np.int64, len(keys))
                moved = old > 0
                ids, counts = older.ids(old[moved])
                units.put(at[moved], counts, ids)
                keys, at = [k for k, m in zip(keys, moved, strict=True) if not m], at[~moved]
            units.put(at, *self._encode_new(kind, keys))
            if kind in (_WORD, _FIRST):
                at = units.find(kind, numbers.new)
                units.white_first[at] = [not k or k[0].isspace() for k in numbers.new]
                units.white_last[at] = [not k or k[-1].isspace() for k in numbers.new]
            numbers.new = []

    def whole(self, texts: Sequence[str]) -> list[np.ndarray]:
        """As the library itself encodes them."""
        self.tokenizer.encode_special_tokens = self.special_as_text
        try:
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
        finally:
            self.tokenizer.encode_special_tokens = True

    def forget(self) -> None:
        """Drops all remembered units."""
        self.units, self.older = _Units(), _Units()

    def encode(self, texts: Sequence[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.units.size > self.cache_units:
            self.older, self.units = self.units, _Units()
        units = self.units
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()).fill_null("")
        both, ends, sizes, all_words, _ = code_words(units, blanked(column) if self.blanks else column, self.lowers)
        begin = ends - sizes
        both[2 * begin] = units.find(_FIRST, strings(all_words.take(pa.array(begin))))
        both[2 * begin + 1] = 0
        self._learn()
        ids, counts = units.ids(both)
        per_text = np.add.reduceat(counts, 2 * begin)
        odd = np.zeros(0, np.int64)
        if self.special:
            odd = np.flatnonzero(pc.match_substring_regex(column, self.special, ignore_case=True).to_numpy(zero_copy_only=False))
        if self.keeps_blanks:
            beside = units.white_last[both[:-2:2]] & units.white_first[both[2::2]]
            beside[ends[:-1] - 1] = False
            odd = np.union1d(odd, np.searchsorted(ends, np.flatnonzero(beside), side="right")).astype(np.int64)
        if len(odd):
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for i, own in zip(odd, self.whole(column.take(pa.array(odd)).to_pylist()), strict=True):
                parts[i], per_text[i] = own, len(own)
            ids = np.concatenate(parts)
        return ids, per_text


_encoders: dict[tuple[str, bool], WordEncoder] = {}


def encoder_for(path: str, special_as_text: bool = False) -> WordEncoder:
    """One encoder for each tokenizer and Python worker, kept between tasks."""
    key = path, special_as_text
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, special_as_text)
    return _encoders[key]
