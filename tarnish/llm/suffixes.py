"""Suffix arrays of many short texts by induced sorting, and their permuted common prefixes.

The texts stand in a row, each with a terminator of its own, smaller than all
bytes and in order of the texts. Suffixes are classified as smaller or larger
than the next one; those that are smaller after a larger one are leftmost. The leftmost
substrings are sorted by one round of induction and named; the names are a
text of a third of the length, whose suffixes are sorted in turn, each round
over names of twice the length and only where names are still equal. A second
round of induction puts all suffixes in order.

Induction goes bucket by bucket, and through a bucket in waves: all suffixes that
one wave brings are moved to their buckets by one stable sort of their first
bytes. Work is linear in the length, with some array operations for each
distinct byte and run.
"""

from __future__ import annotations

import numpy as np



class Texts:
    """Texts in a row: ``symbols`` holds byte + 1, and 0 where a text ends."""

    def __init__(self, parts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        raw = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
        if len(raw) and raw.max() == 255:
            raise ValueError("0xFF is no byte of a text")
        self.symbols = raw + np.uint8(1)
        self.symbols[self.ends] = 0
        #: How far each position is from the end of its text.
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(len(raw))


def suffix_array(texts: Texts) -> np.ndarray:
    symbols = texts.symbols
    if not len(symbols):
        return np.zeros(0, np.int64)
    small = _smaller(symbols)
    is_leftmost = small & np.r_[False, ~small[:-1]]
    # An empty text's terminator has no larger suffix before it.
    is_leftmost[texts.ends] = True
    # Positions take half the memory where they can.
    position = np.int32 if len(symbols) < 1 << 31 else np.int64
    leftmost, ends = np.flatnonzero(is_leftmost).astype(position), texts.ends.astype(position)
    order = _induce(symbols, small, leftmost, ends)
    by_substring = order[is_leftmost[order]]
    names = _names(symbols, leftmost, by_substring)
    ranks = _ranks(names)
    sorted_leftmost = np.empty(len(leftmost), position)
    sorted_leftmost[ranks] = leftmost
    return _induce(symbols, small, sorted_leftmost, ends)


def _smaller(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one is."""
    n = len(symbols)
    unlike = np.r_[symbols[:-1] != symbols[1:], True]
    # Two terminators in a row differ as well: the earlier one is smaller.
    unlike |= symbols == 0
    at = np.where(unlike, np.arange(n), n)
    decides = np.minimum.accumulate(at[::-1])[::-1]
    rises = np.r_[symbols[:-1] < symbols[1:], True] | (symbols == 0)
    return rises[decides]


def _spread(positions: np.ndarray, symbols: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Add positions to the buckets of their symbols, in order."""
    if not len(positions):
        return
    key = symbols[positions]
    positions = positions[np.argsort(key, kind="stable")]
    counts = np.bincount(key, minlength=256)
    at = 0
    for c in np.flatnonzero(counts).tolist():
        into[c].append(positions[at : at + counts[c]])
        at += counts[c]


_NONE = np.zeros(0, np.int64)


def _join(parts: list[np.ndarray], none: np.ndarray) -> np.ndarray:
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else none


def _induce(symbols: np.ndarray, small: np.ndarray, seeds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the order of the leftmost ones within their buckets."""
    used = np.flatnonzero(np.bincount(symbols, minlength=256)).tolist()
    none = seeds[:0]
    seeded: list[list[np.ndarray]] = [[] for _ in range(256)]
    _spread(seeds, symbols, seeded)
    seeded[0] = [ends]
    coming: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger: dict[int, np.ndarray] = {}

    def before(wave: np.ndarray, wanted: bool) -> np.ndarray:
        wave = wave[wave > 0] - 1
        is_small = small[wave]
        return wave[is_small if wanted else ~is_small]

    def through(c: int, wanted: bool) -> np.ndarray:
        """The suffixes of a bucket in the order they are met, and what they bring into other buckets."""
        waves, wave = [], _join(coming[c], none)
        while len(wave):
            waves.append(wave)
            brought = before(wave, wanted)
            here = symbols[brought] == c
            _spread(brought[~here], symbols, coming)
            wave = brought[here]
        return _join(waves, none)

    for c in used:
        larger[c] = through(c, False) if c else none
        _spread(before(_join(seeded[c], none), False), symbols, coming)
    coming = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for c in reversed(used):
        out.append(through(c, True)[::-1] if c else ends)
        _spread(before(larger[c][::-1], True), symbols, coming)
        out.append(larger[c])
    return np.concatenate(out[::-1])


def _names(symbols: np.ndarray, leftmost: np.ndarray, by_substring: np.ndarray) -> np.ndarray:
    """A number for each leftmost position, in order of its substring up to the next one; equal for equal substrings."""
    following = np.empty(len(symbols), leftmost.dtype)
    following[leftmost] = np.r_[leftmost[1:], len(symbols) - 1]
    a, b = by_substring[:-1], by_substring[1:]
    size = following[b] - b
    # Substrings that end in a terminator, or are one, are like no other.
    same = (following[a] - a == size) & (symbols[following[b]] != 0) & (symbols[b] != 0)
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        like = symbols[a[active] + k] == symbols[b[active] + k]
        same[active[~like]] = False
        active = active[like]
        k += 1
        active = active[size[active] >= k]
    number = np.empty(len(symbols), np.int64)
    number[by_substring] = np.cumsum(np.r_[0, ~same])
    return number[leftmost]


def _ranks(names: np.ndarray) -> np.ndarray:
    """The rank of each suffix of a text of names that ends in a name of its own."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    first = np.r_[True, sorted_names[1:] != sorted_names[:-1]]
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, at, 0))
    alone = first & np.r_[first[1:], True]
    open_ = order[~alone]
    step = 1
    while len(open_):
        # Never beyond the end: the suffix of the last name is alone from the start.
        key = rank[open_ + step]
        by = np.argsort(rank[open_] * n + key)
        open_, key = open_[by], key[by]
        group = rank[open_]
        at = np.arange(len(open_))
        new_group = np.r_[True, group[1:] != group[:-1]]
        new = new_group | np.r_[True, key[1:] != key[:-1]]
        rank[open_] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        open_ = open_[~(new & np.r_[new[1:], True])]
        step *= 2
    return rank


def permuted_common_prefixes(texts: Texts, order: np.ndarray) -> np.ndarray:
    """For each position, how many bytes its suffix shares with the one before it in ``order``.

    Only where the byte before differs is it counted byte by byte (eight at a
    time); elsewhere it is one less than that of the position before.
    """
    n = len(order)
    symbols, left = texts.symbols, texts.left
    phi = np.empty(n, order.dtype)
    if n:
        phi[order[0]] = -1
        phi[order[1:]] = order[:-1]
    own = np.arange(n, dtype=order.dtype)
    counted = (phi <= 0) | (own == 0)
    before_own, before_phi = np.r_[symbols[:1], symbols[:-1]], symbols[np.maximum(phi - 1, 0)]
    counted |= (before_own != before_phi) | (before_own == 0)
    i = np.flatnonzero(counted)
    j = phi[i]
    # The eight symbols from each position on as a number, read where they lie.
    padded = np.r_[symbols, np.zeros(8, np.uint8)]
    words = np.ndarray(n, "<u8", padded, strides=(1,))
    prefix = np.zeros(n, np.int64)
    most = np.where(j < 0, 0, np.minimum(left[i], left[np.maximum(j, 0)]))
    shared = np.zeros(len(i), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        at = shared[active]
        x = words[i[active] + at] ^ words[j[active] + at]
        like = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
        shared[active] = at + like
        active = active[(like == 8) & (shared[active] < most[active])]
    prefix[i] = np.minimum(shared, most)
    last = np.maximum.accumulate(np.where(counted, own, 0))
    return np.where(counted, prefix, np.maximum(prefix[last] - (own - last), 0))


def earlier_windows(parts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, offset) of every string of ``size`` bytes that also starts earlier: in an earlier part, or earlier in its own."""
    texts = Texts(parts)
    order = suffix_array(texts)
    if not len(order):
        return _NONE, _NONE
    prefixes = permuted_common_prefixes(texts, order)[order]
    heads = np.flatnonzero(np.r_[True, prefixes[1:] < size])
    counts = np.diff(np.r_[heads, len(order)])
    least = np.repeat(np.minimum.reduceat(order, heads), counts)
    found = np.sort(order[order > least])
    part = np.searchsorted(texts.ends, found)
    return part, found - texts.begins[part]


