"""Operator 6: benchmark passages in documents, by SimHash of item-sized windows.

A document's words (letters and digits of what stands between white space, in lower case) are slid over
by windows of each benchmark item's length. A window's fingerprint is the SimHash
of its five-word shingles, weighted by how often they occur, from running sums of their
bits. Fingerprints are looked up in a multi-index: with ``radius + 1`` blocks of bits,
any item within ``radius`` bits agrees with the window in one block at least, so all of
them are found. Candidates are then compared exactly, by the weighted Jaccard
similarity of their shingles, and count from 0.8 on.

Only windows that can reach the similarity are fingerprinted: by its definition at
least 2 s / (1 + s) of an item's shingles must be in the window, so a window with fewer
shingles of the benchmark is passed over. That loses nothing. At similarity 0.8 two
fingerprints differ in about 10 bits of 64; the radius of 20 is 3.6 standard deviations beyond.

Items of fewer than five words are compared as one shingle; items without words match
nothing. A document shorter than an item is one window. Null texts match nothing, null ids are
kept. Items with the same words are each reported. The benchmark is read in blocks of
bounded size, each sent to all tasks; documents are read once for each block.
Memory: a batch of documents and one block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table
from tarnish.llm.common import free_name, id_and_text, tidy

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
#: Bytes of benchmark text that go to the tasks at once.
BLOCK_BYTES = 8 << 20
CACHE_WORDS = 350_000
_B = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


class _Hashes(dict):
    """The hash of a word's letters and digits; 0 if it has none."""

    def __missing__(self, token: str) -> int:
        word = token if token.isalnum() else "".join(c for c in token if c.isalnum())
        self[token] = h = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass")) | 1 if word else 0
        return h


_hashes = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    if len(_hashes) > CACHE_WORDS:
        _hashes.clear()
    tokens = (text or "").split()
    found = np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))
    return found[found != 0]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` words in a row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, k):
        out = out * _B + words[i : i + n]
    out = (out ^ out >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(29)


def _votes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


@dataclass
class _Size:
    """The items of one length in words, with their multi-index."""

    words: int
    k: int
    ids: list[int]
    prints: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray]]
    total: int
    known: np.ndarray
    blocks: list[tuple[int, int, np.ndarray, np.ndarray]] = field(default_factory=list)

    def index(self, radius: int) -> None:
        edges = np.linspace(0, 64, radius + 2).astype(int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            value = self.prints >> np.uint64(a) & np.uint64((1 << (b - a)) - 1)
            order = np.argsort(value, kind="stable")
            self.blocks.append((a, b - a, value[order], order))

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints that differ in ``radius`` bits at most."""
        keys = []
        for shift, width, values, order in self.blocks:
            value = prints >> np.uint64(shift) & np.uint64((1 << width) - 1)
            lo, hi = np.searchsorted(values, value), np.searchsorted(values, value, side="right")
            size = hi - lo
            window = np.repeat(np.arange(len(prints)), size)
            item = order[np.repeat(lo, size) + np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)]
            near = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
            keys.append(window[near] * len(self.ids) + item[near])
        key = np.unique(np.concatenate(keys))
        return key // len(self.ids), key % len(self.ids)


class Benchmark:
    """What the tasks need of a block of benchmark items."""

    def __init__(self, items: Iterable[tuple[int, str | None]], similarity: float = SIMILARITY, radius: int = RADIUS, k: int = SHINGLE_WORDS) -> None:
        self.similarity, self.radius, self.k = similarity, radius, k
        by_size: dict[int, list] = defaultdict(list)
        for item_id, text in items:
            words = word_hashes(text)
            if len(words):
                own = shingles(words, min(k, len(words)))
                by_size[len(words)].append((item_id, own))
        self.sizes: list[_Size] = []
        for n, rows in sorted(by_size.items()):
            prints = np.concatenate([_packed(_votes(s).sum(axis=0, keepdims=True)) for _, s in rows])
            counts = [np.unique(s, return_counts=True) for _, s in rows]
            size = _Size(n, min(k, n), [i for i, _ in rows], prints, counts, len(rows[0][1]), np.unique(np.concatenate([c for c, _ in counts])))
            size.index(radius)
            self.sizes.append(size)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for kk in sorted({s.k for s in self.sizes}):
            known = np.unique(np.concatenate([c[0] for s in self.sizes if s.k == kk for c in s.counts]))
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[(known >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.known[kk] = (known, table)

    def _hits(self, own: np.ndarray, k: int) -> np.ndarray:
        known, table = self.known[k]
        hit = table[(own >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
        at = np.flatnonzero(hit)
        hit[at] = known[np.minimum(np.searchsorted(known, own[at]), len(known) - 1)] == own[at]
        return hit

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item in the text."""
        words = word_hashes(text)
        best: dict[int, tuple[int, int, int, float]] = {}
        made: dict[int, tuple] = {}
        for size in self.sizes:
            if size.k not in made:
                own = shingles(words, size.k)
                made[size.k] = own, np.flatnonzero(self._hits(own, size.k))
            own, at = made[size.k]
            # Shingles of a window, fewer if the document is shorter than the item.
            m = min(size.total, len(own))
            least = self.similarity / (1 + self.similarity) * (m + size.total) - 1e-9
            if len(at) < least or not len(at):
                continue
            # Only shingles of items of this length count for it.
            at = at[size.known[np.minimum(np.searchsorted(size.known, own[at]), len(size.known) - 1)] == own[at]]
            if len(at) < least or not len(at):
                continue
            hits = np.zeros(len(own) + 1, np.int32)
            hits[at + 1] = 1
            hits = np.cumsum(hits)
            starts = np.flatnonzero(hits[m:] - hits[:-m] >= least)
            for part in range(0, len(starts), 8192):
                self._look(own, starts[part : part + 8192], m, size, best)
        return sorted(best.values())

    def _look(self, own: np.ndarray, starts: np.ndarray, m: int, size: _Size, best: dict) -> None:
        prints = np.empty(len(starts), np.uint64)
        # Running sums over stretches of windows that are close to each other.
        cuts = np.flatnonzero(np.r_[True, np.diff(starts) > m, True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            begin = starts[a]
            sums = np.zeros((starts[b - 1] + m - begin + 1, 64), np.int32)
            np.cumsum(_votes(own[begin : starts[b - 1] + m]), axis=0, out=sums[1:])
            at = starts[a:b] - begin
            prints[a:b] = _packed(sums[at + m] - sums[at])
        for window, item in zip(*size.within(prints, self.radius), strict=True):
            keys, counts = size.counts[item]
            begin = int(starts[window])
            at = np.searchsorted(keys, own[begin : begin + m])
            at = at[keys[np.minimum(at, len(keys) - 1)] == own[begin : begin + m]]
            shared = int(np.minimum(np.bincount(at, minlength=len(keys))[: len(keys)], counts).sum())
            like = shared / (m + size.total - shared)
            if like >= self.similarity:
                item_id = size.ids[item]
                found = (item_id, begin, m + size.k - 1, like)
                # The most similar window; of equal ones the first.
                if item_id not in best or (like, -begin) > (best[item_id][3], -best[item_id][1]):
                    best[item_id] = found


def benchmark_blocks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, **settings
) -> Iterator[Benchmark]:
    """The benchmark in blocks of about ``block_bytes`` of text, one item at least."""
    items: list[tuple[int, str | None]] = []
    held = 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    for item_id, text in rows.toLocalIterator():
        items.append((item_id, text))
        held += len(text or "")
        if held >= block_bytes:
            yield Benchmark(items, **settings)
            items, held = [], 0
    yield Benchmark(items, **settings)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity) for each row of ``docs`` and item that it holds."""
    wanted = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    out: list[DataFrame] = []
    blocks = benchmark_blocks(benchmark, **settings)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        found = wanted.mapInArrow(tidy(_finder(block), _hashes.clear), schema)
        # One block is held at a time.
        out.append(found if following is None and not out else through_table(found, "leaks"))
        block = following
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _finder(block: Benchmark):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, columns = batch.column(0).to_pylist(), ([], [], [], [], [])
            for d, t in zip(ids, batch.column(1).to_pylist(), strict=True):
                for row in block.matches(t):
                    for column, value in zip(columns, (d, *row), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            names = ["doc_id", "item_id", "first_word", "n_words", "similarity"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark item.

    A benchmark of one block is a filter. With more, one block is held at a time: each writes down hashes
    (128 bits) of the texts it matches, and rows with such a text go.
    """
    at = docs.columns.index(text_col)
    blocks = benchmark_blocks(benchmark, **settings)
    block, following = next(blocks), next(blocks, None)

    def chosen(df: DataFrame, block: Benchmark, column: int, leaks: bool) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([bool(block.matches(t)) == leaks for t in batch.column(column).to_pylist()], pa.bool_()))

        return df.mapInArrow(tidy(run, _hashes.clear), df.schema)

    if following is None:
        return chosen(docs, block, at, False)
    text = docs[text_col].cast("string")
    names = [free_name("leak_1", docs), free_name("leak_2", docs)]
    hashes = [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(1), text).alias(names[1])]
    texts, leaks = docs.select(text.alias("text"), *hashes), None
    while block is not None:
        found = through_table(chosen(texts, block, 0, True).select(*names), "leaks")
        leaks = found if leaks is None else leaks.unionByName(found)
        block, following = following, next(blocks, None)
    return docs.select("*", *hashes).join(leaks.distinct(), names, "left_anti").drop(*names)
