"""Operator 12: tokens of two tokenizers aligned by the bytes they cover.

A document is a blank and its text. Both tokenizers' tokens lie over its bytes
without a gap. All tokens are sorted by where they start; a running maximum of
their ends says how far earlier tokens reach, and where a start reaches it a new
group begins. So groups are cut where tokens of both end. Within a group each A
token is linked with each B token. A pair of ids counts the documents of the
corpus that link it; the best pairs of an A id are those with its highest count.

Documents are aligned once, in blocks of some millions of characters. A block's
distinct pairs are numbered, and its links kept as those numbers, packed, in a
table; only the pairs themselves are shuffled and counted. The counts go back to
the blocks that hold the pairs, and each block adds up its own links. The highest
counts are a table of one row for each A id, bounded by A's vocabulary.

Null and empty texts, and texts whose tokens spell other bytes than the blank and
the text, have no tokens: zeros and an empty string. Rows that share an id are
taken each by itself. An empty table gives an empty one. Special tokens' strings
are plain text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table
from tarnish.llm.common import chunks, id_and_text, ranges, utf8
from tarnish.llm.tokens import MARKS, WordEncoder, _Units, code_words, crosses_to_marks

#: Characters of text whose pairs are numbered together.
BLOCK_CHARS = 1 << 24
#: Characters of text that are aligned at once, and units of text that a task remembers; they bound its memory.
ALIGN_CHARS = 1 << 20
CACHE_UNITS = 150_000
#: Links of a group beyond which equal ids are counted before they are paired.
WIDE_GROUP = 1 << 12
_SPACE = "▁"
_B_BITS = 32


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: visible bytes spell themselves, the others the letters from 256 on, in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(visible)))}


@dataclass
class _Spelled:
    """What bytes each id stands for."""

    spelled: list[bytes]
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.fromiter(map(len, self.spelled), np.int64, len(self.spelled))
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(self.spelled), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        return self.pool[np.repeat(self.begin[ids], n) + ranges(n)]


class PieceEncoder:
    """Ids of whole texts by a sentencepiece BPE model whose pieces have blanks at their beginning alone."""

    def __init__(self, path: str, cache_units: int = CACHE_UNITS) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # Merges give pieces, so none crosses from a letter to a blank, or to a mark behind it, unless a piece does.
        merged = [p for i, p in enumerate(pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.by_words = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) or crosses_to_marks(p) for p in merged)
        self.before_marks = len(self.model.encode("a"))
        self.cache_units, self.units = cache_units, _Units()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(counts.sum())), counts

    def _learn(self) -> None:
        units = self.units
        units.grow()
        for kind, numbers in enumerate(units.numbers):
            keys, numbers.new = numbers.new, []
            if keys:
                # Marks stand behind letters, not behind a blank.
                flat, counts = self._whole([f"a{k}" for k in keys] if kind == MARKS else keys)
                if kind == MARKS:
                    flat = flat[ranges(counts) >= self.before_marks]
                    counts = counts - self.before_marks
                units.put(units.find(kind, keys), counts, flat)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text (large_string, no nulls)."""
        if not self.by_words:
            return self._whole(column.to_pylist())
        if self.units.size > self.cache_units:
            self.units = _Units()
        both, ends, sizes, _, coded = code_words(self.units, column)
        self._learn()
        ids, counts = self.units.ids(both)
        per_text = np.add.reduceat(counts, 2 * (ends - sizes))
        # Two blanks in a row make one unit with the word behind them.
        words = coded.dictionary
        blank = pc.or_(pc.equal(words, ""), pc.match_substring(words, _SPACE)).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(blank), side="right"))
        if len(odd):
            own, own_counts = self._whole(column.take(pa.array(odd)).to_pylist())
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for i, x in zip(odd, np.split(own, np.cumsum(own_counts)[:-1]), strict=True):
                parts[i], per_text[i] = x, len(x)
            ids = np.concatenate(parts)
        return ids, per_text


def groups_of(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each A and of each B token, and the number of groups, by coalescing the tokens' intervals."""
    n = len(starts_a)
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:n], group[n:], int(breaks.sum())


def links_of(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, group, times) of all links; times is 1 but where equal ids of a wide group were counted first."""
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    wide = np.flatnonzero(in_a * in_b > WIDE_GROUP)
    narrow = np.ones(n, bool)
    narrow[wide] = False
    keep = narrow[group_a]
    some, of = ids_a[keep].astype(np.int64), group_a[keep]
    times = in_b[of]
    pairs = [np.repeat(some << _B_BITS, times) | ids_b[np.repeat(first_b[of], times) + ranges(times)].astype(np.int64)]
    groups, counts = [np.repeat(of, times)], [np.ones(len(pairs[0]), np.int64)]
    for g in wide.tolist():
        a, many_a = np.unique(ids_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
        b, many_b = np.unique(ids_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
        pairs.append((a.astype(np.int64)[:, None] << _B_BITS | b.astype(np.int64)).ravel())
        counts.append((many_a[:, None] * many_b).ravel())
        groups.append(np.full(len(pairs[-1]), g))
    return np.concatenate(pairs), np.concatenate(groups), np.concatenate(counts)


class _Writer:
    """Spells groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int) -> None:
        self.ids = ids
        width = len(str(ids)) + 1
        table = np.zeros((3, ids, width), np.uint8)
        for i in range(ids):
            digits = str(i).encode()
            table[:, i, : len(digits)] = np.frombuffer(digits, np.uint8)
            table[:, i, len(digits)] = np.frombuffer(b",|;", np.uint8)
        self.table = table.reshape(3 * ids, width)
        self.lengths = (self.table != 0).sum(axis=1)

    def spell(self, ids_a, group_a, ids_b, group_b, n: int, docs: np.ndarray) -> list[memoryview]:
        """One text for each document; ``docs`` holds the number of tokens, of A and B together, of each."""
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        until_a, until_b = np.cumsum(in_a), np.cumsum(in_b)
        rows = np.empty(len(ids_a) + len(ids_b), np.int64)
        # A token is followed by a comma, the last A one of its group by a bar, the last B one by a semicolon.
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[until_a - 1], last_b[until_b - 1] = 1, 2
        rows[np.arange(len(ids_a)) + (until_b - in_b)[group_a]] = ids_a + last_a * self.ids
        rows[np.arange(len(ids_b)) + until_a[group_b]] = ids_b + last_b * self.ids
        ends = np.cumsum(self.lengths[rows])[np.cumsum(docs) - 1]
        text = self.table[rows].ravel()
        text = memoryview(text[text != 0].tobytes())
        return [text[a : b - 1] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Aligner:
    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = WordEncoder(a_path, special_as_text=True, cache_units=CACHE_UNITS), PieceEncoder(b_path)
        vocabulary, alphabet = self.a.tokenizer.get_vocab(), byte_alphabet()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelled[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else b""
        self.of_a, self.of_b = _Spelled(spelled), _Spelled(self.b.spelled)
        self.writer = _Writer(max(len(spelled), len(self.b.spelled)))

    def align(self, texts: list[str | None]) -> dict:
        """Counts and groups of each text, and the distinct pairs of each with the times they are linked."""
        column = pa.array(texts, pa.large_string()).fill_null("")
        with_blank = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string()))
        wanted, at = utf8(with_blank)
        sizes = np.diff(at)
        ok = sizes > 1
        sides = []
        for encode, spelled, strings in ((self.a.encode, self.of_a, with_blank), (self.b.encode, self.of_b, column)):
            ids, counts = encode(strings)
            ids = ids.astype(np.int64)
            doc = np.repeat(np.arange(len(counts)), counts)
            lengths = np.bincount(doc, spelled.lengths[ids], len(counts)).astype(np.int64)
            ok &= lengths == sizes
            sides.append((spelled, ids, doc))
        # First the same number of bytes, then the same bytes.
        for spelled, ids, doc in sides:
            some = ok[doc]
            same = spelled.bytes_of(ids[some]) == wanted[np.repeat(ok, sizes)]
            lasting = sizes[ok]
            if len(lasting):
                ok[np.flatnonzero(ok)[~np.logical_and.reduceat(same, np.cumsum(lasting) - lasting)]] = False
        found = {n: np.zeros(len(texts), np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")}
        found["groups"] = [""] * len(texts)
        empty = np.zeros(0, np.int64)
        found["pairs"], found["entries"], found["times"] = empty, np.zeros(len(texts), np.int64), empty
        if not ok.any():
            return found | {"index": empty, "docs": empty}
        tokens = []
        for spelled, ids, doc in sides:
            some = ok[doc]
            ids, doc = ids[some], doc[some]
            ends = np.cumsum(spelled.lengths[ids])
            tokens.append((ids, doc, ends - spelled.lengths[ids], ends))
        (ids_a, doc_a, starts_a, ends_a), (ids_b, doc_b, starts_b, ends_b) = tokens
        group_a, group_b, n = groups_of(starts_a, ends_a, starts_b, ends_b)
        doc_of_group = np.empty(n, np.int64)
        doc_of_group[group_a] = doc_a
        pairs, groups, times = links_of(ids_a, group_a, ids_b, group_b, n)
        docs, many = doc_of_group[groups], len(texts)
        found["n_a"], found["n_b"] = np.bincount(doc_a, minlength=many), np.bincount(doc_b, minlength=many)
        found["n_groups"] = np.bincount(doc_of_group, minlength=many)
        linked = np.zeros(many, np.int64)
        np.add.at(linked, docs, times) if len(times) and times.max() > 1 else linked.__iadd__(np.bincount(docs, minlength=many))
        found["n_links"] = linked
        valid = np.flatnonzero(ok)
        spelled = self.writer.spell(ids_a, group_a, ids_b, group_b, n, (found["n_a"] + found["n_b"])[valid])
        for i, text in zip(valid.tolist(), spelled, strict=True):
            found["groups"][i] = text
        distinct, index = np.unique(pairs, return_inverse=True)
        key = docs * len(distinct) + index
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=-1))
        key = key[order][begins]
        counts = np.add.reduceat(times[order], begins)
        found["times"] = counts.astype(np.uint32) if counts.max() < 1 << 32 else counts
        found["entries"] = np.bincount(key // len(distinct), minlength=many)
        return found | {"pairs": distinct, "index": (key % len(distinct)).astype(np.uint32), "docs": np.bincount(key % len(distinct), minlength=len(distinct))}


def _pack(entries: np.ndarray, index: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted numbers of each document as differences, byte by byte, so that they compress."""
    index, times = index.astype(np.int64), times.astype(np.int64)
    steps = np.diff(index, prepend=0)
    begins = (np.cumsum(entries) - entries)[entries > 0]
    steps[begins] = index[begins]
    planes = steps.astype("<u4").view(np.uint8).reshape(-1, 4).T
    # Nearly all are linked a few times: one byte, and the larger ones in full behind.
    few = np.minimum(times, 255).astype(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes() + few.tobytes() + times[times >= 255].astype("<i8").tobytes())


def _unpack(packed: bytes, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw, n = zstandard.ZstdDecompressor().decompress(packed), int(entries.sum())
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n).T).view("<u4").ravel().astype(np.int64)
    times = np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64)
    times[times == 255] = np.frombuffer(raw, "<i8", -1, 5 * n)
    total, begins = np.cumsum(steps), np.cumsum(entries) - entries
    before = np.where(begins > 0, total[np.maximum(begins, 1) - 1], 0) if n else np.zeros(len(entries), np.int64)
    return total - np.repeat(before, entries), times


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner_for(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_DOCS = pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in _NUMBERS), ("entries", pa.int64()), ("groups", pa.string())])
_DOCS_DDL = "array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, entries: long, groups: string>>"
_BLOCKS = pa.schema([("block", pa.int64()), ("number", pa.int64()), ("pair", pa.int64()), ("holders", pa.int64()), ("docs", pa.list_(_DOCS)), ("packed", pa.binary())])


def align_tokens(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    groups: str = "text",
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each document.

    ``n_best`` counts the links whose pair has its A id's highest count,
    ``count_sum`` adds the counts of all links. ``groups`` spells the aligned ids
    as ``a1,a2|b1;a3|b2,b3``, or is the SHA-256 of that (``groups="sha256"``).
    """
    if groups not in ("text", "sha256"):
        raise ValueError(f"groups is text or sha256, not {groups!r}")

    def told(text) -> str:
        return hashlib.sha256(text).hexdigest() if groups == "sha256" and len(text) else bytes(text).decode() if len(text) else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = aligner_for(a_path, b_path), TaskContext.get().partitionId() << 32
        held, chars = [], 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            """The block's documents, their links by number, and its distinct pairs."""
            distinct = np.unique(np.concatenate([f["pairs"] for _, f in held]))
            holders = np.zeros(len(distinct), np.int64)
            for rows, found in held:
                number = np.searchsorted(distinct, found["pairs"])
                holders[number] += found["docs"]
                packed = _pack(found["entries"], number[found["index"]], found["times"])
                entries = [{"doc_id": d, **{c: found[c][i] for c in (*_NUMBERS, "entries")}, "groups": g} for i, (d, g) in enumerate(zip(rows, found["groups"], strict=True))]
                yield pa.RecordBatch.from_pydict({"block": [block], "number": [None], "pair": [None], "holders": [None], "docs": [entries], "packed": [packed]}, schema=_BLOCKS)
            for a in range(0, len(distinct), 1 << 16):
                n = min(len(distinct) - a, 1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(np.arange(a, a + n)), pa.array(distinct[a : a + n]), pa.array(holders[a : a + n]), pa.nulls(n, _BLOCKS.field("docs").type), pa.nulls(n, pa.binary())],
                    schema=_BLOCKS,
                )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts, ALIGN_CHARS):
                found = aligner.align(texts[a:b])
                found["groups"] = [told(g) for g in found["groups"]]
                held.append((ids[a:b], found))
                chars += sum(len(t or "") for t in texts[a:b])
                if chars >= block_chars:
                    yield from hand_on()
                    held, chars, block = [], 0, block + 1
        if held:
            yield from hand_on()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, bool)
        number = right.column("number").to_numpy()
        counts[number] = right.column("holders").to_numpy()
        best[number] = right.column("best").to_numpy()
        out = []
        for rows, packed in zip(left.column("docs").combine_chunks(), left.column("packed").to_pylist(), strict=True):
            flat = rows.values
            entries = flat.field("entries").to_numpy()
            index, times = _unpack(packed, entries)
            doc = np.repeat(np.arange(len(entries)), entries)
            sums = [np.zeros(len(entries), np.int64) for _ in range(2)]
            for into, what in zip(sums, (best[index] * times, counts[index] * times), strict=True):
                np.add.at(into, doc, what)
            columns = [flat.field("doc_id"), *(flat.field(c) for c in _NUMBERS), *map(pa.array, sums), flat.field("groups")]
            out.append(pa.table(columns, names=["doc_id", *_NUMBERS, "n_best", "count_sum", "groups"]))
        # A block has documents, if it has pairs.
        return pa.concat_tables(out)

    blocks = through_table(
        id_and_text(docs, id_col, text_col).mapInArrow(
            run, f"block long, number long, pair long, holders long, docs {_DOCS_DDL}, packed binary"
        ),
        "aligned",
    )
    pairs = blocks.where("pair is not null").select("block", "number", "pair", "holders")
    totals = pairs.groupBy("pair").agg(F.sum("holders").alias("holders"))
    id_a = F.shiftright("pair", _B_BITS)
    highest = totals.groupBy(id_a.alias("a")).agg(F.max("holders").alias("highest"))
    # One row for each A id at most: bounded by its vocabulary.
    known = totals.join(F.broadcast(highest), id_a == F.col("a")).select("pair", "holders", (F.col("holders") == F.col("highest")).alias("best"))
    back = pairs.select("block", "number", "pair").join(known, "pair").select(F.col("block").alias("of"), "number", "holders", "best")
    texts = blocks.where("pair is null").select("block", "docs", "packed")
    return (
        texts.groupBy("block")
        .cogroup(back.groupBy("of"))
        .applyInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    )
