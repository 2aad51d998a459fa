"""Operator 8: cost-balanced packing of documents into sequences of bounded length.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention stays
within a piece. A task takes its documents in windows of about a million tokens.
Whole sequences are cut from documents that are longer than one. The remains go,
longest first, to the sequence of lowest cost that has room; what fits nowhere
is cut over the sequences with the most room. A window makes only as many
sequences as it can fill; the tokens left over go to sequences whose lengths are
powers of two, which need no padding. So nothing is padded, nothing is dropped,
there is no shuffle, and memory is bounded by a window and one document.

Each id lies in exactly one piece. Null text counts as empty: the end id alone.
Rows that share an id are packed each by itself. An empty table gives no pieces.
``sequence_id`` holds the task's partition in its upper half.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tarnish.llm.common import binaries, chunks, id_and_text, tidy
from tarnish.llm.tokens import ENCODE_CHARS, encoder_for

SEQUENCE_TOKENS = 2048
WINDOW_TOKENS = 1 << 20
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def assign(lengths: np.ndarray, size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces, without padding.

    Sequences are numbered from 0; all have ``size`` tokens but the last ones, whose lengths are powers of two.
    """
    pieces, made = [], 0
    for d in np.flatnonzero(lengths >= size).tolist():
        for start in range(0, int(lengths[d]) - size + 1, size):
            pieces.append((d, start, size, made, 0))
            made += 1
    rest = lengths % size
    full = int(rest.sum()) // size
    tail = [1 << b for b in range(int(size).bit_length(), -1, -1) if (int(rest.sum()) % size) >> b & 1]
    used, cost = np.zeros(full, np.int64), np.zeros(full)
    cut: list[tuple[int, int, int]] = []
    for d in np.argsort(-rest, kind="stable").tolist():
        n = int(rest[d])
        if not n:
            break
        begin = int(lengths[d]) - n
        room = used + n <= size
        if not room.any():
            cut.append((d, begin, n))
            continue
        s = int(np.where(room, cost, np.inf).argmin())
        pieces.append((d, begin, n, made + s, int(used[s])))
        used[s] += n
        cost[s] += linear * n + quadratic * n * n
    # The roomiest sequences first, then the powers of two, largest first.
    gaps = [(int(s), int(used[s]), size - int(used[s])) for s in np.argsort(used, kind="stable") if used[s] < size]
    gaps += [(full + i, 0, n) for i, n in enumerate(tail)]
    gaps.reverse()
    for d, begin, n in cut:
        while n:
            s, offset, room = gaps.pop()
            now = min(n, room)
            pieces.append((d, begin, now, made + s, offset))
            begin, n = begin + now, n - now
            if room > now:
                gaps.append((s, offset + now, room - now))
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = SEQUENCE_TOKENS,
    linear: float = 1.0,
    quadratic: float = 1.0 / SEQUENCE_TOKENS,
    window: int = WINDOW_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All pieces of all documents with their ids (little-endian unsigned 32-bit) and places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, made = encoder_for(tokenizer), TaskContext.get().partitionId(), 0
        held_ids: list[int | None] = []
        held: list[np.ndarray] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made, tokens
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            pieces = assign(lengths, size, linear, quadratic)
            for k in range(0, len(pieces), 4096):
                now = pieces[k : k + 4096]
                d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*now, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([held_ids[i] for i in d], pa.int64()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(lengths[d]),
                        pa.array((part << 32) + made + sequence),
                        pa.array(offset),
                        binaries([held[i][a : a + n].astype("<u4").tobytes() for i, a, n, _, _ in now]),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )
            made += 1 + max((p[3] for p in pieces), default=-1)
            held_ids.clear()
            held.clear()
            tokens = 0

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts, ENCODE_CHARS):
                ids, counts = encoder.encode(texts[a:b])
                ends = np.cumsum(counts)
                for d, lo, hi in zip(doc_ids[a:b], (ends - counts).tolist(), ends.tolist(), strict=True):
                    held_ids.append(d)
                    held.append(np.append(ids[lo:hi], np.uint32(end_id)))
                    tokens += hi - lo + 1
                if tokens >= window:
                    yield from flush()
        if held:
            yield from flush()

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run, lambda: encoder_for(tokenizer).forget()), SCHEMA)
