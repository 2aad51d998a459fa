"""Operator 13: lines found in many documents go, found by two Bloom filters.

A line's key is the line without white space at its ends, ASCII letters
lower-cased. Tasks put the hashes of their documents' keys into two Bloom
filters: one of keys seen, one of keys seen again. Filters of tasks meet shard
by shard: what two of them have seen is seen again, so no repeat is lost, though
some single keys may pass. Only the suspected repeats are shuffled, as SHA-256 of
their keys, and counted exactly. Which documents hold which repeats is joined
back to the texts.

The filters have a fixed size (``filter_bits``), whatever the size of the table:
beyond about one key for every ten bits more single keys are counted in vain,
with the same results. The second filter alone is sent to the tasks.

Each row is a document. Null text counts as one empty line. Empty keys and those
with fewer than ``min_chars`` code points stay. With ``keep="first"`` the first
such line stays in the document with the smallest id (null first; then by hash
of the text); rows that share id and text are alike and keep it in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table
from tarnish.llm.common import id_and_text

WHITE = b" \t\n\x0b\x0c\r"
#: Bits of each filter, and of a shard of it, as powers of two.
FILTER_BITS = 27
SHARD_BITS = 20
PROBES = 4
#: Keys that a task holds before it hands on its filters.
HELD_KEYS = 1 << 22

LINES_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parted AS (
    SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs
),
keyed AS (
    SELECT r, doc_id, i, line, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM parted
),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.key = often.key GROUP BY r
"""


def keys_of(text: str | None) -> list[bytes]:
    """The key of each line."""
    return [line.strip(WHITE) for line in (text or "").encode().lower().split(b"\n")]


def _counted(keys: list[bytes], min_chars: int) -> list[bytes]:
    """The different keys of a document that are long enough."""
    return [k for k in set(keys) if len(k) >= min_chars and (min_chars < 2 or len(k.decode()) >= min_chars)]


def _probes(hashes: np.ndarray) -> np.ndarray:
    """The places of each hash within its shard."""
    mask = np.uint64((1 << SHARD_BITS) - 1)
    first, step = hashes & mask, hashes >> np.uint64(SHARD_BITS) & mask | np.uint64(1)
    return np.stack([(first + np.uint64(i) * step) & mask for i in range(PROBES)]).astype(np.int64)


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << SHARD_BITS, bool)
    bits[_probes(hashes).ravel()] = True
    return np.packbits(bits, bitorder="little")


def _shard_of(hashes: np.ndarray, filter_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - filter_bits + SHARD_BITS)).astype(np.int64) if filter_bits > SHARD_BITS else np.zeros(len(hashes), np.int64)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def seen_again(texts: DataFrame, filter_bits: int = FILTER_BITS, min_chars: int = 1) -> DataFrame:
    """(shard, twice) of the filter of keys seen in two documents or more; ``texts`` has the one column text."""
    blank = (1 << SHARD_BITS) >> 3

    def pack(bits: np.ndarray) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(bits.tobytes())

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            hashes, times = np.unique(np.concatenate(held), return_counts=True)
            # Hashes are in order, so shards are runs.
            shards = _shard_of(hashes, filter_bits)
            names, begins = np.unique(shards, return_index=True)
            for name, a, b in zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(hashes)], strict=True):
                again = hashes[a:b][times[a:b] > 1]
                twice = pack(_bitmap(again)) if len(again) else None
                yield pa.RecordBatch.from_pydict({"shard": [name], "once": [pack(_bitmap(hashes[a:b]))], "twice": pa.array([twice], pa.binary())})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                keys = _counted(keys_of(text), min_chars)
                held.append(_hashes(keys))
                count += len(keys)
            if count >= HELD_KEYS:
                yield from hand_on()
                held, count = [], 0
        if count:
            yield from hand_on()

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their shard; one shard's filters are held."""
        unpack, now = zstandard.ZstdDecompressor().decompress, None

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None and twice.any():
                yield pa.RecordBatch.from_pydict({"shard": [now], "twice": [pack(twice)]})

        for batch in batches:
            for shard, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now:
                    yield from done()
                    now, once, twice = shard, np.zeros(blank, np.uint8), np.zeros(blank, np.uint8)
                other = np.frombuffer(unpack(a), np.uint8)
                twice |= once & other
                once |= other
                if b is not None:
                    twice |= np.frombuffer(unpack(b), np.uint8)
        yield from done()

    shards = texts.mapInArrow(own, "shard long, once binary, twice binary")
    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(merged, "shard long, twice binary")


def keyed_by_content(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, doc_id, text): rows of the same id and text have the same lines dropped, so 128 bits of both name a document."""
    own = id_and_text(docs, id_col, text_col)
    return own.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(13), "text", "doc_id").alias("k2"), "doc_id", "text")


def _suspects(keyed: DataFrame, spark: SparkSession, filter_bits: int, min_chars: int) -> DataFrame:
    """(k1, k2, doc_id, digest) of each different key of a document that another may hold."""
    # As many bytes as the second filter has, compressed: bounded by filter_bits.
    sent = spark.sparkContext.broadcast({r.shard: bytes(r.twice) for r in seen_again(keyed.select("text"), filter_bits, min_chars).collect()})
    size = (1 << SHARD_BITS) >> 3

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((max(1, 1 << (filter_bits - SHARD_BITS)), size), np.uint8)
        for shard, packed in sent.value.items():
            bits[shard] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        for batch in batches:
            k1, k2, ids, texts = (c.to_pylist() for c in batch.columns)
            keys, rows = [], []
            for i, text in enumerate(texts):
                own = _counted(keys_of(text), min_chars)
                keys += own
                rows += [i] * len(own)
            if not keys:
                continue
            hashes = _hashes(keys)
            shards, found = _shard_of(hashes, filter_bits), np.ones(len(hashes), bool)
            for at in _probes(hashes):
                found &= (bits[shards, at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            some = np.flatnonzero(found).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k1[rows[j]] for j in some], pa.int64()),
                    pa.array([k2[rows[j]] for j in some], pa.int64()),
                    pa.array([ids[rows[j]] for j in some], pa.int64()),
                    pa.array([hashlib.sha256(keys[j]).digest() for j in some], pa.binary()),
                ],
                names=["k1", "k2", "doc_id", "digest"],
            )

    return keyed.mapInArrow(run, "k1 long, k2 long, doc_id long, digest binary")


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep: str = "none",
    filter_bits: int = FILTER_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): each document without the lines found in ``min_docs`` (2 or more) documents."""
    if min_docs < 2:
        raise ValueError("a repeated line is in two documents at least")
    if keep not in ("none", "first"):
        raise ValueError(f"keep is none or first, not {keep!r}")
    keyed = keyed_by_content(docs, id_col, text_col)
    suspects = through_table(_suspects(keyed, docs.sparkSession, filter_bits, max(1, min_chars)), "suspects")
    first = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "k1", "k2"))
    often = suspects.groupBy("digest").agg(F.count("*").alias("n"), first.alias("first")).where(F.col("n") >= min_docs)
    # Written, so that a line which a third of all documents hold is split in the join.
    often = through_table(often.select("digest", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2")), "repeats")
    is_first = (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2"))
    found = suspects.join(often, "digest").select("k1", "k2", F.struct("digest", is_first.alias("is_first")).alias("hit"))
    # As many as the document has lines.
    hits = found.groupBy("k1", "k2").agg(F.collect_set("hit").alias("hits"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, found = (c.to_pylist() for c in batch.columns)
            n_lines, n_dropped, kept = [], [], []
            for text, hit in zip(texts, found, strict=True):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if hit:
                    spared = {h["digest"] for h in hit if h["is_first"]} if keep == "first" else set()
                    drop = {h["digest"] for h in hit}
                    stay = []
                    for line, key in zip(lines, keys_of(text), strict=True):
                        digest = hashlib.sha256(key).digest()
                        if digest not in drop or digest in spared:
                            stay.append(line)
                            spared.discard(digest)
                    lines = stay
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append("\n".join(lines))
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "n_lines": n_lines, "n_dropped": n_dropped, "kept": kept}, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])
    joined = keyed.join(hits, ["k1", "k2"], "left").select("doc_id", "text", "hits")
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept string")
