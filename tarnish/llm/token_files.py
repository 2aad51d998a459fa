"""Operator 1: token ids in files of independent zstandard frames with a seek table.

A file holds one frame for each document (its ids as little-endian unsigned
32-bit integers, with zstandard's content checksum), a skippable frame with the
document ids, and the seek table of the public zstandard seekable format, also a
skippable frame: compressed size, size and the low 32 bits of XXH64 of each
frame, then the number of frames. Any zstandard decoder reads the whole file; a
reader that wants some documents reads the two tables and those frames alone.

Documents lie in ascending order of their id over all files (null ids first;
rows that share an id follow each other, by a hash of the text, so that many of
them, or many null ids, spread over files). Null text counts as empty and gives
the end id alone. An empty table gives an empty folder. Memory: one file's
tables and one chunk of texts for each task.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnish.llm.common import binaries, chunks, id_and_text
from tarnish.llm.tokens import ENCODE_CHARS, encoder_for

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
HEADER = struct.Struct("<II")

_NO_ID = -(2**63)


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes one file; ``close`` gives its documents and ids as counts."""

    def __init__(self, out, level: int = 3) -> None:
        self.out, self.ids, self.entries, self.tokens = out, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """``raw``: the document's ids as little-endian unsigned 32-bit integers."""
        frame = self.compressor.compress(raw)
        self.out.write(frame)
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.tokens += len(raw) // 4

    def close(self) -> tuple[int, int]:
        index = np.array(self.ids, "<i8").tobytes()
        self.out.write(HEADER.pack(SKIPPABLE_INDEX, len(index)) + index)
        # The index is a frame too, of no content, so that frames lie without a gap.
        entries = [*self.entries, (HEADER.size + len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = np.array(entries, "<u4").tobytes() + FOOTER.pack(len(entries), WITH_CHECKSUMS, SEEKABLE)
        self.out.write(HEADER.pack(SKIPPABLE_SEEK, len(table)) + table)
        return len(self.ids), self.tokens


@dataclass
class FrameReader:
    """Reads documents of one file; only the frames asked for are read and decompressed."""

    file: object

    def __post_init__(self) -> None:
        size = self.file.size()
        frames, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError("the file has no seek table with checksums")
        table = self._at(size - FOOTER.size - 12 * frames, 12 * frames)
        self.entries = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.begin = np.cumsum(self.entries[:, 0]) - self.entries[:, 0]
        index = self._at(int(self.begin[-1]) + HEADER.size, int(self.entries[-1, 0]) - HEADER.size)
        self.ids = [None if x == _NO_ID else int(x) for x in np.frombuffer(index, "<i8")]
        self.counts = self.entries[:-1, 1] // 4
        self._decompressor = zstandard.ZstdDecompressor()

    def _at(self, begin: int, size: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(size)

    def read(self, i: int) -> bytes:
        """The ids of the file's document ``i`` as bytes; raises if a checksum is wrong."""
        size, raw, checksum = map(int, self.entries[i])
        ids = self._decompressor.decompress(self._at(int(self.begin[i]), size), max_output_size=raw)
        if len(ids) != raw or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return ids

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        wanted = set(doc_ids)
        for i, d in enumerate(self.ids):
            if d in wanted:
                yield d, self.read(i)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", level: int = 3
) -> list[tuple[int, str, int, int]]:
    """Encode all texts and write them in order of their id.

    Returns one (part, file, documents, ids) for each file, in order: the folder's
    manifest. Each attempt of a task writes a file of its own and then gives it its
    name, so that lost or doubled tasks leave whole files.
    """
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        part, writer = TaskContext.get().partitionId(), None
        encoder, end = encoder_for(tokenizer), struct.pack("<I", end_id)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                attempt = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(attempt)
                writer = FrameWriter(out, level)
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts, ENCODE_CHARS):
                ids, counts = encoder.encode(texts[a:b])
                raw, ends = memoryview(ids.astype("<u4").tobytes()), 4 * np.cumsum(counts)
                for d, lo, hi in zip(doc_ids[a:b], (ends - 4 * counts).tolist(), ends.tolist(), strict=True):
                    writer.add(d, b"".join((raw[lo:hi], end)))
        if writer is not None:
            documents, tokens = writer.close()
            out.close()
            name = f"part-{part:06d}.zst"
            fs.move(attempt, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "documents": [documents], "tokens": [tokens]})

    own = id_and_text(docs, id_col, text_col).withColumn("same", F.xxhash64("text"))
    ordered = own.repartitionByRange("doc_id", "same").sortWithinPartitions("doc_id", "same", "text").drop("same")
    # One short row for each file: the manifest grows with the files, not with their documents.
    return sorted(map(tuple, ordered.mapInArrow(write, "part long, file string, documents long, tokens long").collect()))


def read_token_files(
    spark: SparkSession, folder: str, manifest: Sequence[tuple[int, str, int, int]], wanted: Sequence[int] | None = None
) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of those ``wanted``; start counts the ids of all documents before."""
    rows, start = [], 0
    for _, name, _, tokens in manifest:
        rows.append((name, start))
        start += tokens
    only = None if wanted is None else frozenset(wanted)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{root}/{name}") as file:
                    reader = FrameReader(file)
                    starts = start + np.cumsum(reader.counts) - reader.counts
                    some = [i for i, d in enumerate(reader.ids) if only is None or d in only]
                    for k in range(0, len(some), 256):
                        now = some[k : k + 256]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([reader.ids[i] for i in now], pa.int64()),
                                pa.array(starts[now], pa.int64()),
                                pa.array(reader.counts[now], pa.int64()),
                                binaries([reader.read(i) for i in now]),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    files = spark.createDataFrame(rows, "file string, start long")
    if len(rows) > 1:
        files = files.repartitionByRange(len(rows), "start")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
