"""What the operators share: columns as they need them, Arrow batches, names that are free."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; bounds its arrays, changes no result.
CHUNK_BYTES = 1 << 20


_ROOT = str(Path(__file__).resolve().parents[2])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers find this package where the driver found it, if it isn't installed."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{path}:{_ROOT}".lstrip(":")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string), so that other columns and their names don't matter."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % F.lit(by), F.lit(0))


def free_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, or the first of ``wanted_1``, ``wanted_2``... that no frame has."""
    taken = {c.lower() for df in frames for c in df.columns}
    n, name = 0, wanted
    while name.lower() in taken:
        n, name = n + 1, f"{wanted}_{n + 1}"
    return name


def chunks(texts: Sequence[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` characters each, one row at least."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > size:
            yield begin, i
            begin, held = i, 0
        held += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins and ends; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Returns the process's free memory to the system: Python's, Arrow's, and where there is a way the C library's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Batches, forget: Callable[[], None] | None = None) -> Batches:
    """``run`` for ``mapInArrow``, which at its task's end calls ``forget`` and gives memory back.

    Workers live on between the stages of a job; what one stage has kept would count against the next one's memory.
    """

    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return tidied


def binaries(parts: Sequence[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
