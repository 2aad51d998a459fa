"""Reading and writing tables: CSV, Parquet, JSON lines, one metadata document.

A table is a directory of part files, one per task; nothing is gathered into a
single file.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnish.functions.convert import nan_to_null
from tarnish.functions.families import type_of

# Formats and the names of an exported dataset's tables.
FORMATS = ("csv", "parquet", "json")
TABLE_NAMES = {"dirty": "dirty", "clean": "clean", "perfect": "perfect_synthetic"}
METADATA_NAME = "metadata.json"

#: What NULL is written as when a CSV must tell it from the empty text.
NULL_TEXT = "\\N"
_STAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def format_list(formats: str | Iterable[str]) -> list[str]:
    """One format, several, or ``all``; duplicates dropped."""
    wanted = [formats] if isinstance(formats, str) else list(formats)
    out: list[str] = []
    for f in wanted:
        if f != "all" and f not in FORMATS:
            raise ValueError(f"unknown format {f!r}; use {', '.join(FORMATS)} or all")
        out += [g for g in (FORMATS if f == "all" else (f,)) if g not in out]
    return out


def _csv_options(lossless: bool) -> dict[str, Any]:
    # The writer trims values unless told not to, and escapes quotes its own way.
    options: dict[str, Any] = {
        "header": True,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "quote": '"',
        "escape": '"',
        "timestampNTZFormat": _STAMP,
    }
    # Left alone, an empty text is written as a pair of quotes and read back as such.
    return options | ({"nullValue": NULL_TEXT} if lossless else {"nullValue": "", "emptyValue": ""})


# How line breaks are written in a lossless CSV, and the sign itself.
LINE_BREAKS = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))


def _texts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Each text with the first of each pair replaced by the second, in order."""

    def replaced(c: str) -> Column:
        out = F.col(c)
        for old, new in pairs:
            out = F.replace(out, F.lit(old), F.lit(new))
        return out.alias(c)

    return df.select(*(replaced(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema))


def write_csv(df: DataFrame, path: str, lossless: bool = False, mode: str = "error", by: Sequence[str] = ()) -> str:
    """CSV with a header. NULL and the empty text both come out empty, unless ``lossless``.

    ``lossless`` also escapes line breaks in texts, so that a line is a row and files can be read in parts.
    """
    if lossless:
        df = _texts(df, LINE_BREAKS)
    df.write.mode(mode).partitionBy(*by).options(**_csv_options(lossless)).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "error", by: Sequence[str] = ()) -> str:
    df.write.mode(mode).partitionBy(*by).parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "error", by: Sequence[str] = ()) -> str:
    """JSON lines, ISO datetimes, NULLs written out."""
    options = {"ignoreNullFields": False, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
    df.write.mode(mode).partitionBy(*by).options(**options).json(path)
    return path


def write_table(
    df: DataFrame, path: str, fmt: str, lossless: bool = False, mode: str = "error", by: Sequence[str] = ()
) -> str:
    df = normalise_missing(df)
    if fmt == "csv":
        return write_csv(df, path, lossless, mode, by)
    if fmt == "parquet":
        return write_parquet(df, path, mode, by)
    if fmt == "json":
        return write_json(df, path, mode, by)
    raise ValueError(f"unknown format {fmt!r}; use {', '.join(FORMATS)}")


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL, so there is one kind of missing value."""
    return df.select(*(nan_to_null(F.col(c), type_of(df, c)).alias(c) for c in df.columns))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    lossless: bool = False,
    nan_is_missing: bool = False,
    multi_line: bool | None = None,
) -> DataFrame:
    """A table written by this module, or any table in these formats.

    CSV and JSON need a schema: inferring one would read the data twice. Tables
    written by this module hold no NaN, and filters on their columns reach the
    scan; ``nan_is_missing=True`` reads the NaN of other tables as NULL, which
    keeps filters on float columns above the scan. CSV is read with line breaks
    in its texts, which keeps a file in one task, unless ``lossless`` escaped
    them; ``multi_line=False`` splits other files that have none.
    """
    finish = normalise_missing if nan_is_missing else lambda df: df
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return finish(reader.parquet(path))
    if schema is None:
        raise ValueError(f"reading {fmt} needs a schema")
    if fmt == "csv":
        options = {**_csv_options(lossless), "multiLine": not lossless if multi_line is None else multi_line}
        df = spark.read.schema(schema).options(**options).csv(path)
        return finish(_texts(df, [(new, old) for old, new in reversed(LINE_BREAKS)]) if lossless else df)
    if fmt == "json":
        options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
        return finish(spark.read.schema(schema).options(**options).json(path))
    raise ValueError(f"unknown format {fmt!r}; use {', '.join(FORMATS)}")


def _plain(value: Any) -> Any:
    if isinstance(value, Mapping):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [_plain(v) for v in value]
    if isinstance(value, (datetime, date)):
        return value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    if value is None or isinstance(value, (str, int, float, bool)):
        return value
    return str(value)


def write_metadata(spark: SparkSession, metadata: Mapping[str, Any], path: str, mode: str = "error") -> str:
    """The (small) metadata document as one JSON text file, written by Spark so any store works."""
    document = json.dumps(_plain(metadata), ensure_ascii=False)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode(mode).text(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def export_dataset(
    dirty: DataFrame,
    clean: DataFrame,
    metadata: Mapping[str, Any],
    output_dir: str,
    formats: str | Iterable[str] = "csv",
    perfect: DataFrame | None = None,
    lossless: bool = False,
    mode: str = "error",
    by: Sequence[str] = (),
) -> dict[str, list[str]]:
    """The tables of a dataset in each format, and its metadata; returns the paths per table.

    ``by`` partitions the tables by these columns (one directory per dataset of a batch).
    """
    tables = {"dirty": dirty, "clean": clean, "perfect": perfect}
    base = output_dir.rstrip("/")
    written: dict[str, list[str]] = {"dirty": [], "clean": [], "perfect": [], "metadata": []}
    for fmt in format_list(formats):
        for name, df in tables.items():
            if df is not None:
                path = f"{base}/{TABLE_NAMES[name]}.{fmt}"
                written[name].append(write_table(df, path, fmt, lossless, mode, by))
    written["metadata"].append(write_metadata(dirty.sparkSession, metadata, f"{base}/{METADATA_NAME}", mode))
    return written


def export_summary(spark: SparkSession, exported: Mapping[str, Sequence[str]]) -> DataFrame:
    """(dataset, path, files, size_bytes, size_mb) of exported tables, from a file listing only."""
    frames = []
    for name, paths in exported.items():
        for path in paths:
            listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            frames.append(
                listing.select(F.lit(name).alias("dataset"), F.lit(path).alias("path"), F.col("length").alias("_size"))
            )
    if not frames:
        return spark.createDataFrame([], "dataset string, path string, files bigint, size_bytes bigint, size_mb double")
    everything = frames[0]
    for f in frames[1:]:
        everything = everything.unionByName(f)
    sizes = everything.groupBy("dataset", "path").agg(
        F.count("*").alias("files"), F.sum("_size").alias("size_bytes")
    )
    return sizes.withColumn("size_mb", F.round(F.col("size_bytes") / F.lit(float(2**20)), 2))
