"""Small driver tables, and the shared folder for data that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "string": pa.string(),
    "double": pa.float64(),
    "float": pa.float32(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "smallint": pa.int16(),
    "tinyint": pa.int8(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp_ntz": pa.timestamp("us"),
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def small_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A table of driver rows as a local relation (no Python job to build it)."""
    schema = T.StructType.fromDDL(ddl)
    types = [f.dataType.simpleString() for f in schema.fields]
    if any(t not in _ARROW for t in types):
        return spark.createDataFrame(list(rows), schema)
    arrays = [pa.array([r[i] for r in rows], _ARROW[t]) for i, t in enumerate(types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema=schema)


_own_dirs: dict[str, str] = {}
_held: dict[str, dict[str, None]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Where it is unset, as in tests, a session that runs in one process sets its
    own. Any other is refused: a folder of one machine would be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tarnish-")
    return _own_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, known to ``release``."""
    path = f"{shared_dir(spark)}/tarnish/{name}-{uuid.uuid4().hex[:12]}"
    _held.setdefault(spark.sparkContext.applicationId, {})[path] = None
    return path


def through_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Cuts the lineage, keeps rows and order-dependent columns as written, and a
    lost executor costs only its running tasks. The files stay until
    ``release``, as a result that is not computed yet reads them.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(spark: SparkSession) -> list[str]:
    """The paths in the shared folder that this application has taken and not released, oldest first."""
    return list(_held.get(spark.sparkContext.applicationId, {}))


def release(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Delete tables of the shared folder: ``paths``, or all that are held.

    For when their results have been computed or written elsewhere; works on any store that Spark reaches.
    """
    own = _held.get(spark.sparkContext.applicationId, {})
    jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in list(own if paths is None else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(configuration).delete(path, True)
        own.pop(p, None)


def keep(df: DataFrame, how: str, name: str = "stage") -> DataFrame:
    """Prepare ``df`` for several reads.

    ``recompute`` leaves it alone, ``persist`` caches it (rebuilt from its
    lineage when an executor goes), ``table`` writes it to the shared folder.
    """
    if how == "recompute":
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "table":
        return through_table(df, name)
    raise ValueError(f"unknown way to keep a stage: {how!r}; use recompute, persist or table")
