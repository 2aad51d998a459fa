"""Keys of a stream share state and timers by a hash, and keep their own rows and sessions."""

from datetime import datetime, timedelta

import pytest

from tarnish.functions.storage import new_path
from tarnish.streaming import state

START = datetime(2024, 1, 1)
SCHEMA = "id long, k string, at timestamp_ntz, v double"


@pytest.mark.parametrize("kind", ["fill", "sessions"])
def test_many_keys_few_entries(spark, monkeypatch, kind):
    monkeypatch.setattr(state, "BUCKETS", 3, raising=False)
    state.use_rocksdb(spark)
    path, out = new_path(spark, "parts"), new_path(spark, "out")
    keys = [f"k{i}" for i in range(40)]
    first = [(i, k, START, float(i)) for i, k in enumerate(keys)]
    second = [(100 + i, k, START + timedelta(hours=1), None) for i, k in enumerate(keys)]
    for rows in (first + second, [(999, "end", START + timedelta(hours=90), 1.0)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    if kind == "fill":
        made = state.forward_fill_stream(stream, ["v"], ["k"], "at", "1 hour", "9 hours", ["id"])
    else:
        made = state.sessions_stream(stream, ["k"], "at", "2 hours", "1 hour", ["v"])
    query = state.write_apart(made, out)
    query.awaitTermination()
    found = spark.read.schema(made.schema).parquet(out).collect()
    if kind == "fill":
        assert {r.id: (r.v, r.late) for r in found} == {100 * b + i: (float(i), False) for i in range(40) for b in (0, 1)}
    else:
        assert {(r.k, r.rows, r.sum_v, r.late) for r in found} == {(k, 2, float(i), False) for i, k in enumerate(keys)}
    # Rows, values and two columns of timers for each of three hashes; not for each of 40 keys.
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 3 * 4


def test_each_batch_has_as_many_files(spark, monkeypatch, tmp_path):
    import glob
    import os

    import pyarrow.parquet as pq

    from pyspark.sql import functions as F

    from tarnish.functions.storage import held
    from tarnish.queries import inout

    monkeypatch.setattr(inout, "_FILE_ROWS", 60, raising=False)
    events = spark.range(1500, numPartitions=3).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 977 % 1500 + 1_700_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.col("id").cast("double").alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    inout._arriving_events(spark, str(tmp_path))
    files = sorted(glob.glob(held(spark)[-1].removeprefix("file:") + "/*.parquet"), key=os.path.getmtime)
    batches = [set(pq.read_table(f)["batch"].to_pylist()) for f in files]
    n = len(files) // (inout._PARTS + 2)
    assert n > 1 and [b for own in batches for b in own] == [b for b in range(inout._PARTS + 2) for _ in range(n)]
    assert sum(pq.read_metadata(f).num_rows for f in files) == 1500
