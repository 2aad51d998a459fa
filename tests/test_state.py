"""Streams that remember: fills and sessions over several micro-batches, late rows kept apart, state let go."""

from datetime import datetime, timedelta

import pytest

from tarnish.functions.storage import new_path
from tarnish.streaming.state import forward_fill_stream, micros, sessions_stream, use_rocksdb, write_apart

START = datetime(2024, 1, 1)
SCHEMA = "id long, k string, at timestamp_ntz, v double, name string"


@pytest.fixture
def batches(spark):
    use_rocksdb(spark)

    def make(*parts):
        """A stream with one micro-batch for each list of (id, k, hours, v, name)."""
        path = new_path(spark, "parts")
        for rows in parts:
            frame = spark.createDataFrame([(i, k, None if h is None else START + timedelta(hours=h), v, n) for i, k, h, v, n in rows], SCHEMA)
            frame.coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)

    return make


def rows_of(spark, stream, checkpoint=None, path=None):
    path = path or new_path(spark, "out")
    query = write_apart(stream, path, checkpoint=checkpoint)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).collect(), query


def test_fill_over_batches_with_late_rows(spark, batches):
    stream = batches(
        [(1, "a", 0, 1.0, "x"), (2, "a", 2, None, None), (3, None, 1, 7.0, None)],
        # In time though out of order: a known value between rows of the first batch.
        [(4, "a", 1, 5.0, None), (5, "b", 9, None, "y"), (6, "a", 10, None, None)],
        # The watermark stands at 10 - 4 hours: row 7 is late, row 8 is not; row 13 has no time.
        [(7, "a", 5, 99.0, None), (8, "a", 7, 2.0, None), (9, None, 8, None, None), (13, "a", None, 3.0, None)],
        [(10, "a", 40, None, None), (11, "z", 60, 0.0, None)],
        [(12, "z", 90, 0.0, None)],
    )
    found, _ = rows_of(spark, forward_fill_stream(stream, ["v", "name"], ["k"], "at", "4 hours", "20 hours", ["id"]))
    assert {r.id: (r.v, r.name, r.late) for r in found} == {
        1: (1.0, "x", False),
        2: (5.0, "x", False),
        3: (7.0, None, False),
        4: (5.0, "x", False),
        5: (None, "y", False),
        6: (2.0, "x", False),
        7: (99.0, None, True),
        8: (2.0, "x", False),
        9: (7.0, None, False),
        # More than 20 hours after the last known values.
        10: (None, None, False),
        11: (0.0, None, False),
        13: (3.0, None, True),
    }


def test_state_is_let_go(spark, batches):
    stream = batches(*([(100 * b + i, f"k{b}-{i}", 10 * b, 1.0, None) for i in range(50)] for b in range(6)))
    _, query = rows_of(spark, forward_fill_stream(stream, ["v"], ["k"], "at", "1 hour", "2 hours", ["id"]))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Rows, values and timers of one or two batches of 50 keys, not of all six.
    assert max(kept) <= 50 * 3 * 2 * 2 and kept[-1] <= 50 * 3 * 2


def test_sessions_with_late_rows(spark, batches):
    stream = batches(
        [(1, "a", 0, 1.0, None), (2, "a", 1.5, 2.0, None), (3, "b", 0, None, None)],
        # Joins the two sides of a gap, across batches.
        [(4, "a", 3.4, 4.0, None), (5, "a", 2.5, 8.0, None), (6, "a", 6, 16.0, None)],
        [(7, "a", 1, 32.0, None), (8, "a", 1.2, 64.0, None), (9, "b", 20, 1.0, None)],
        [(10, "b", 40, 1.0, None)],
    )
    found, _ = rows_of(spark, sessions_stream(stream, ["k"], "at", "2 hours", "3 hours", ["v"]))
    told = {(r.k, r.session_start, r.session_end, r.rows, r.sum_v, r.late) for r in found}
    at = lambda h: START + timedelta(hours=h)
    assert told == {
        ("a", at(0), at(3.4), 4, 15.0, False),
        ("b", at(0), at(0), 1, 0.0, False),
        ("a", at(6), at(6), 1, 16.0, False),
        ("b", at(20), at(20), 1, 1.0, False),
        ("a", None, None, 2, 96.0, True),
    }


def test_a_restart_goes_on(spark, batches):
    """A second run with the same checkpoint takes only what is new, with the state of the first."""
    source, checkpoint, path = new_path(spark, "source"), new_path(spark, "state"), new_path(spark, "out")
    use_rocksdb(spark)

    def write(rows):
        spark.createDataFrame([(i, k, START + timedelta(hours=h), v, None) for i, k, h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        return {r.id: r.v for r in rows_of(spark, forward_fill_stream(stream, ["v"], ["k"], "at", "1 hour", "50 hours", ["id"]), checkpoint, path)[0]}

    write([(1, "a", 0, 3.0), (2, "a", 5, None)])
    assert run() == {1: 3.0}
    write([(3, "a", 9, None), (4, "a", 20, 1.0)])
    assert run() == {1: 3.0, 2: 3.0, 3: 3.0}


def test_lengths_and_wrong_columns(spark, batches):
    assert micros("90 minutes") == micros("1.5 hours") == 5_400_000_000
    with pytest.raises(ValueError):
        forward_fill_stream(batches([(1, "a", 0, 1.0, None)]), ["w"], ["k"], "at", "1 hour", "1 hour")
