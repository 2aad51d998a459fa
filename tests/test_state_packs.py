"""Rows cross to a stream's state in packs: one for each hash of a task, however many rows it has."""

import pickle
from datetime import datetime, timedelta

from tarnish.streaming import state

START = datetime(2024, 1, 1)


def test_rows_of_a_hash_are_one_pack(spark):
    rows = [(i, f"k{i % 5}" if i % 7 else None, START + timedelta(seconds=i) if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, at timestamp_ntz").coalesce(1)
    packs = state._packed(df, ["id", "k"], ["k"], "at", "1 hour").collect()
    assert len(packs) == len({p._bucket for p in packs}) == 6
    got = sorted((values, at) for p in packs for _, at, values in pickle.loads(p._pack))
    micros = [None if at is None else (at - datetime(1970, 1, 1)) // timedelta(microseconds=1) for _, _, at in rows]
    assert got == sorted(((i, k), at) for (i, k, _), at in zip(rows, micros, strict=True))
    for p in packs:
        names = {name for name, _, _ in pickle.loads(p._pack)}
        assert len(names) == 1


def test_full_packs_go_out_at_once(spark, monkeypatch):
    monkeypatch.setattr(state, "PACK_ROWS", 1)
    df = spark.createDataFrame([(1, START), (1, START)], "k long, at timestamp_ntz").coalesce(1)
    (pack,) = state._packed(df, ["k"], ["k"], "at", "1 hour").collect()
    assert len(pickle.loads(pack._pack)) == 2
