"""Operators on streams that remember rows: fills along the time, and sessions, with late rows kept apart.

Both hold rows or sessions of a key until the watermark has passed them, and then
let them out in the order of their time; timers wake a key when it has something
to let out or to forget. So a key's state is what came within the delay, and at
most one value for each filled column. Every call of the state crosses from Python
to the JVM, so keys share the calls: Spark's key is one of ``BUCKETS`` hashes of
the keys, and the rows and sessions of each key are told apart within it. Rows
cross by the hundred too: before the shuffle those of a hash that lie in one task
are packed into one.

Spark drops rows behind the watermark before an operator sees them. Here the
watermark is laid on a copy of the time that is moved far ahead, with a delay that
is longer by as much: it stands where it would stand anyway, and no row is behind
it. The operators tell late rows themselves and let them out marked ``late``, so
``write_apart`` can put them into a folder of their own.

A row is late if its time is at or before the watermark when it arrives: the
greatest time of earlier micro-batches, in whole milliseconds, less the delay.
Rows without a time are late too. State is kept in RocksDB (``use_rocksdb``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from datetime import timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tarnish.functions.families import require_columns, type_of
from tarnish.functions.storage import new_path
from tarnish.streaming.streams import instant

_AHEAD = "_ahead"
_AT = "_at"
_KEY = "_key"
_BUCKET = "_bucket"
_PACK = "_pack"
#: Hashes that the keys of a stream share; changes no result. A checkpoint keeps to the number it began with.
BUCKETS = 2048
#: Rows that lie in one entry of a bucket's list; bounds entries, changes no result.
CHUNK = 5000
#: Rows of a task that are packed at once; bounds memory, changes no result.
PACK_ROWS = 100_000
#: How far the watermark's copy of the time is moved; no row is later than that.
AHEAD_DAYS = 366 * 200
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers needs the RocksDB state store; set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def micros(length: str | timedelta) -> int:
    """``"90 minutes"`` or a timedelta, in microseconds."""
    if isinstance(length, timedelta):
        return length // timedelta(microseconds=1)
    number, unit = length.split()
    name = unit if unit.endswith("s") else f"{unit}s"
    return timedelta(**{name: float(number)}) // timedelta(microseconds=1)


def _packed(stream: DataFrame, columns: Sequence[str | Column], keys: Sequence[str], time: str, delay: str | timedelta) -> DataFrame:
    """Packs of rows: ``_bucket``, the hash of their keys; ``_ahead``, the watermark's copy of their greatest time; ``_pack``.

    A pack lists (the keys as one text, nulls too; microseconds since 1970; the values of ``columns``) of each row.
    """
    parts = (F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys)
    at = F.unix_micros(instant(stream, time))
    key = F.concat_ws("\x1f", *parts)
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    rows = stream.select(bucket.alias(_BUCKET), key.alias(_KEY), at.alias(_AT), *columns)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        n = 0
        for batch in batches:
            buckets, names, times, *values = (c.to_pylist() for c in batch.columns)
            each = zip(*values, strict=True) if values else [()] * len(names)
            for b, row in zip(buckets, zip(names, times, each, strict=True), strict=True):
                held.setdefault(b, []).append(row)
            n += len(names)
            if n >= PACK_ROWS:
                yield packs(held)
                held, n = {}, 0
        if held:
            yield packs(held)

    def packs(held: dict[int, list[tuple]]) -> pa.RecordBatch:
        top = [max(at or 0 for _, at, _ in rows) for rows in held.values()]
        columns = [pa.array(list(held), pa.int64()), pa.array(top, pa.int64()), pa.array([pickle.dumps(rows) for rows in held.values()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[_BUCKET, _AHEAD, _PACK])

    ahead = F.timestamp_micros(F.col(_AHEAD) + F.lit(AHEAD_DAYS * 86_400_000_000))
    made = rows.mapInArrow(pack, f"{_BUCKET} long, {_AHEAD} long, {_PACK} binary").withColumn(_AHEAD, ahead)
    return made.withWatermark(_AHEAD, f"{AHEAD_DAYS * 86400 + micros(delay) / 1e6} seconds")


def _unpacked(packs: Iterable[Row]) -> Iterator[tuple]:
    for pack in packs:
        yield from pickle.loads(pack[_PACK])


class _Waking(StatefulProcessor):
    """One timer for each bucket: the earliest time at which one of its keys has something to do."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def wake(self, at: int | None, gone: int = -1) -> None:
        """``at`` in microseconds; timers count whole milliseconds, the first that is not before. Those up to ``gone`` are just being served."""
        wanted = None if at is None else max(-(-at // 1000), 1)
        for timer in [t for t in self.handle.listTimers() if t > gone]:
            if wanted is not None and timer <= wanted:
                return
            self.handle.deleteTimer(timer)
        if wanted is not None:
            self.handle.registerTimer(wanted)

    def close(self) -> None:
        pass


class _ForwardFill(_Waking):
    def __init__(self, names: Sequence[str], columns: Sequence[str], order: Sequence[str], max_gap: int) -> None:
        self.names, self.columns, self.order, self.max_gap = list(names), list(columns), list(order), max_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.out = Row(*self.names, "late")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.last = handle.getValueState("last", "known binary")

    @staticmethod
    def _chunks(rows: Sequence[tuple]) -> list[tuple]:
        return [(pickle.dumps(rows[i : i + CHUNK]),) for i in range(0, len(rows), CHUNK)]

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        done, new = timerValues.getCurrentWatermarkInMs() * 1000, []
        for own, at, values in _unpacked(rows):
            if at is None or at <= done:
                yield self.out(*values, True)
            else:
                new.append((own, at, values))
        if new:
            self.waiting.appendList(self._chunks(new))
            self.wake(min(at for _, at, _ in new))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        done = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], []
        for (chunk,) in self.waiting.get():
            for held in pickle.loads(chunk):
                (ready if held[1] <= done else rest).append(held)
        places = [self.names.index(c) for c in self.order]
        # Nulls first, as in an ascending order.
        ready.sort(key=lambda x: (x[0], x[1], *((x[2][p] is not None, x[2][p]) for p in places)))
        found = self.last.get()
        last: dict[str, dict[str, tuple[int, Any]]] = pickle.loads(found[0]) if found else {}
        filled_at = [(c, self.names.index(c)) for c in self.columns]
        for own, at, values in ready:
            known = last.setdefault(own, {})
            filled = list(values)
            for c, p in filled_at:
                if filled[p] is not None:
                    known[c] = (at, filled[p])
                elif c in known and at - known[c][0] <= self.max_gap:
                    filled[p] = known[c][1]
            yield self.out(*filled, False)
        # What lies too far back for any row to come is forgotten.
        kept = ((own, {c: v for c, v in known.items() if v[0] + self.max_gap > done}) for own, known in last.items())
        last = {own: known for own, known in kept if known}
        if last:
            self.last.update((pickle.dumps(last),))
        else:
            self.last.clear()
        if rest:
            self.waiting.put(self._chunks(rest))
        else:
            self.waiting.clear()
        ends = [at + self.max_gap for known in last.values() for at, _ in known.values()]
        self.wake(min([at for _, at, _ in rest] + ends, default=None), done // 1000)


def forward_fill_stream(
    stream: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    time: str,
    delay: str | timedelta,
    max_gap: str | timedelta,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Missing cells of ``columns`` take the last value of their key that is at most ``max_gap`` older.

    Rows come out with a column ``late`` when the watermark has passed them, in
    the order of ``time`` and ``order_by``, which must tell a key's rows apart.
    Late rows come out as they are. ``max_gap`` bounds how long a value is kept.
    """
    require_columns(stream, [*columns, *keys, time, *order_by])
    names = stream.columns
    schema = T.StructType([*stream.schema.fields, T.StructField("late", T.BooleanType())])
    processor = _ForwardFill(names, columns, order_by, micros(max_gap))
    return (
        _packed(stream, names, keys, time, delay)
        .groupBy(_BUCKET)
        .transformWithState(processor, schema, "append", "EventTime")
    )


class _Sessions(_Waking):
    def __init__(self, gap: int, keys: int, sums: int, names: Sequence[str]) -> None:
        self.gap, self.keys, self.sums, self.names = gap, keys, sums, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.out = Row(*self.names)
        self.open = handle.getValueState("open", "sessions binary")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        done = timerValues.getCurrentWatermarkInMs() * 1000
        late: dict[str, tuple] = {}
        points: dict[str, list] = {}
        owners: dict[str, tuple] = {}
        for name, at, told in _unpacked(rows):
            values = tuple(0.0 if v is None else v for v in told[self.keys :])
            owners[name] = told[: self.keys]
            if at is None or at <= done:
                late[name] = _added(late.get(name, (0, (0.0,) * self.sums)), (1, values))
            else:
                points.setdefault(name, []).append((at, at, (1, values)))
        for name, told in late.items():
            yield self.out(*owners[name], None, None, told[0], *told[1], True)
        if points:
            found = self.open.get()
            held = pickle.loads(found[0]) if found else {}
            for name, new in points.items():
                before = held[name][1] if name in held else []
                held[name] = (owners[name], self._merged(before + new))
            self.open.update((pickle.dumps(held),))
            self.wake(min(last for name in points for _, last, _ in held[name][1]) + self.gap)

    def _merged(self, sessions: Iterable[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for first, last, told in sorted(sessions, key=lambda s: s[:2]):
            if out and first < out[-1][1] + self.gap:
                a, b, before = out[-1]
                out[-1] = (a, max(b, last), _added(before, told))
            else:
                out.append((first, last, told))
        return out

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        done, rest, found = timerValues.getCurrentWatermarkInMs() * 1000, {}, self.open.get()
        for name, (own, sessions) in (pickle.loads(found[0]) if found else {}).items():
            for first, last, (rows, sums) in sessions:
                if last + self.gap <= done:
                    yield self.out(*own, first, last, rows, *sums, False)
            left = [s for s in sessions if s[1] + self.gap > done]
            if left:
                rest[name] = (own, left)
        if rest:
            self.open.update((pickle.dumps(rest),))
        else:
            self.open.clear()
        self.wake(min((last + self.gap for _, sessions in rest.values() for _, last, _ in sessions), default=None), done // 1000)


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], tuple(x + y for x, y in zip(a[1], b[1], strict=True))


def sessions_stream(
    stream: DataFrame, keys: Sequence[str], time: str, gap: str | timedelta, delay: str | timedelta, sums: Sequence[str] = ()
) -> DataFrame:
    """(keys, session_start, session_end, rows, sum_<c>..., late) of each key's sessions.

    A row belongs to the session before it if it comes less than ``gap`` after
    that one's last row. A session comes out once, when the watermark is ``gap``
    past its last row (``session_end`` is that row's time). Late rows join no
    session: those of a key and micro-batch come out as one row with ``late``.
    Times come out as ``time`` has them.
    """
    require_columns(stream, [*keys, time, *sums])
    key_fields = [T.StructField(k, type_of(stream, k)) for k in keys]
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("_first", T.LongType()),
            T.StructField("_last", T.LongType()),
            T.StructField("rows", T.LongType()),
            *(T.StructField(f"sum_{c}", T.DoubleType()) for c in sums),
            T.StructField("late", T.BooleanType()),
        ]
    )
    columns = [*keys, *(F.col(c).cast("double").alias(f"_sum{i}") for i, c in enumerate(sums))]
    packs = _packed(stream, columns, keys, time, delay)
    found = packs.groupBy(_BUCKET).transformWithState(_Sessions(micros(gap), len(keys), len(sums), schema.names), schema, "append", "EventTime")

    def told(c: str) -> Column:
        if isinstance(type_of(stream, time), T.TimestampNTZType):
            return F.timestamp_add("MICROSECOND", F.col(c), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
        return F.timestamp_micros(c)

    return found.select(*keys, told("_first").alias("session_start"), told("_last").alias("session_end"), "rows", *(f"sum_{c}" for c in sums), "late")


def write_apart(stream: DataFrame, path: str, by: Sequence[str] = ("late",), checkpoint: str | None = None) -> StreamingQuery:
    """Append all that has arrived to Parquet folders by ``by`` (``late=true`` and ``late=false``), then stop.

    One query and one commit for each micro-batch, so a restart neither loses nor repeats rows of either folder.
    """
    where = checkpoint or new_path(stream.sparkSession, "stream-state")
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", where)
        .partitionBy(*by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
