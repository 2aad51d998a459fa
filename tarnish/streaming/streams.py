"""The cleaning operators on unbounded input.

Fitted operators hold literals only, so the plan that was fitted on a batch is
applied to a stream as it is; refit it with a batch job when the data drifts.
Removing copies needs memory of what was seen, which a watermark bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarnish.functions.families import text_columns, type_of
from tarnish.functions.storage import new_path
from tarnish.functions.text import strip
from tarnish.operators.clean import Fitted, FittedDuplicates, FittedNearest, FittedOrderedFill
from tarnish.plans.cleaning import transform_all

EVENT_TIME = "_event_time"


def clean_stream(stream: DataFrame, fitted: Sequence[Fitted]) -> DataFrame:
    """Apply fitted operators row by row."""
    for operator in fitted:
        if isinstance(operator, (FittedDuplicates, FittedNearest, FittedOrderedFill)):
            raise ValueError(f"{operator.operation} needs more than one row at a time; see dedupe_stream and forward_fill_stream")
    return transform_all(stream, fitted)


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def instant(stream: DataFrame, time: str) -> Column:
    """A zoned time for watermarks; a zoneless one counts from 1970, so no session zone moves it."""
    if isinstance(type_of(stream, time), T.TimestampNTZType):
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(time)))
    return F.col(time).cast("timestamp")


def _event_time(stream: DataFrame, time: str, delay: str) -> DataFrame:
    # A watermark needs the zoned type; the column itself stays as it is.
    return stream.withColumn(EVENT_TIME, instant(stream, time)).withWatermark(EVENT_TIME, delay)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; copies up to ``delay`` later in event time are dropped.

    Keys are forgotten once the watermark is ``delay`` past them, so state holds the keys of about that time.
    """
    return _event_time(stream, time, delay).dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME)


def windowed_quality(stream: DataFrame, time: str, window: str, delay: str, columns: Sequence[str]) -> DataFrame:
    """(window_start, rows, missing, whitespace_issues) per event-time window, in UTC for zoneless times.

    Written in append mode, a window comes once, when the watermark has passed its end, and its state is freed.
    """
    missing, untrimmed = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    texts = text_columns(stream)
    for c in columns:
        missing = missing + F.col(c).isNull().cast("bigint")
        if c in texts:
            untrimmed = untrimmed + F.coalesce((F.col(c) != strip(F.col(c))).cast("bigint"), F.lit(0))
    start = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("_window.start")), F.expr(_EPOCH))
    return (
        _event_time(stream, time, delay)
        .groupBy(F.window(EVENT_TIME, window).alias("_window"))
        .agg(
            F.count("*").alias("rows"),
            F.sum(missing).alias("missing"),
            F.sum(untrimmed).alias("whitespace_issues"),
        )
        .select(start.alias("window_start"), "rows", "missing", "whitespace_issues")
    )


def write_available(stream: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append everything that has arrived to Parquet files at ``path``, then stop.

    The file sink commits each micro-batch once, so a restart neither loses nor repeats rows.
    """
    where = checkpoint or new_path(stream.sparkSession, "stream-state")
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", where)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
