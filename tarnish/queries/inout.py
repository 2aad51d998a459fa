"""Writing tables and reading them back, and the streaming forms of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnish.functions.storage import new_path
from tarnish.operators.clean import CleanText, NullifySentinels, RemoveOutliers
from tarnish.queries import sql
from tarnish.queries.registry import query, table
from tarnish.queries.relational import CUSTOMER, DIRTY_CUSTOMER, dirty_customer
from tarnish.sources.files import export_dataset, export_summary, read_table, write_table
from tarnish.streaming.state import forward_fill_stream, sessions_stream, use_rocksdb, write_apart
from tarnish.streaming.streams import clean_stream, dedupe_stream, windowed_quality, write_available


def _there_and_back(df, fmt, lossless=False, by=()):
    path = write_table(df, new_path(df.sparkSession, f"sink-{fmt}"), fmt, lossless, by=by)
    return read_table(df.sparkSession, path, fmt, df.schema, lossless)


@query("sink_csv", "SELECT * FROM documents")
def sink_csv(spark, d):
    return _there_and_back(table(spark, d, "documents"), "csv", lossless=True)


@query(
    "sink_csv_empty_is_null",
    f"WITH t AS ({DIRTY_CUSTOMER}) " + sql.replaced("t", CUSTOMER, {c: f"nullif({c}, '')" for c in ("c_name", "c_mktsegment")}),
)
def sink_csv_empty_is_null(spark, d):
    return _there_and_back(dirty_customer(spark, d), "csv")


@query("sink_csv_lossless", DIRTY_CUSTOMER)
def sink_csv_lossless(spark, d):
    return _there_and_back(dirty_customer(spark, d), "csv", lossless=True)


@query("sink_json", "SELECT * FROM events")
def sink_json(spark, d):
    return _there_and_back(table(spark, d, "events"), "json")


@query("sink_parquet", DIRTY_CUSTOMER)
def sink_parquet(spark, d):
    return _there_and_back(dirty_customer(spark, d), "parquet")


@query("sink_by_dataset", "SELECT * FROM orders")
def sink_by_dataset(spark, d):
    return _there_and_back(table(spark, d, "orders"), "parquet", by=["o_orderpriority"])


@query(
    "export_layout",
    "SELECT * FROM (VALUES ('dirty', 'dirty.csv', true), ('dirty', 'dirty.parquet', true), ('dirty', 'dirty.json', true), "
    "('clean', 'clean.csv', true), ('clean', 'clean.parquet', true), ('clean', 'clean.json', true), "
    "('metadata', 'metadata.json', true)) AS t(dataset, name, has_files)",
)
def export_layout(spark, d):
    """The tables of an exported pair, and whether each has files that hold something."""
    dirty = dirty_customer(spark, d)
    written = export_dataset(
        dirty, table(spark, d, "customer"), {"source": "customer"}, new_path(spark, "export"), "all"
    )
    return export_summary(spark, written).select("dataset", F.element_at(F.split("path", "/"), -1).alias("name"), ((F.col("files") > 0) & (F.col("size_bytes") > 0)).alias("has_files"))


def _event_stream(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


_VALUE_BOUNDS = (
    "(SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo, "
    "quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events)"
)


@query(
    "stream_clean",
    f"SELECT event_id, ts, user_id, upper(event_type) AS event_type, value, upper(props) AS props "
    f"FROM events, {_VALUE_BOUNDS} WHERE value BETWEEN lo AND hi",
)
def stream_clean(spark, d):
    events = table(spark, d, "events")
    fitted = [CleanText(("upper",)).fit(events), RemoveOutliers(columns=["value"]).fit(events)]
    path = new_path(spark, "stream-clean")
    write_available(clean_stream(_event_stream(spark, d), fitted), path).awaitTermination()
    return spark.read.schema(events.schema).parquet(path)


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    # All events come in one micro-batch, within which every copy is dropped; state is kept for a day.
    distinct = dedupe_stream(_event_stream(spark, d), ["user_id", "event_type"], "ts", "1 day")
    path = new_path(spark, "stream-dedupe")
    write_available(distinct.select("user_id", "event_type"), path).awaitTermination()
    return spark.read.schema("user_id bigint, event_type string").parquet(path)


@query(
    "stream_window_quality",
    "WITH w AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS rows, "
    "count(*) FILTER (value IS NULL) AS missing, count(*) FILTER (props <> trim(props)) AS whitespace_issues FROM events GROUP BY ALL) "
    "SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY",
)
def stream_window_quality(spark, d):
    totals = windowed_quality(_event_stream(spark, d), "ts", "1 hour", "1 day", ["value", "props"])
    path = new_path(spark, "stream-window")
    write_available(totals, path).awaitTermination()
    return spark.read.schema("window_start timestamp_ntz, rows bigint, missing bigint, whitespace_issues bigint").parquet(path)


# Events as they arrive: in micro-batches along their time, some of them one or two batches behind.
_PARTS = 5
_FILE_ROWS = 250_000


def _arriving_events(spark, d):
    """A stream of all events with ``batch``, one micro-batch for each; every third value is a stand-in for a missing one."""
    events = table(spark, d, "events")
    at = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts").cast("timestamp_ntz"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    behind = F.when(F.col("event_id") % 11 == 0, 2).when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    batch = F.floor((at - F.lit(low)) * F.lit(_PARTS) / F.lit(high - low + 1)).cast("int") + behind
    value = F.when(F.col("event_id") % 3 == 0, -999.0).otherwise(F.col("value"))
    dealt = events.withColumns({"batch": batch, "value": value})
    path = new_path(spark, "arriving")
    files = _files_of_a_batch(dealt)
    for b in range(_PARTS + 2):
        # As many files for each micro-batch; files are taken in the order in which they were written.
        own = dealt.where(F.col("batch") == b)
        (own.coalesce(1) if files == 1 else own.repartition(files)).write.mode("append").parquet(path)
    return spark.readStream.schema(dealt.schema).option("maxFilesPerTrigger", files).parquet(path)


def _files_of_a_batch(dealt):
    """By the largest batch; rows dealt in turn fill that many files if one partition holds as many of the batch's rows."""
    parts = dealt.groupBy("batch", F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    batches = parts.groupBy("batch").agg(F.sum("n").alias("rows"), F.max("n").alias("most")).where("batch IS NOT NULL")
    rows, most, n = batches.agg(F.max("rows"), F.min("most"), F.count("*")).first()
    return 1 if n < _PARTS + 2 else max(1, min(-(-rows // _FILE_ROWS), most))


_ARRIVING = f"""
    span AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
    dealt AS (
        SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
               floor(((epoch_us(ts) - low) * {_PARTS})::DOUBLE / (high - low + 1)::DOUBLE)::INT
               + CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS batch
        FROM events, span
    ),
    seen AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM dealt GROUP BY batch),
    told AS (
        SELECT dealt.*, coalesce(ts <= date_trunc('milliseconds', top) - INTERVAL 1 DAY, false) AS late FROM dealt JOIN seen USING (batch)
    ),
    done AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS until FROM dealt)
"""


@query(
    "stream_forward_fill",
    f"""WITH {_ARRIVING},
    ordered AS (
        SELECT *, last_value(value IGNORE NULLS) OVER w AS known, max(CASE WHEN value IS NOT NULL THEN ts END) OVER w AS known_at
        FROM told WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    )
    SELECT event_id, user_id, CASE WHEN ts - known_at <= INTERVAL 10 DAY THEN known END AS value, late FROM ordered, done WHERE ts <= until
    UNION ALL SELECT event_id, user_id, value, late FROM told WHERE late""",
)
def stream_forward_fill(spark, d):
    use_rocksdb(spark)
    stream = _arriving_events(spark, d)
    repaired = clean_stream(stream, [NullifySentinels(columns=["value"]).fit(stream)])
    filled = forward_fill_stream(repaired, ["value"], ["user_id"], "ts", "1 day", "10 days", ["event_id"])
    path = new_path(spark, "stream-fill")
    write_apart(filled.select("event_id", "user_id", "value", "late"), path).awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint, value double, late boolean").parquet(path)


@query(
    "stream_sessions",
    f"""WITH {_ARRIVING},
    marked AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 36 HOUR THEN 0 ELSE 1 END AS begins
        FROM told WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    ),
    numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM marked),
    sessions AS (SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS rows, round(sum(coalesce(value, 0)), 4) AS sum_value FROM numbered GROUP BY user_id, session)
    SELECT user_id, session_start, session_end, rows, sum_value, false AS late FROM sessions, done WHERE session_end + INTERVAL 36 HOUR <= until
    UNION ALL SELECT user_id, NULL, NULL, count(*), round(sum(coalesce(value, 0)), 4), true FROM told WHERE late GROUP BY user_id, batch""",
)
def stream_sessions(spark, d):
    use_rocksdb(spark)
    stream = _arriving_events(spark, d)
    repaired = clean_stream(stream, [NullifySentinels(columns=["value"]).fit(stream)])
    path = new_path(spark, "stream-sessions")
    write_apart(sessions_stream(repaired, ["user_id"], "ts", "36 hours", "1 day", ["value"]), path).awaitTermination()
    schema = "user_id bigint, session_start timestamp_ntz, session_end timestamp_ntz, rows bigint, sum_value double, late boolean"
    return spark.read.schema(schema).parquet(path).withColumn("sum_value", F.round("sum_value", 4))
