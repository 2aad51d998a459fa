import pytest
from pyspark.sql import functions as F

from tarnish import CleanText, Impute, RemoveDuplicates
from tarnish.functions.storage import new_path
from tarnish.streaming.streams import clean_stream, dedupe_stream, windowed_quality, write_available


@pytest.fixture
def source(spark):
    df = spark.range(200).select(
        F.col("id"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("at"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit(" Item "), (F.col("id") % 5).cast("string"))).alias("name"),
    )
    path = new_path(spark, "stream-source")
    df.repartition(4).write.parquet(path)
    return df, lambda files=1: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def test_a_fitted_plan_gives_the_same_on_a_stream(spark, source):
    df, stream = source
    fitted = [CleanText().fit(df), Impute(exclude=["id"]).fit(df)]
    path = new_path(spark, "stream-out")
    write_available(clean_stream(stream(), fitted), path).awaitTermination()
    expected = df
    for operator in fitted:
        expected = operator.transform(expected)
    assert sorted(map(repr, spark.read.schema(expected.schema).parquet(path).collect())) == sorted(map(repr, expected.collect()))
    with pytest.raises(ValueError):
        clean_stream(stream(), [RemoveDuplicates().fit(df)])


def test_copies_are_dropped_across_micro_batches(spark, source):
    _, stream = source
    path = new_path(spark, "stream-out")
    write_available(dedupe_stream(stream().filter("name is not null"), ["name"], "at", "30 days"), path).awaitTermination()
    assert spark.read.parquet(path).count() == 5


def test_closed_windows_come_once_whatever_the_zone(spark, source):
    _, stream = source
    path = new_path(spark, "stream-out")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        write_available(windowed_quality(stream(10), "at", "1 hour", "10 minutes", ["name"]), path).awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    rows = spark.read.parquet(path).orderBy("window_start").collect()
    # The last event is at 3:19, so the watermark closes the windows that end by 3:09.
    assert [(r["window_start"].hour, r["rows"]) for r in rows] == [(0, 60), (1, 60), (2, 60)]
    assert sum(r["missing"] for r in rows) == 60
    assert sum(r["whitespace_issues"] for r in rows) == 120
