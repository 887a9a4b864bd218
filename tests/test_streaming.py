"""Streaming forms: per-batch sketches (replay-safe) and the watermarked exact cohort."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tuplecohort import Metric, cohort_exact, time_bucket, tuple_sketch
from tuplecohort.session import scratch_path
from tuplecohort.streaming import read_stream_sketches, stream_cohort_exact, stream_sketches


def metrics():
    return [Metric(F.lit(1.0), F.col("event_type") == "view"),
            Metric(F.lit(1.0), F.col("event_type") == "purchase")]


@pytest.fixture
def time_ordered_source(spark):
    """events split into 6 files by time range, written oldest first."""
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    src = scratch_path(spark, "stream-src")
    edges = [datetime.datetime(2024, 1, d) for d in (1, 6, 11, 16, 21, 26)] + \
        [datetime.datetime(2024, 2, 1)]
    for lo, hi in zip(edges, edges[1:]):
        ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1) \
            .write.mode("append").parquet(src)
        time.sleep(0.05)
    return src, ev.schema


def canon(df):
    return sorted((r["week"], r["sketch"]["theta"],
                   [(e["h"], e["values"]) for e in r["sketch"]["entries"]]) for r in df.collect())


def test_stream_sketches_equal_batch_build(spark, time_ordered_source):
    src, schema = time_ordered_source
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    path = scratch_path(spark, "stream-out")
    week = time_bucket("ts").alias("week")
    q = stream_sketches(stream, path, "user_id", metrics(), by=week, k=64,
                        trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(path).select("batch_id").distinct().count() == 6
    got = read_stream_sketches(spark, path, by="week", k=64, num_values=2)
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    want = tuple_sketch(ev, "user_id", metrics(), by=time_bucket("ts").alias("week"), k=64)
    assert canon(got) == canon(want)


def test_stream_cohort_exact_matches_batch(spark, time_ordered_source):
    src, schema = time_ordered_source
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = stream_cohort_exact(stream, "ts", "user_id", metrics(), "$0 >= 4 && $1 > 0",
                              watermark="2 days")
    name = "cohort_" + str(abs(hash(src)) % 10 ** 8)
    q = out.writeStream.outputMode("append").format("memory").queryName(name) \
        .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start()
    q.processAllAvailable()
    # A late sentinel row advances the watermark past the last week.
    sentinel = spark.createDataFrame(
        [(10 ** 9, datetime.datetime(2024, 3, 1), 1, "click", 1.0, "{}")], schema)
    sentinel.coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    got = {r["bucket"]: r["keys"] for r in spark.sql(f"SELECT * FROM {name}").collect()}
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    want = {r["week"]: r["keys"] for r in cohort_exact(
        ev, "user_id", metrics(), "$0 >= 4 && $1 > 0",
        by=time_bucket("ts").alias("week")).collect()}
    assert got == want


def test_replayed_batch_is_not_counted_twice(spark):
    from tuplecohort.streaming import write_batch_sketches
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    path = scratch_path(spark, "replay")
    week = time_bucket("ts").alias("week")
    first, second = ev.where(F.dayofmonth("ts") <= 15), ev.where(F.dayofmonth("ts") > 15)
    write_batch_sketches(first, 0, path, "user_id", metrics(), by=week, k=64)
    write_batch_sketches(second, 1, path, "user_id", metrics(), by=week, k=64)
    write_batch_sketches(second, 1, path, "user_id", metrics(), by=week, k=64)  # replay
    got = read_stream_sketches(spark, path, by="week", k=64, num_values=2)
    want = tuple_sketch(ev, "user_id", metrics(), by=time_bucket("ts").alias("week"), k=64)
    assert canon(got) == canon(want)


def test_compact_equals_merged_batches(spark):
    from tuplecohort.streaming import compact_sketches, write_batch_sketches
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    path = scratch_path(spark, "compact-src")
    for i, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):
        part = ev.where(F.dayofmonth("ts").between(lo, hi))
        write_batch_sketches(part, i, path, "user_id", metrics(), by=time_bucket("ts").alias("week"),
                             k=64)
    compacted = compact_sketches(spark, path, scratch_path(spark, "compact-out"), by="week", k=64,
                                 num_values=2)
    want = tuple_sketch(ev, "user_id", metrics(), by=time_bucket("ts").alias("week"), k=64)
    assert canon(compacted) == canon(want)


def test_stream_cohort_exact_other_session_zone(spark, time_ordered_source):
    src, schema = time_ordered_source
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        out = stream_cohort_exact(stream, "ts", "user_id", metrics(), "$0 >= 4 && $1 > 0",
                                  watermark="2 days")
        name = "cohort_tz_" + str(abs(hash(src)) % 10 ** 8)
        q = out.writeStream.outputMode("append").format("memory").queryName(name) \
            .option("checkpointLocation", scratch_path(spark, "stream-ckpt-tz")).start()
        q.processAllAvailable()
        spark.createDataFrame([(10 ** 9, datetime.datetime(2024, 3, 1), 1, "click", 1.0, "{}")],
                              schema).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        q.stop()
        got = {r["bucket"]: r["keys"] for r in spark.sql(f"SELECT * FROM {name}").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    want = {r["week"]: r["keys"] for r in cohort_exact(
        ev, "user_id", metrics(), "$0 >= 4 && $1 > 0",
        by=time_bucket("ts").alias("week")).collect()}
    assert got == want
