"""Every operator's output keeps the sketch invariants; ingest can reject bad values."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tuplecohort import (Metric, as_sketch_column, collapse_tuples, combine_sketches,
                         filter_tuples, merge_sketches, sketch_valid, tuple_sketch)


def all_valid(df, *cols):
    return all(r[0] for r in df.select(F.min(F.array_min(F.array(
        *[sketch_valid(c).cast("int") for c in cols])))).collect())


@pytest.fixture(scope="module")
def built(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    ms = [Metric("value"), Metric(F.lit(1.0), F.col("event_type") == "view")]
    return tuple_sketch(ev, "user_id", ms, by=["event_type", F.to_date("ts").alias("day")], k=16)


def test_operators_keep_invariants(spark, built):
    assert all_valid(built, "sketch")
    merged = merge_sketches(built, by="event_type", k=16, num_values=2)
    assert all_valid(merged, "sketch")
    t = merged.withColumn("f", filter_tuples("sketch", "$0 > 50")) \
        .withColumn("c", collapse_tuples("f", "$0 + $1")) \
        .withColumn("z", filter_tuples("sketch", "$0 < 0")) \
        .withColumn("u", combine_sketches("sketch", "f", k=16))
    assert all_valid(t, "f", "c", "z", "u")


def test_ingest_validation_rejects_bad_values(spark, built):
    bad = built.withColumn("sketch", F.struct(
        F.col("sketch.theta"), F.col("sketch.k"), F.lit(3).alias("num_values"),  # wrong width
        F.col("sketch.hash"), F.col("sketch.entries")))
    assert not all_valid(bad, "sketch")
    with pytest.raises(Exception, match="not a valid sketch"):
        as_sketch_column(bad, "sketch", validate=True).collect()
    assert as_sketch_column(built, "sketch", validate=True).count() == built.count()
