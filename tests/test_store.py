import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tuplecohort import (Metric, as_sketch_column, merge_sketches, read_sketches, sketch_estimate,
                         tuple_sketch, write_sketches)
from tuplecohort.session import scratch_path


def test_roundtrip_partitioned(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    daily = tuple_sketch(ev, "user_id", [Metric("value")],
                         by=["event_type", F.to_date("ts").alias("day")], k=64)
    path = scratch_path(spark, "store-test")
    write_sketches(daily, path, partition_by=["day"])
    back = read_sketches(spark, path)
    a = merge_sketches(daily, by="event_type", num_values=1, k=64) \
        .select("event_type", sketch_estimate("sketch").alias("e")).orderBy("event_type").collect()
    b = merge_sketches(back, by="event_type", num_values=1, k=64) \
        .select("event_type", sketch_estimate("sketch").alias("e")).orderBy("event_type").collect()
    assert a == b


def test_schema_check_rejects_other_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, sketch string")
    with pytest.raises(TypeError):
        as_sketch_column(df, "sketch")
    with pytest.raises(ValueError):
        as_sketch_column(df, "missing")
    with pytest.raises(TypeError):
        write_sketches(df, "/nonexistent", sketch="sketch")
