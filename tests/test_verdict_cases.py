"""Cases beyond the registered inputs: checks that plans cannot prune, restarts, names, time zones, sizes."""

import pytest
from pyspark.sql import functions as F

from tuplecohort import (Metric, cohort_exact, combine_sketches, filter_tuples, merge_sketches, sketch_estimate,
                         sketch_retained, sketch_slot_sum, transform_chain, tuple_sketch)
from tuplecohort.operators.bottomk import TASK_ROWS, auto_fanout
from tuplecohort.session import scratch_path
from tuplecohort.streaming import compact_sketches, read_stream_sketches, stream_sketches


def one(spark, n=100, **kw):
    return tuple_sketch(spark.range(n), "id", [Metric(F.lit(1.0))] * kw.pop("width", 1), k=64, **kw)


@pytest.mark.parametrize("other", [{"hash": "xxhash64"}, {"width": 2}])
@pytest.mark.parametrize("read", [sketch_estimate, lambda s: F.col(s)["hash"], lambda s: F.col(s)["num_values"],
                                  sketch_retained, lambda s: F.col(s)["theta"]])
def test_combine_mismatch_is_seen_by_every_reader(spark, other, read):
    two = one(spark, out="a").crossJoin(one(spark, out="b", **other)).withColumn("c", combine_sketches("a", "b"))
    with pytest.raises(Exception, match="cannot combine"):
        two.select(read("c")).collect()


def test_presample_counts_kept_keys_only(spark):
    df = spark.range(20_000).withColumn("m", F.when(F.col("id") % 20 == 0, 1.0))
    a = tuple_sketch(df, "id", [Metric("m")], k=64).first().sketch
    b = tuple_sketch(df, "id", [Metric("m")], k=64, presample=True).first().sketch
    assert a == b and len(a.entries) == 64


def jobs_of(spark, group, make):
    spark.sparkContext.setJobGroup(group, group)
    make()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_building_runs_no_job(spark):
    df = spark.range(1000)
    assert jobs_of(spark, "presample", lambda: tuple_sketch(df, "id", [Metric(F.lit(1.0))], k=64, presample=True)) == 0
    sk = one(spark)
    assert jobs_of(spark, "merge", lambda: merge_sketches(sk)) == 0


def test_merge_sizes_come_from_parameters(spark):
    small, large = one(spark, 5000), tuple_sketch(spark.range(5000), "id", [Metric(F.lit(1.0))], k=1024)
    for u in (small.union(large), large.union(small)):
        assert merge_sketches(u, k=1024).first().sketch.k == 1024
        assert merge_sketches(u).first().sketch.k == 4096
    with pytest.raises(Exception, match="expected num_values=1"):
        merge_sketches(one(spark, width=2)).collect()


def test_missing_sketch_column(spark):
    df = spark.range(3).withColumn("g", F.lit("x"))
    with pytest.raises(ValueError, match="not found"):
        merge_sketches(df, "nope", by="g")
    row = merge_sketches(df, "nope", by="g", missing_ok=True, num_values=2).first()
    assert row.nope.num_values == 2 and row.nope.entries == []


@pytest.mark.parametrize("key", ["K", "k", "s.a", "S.A", "`k`"])
def test_key_names_are_resolved_by_spark(spark, key):
    df = spark.range(100).select(F.col("id").alias("k"), F.struct(F.col("id").alias("a")).alias("s"))
    for ok in (True, False):
        assert tuple_sketch(df, key, [Metric(F.lit(1.0))], missing_ok=ok).select(sketch_estimate("sketch")).first()[0] == 100


def test_timestamp_keys_hash_alike_in_every_zone(spark):
    df = spark.range(50).select((F.col("id") * 3600 * 24 * 5).cast("timestamp").alias("t"))
    zone, found = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for z in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", z)
            found.append(tuple_sketch(df, "t", [Metric(F.lit(1.0))]).first().sketch)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1]


def test_restart_and_snapshot(spark):
    src, path = scratch_path(spark, "src"), scratch_path(spark, "sk")
    for i in range(3):
        spark.range(i * 50, i * 50 + 100).coalesce(1).write.mode("append").parquet(src)
    m = [Metric(F.lit(1.0))]

    def start(files):
        s = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", files).parquet(src)
        stream_sketches(s, path, "id", m, trigger={"availableNow": True}).awaitTermination()

    def total(df):
        return df.select(sketch_slot_sum("sketch", 0)).first()[0]

    start(1)
    start(2)    # another batching: nothing is read again
    assert total(read_stream_sketches(spark, path)) == 300
    snap = scratch_path(spark, "snap")
    compact_sketches(spark, path, snap)
    spark.range(500, 510).coalesce(1).write.mode("append").parquet(src)
    start(1)
    assert total(read_stream_sketches(spark, path, snapshot=snap)) == 310
    snap2 = scratch_path(spark, "snap")
    compact_sketches(spark, path, snap2, snapshot=snap)
    assert total(read_stream_sketches(spark, path, snapshot=snap2)) == 310


def tuples(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [float("nan"), 1.0]), ("d", [3.0, 4.0])]
    df = spark.createDataFrame(rows, "k string, v array<double>")
    return tuple_sketch(df, "k", [Metric(F.col("v")[0]), Metric(F.col("v")[1])])


@pytest.mark.parametrize("expr,n", [("$0 && $1", 1), ("!$0", 2), ("$0 || $1", 4), ("$0 - 1", 1), ("$0", 2), ("!($0 && $1)", 3),
                                    ("$0 / $1 > 0.5", 2), ("$0 / $1", 1), ("`a$1` > 0 && $1", 3), ("$0 != 1", 3),
                                    ("'x$0' = 'x$0' && '\\'' = '\\'' && $1 > 1", 2)])
def test_expressions(spark, expr, n):
    df = tuples(spark).withColumn("a$1", F.lit(1))
    assert df.select(sketch_retained(filter_tuples("sketch", expr))).first()[0] == n


def test_chain_keeps_user_columns(spark):
    df = tuples(spark).withColumn("_step0", F.lit("mine"))
    out = transform_chain(df, "sketch", [("filter", "$1 > 0"), ("collapse", "$0 + $1"), ("filter", "$0 > 2")])
    assert out.columns == df.columns and out.first()["_step0"] == "mine"


def test_exact_cohort_keeps_groups_without_keys(spark):
    df = spark.createDataFrame([("x", "k", 1.0), ("y", None, 1.0), ("z", "k", None)], "g string, k string, m double")
    got = cohort_exact(df, "k", [Metric("m")], "$0 > 0", by="g")
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 0), ("z", 0)]


def test_fanout_follows_the_rows_of_the_last_task(spark):
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert auto_fanout(spark, 64) == 1
    assert auto_fanout(spark, TASK_ROWS) > 1 and auto_fanout(spark, 1 << 40) <= p
