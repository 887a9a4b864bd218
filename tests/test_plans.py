"""Physical-plan shape: what must (not) be in the plan."""

from pyspark.sql import functions as F

from conftest import SF_MID, explain
from tuplecohort import (Metric, collapse_tuples, filter_tuples, merge_sketches, read_sketches,
                         sketch_estimate, tuple_sketch, write_sketches)
from tuplecohort.plans.queries import QUERIES
from tuplecohort.session import scratch_path


def _events(spark):
    return spark.read.parquet(f"{SF_MID}/events.parquet")


def test_build_has_partial_group_limit_and_two_exchanges(spark):
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")], by="event_type", k=4096)
    plan = explain(sk)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    phys = plan.split("\n\n")[0]
    assert phys.count("Exchange") == 2
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_ungrouped_build_is_bounded_too(spark):
    # Without group columns Spark plans the bottom-k as a top-k
    # (TakeOrderedAndProject): per-task top k+2, then one bounded merge.
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")], k=1024)
    plan = explain(sk)
    assert "TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan


def test_scan_prunes_columns(spark):
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value", F.col("event_type") == "view")],
                      by="event_type")
    plan = explain(sk)
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_transforms_add_no_exchange(spark):
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")], by="event_type", k=64)
    path = scratch_path(spark, "plan-test")
    write_sketches(sk, path)
    stored = read_sketches(spark, path)
    t = stored.withColumn("f", filter_tuples("sketch", "$0 > 10")) \
        .withColumn("c", collapse_tuples("f", "$0 * 2")) \
        .select("event_type", sketch_estimate("c").alias("e"))
    plan = explain(t)
    assert "Exchange" not in plan


def test_estimate_reads_only_hash_leaf(spark):
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")], by="event_type", k=64)
    path = scratch_path(spark, "prune-test")
    write_sketches(sk, path)
    e = read_sketches(spark, path).select(sketch_estimate("sketch"))
    plan = explain(e)
    read_schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "values" not in read_schema and "h:bigint" in read_schema


def test_merge_plan_has_group_limit(spark):
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")],
                      by=["event_type", F.to_date("ts").alias("day")], k=64)
    m = merge_sketches(sk, "sketch", by="event_type", k=64, num_values=1)
    plan = explain(m)
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_udf_anywhere(spark):
    for name, fn in QUERIES.items():
        if name == "store_roundtrip":
            continue
        plan = explain(fn(spark, SF_MID), "simple")
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                    "CartesianProduct"):
            assert bad not in plan, (name, bad)


def test_large_partition_counts_plan_a_two_level_limit(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4096")
        sk = tuple_sketch(_events(spark), "user_id", [Metric("value")], by="event_type", k=1024)
        plan = explain(sk, "simple")  # plan only; nothing runs with 4096 partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    import re
    assert re.search(r"hashpartitioning\(event_type#\d+, __tc_b#\d+, 4096\)", plan)
    assert plan.count("WindowGroupLimit") == 4  # partial + final at both levels
    formatted = None
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4096")
        formatted = explain(tuple_sketch(_events(spark), "user_id", [Metric("value")],
                                         by="event_type", k=1024))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    # 4096 partitions * 1026 rows over 2,000,000 rows a task
    assert "pmod(SPARK_PARTITION_ID(), 3)" in formatted


def test_stored_sketches_prune_partitions(spark):
    import datetime
    sk = tuple_sketch(_events(spark), "user_id", [Metric("value")],
                      by=["event_type", F.to_date("ts").alias("day")], k=64)
    path = scratch_path(spark, "prune-days")
    write_sketches(sk, path, partition_by=["day"])
    week = read_sketches(spark, path).where(
        F.col("day").between(datetime.date(2024, 1, 8), datetime.date(2024, 1, 14)))
    m = merge_sketches(week, "sketch", by="event_type", k=64, num_values=1)
    plan = explain(m)
    scan = [ln for ln in plan.splitlines() if "PartitionFilters" in ln][0]
    assert "day" in scan and "2024-01-08" in scan


def test_exact_rollup_pushes_key_filter_to_parquet(spark):
    from tuplecohort import tuple_rollup
    r = tuple_rollup(_events(spark), "user_id", [Metric("value")], by="event_type")
    plan = explain(r)
    assert "PushedFilters: [IsNotNull(value), IsNotNull(user_id)]" in plan \
        or "PushedFilters: [IsNotNull(user_id), IsNotNull(value)]" in plan


def test_presample_count_pass_reads_group_key_and_metrics(spark):
    from tuplecohort.operators.build import _presample_thresholds
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    t = _presample_thresholds(li, ["l_returnflag"], "l_orderkey", [Metric("l_quantity")], 64)
    assert t.count() == 3
    # Keys without complete metrics do not count, so the metric's nulls have to be read.
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in explain(t)
    few = _presample_thresholds(li, ["l_returnflag"], "l_orderkey", [Metric("l_quantity")], 65536)
    assert few.count() == 0   # no threshold for groups that a sketch holds whole
