"""One test per null / empty / default rule (N1..N15)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tuplecohort import (THETA_MAX, Metric, collapse_tuples, combine_sketches, empty_sketch,
                         filter_tuples, merge_sketches, sketch_entries, sketch_estimate,
                         tuple_rollup, tuple_sketch)

F1_SCHEMA = "sketchDim string, filterDim string, value double"


def f1_metrics():
    return [Metric("value", F.col("filterDim") == v) for v in ("f_1", "f_2", "f_3")]


def rollup_dict(df, key, metrics, **kw):
    return {r["key"]: r["values"] for r in tuple_rollup(df, key, metrics, **kw).collect()}


def test_n1_null_metric_drops_whole_row(spark):
    df = spark.createDataFrame([("x", "p", 1.0, None), ("x", "p", 2.0, 5.0)],
                               "k string, f string, m1 double, m2 double")
    ms = [Metric("m1", F.col("f") == "p"), Metric("m2", F.col("f") == "q")]
    assert rollup_dict(df, "k", ms) == {"x": [2.0, 0.0]}


def test_n2_no_match_still_inserts_key(spark):
    df = spark.createDataFrame([("z", "f_9", 7.0)], F1_SCHEMA)
    assert rollup_dict(df, "sketchDim", f1_metrics()) == {"z": [0.0, 0.0, 0.0]}
    sk = tuple_sketch(df, "sketchDim", f1_metrics())
    assert sk.select(sketch_estimate("sketch")).first()[0] == 1.0


def test_n3_null_predicate_is_no_match(spark):
    df = spark.createDataFrame([("y", None, 3.0)], F1_SCHEMA)
    assert rollup_dict(df, "sketchDim", f1_metrics()) == {"y": [0.0, 0.0, 0.0]}


def test_n4_null_and_empty_key_ignored(spark):
    df = spark.createDataFrame([(None, "f_1", 1.0), ("", "f_1", 1.0)], F1_SCHEMA)
    assert rollup_dict(df, "sketchDim", f1_metrics()) == {}
    sk = tuple_sketch(df, "sketchDim", f1_metrics())
    # The group exists (it has rows) but holds no key.
    assert sk.select(sketch_estimate("sketch")).collect()[0][0] == 0.0


def test_n5_multi_valued_key(spark):
    df = spark.createDataFrame([(["a", "a", "b"], 2.0), ([], 9.0), (None, 4.0)],
                               "k array<string>, m double")
    assert rollup_dict(df, "k", [Metric("m")]) == {"a": [4.0], "b": [2.0]}
    sk = tuple_sketch(df, "k", [Metric("m")])
    vals = sorted(r["values"][0] for r in sketch_entries(sk).collect())
    assert vals == [2.0, 4.0]


def test_n6_missing_key_column(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, m double")
    with pytest.raises((ValueError, AnalysisException)):
        tuple_sketch(df, "nope", [Metric("m")], by="g")
    sk = tuple_sketch(df, "nope", [Metric("m")], by="g", missing_ok=True)
    row = sk.first()
    assert row["sketch"]["entries"] == [] and row["sketch"]["num_values"] == 1


def _one_sketch(spark, keys, k=1024, values=None):
    rows = [(kk, float(values[i] if values else 1.0)) for i, kk in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, m double")
    return tuple_sketch(df, "k", [Metric("m")], k=k)


def test_n7_merge_skips_null_sketches(spark):
    sk = _one_sketch(spark, ["a", "b"])
    nul = sk.select(F.lit(None).cast(sk.schema["sketch"].dataType).alias("sketch"))
    merged = merge_sketches(sk.unionByName(nul), "sketch", num_values=1, k=1024)
    assert merged.select(sketch_estimate("sketch")).first()[0] == 2.0


def test_n8_combine_two_nulls_is_empty(spark):
    sk = _one_sketch(spark, ["a"])
    t = sk.schema["sketch"].dataType
    row = spark.range(1).select(combine_sketches(F.lit(None).cast(t), F.lit(None).cast(t))
                                .alias("c")).first()["c"]
    assert row is not None and row["entries"] == [] and row["theta"] == THETA_MAX


def test_n9_n10_null_sketch_propagates(spark):
    sk = _one_sketch(spark, ["a"])
    t = sk.schema["sketch"].dataType
    df = spark.range(1).select(F.lit(None).cast(t).alias("s"))
    row = df.select(sketch_estimate("s").alias("e"), filter_tuples("s", "$0 > 0").alias("f"),
                    collapse_tuples("s", "$0").alias("c")).first()
    assert row["e"] is None and row["f"] is None and row["c"] is None


def test_n11_zero_survivors_resets_theta(spark):
    keys = [f"u{i}" for i in range(500)]
    sk = _one_sketch(spark, keys, k=16)
    assert sk.first()["sketch"]["theta"] < THETA_MAX
    f = sk.select(filter_tuples("sketch", "$0 < 0").alias("f")).first()["f"]
    assert f["entries"] == [] and f["theta"] == THETA_MAX and f["num_values"] == 1


def test_n12_sampled_filter_keeps_theta(spark):
    keys = [f"u{i}" for i in range(10000)]
    sk = _one_sketch(spark, keys, k=64, values=[i % 2 for i in range(10000)])
    s = sk.first()["sketch"]
    f = sk.select(filter_tuples("sketch", "$0 > 0").alias("f")).first()["f"]
    assert f["theta"] == s["theta"] < THETA_MAX
    est = sk.select(sketch_estimate(filter_tuples("sketch", "$0 > 0"))).first()[0]
    assert est == pytest.approx(len(f["entries"]) / (s["theta"] / THETA_MAX))


def test_n13_n14_out_of_range_slot_collapses_to_zero(spark):
    sk = _one_sketch(spark, ["a", "b", "c"])
    c = sk.select(collapse_tuples("sketch", "$9").alias("c")).first()["c"]
    assert [e["values"] for e in c["entries"]] == [[0.0], [0.0], [0.0]]
    # Out-of-range slot in a filter: null -> not kept.
    assert sk.select(sketch_estimate(filter_tuples("sketch", "$9 > 0"))).first()[0] == 0.0


def test_n15_numeric_predicate_is_truthy_when_positive(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "k string, m double")
    sk = tuple_sketch(df, "k", [Metric("m")])
    assert sk.select(sketch_estimate(filter_tuples("sketch", "$0 - 1"))).first()[0] == 2.0


def test_empty_sketch_literal(spark):
    row = spark.range(1).select(empty_sketch(3).alias("e"), sketch_estimate(empty_sketch(3))
                                .alias("x")).first()
    assert row["e"]["num_values"] == 3 and row["x"] == 0.0


def test_n7_group_of_only_null_sketches_gets_an_empty_sketch(spark):
    sk = _one_sketch(spark, ["a", "b"]).withColumn("g", F.lit("x"))
    t = sk.schema["sketch"].dataType
    nul = spark.range(2).select(F.lit("y").alias("g"), F.lit(None).cast(t).alias("sketch"))
    merged = merge_sketches(sk.select("g", "sketch").unionByName(nul), "sketch", by="g",
                            num_values=1, k=1024)
    got = {r["g"]: (r["e"], r["s"]["theta"], r["s"]["hash"], r["s"]["entries"])
           for r in merged.select("g", sketch_estimate("sketch").alias("e"),
                                  F.col("sketch").alias("s")).collect()}
    assert got["x"][0] == 2.0
    assert got["y"] == (0.0, THETA_MAX, "md5", [])


def test_n8_combine_with_one_null_side_is_the_other(spark):
    sk = _one_sketch(spark, ["a", "b", "c"])
    t = sk.schema["sketch"].dataType
    row = sk.select(F.col("sketch").alias("s"),
                    combine_sketches("sketch", F.lit(None).cast(t)).alias("l"),
                    combine_sketches(F.lit(None).cast(t), "sketch").alias("r")).first()
    for side in ("l", "r"):
        assert row[side]["entries"] == row["s"]["entries"]
        assert row[side]["theta"] == row["s"]["theta"] and row[side]["hash"] == row["s"]["hash"]
