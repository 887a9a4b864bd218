"""Merge / combine / filter laws over randomized splits of real tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tuplecohort import (Metric, combine_sketches, filter_tuples, merge_sketches, sketch_estimate,
                         tuple_sketch)


def canon(df, col="sketch", by=("event_type",)):
    """Comparable form: per group (theta, sorted entries rounded)."""
    out = {}
    for r in df.collect():
        s = r[col]
        key = tuple(r[b] for b in by)
        out[key] = (s["theta"], [(e["h"], [round(v, 6) for v in e["values"]]) for e in s["entries"]])
    return out


def metrics():
    return [Metric("value"), Metric(F.lit(1.0), F.col("event_type") == "view")]


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_MID}/events.parquet")


@pytest.mark.parametrize("k,parts", [(16, 2), (64, 3), (1024, 4)])
def test_merge_of_parts_equals_build_of_all(events, k, parts):
    whole = tuple_sketch(events, "user_id", metrics(), by="event_type", k=k)
    split = events.withColumn("part", F.abs(F.xxhash64("event_id", F.lit(k))) % parts)
    pieces = tuple_sketch(split, "user_id", metrics(), by=["event_type", "part"], k=k)
    merged = merge_sketches(pieces, "sketch", by="event_type", k=k, num_values=2)
    assert canon(merged) == canon(whole)


def test_merge_of_pieces_equals_the_whole(events):
    pieces = tuple_sketch(events, "user_id", metrics(), by=["event_type", F.to_date("ts")
                                                            .alias("day")], k=64)
    merged = merge_sketches(pieces, "sketch", by="event_type", k=64, num_values=2)
    whole = tuple_sketch(events, "user_id", metrics(), by="event_type", k=64)
    assert canon(merged) == canon(whole)


def test_merge_rolls_up_to_ungrouped(events):
    pieces = tuple_sketch(events, "user_id", metrics(), by="event_type", k=64)
    merged = merge_sketches(pieces, "sketch", k=64, num_values=2)
    whole = tuple_sketch(events, "user_id", metrics(), k=64)
    assert canon(merged, by=()) == canon(whole, by=())


def test_combine_commutative_and_associative(events):
    parts = events.withColumn("p", F.col("event_id") % 3)
    sk = {i: tuple_sketch(parts.where(F.col("p") == i), "user_id", metrics(), by="event_type",
                          k=64, out=f"s{i}") for i in range(3)}
    j = sk[0].join(sk[1], "event_type", "full_outer").join(sk[2], "event_type", "full_outer")
    r = j.select("event_type",
                 combine_sketches("s0", "s1", k=64).alias("ab"),
                 combine_sketches("s1", "s0", k=64).alias("ba"),
                 combine_sketches(combine_sketches("s0", "s1", k=64), "s2", k=64).alias("ab_c"),
                 combine_sketches("s0", combine_sketches("s1", "s2", k=64), k=64).alias("a_bc"))
    assert canon(r, "ab") == canon(r, "ba")
    assert canon(r, "ab_c") == canon(r, "a_bc")
    whole = tuple_sketch(events, "user_id", metrics(), by="event_type", k=64)
    assert canon(r, "ab_c") == canon(whole)


def test_filter_composition(events):
    sk = tuple_sketch(events, "user_id", metrics(), by="event_type", k=64)
    twice = sk.withColumn("f1", filter_tuples("sketch", "$0 > 100")) \
              .withColumn("f2", filter_tuples("f1", "$1 >= 2"))
    once = sk.withColumn("f", filter_tuples("sketch", "$0 > 100 && $1 >= 2"))
    assert canon(twice, "f2") == canon(once, "f")


def test_filter_does_not_commute_with_merge_when_keys_straddle(spark):
    # Key "a" has 1 in each part: each part fails "$0 >= 2", the merged tuple passes.
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 1.0, 1)], "k string, m double, part int")
    parts = tuple_sketch(df, "k", [Metric("m")], by="part")
    filtered_then_merged = merge_sketches(
        parts.withColumn("sketch", filter_tuples("sketch", "$0 >= 2")), "sketch", num_values=1)
    merged_then_filtered = merge_sketches(parts, "sketch", num_values=1) \
        .withColumn("sketch", filter_tuples("sketch", "$0 >= 2"))
    assert filtered_then_merged.select(sketch_estimate("sketch")).first()[0] == 0.0
    assert merged_then_filtered.select(sketch_estimate("sketch")).first()[0] == 1.0


def test_merge_width_mismatch_raises(spark):
    a = tuple_sketch(spark.createDataFrame([("a", 1.0)], "k string, m double"), "k",
                     [Metric("m")])
    b = tuple_sketch(spark.createDataFrame([("b", 1.0, 2.0)], "k string, m double, n double"),
                     "k", [Metric("m"), Metric("n")])
    with pytest.raises(Exception, match="num_values"):
        merge_sketches(a.unionByName(b), "sketch", num_values=1).collect()


def test_merge_hash_kind_mismatch_raises(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, m double")
    a = tuple_sketch(df, "k", [Metric("m")], hash="md5")
    b = tuple_sketch(df, "k", [Metric("m")], hash="xxhash64")
    with pytest.raises(Exception, match="hash"):
        merge_sketches(a.unionByName(b), "sketch", num_values=1).collect()


def test_presample_equals_one_pass(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    ms = [Metric("l_quantity")]
    for by in (None, "l_returnflag"):
        a = tuple_sketch(li, "l_orderkey", ms, by=by, k=256)
        b = tuple_sketch(li, "l_orderkey", ms, by=by, k=256, presample=True)
        keys = () if by is None else (by,)
        assert canon(a, by=keys) == canon(b, by=keys)


@pytest.mark.parametrize("by", [None, "l_returnflag"])
def test_two_level_limit_same_result(spark, by):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    ms = [Metric("l_quantity"), Metric("l_extendedprice", F.col("l_discount") > 0.05)]
    keys = () if by is None else (by,)
    one = tuple_sketch(li, "l_orderkey", ms, by=by, k=256, fanout=1)
    two = tuple_sketch(li, "l_orderkey", ms, by=by, k=256, fanout=3)
    assert canon(one, by=keys) == canon(two, by=keys)
    m1 = merge_sketches(two, by=by, k=64, num_values=2, fanout=1)
    m2 = merge_sketches(two, by=by, k=64, num_values=2, fanout=5)
    assert canon(m1, by=keys) == canon(m2, by=keys)
