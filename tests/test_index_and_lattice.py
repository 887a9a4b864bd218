"""Dyadic index, lattice of groupings and certain top groups against direct merges and builds."""

import datetime
import math
import random
import re
from itertools import combinations

import pytest
from conftest import explain
from pyspark.sql import functions as F

from tuplecohort.functions.metrics import Metric
from tuplecohort.operators.build import tuple_sketch
from tuplecohort.operators.lattice import cube_sketches, grouping_sketches, rollup_sketches
from tuplecohort.operators.merge import merge_sketches
from tuplecohort.operators.top import group_bounds, top_groups
from tuplecohort.functions.sketch import sketch_estimate
from tuplecohort.session import scratch_path
from tuplecohort.sources.dyadic import day_number, range_cover, write_dyadic
from tuplecohort.sources.store import read_sketches, stream_table, write_sketches


def values(df, cols):
    return sorted(((tuple(r[c] for c in cols), r["sketch"]["theta"], [(e["h"], [round(v, 6) for v in e["values"]])
                                                                     for e in r["sketch"]["entries"]]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_cover_is_whole_disjoint_and_short(seed):
    rng = random.Random(seed)
    for _ in range(200):
        first = rng.randint(-400, 20_000)
        n = rng.randint(0, 800)
        cover = range_cover(first, first + n - 1)
        days = [d for level, block in cover for d in range(block << level, (block + 1) << level)]
        assert days == list(range(first, first + n))
        assert len(cover) <= max(2 * math.log2(n) + 2 if n else 0, n == 1)
        capped = range_cover(first, first + n - 1, 2)
        assert all(v <= 2 for v, _ in capped) and sum(1 << v for v, _ in capped) == n


@pytest.fixture(scope="module")
def daily(spark):
    rng = random.Random(6)
    start = datetime.date(1969, 12, 20)
    rows = [(rng.choice(["a", "b", None]), start + datetime.timedelta(days=rng.choice([*range(30), 37])), str(rng.randrange(300)),
             float(rng.randrange(9))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, day date, k string, v double")
    return tuple_sketch(df, "k", [Metric("v")], by=["g", "day"], k=16)


def test_dyadic_ranges_equal_merges_of_days(spark, daily):
    index = write_dyadic(daily, scratch_path(spark, "dy"), by=["g"], k=16)
    day0 = datetime.date(1969, 12, 20)
    for a, b in ((0, 37), (3, 3), (5, 28), (31, 36), (9, 4)):
        first, last = day0 + datetime.timedelta(days=a), day0 + datetime.timedelta(days=b)
        want = merge_sketches(daily.where(F.col("day").between(first, last)), "sketch", by="g", k=16)
        parts = index.parts(first, last)
        assert values(index.merged(first, last), ["g"]) == values(want, ["g"])
        folders = {re.sub(r"/[^/]*$", "", r[0]) for r in parts.select(F.input_file_name()).distinct().collect()}
        n = max(1, b - a + 1)
        assert len(folders) <= 2 * math.log2(n) + 2
    assert index.top == 5 and day_number(datetime.date(1969, 12, 31)) == -1
    assert "PartitionFilters: [" in explain(index.parts(day0, day0))


def test_dyadic_of_nothing(spark, daily):
    index = write_dyadic(daily.limit(0), scratch_path(spark, "dy"), by=["g"], k=16)
    assert index.merged(datetime.date(2020, 1, 1), datetime.date(2020, 2, 1)).collect() == []
    nulls = daily.withColumn("day", F.lit(None).cast("date"))
    assert write_dyadic(nulls, scratch_path(spark, "dy"), by=["g"], k=16).top == 0


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]), rng.random() < 0.5, str(rng.randrange(200)),
             float(rng.randrange(5))) for _ in range(3000)]
    return spark.createDataFrame(rows, "a string, b int, c boolean, k string, v double")


def test_cube_equals_direct_builds(spark, facts):
    names = ["a", "b", "c"]
    got = cube_sketches(facts, "k", [Metric("v")], names, k=16)
    assert got.columns == [*names, "grouping_id", "sketch"]
    for r in range(4):
        for by in combinations(names, r):
            bits = sum(1 << (2 - i) for i, n in enumerate(names) if n not in by)
            want = tuple_sketch(facts, "k", [Metric("v")], by=list(by), k=16)
            assert values(got.where(F.col("grouping_id") == bits), by) == values(want, by)
    assert got.select("grouping_id").distinct().count() == 8


def test_lattice_merges_stored_sketches(spark, facts):
    got = rollup_sketches(facts, "k", [Metric("v")], ["a", F.col("b").alias("bb")], k=16)
    assert {r[0] for r in got.select("grouping_id").distinct().collect()} == {0, 1, 3}
    assert "lattice-" in explain(got) and "__tc" not in explain(got)     # what is returned reads written results only
    one = grouping_sketches(facts, "k", [Metric("v")], ["a", "b"], [["b"], ["b"]], k=16)
    assert values(one, ["b"]) == values(tuple_sketch(facts, "k", [Metric("v")], by="b", k=16), ["b"])
    for sets in ([], [["z"]]):
        with pytest.raises(ValueError):
            grouping_sketches(facts, "k", [Metric("v")], ["a", "b"], sets)


@pytest.mark.parametrize("seed", range(2))
def test_top_groups_equal_the_full_order(spark, seed):
    rng = random.Random(seed)
    rows = [(g, p, str(rng.randrange(5000)), 1.0) for g in [*range(25), None] for p in range(3)
            for _ in range(rng.choice([0, 1, 2, 3, 10, 40, 200]))]
    df = spark.createDataFrame(rows, "g int, p int, k string, v double")
    parts = tuple_sketch(df, "k", [Metric("v")], by=["g", "p"], k=16).unionByName(
        tuple_sketch(df.where("p = 0"), "k", [Metric("v")], by=["g", "p"], k=16).select(
            F.lit(99).alias("g"), "p", F.when(F.lit(False), F.col("sketch")).alias("sketch")))
    merged = merge_sketches(parts, "sketch", by="g", k=16).withColumn("e", sketch_estimate("sketch"))
    bounds = {r["g"]: r for r in group_bounds(parts, "sketch", ["g"], 16).collect()}
    for r in merged.collect():
        b = bounds[r["g"]]
        assert b["__tc_lower"] <= r["e"] * (1 + 1e-12) and (b["__tc_upper"] is None or b["__tc_upper"] >= r["e"] * (1 - 1e-12))
    want = [(r["g"], r["e"]) for r in merged.orderBy(F.col("e").desc(), F.col("g").asc()).collect()]
    for n in (5, 100):
        got = top_groups(parts, n, by="g", k=16)
        assert [(r["g"], r["est_keys"]) for r in got.collect()] == want[:n]


def test_top_groups_merge_fewer_entries(spark):
    # 200 small groups and 5 large ones: only the large ones are merged.
    df = spark.range(0, 20_000).select((F.col("id") % 205).alias("g"), F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("p"))
    df = df.where((F.col("g") < 5) | (F.col("k").cast("int") < 3000))
    parts = tuple_sketch(df, "k", [Metric(F.lit(1.0))], by=["g", "p"], k=1024)
    path = scratch_path(spark, "parts")
    write_sketches(parts, path)
    stored = read_sketches(spark, path)
    bounds = group_bounds(stored, "sketch", ["g"], 1024)
    floor = bounds.orderBy(F.desc("__tc_lower")).limit(5).agg(F.min("__tc_lower")).first()[0]
    assert bounds.where(F.col("__tc_upper") >= floor).count() == 5
    assert "values" not in re.findall(r"ReadSchema: (.*)", explain(bounds))[0]     # tuples are not read for the bounds
    assert [r["g"] for r in top_groups(stored, 5, by="g", k=1024).collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        top_groups(stored, 5)


@pytest.mark.parametrize("as_folder", [True, False])
def test_streams_read_tables_of_one_file_and_of_many(spark, tmp_path, as_folder):
    path = f"{tmp_path}/events.parquet"
    if as_folder:
        spark.range(100).repartition(3).write.parquet(path)
    else:
        spark.range(100).toPandas().to_parquet(path)
        spark.range(7).toPandas().to_parquet(f"{tmp_path}/other.parquet")
    out = f"{tmp_path}/out"
    stream_table(spark, path).writeStream.option("checkpointLocation", out + "-c").trigger(availableNow=True) \
        .format("parquet").start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 100
