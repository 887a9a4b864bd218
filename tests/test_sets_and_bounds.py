"""Set operations, bounds and bounded partial results: brute force, null rules, coverage, equality."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tuplecohort.functions.hashing import THETA_MAX
from tuplecohort.functions.metrics import Metric
from tuplecohort.functions.sketch import (a_not_b, intersect_sketches, sketch_bounds, sketch_estimate, sketch_mean,
                                          sketch_sum, sketch_sum_bounds, sketch_valid)
from tuplecohort.operators import build as build_module
from tuplecohort.operators import partials
from tuplecohort.operators.build import tuple_sketch
from tuplecohort.operators.sets import intersect_groups

SKETCH = "struct<theta: bigint, k: int, num_values: int, hash: string, entries: array<struct<h: bigint, values: array<double>>>>"


def sketch(theta, entries, k=16, width=1, kind="md5"):
    return (theta, k, width, kind, sorted((h, [float(v)] * width) for h, v in entries.items()))


def pair(spark, a, b):
    return spark.createDataFrame([(a, b)], f"a {SKETCH}, b {SKETCH}")


def plain(s):
    return (s["theta"], {e["h"]: list(e["values"]) for e in s["entries"]})


@pytest.mark.parametrize("seed", range(5))
def test_sets_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    ta, tb = (rng.choice([THETA_MAX, 500, 900]) for _ in range(2))
    a, b = ({h: rng.randint(1, 9) for h in rng.sample(range(min(t, 1000)), 15)} for t in (ta, tb))
    t = min(ta, tb)
    row = pair(spark, sketch(ta, a), sketch(tb, b)).select(
        intersect_sketches("a", "b").alias("i"), intersect_sketches("a", "b", "concat").alias("c"),
        intersect_sketches("a", "b", "left").alias("l"), a_not_b("a", "b").alias("d"), a_not_b("b", "a").alias("e"))
    valid = row.select(*[sketch_valid(c).alias(c) for c in "icld"]).first()
    r = row.first()
    both = {h for h in a if h in b and h < t}
    assert plain(r["i"]) == (t, {h: [a[h] + b[h]] for h in both})
    assert plain(r["c"]) == (t, {h: [a[h], b[h]] for h in both}) and r["c"]["num_values"] == 2
    assert plain(r["l"]) == (t, {h: [a[h]] for h in both})
    assert plain(r["d"]) == (t, {h: [a[h]] for h in a if h not in b and h < t})
    assert plain(r["e"]) == (t, {h: [b[h]] for h in b if h not in a and h < t})
    assert all(valid)


def test_sets_with_null_sides(spark):
    s = sketch(900, {5: 1, 7: 2})
    r = pair(spark, s, None).select(intersect_sketches("a", "b").alias("i"), a_not_b("a", "b").alias("d"),
                                    a_not_b("b", "a").alias("e"), intersect_sketches("b", "b").alias("n")).first()
    assert plain(r["i"]) == (900, {}) and plain(r["d"]) == (900, {5: [1.0], 7: [2.0]})
    assert plain(r["e"]) == (900, {}) and plain(r["n"]) == (THETA_MAX, {}) and r["n"]["num_values"] == 1


def test_sets_check_widths_and_kinds(spark):
    one, two, other = sketch(900, {5: 1}), sketch(900, {5: 1}, width=2), sketch(900, {5: 1}, kind="xxhash64")
    for expr, b in ((intersect_sketches("a", "b"), two), (intersect_sketches("a", "b"), other), (a_not_b("a", "b"), other)):
        for field in ("theta", "num_values", "entries"):
            with pytest.raises(Exception, match="cannot (intersect|subtract)"):
                pair(spark, one, b).select(expr[field]).collect()
    assert pair(spark, one, two).select(a_not_b("a", "b").alias("d")).first()["d"]["num_values"] == 1
    with pytest.raises(ValueError):
        intersect_sketches("a", "b", "product")


def test_intersect_groups(spark):
    rows = [("x", sketch(900, {5: 1, 7: 2, 800: 1})), ("x", sketch(700, {7: 3, 5: 1})), ("y", sketch(900, {5: 1})), ("y", None),
            ("z", sketch(900, {1: 1, 2: 2})), (None, sketch(THETA_MAX, {9: 4}))]
    df = spark.createDataFrame(rows, f"g string, sketch {SKETCH}")
    got = {r["g"]: plain(r["s"]) for r in intersect_groups(df, "sketch", by="g", k=16, out="s").collect()}
    assert got == {"x": (700, {5: [2.0], 7: [5.0]}), "y": (900, {}), "z": (900, {1: [1.0], 2: [2.0]}), None: (THETA_MAX, {9: [4.0]})}
    every = intersect_groups(df.filter("g in ('x', 'z')"), "sketch", k=16, out="s").collect()
    assert [plain(r["s"]) for r in every] == [(700, {})]
    mixed = spark.createDataFrame([("x", sketch(9, {})), ("x", sketch(9, {}, kind="xxhash64"))], f"g string, sketch {SKETCH}")
    with pytest.raises(Exception, match="different hash kinds"):
        intersect_groups(mixed, "sketch", by="g", k=16).collect()


def test_bounds_of_exact_empty_and_null_sketches(spark):
    rows = [(1, sketch(THETA_MAX, {5: 2, 6: 4})), (2, sketch(THETA_MAX // 2, {})), (3, None), (4, sketch(THETA_MAX, {}))]
    df = spark.createDataFrame(rows, f"i int, s {SKETCH}").select(
        "i", sketch_bounds("s").alias("b"), sketch_sum("s", 0).alias("t"), sketch_sum_bounds("s", 0).alias("tb"),
        sketch_mean("s", 0).alias("m"))
    r = {x["i"]: x for x in df.collect()}
    assert tuple(r[1]["b"]) == (2, 2, 2) and tuple(r[1]["tb"]) == (6, 6, 6) and r[1]["m"] == 3
    assert tuple(r[2]["b"]) == (0, 0, 4.0) and r[2]["m"] is None       # z^2 (1 - p) / p
    assert r[3]["b"] is None and r[3]["t"] is None and r[3]["tb"] is None and r[3]["m"] is None
    assert tuple(r[4]["b"]) == (0, 0, 0) and r[4]["t"] == 0


def test_coverage_of_bounds(spark):
    # 200 salted trials: keys 1..3000 with values key % 7, sketches of 128.
    n, trials = 3000, 200
    df = spark.range(n).withColumnRenamed("id", "key").crossJoin(spark.range(trials).withColumnRenamed("id", "trial"))
    df = df.withColumn("salted", F.concat_ws("-", "trial", "key")).withColumn("v", (F.col("key") % 7).cast("double"))
    sk = tuple_sketch(df, "salted", [Metric("v")], by="trial", k=128)
    b, t = sketch_bounds("sketch"), sketch_sum_bounds("sketch", 0)
    total = float(sum(i % 7 for i in range(n)))
    r = sk.agg(F.avg(((b["lower"] <= n) & (b["upper"] >= n)).cast("int")).alias("count"),
               F.avg(((t["lower"] <= total) & (t["upper"] >= total)).cast("int")).alias("sum"),
               F.avg(sketch_estimate("sketch")).alias("est"), F.avg(sketch_sum("sketch", 0)).alias("total"),
               F.avg(sketch_mean("sketch", 0)).alias("mean")).first()
    assert r["count"] >= 0.92 and r["sum"] >= 0.92
    assert abs(r["est"] / n - 1) < 0.03 and abs(r["total"] / total - 1) < 0.03 and abs(r["mean"] - total / n) < 0.06


def rounded(df):
    return sorted(((tuple(r)[:-1], r["sketch"]["theta"], [(e["h"], [round(v, 6) for v in e["values"]]) for e in r["sketch"]["entries"]])
                  for r in df.collect()), key=repr)


@pytest.mark.parametrize("hash", ["md5", "xxhash64"])
@pytest.mark.parametrize("held", [50, 1 << 18])
def test_bounded_partials_equal_the_plain_build(spark, monkeypatch, hash, held):
    monkeypatch.setattr(partials.bounded_partials, "__defaults__", (None, held))
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), None if rng.random() < 0.05 else str(rng.randrange(400)),
             None if rng.random() < 0.05 else rng.randrange(100) / 4) for _ in range(6000)]
    df = spark.createDataFrame(rows, "g string, i int, k string, v double").repartition(6)
    ms = [Metric("v"), Metric("v", "i = 1")]
    for by in ([], ["g"], ["g", "i"], ["g", F.to_date(F.lit("2024-01-01")).alias("d"), F.lit(1.5).cast("decimal(3,1)").alias("x")]):
        assert rounded(tuple_sketch(df, "k", ms, by=by, k=16, hash=hash, partials="bounded")) == \
            rounded(tuple_sketch(df, "k", ms, by=by, k=16, hash=hash, partials="all"))
    # Any key type, multi-valued keys, and group types that tasks do not group.
    typed = df.withColumn("ts", F.timestamp_seconds(F.xxhash64("k") % 1000)).withColumn("ks", F.array("k", F.lit("z"))) \
              .withColumn("dbl", F.col("i").cast("double"))
    for key, by in (("ts", "g"), ("ks", "g"), ("k", "dbl"), ("i", "g")):
        assert rounded(tuple_sketch(typed, key, ms, by=by, k=16, hash=hash, partials="bounded")) == \
            rounded(tuple_sketch(typed, key, ms, by=by, k=16, hash=hash, partials="all"))


def test_first_exchange_is_bounded(spark):
    k, tasks, groups = 16, 6, 3
    df = spark.range(0, 30_000, 1, tasks).select((F.col("id") % groups).alias("g"), F.col("id").alias("h"), F.lit(1.0).alias("m"))
    out = partials.bounded_partials(df, ["g"], "h", ["m"], k)
    assert out.count() <= (k + 2) * tasks * groups
    assert df.groupBy("g", "h").count().count() == 30_000


def test_auto_goes_by_the_size_of_the_input(spark, monkeypatch):
    df = spark.range(1000).withColumn("v", F.lit(1.0))

    def plan():
        return tuple_sketch(df, "id", [Metric("v")], k=16)._jdf.queryExecution().toString()

    assert "MapInArrow" not in plan()
    monkeypatch.setattr(build_module, "BOUNDED_FROM", 1)
    assert "MapInArrow" in plan()
    with pytest.raises(ValueError):
        tuple_sketch(df, "id", [Metric("v")], partials="some")


def test_score_interval_by_hand():
    n, p, z = 64, 0.1, 2.0
    q = z * z * (1 - p)
    for sign in (-1, 1):
        x = (2 * n + q + sign * math.sqrt(q * (q + 4 * n))) / (2 * p)
        assert math.isclose((n - x * p) ** 2, z * z * x * p * (1 - p))
