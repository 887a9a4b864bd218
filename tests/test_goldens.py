"""The reference's own three unit tests, on the exact table and the sketch."""

import pytest
from pyspark.sql import functions as F

from tuplecohort import (Metric, collapse_rows, collapse_tuples, filter_rows, filter_tuples,
                         sketch_entries, sketch_estimate, tuple_rollup, tuple_sketch)

F1_ROWS = [("test_a", "f_1", 1.0), ("test_a", "f_2", 2.0), ("test_b", "f_3", 3.0),
           ("test_b", "f_1", 4.0), ("test_c", "f_2", 5.0), ("test_c", "f_3", 6.0)]
F1_EXPECTED = {"test_a": [1.0, 2.0, 0.0], "test_b": [4.0, 0.0, 3.0], "test_c": [0.0, 5.0, 6.0]}


@pytest.fixture
def f1(spark):
    return spark.createDataFrame(F1_ROWS, "sketchDim string, filterDim string, value float")


def f1_metrics():
    return [Metric("value", F.col("filterDim") == v) for v in ("f_1", "f_2", "f_3")]


def test_build_exact_table(f1):
    got = {r["key"]: r["values"] for r in tuple_rollup(f1, "sketchDim", f1_metrics()).collect()}
    assert got == F1_EXPECTED


def test_build_sketch(f1):
    sk = tuple_sketch(f1, "sketchDim", f1_metrics(), k=1024)
    row = sk.collect()[0]["sketch"]
    assert row["theta"] == 1 << 60 and row["k"] == 1024 and row["num_values"] == 3
    hs = [e["h"] for e in row["entries"]]
    assert hs == sorted(hs)
    assert sorted(e["values"] for e in row["entries"]) == sorted(F1_EXPECTED.values())
    assert sk.select(sketch_estimate("sketch")).first()[0] == 3.0


def test_build_rejects_bad_k(f1):
    with pytest.raises(ValueError):
        tuple_sketch(f1, "sketchDim", f1_metrics(), k=1000)
    with pytest.raises(ValueError):
        tuple_sketch(f1, "sketchDim", f1_metrics(), num_values=2)


F2_ROWS = [("a", [1.0, 2.0, 3.0]), ("b", [2.0, 2.0, 3.0]), ("c", [3.0, 3.0, 3.0])]
FILTER_CASES = [("$0 > 0", 3), ("$1 == 2", 2), ("$2 > 3", 0), ("$0 < $1 && $2 == 3", 1)]


@pytest.fixture
def f2_sketch(spark):
    """F2 tuples held in a sketch: built from one row per (key, slot value)."""
    df = spark.createDataFrame(F2_ROWS, "key string, v array<double>")
    df = df.select("key", *[F.col("v")[i].alias(f"m{i}") for i in range(3)])
    return tuple_sketch(df, "key", [Metric(f"m{i}") for i in range(3)], k=1024)


@pytest.mark.parametrize("expr,expected", FILTER_CASES)
def test_filter_expression_sketch(f2_sketch, expr, expected):
    est = f2_sketch.select(sketch_estimate(filter_tuples("sketch", expr))).first()[0]
    assert est == pytest.approx(expected, abs=1e-3)


@pytest.mark.parametrize("expr,expected", FILTER_CASES)
def test_filter_expression_exact(spark, expr, expected):
    df = spark.createDataFrame(F2_ROWS, "key string, values array<double>")
    assert filter_rows(df, expr).count() == expected


def test_collapse_sketch(f2_sketch):
    c = f2_sketch.withColumn("c", collapse_tuples("sketch", "$0 + $1 + $2"))
    vals = sorted(r["values"] for r in sketch_entries(c, "c").collect())
    assert vals == [[6.0], [7.0], [9.0]]
    assert c.first()["c"]["num_values"] == 1


def test_collapse_exact(spark):
    df = spark.createDataFrame(F2_ROWS, "key string, values array<double>")
    got = sorted(r["values"] for r in collapse_rows(df, "$0 + $1 + $2").collect())
    assert got == [[6.0], [7.0], [9.0]]


def test_callable_expressions(f2_sketch):
    from tuplecohort import slot
    est = f2_sketch.select(sketch_estimate(filter_tuples(
        F.col("sketch"), lambda v: (slot(v, 0) < slot(v, 1)) & (slot(v, 2) == 3)))).first()[0]
    assert est == 1.0
    c = f2_sketch.select(collapse_tuples(F.col("sketch"), lambda v: slot(v, 0) * 10).alias("c"))
    assert sorted(e["values"][0] for e in c.first()["c"]["entries"]) == [10.0, 20.0, 30.0]


def test_order_by_estimate_nulls_first_and_top_k(spark):
    from tuplecohort import order_by_estimate
    df = spark.createDataFrame([("g1", "a"), ("g1", "b"), ("g2", "c"), ("g3", None)],
                               "g string, k string")
    sk = tuple_sketch(df.withColumn("m", F.lit(1.0)), "k", [Metric("m")], by="g")
    sk = sk.withColumn("sketch", F.when(F.col("g") == "g3", F.lit(None)).otherwise(F.col("sketch")))
    asc = [r["g"] for r in order_by_estimate(sk, "sketch").collect()]
    assert asc == ["g3", "g2", "g1"]
    top = [r["g"] for r in order_by_estimate(sk, "sketch", ascending=False, limit=2).collect()]
    assert top == ["g3", "g1"]  # nulls first, then the largest estimate


def test_weekly_cohort_flagship(spark):
    from conftest import SF_SMALL
    from tuplecohort import weekly_cohort
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ms = [Metric(F.lit(1.0), F.col("event_type") == "view"),
          Metric(F.lit(1.0), F.col("event_type") == "purchase")]
    exact = [r["keys"] for r in weekly_cohort(ev, "user_id", ms, "$0 >= 4 && $1 > 0", "ts")
             .orderBy("week").collect()]
    sk = [r["est_keys"] for r in weekly_cohort(ev, "user_id", ms, "$0 >= 4 && $1 > 0", "ts",
                                               exact=False).orderBy("week").collect()]
    assert exact == [5, 7, 4, 4, 0] and sk == [5.0, 7.0, 4.0, 4.0, 0.0]
