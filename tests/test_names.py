"""User columns named like the library's own outputs or struct fields."""

from pyspark.sql import functions as F

from tuplecohort import (Metric, cohort_exact, cohort_sketch, merge_sketches, sketch_estimate,
                         tuple_sketch)


def test_group_columns_named_like_internals(spark):
    df = spark.createDataFrame(
        [("x", "y", 1, "a", 1.0), ("x", "y", 1, "b", 2.0), ("z", "w", 2, "a", 3.0)],
        "values string, h string, key int, k string, m double")
    sk = tuple_sketch(df, "k", [Metric("m")], by=["values", "h", "key"])
    got = {(r["values"], r["h"], r["key"]): r["e"]
           for r in sk.select("values", "h", "key", sketch_estimate("sketch").alias("e")).collect()}
    assert got == {("x", "y", 1): 2.0, ("z", "w", 2): 1.0}
    merged = merge_sketches(sk, "sketch", by="values", num_values=1, k=4096)
    assert {r["values"]: r["e"] for r in merged.select(
        "values", sketch_estimate("sketch").alias("e")).collect()} == {"x": 2.0, "z": 1.0}
    ex = cohort_exact(df, "k", [Metric("m")], "$0 >= 2", by=["values", "key"])
    assert {(r["values"], r["key"]): r["keys"] for r in ex.collect()} == {("x", 1): 1, ("z", 2): 1}
    cs = cohort_sketch(df, "k", [Metric("m")], "$0 >= 2", by=F.col("values").alias("values"))
    assert {r["values"]: r["est_keys"] for r in cs.collect()} == {"x": 1.0, "z": 1.0}
