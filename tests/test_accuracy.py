"""Estimator accuracy: mean error near 0, spread near 1/sqrt(k-1)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tuplecohort import Metric, sketch_estimate, tuple_sketch


@pytest.mark.parametrize("k", [16, 64, 256, 1024])
def test_relative_error(spark, k):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey")
    n_true = li.select(F.countDistinct("l_orderkey")).first()[0]
    salts = 40
    # One sketch per salt: the salt changes every key's hash, like an independent trial.
    salted = li.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))) \
        .withColumn("key", F.concat_ws(":", F.col("salt").cast("string"),
                                       F.col("l_orderkey").cast("string")))
    est = tuple_sketch(salted, "key", [Metric(F.lit(1.0))], by="salt", k=k, hash="xxhash64") \
        .select(sketch_estimate("sketch").alias("e")).collect()
    errs = [r["e"] / n_true - 1.0 for r in est]
    mean = sum(errs) / len(errs)
    sd = math.sqrt(sum((e - mean) ** 2 for e in errs) / (len(errs) - 1))
    expected_sd = 1 / math.sqrt(k - 1)
    assert abs(mean) < 4 * expected_sd / math.sqrt(salts) + 1e-9
    assert 0.5 * expected_sd < sd < 1.6 * expected_sd
