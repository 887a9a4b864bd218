"""Key types and argument errors."""

import datetime

import pytest
from pyspark.sql import functions as F

from tuplecohort import (Metric, filter_tuples, sketch_entries, sketch_estimate, transform_chain,
                         tuple_rollup, tuple_sketch)
from tuplecohort.functions.hashing import key_hash


def test_integer_array_keys(spark):
    df = spark.createDataFrame([([1, 1, 2], 2.0), ([], 5.0), (None, 1.0), ([2, None], 1.0)],
                               "k array<int>, m double")
    got = {r["key"]: r["values"] for r in tuple_rollup(df, "k", [Metric("m")]).collect()}
    assert got == {"1": [4.0], "2": [3.0]}


def test_double_keys_group_by_text(spark):
    df = spark.createDataFrame([(1.5, 1.0), (1.5, 2.0), (2.0, 1.0)], "k double, m double")
    got = {r["key"]: r["values"] for r in tuple_rollup(df, "k", [Metric("m")]).collect()}
    assert got == {"1.5": [3.0], "2.0": [1.0]}


def test_date_keys_and_hash_of_text(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 2), 1.0)], "k date, m double")
    sk = tuple_sketch(df, "k", [Metric("m")])
    h = sketch_entries(sk).first()["h"]
    assert h == spark.range(1).select(key_hash(F.lit("2024-01-02"))).first()[0]


def test_argument_errors(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, m double")
    with pytest.raises(ValueError):
        tuple_sketch(df, "k", [])
    with pytest.raises(TypeError):
        tuple_sketch(df, "k", ["m"])
    with pytest.raises(ValueError):
        tuple_sketch(df, "k", [Metric("m")], hash="sha1")
    with pytest.raises(ValueError):
        Metric("m", where=None)
    sk = tuple_sketch(df, "k", [Metric("m")])
    with pytest.raises(ValueError):
        transform_chain(sk, "sketch", [("reverse", "$0")])
    with pytest.raises(TypeError):
        filter_tuples(F.col("sketch"), "$0 > 0")  # string expression needs the sketch by name
    assert sk.select(sketch_estimate(filter_tuples(F.col("sketch"), lambda v: v[0] > 0))) \
        .first()[0] == 1.0
