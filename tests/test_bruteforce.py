"""Randomized small fixtures against a plain-Python bottom-k sketch."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tuplecohort import (THETA_MAX, Metric, filter_tuples, merge_sketches, sketch_estimate,
                         tuple_sketch)


def md5_60(key: str) -> int:
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def brute_sketch(rows, k):
    """rows: (group, key, a, b, flag) -> {group: (theta, [(h, [sum a, sum b where flag])])}."""
    tuples = {}
    groups = set()
    for g, key, a, b, flag in rows:
        groups.add(g)
        if key is None or key == "" or a is None or b is None:
            continue
        t = tuples.setdefault((g, md5_60(key)), [0.0, 0.0])
        t[0] += a
        t[1] += b if flag else 0.0
    out = {}
    for g in groups:
        hs = sorted((h, v) for (gg, h), v in tuples.items() if gg == g)
        theta = hs[k][0] if len(hs) > k else THETA_MAX
        out[g] = (theta, [(h, [round(x, 6) for x in v]) for h, v in hs[:k]])
    return out


row = st.tuples(st.sampled_from(["g1", "g2", "g3"]),
                st.one_of(st.none(), st.just(""), st.integers(0, 60).map(lambda i: f"u{i}")),
                st.one_of(st.none(), st.integers(-5, 20).map(float)),
                st.integers(0, 9).map(float),
                st.booleans())


def spark_sketch(df, k):
    ms = [Metric("a"), Metric("b", F.col("flag"))]
    return tuple_sketch(df, "key", ms, by="g", k=k)


def as_dict(sk):
    return {r["g"]: (r["sketch"]["theta"],
                     [(e["h"], [round(x, 6) for x in e["values"]]) for e in r["sketch"]["entries"]])
            for r in sk.collect()}


SCHEMA = "g string, key string, a double, b double, flag boolean"


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=120), k=st.sampled_from([16, 32]))
def test_build_matches_brute_force(spark, rows, k):
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(spark_sketch(df, k)) == brute_sketch(rows, k)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=120), cut=st.integers(0, 120))
def test_merge_of_two_parts_matches_brute_force(spark, rows, cut):
    k = 16
    df = spark.createDataFrame([r + (i < cut,) for i, r in enumerate(rows)],
                               SCHEMA + ", part boolean")
    parts = tuple_sketch(df, "key", [Metric("a"), Metric("b", F.col("flag"))], by=["g", "part"],
                         k=k)
    merged = merge_sketches(parts, "sketch", by="g", k=k, num_values=2)
    assert as_dict(merged) == brute_sketch(rows, k)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=120))
def test_filtered_estimate_matches_brute_force(spark, rows):
    k = 16
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["g"]: r["e"] for r in spark_sketch(df, k).select(
        "g", sketch_estimate(filter_tuples("sketch", "$0 > 3 && $1 >= 1")).alias("e")).collect()}
    want = {}
    for g, (theta, entries) in brute_sketch(rows, k).items():
        n = sum(1 for _, v in entries if v[0] > 3 and v[1] >= 1)
        t = THETA_MAX if n == 0 else theta
        want[g] = n / (t / THETA_MAX)
    assert got == want
