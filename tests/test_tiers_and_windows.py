"""Tiered compaction, sliding windows (kept and batch), and what a crash or a replay leaves."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tuplecohort import Metric, merge_sketches, sliding_sketches, tuple_sketch
from tuplecohort.session import scratch_path
from tuplecohort.sources.manifest import Manifest
from tuplecohort.streaming import SlidingSketches, TieredSketches

K = 32


def canon(df, by):
    return sorted(((*[str(r[c]) for c in by], r["sketch"]["theta"], [(e["h"], [round(v, 6) for v in e["values"]])
                                                                   for e in r["sketch"]["entries"]]) for r in df.collect()))


@pytest.fixture(scope="module")
def daily(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sk = tuple_sketch(ev, "user_id", [Metric("value")], by=["event_type", F.to_date("ts").alias("day")], k=K)
    path = scratch_path(spark, "daily")
    sk.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def days(daily):
    return sorted(r[0] for r in daily.select("day").distinct().collect())


def of(daily, *wanted):
    return daily.where(F.col("day").isin(list(wanted))).drop("day")


def test_tiers_equal_one_merge_and_stay_few(spark, daily, days):
    t = TieredSketches(spark, scratch_path(spark, "tiers"), by=["event_type"], k=K, fan=2)
    with pytest.raises(ValueError):
        t.merged()
    for n, d in enumerate(days[:11]):
        t.add(of(daily, d), 3 * n)                                # numbers may be left out
        t.add(of(daily, d), 3 * n)                                # a replay counts once
        runs = t.manifest.latest()[1]
        assert len(runs) <= math.log2(n + 1) + 1
        assert [r.first for r in runs] == sorted(r.first for r in runs) and runs[-1].last == 3 * n
    assert [r.level for r in runs] == [3, 1, 0]                   # 11 = 8 + 2 + 1
    want = merge_sketches(of(daily, *days[:11]), by="event_type", k=K)
    assert canon(t.merged(), ["event_type"]) == canon(want, ["event_type"])
    kept = {r.name for r in runs}
    t.vacuum()
    assert canon(t.merged(), ["event_type"]) == canon(want, ["event_type"]) and kept


def test_crash_between_write_and_swap(spark, daily, days, monkeypatch):
    t = TieredSketches(spark, scratch_path(spark, "tiers-crash"), by=["event_type"], k=K, fan=2)
    t.add(of(daily, days[0]), 0)
    before = canon(t.merged(), ["event_type"])
    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.add(of(daily, days[1]), 1)
    assert canon(t.merged(), ["event_type"]) == before            # the old state is whole
    assert t.vacuum() == 2                                        # the batch and its merge, named by no version
    t.add(of(daily, days[1]), 1)
    want = merge_sketches(of(daily, *days[:2]), by="event_type", k=K)
    assert canon(t.merged(), ["event_type"]) == canon(want, ["event_type"])


def test_of_two_writers_one_fails(spark, daily, days):
    t = TieredSketches(spark, scratch_path(spark, "tiers-two"), by=["event_type"], k=K)
    t.add(of(daily, days[0]), 0)
    version, runs = t.manifest.latest()
    schema = of(daily, days[0]).schema
    t.manifest.commit(version, runs, schema)
    with pytest.raises(Exception, match="(?i)exist"):
        t.manifest.commit(version, [], schema)
    assert t.manifest.latest() == (version + 1, runs)


def test_two_stacks_equal_a_rebuild(spark, daily, days):
    s = SlidingSketches(spark, scratch_path(spark, "window"), 3, by=["event_type"], k=K)
    start = datetime.date(1970, 1, 1)
    for d in [*days[:7], days[8], days[13]]:                      # one day left out, then a whole block
        n = (d - start).days
        s.add(of(daily, d), n)
        s.add(of(daily, d), n)
        assert len(s.parts()) <= 2
        had = [x for x in [*days[:7], days[8], days[13]] if n - 3 < (x - start).days <= n]
        want = merge_sketches(of(daily, *had), by="event_type", k=K)
        assert canon(s.merged(), ["event_type"]) == canon(want, ["event_type"])


@pytest.mark.parametrize("window", [1, 5, 7])
def test_windows_of_every_day(spark, daily, days, window):
    some = daily.where(F.col("day") != days[4])                   # a day without sketches
    got = sliding_sketches(some, window, by=["event_type"], k=K)
    wide = some.withColumn("day", F.explode(F.expr(f"sequence(day, date_add(day, {window - 1}))")))
    want = merge_sketches(wide, by=["event_type", "day"], k=K)
    last = daily.groupBy("event_type").agg(F.max("day").alias("last"))
    want = want.join(last, "event_type").where("day <= last").drop("last")
    assert canon(got, ["event_type", "day"]) == canon(want, ["event_type", "day"])
    more = sliding_sketches(some, window, by=["event_type"], k=K, tail=True)
    assert more.count() == got.count() + (window - 1) * daily.select("event_type").distinct().count()


def test_window_of_nothing(spark, daily):
    assert sliding_sketches(daily.limit(0), 7, by=["event_type"], k=K).count() == 0
    assert sliding_sketches(daily.withColumn("day", F.lit(None).cast("date")), 7, by=["event_type"], k=K).count() == 0
    with pytest.raises(ValueError):
        sliding_sketches(daily, 0)
