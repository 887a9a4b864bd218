"""

For every configuration: median of 5 warm runs (noop sink) and the shuffle
bytes/records written by one tagged run, read from Spark's event log in a
scratch folder.  Prints a Markdown table (paste into MEASUREMENTS.md).
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tuplecohort import (Metric, cohort_exact, cohort_sketch, collapse_tuples,  # noqa: E402
                         filter_tuples, merge_sketches, read_sketches, sketch_estimate,
                         sketch_slot_sum, time_bucket, tuple_sketch, write_sketches)
from tuplecohort.session import GROUP_LIMIT_CONF, configure, scratch_path  # noqa: E402

RUNS = 5


def events(logdir):
    for f in glob.glob(f"{logdir}/**/events_*", recursive=True):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def shuffle_by_group(logdir):
    stage_group, out = {}, {}
    evs = list(events(logdir))
    for ev in evs:
        if ev.get("Event") == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = g
    for ev in evs:
        if ev.get("Event") == "SparkListenerTaskEnd":
            g = stage_group.get(ev["Stage ID"])
            w = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
            acc = out.setdefault(g, [0, 0])
            acc[0] += w.get("Shuffle Bytes Written", 0)
            acc[1] += w.get("Shuffle Records Written", 0)
    return out


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    logdir = tempfile.mkdtemp(prefix="measure-eventlog-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    sc = spark.sparkContext
    ev = spark.read.parquet(f"{sf}/events.parquet")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    vp = [Metric(F.lit(1.0), F.col("event_type") == "view"),
          Metric(F.lit(1.0), F.col("event_type") == "purchase")]
    cond = "$0 >= 4 && $1 > 0"
    week = time_bucket("ts").alias("week")
    rows = []

    def measure(name, make, note="", limit=True):
        old = spark.conf.get(GROUP_LIMIT_CONF)
        df = make()
        if not limit:
            spark.conf.set(GROUP_LIMIT_CONF, "1")  # the optimizer reads it when the job runs
        try:
            sc.setJobGroup("measure:" + name, name)
            df.write.format("noop").mode("overwrite").save()
            sc.setJobGroup("timing", "timing")
            times = []
            for _ in range(RUNS):
                t0 = time.perf_counter()
                made = make()  # building a sketch raises the threshold again
                if not limit:
                    spark.conf.set(GROUP_LIMIT_CONF, "1")
                made.write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
        finally:
            spark.conf.set(GROUP_LIMIT_CONF, old)
        rows.append([name, round(statistics.median(times), 3), note])
        print(name, rows[-1][1], flush=True)

    exact = {r["week"]: r["keys"] for r in cohort_exact(ev, "user_id", vp, cond, by=week).collect()}
    measure("cohort_weekly_exact", lambda: cohort_exact(ev, "user_id", vp, cond, by=week))
    for k in (64, 1024, 4096):
        got = {r["week"]: r["est_keys"] for r in
               cohort_sketch(ev, "user_id", vp, cond, by=week, k=k).collect()}
        total = sum(got.values()) / sum(exact.values()) - 1
        big = [abs(got[w] / exact[w] - 1) for w in exact if exact[w] >= 100]
        note = (f"rel. error of the 5-week total {total:+.3f}; max over weeks with >= 100 keys "
                f"{max(big):.3f}" if big else f"rel. error of the total {total:+.3f}")
        measure(f"cohort_weekly_sketch k={k}",
                lambda k=k: cohort_sketch(ev, "user_id", vp, cond, by=week, k=k), note)
    lm = [Metric("l_quantity"), Metric("l_extendedprice", F.col("l_discount") > 0.05)]
    for k in (1024, 4096):
        for pre in (False, True):
            for lim in (True, False):
                measure(f"tuple_sketch lineitem/l_orderkey k={k} presample={pre} group_limit={lim}",
                        lambda k=k, pre=pre: tuple_sketch(li, "l_orderkey", lm, by="l_returnflag",
                                                          k=k, presample=pre), limit=lim)
    for unit, label in (("day", "150 daily"), ("hour", "3,600 hourly")):
        bucket = (F.to_date("ts") if unit == "day" else F.date_trunc("hour", "ts")).alias("b")
        parts = tuple_sketch(ev, "user_id", vp, by=["event_type", bucket], k=1024)
        path = scratch_path(spark, f"measure-{unit}")
        write_sketches(parts, path)
        stored = read_sketches(spark, path)
        n = stored.count()
        measure(f"merge_sketches {label} -> 5 (stored input)",
                lambda stored=stored: merge_sketches(stored, by="event_type", k=1024, num_values=2),
                f"{n} input sketches")

        def transform(stored=stored):
            f = stored.withColumn("f", filter_tuples("sketch", cond)) \
                .withColumn("c", collapse_tuples("f", "$0 + $1"))
            return f.select("event_type", "b", sketch_estimate("f").alias("e"),
                            sketch_slot_sum("c", 0).alias("t"))
        measure(f"filter + collapse on {label} stored sketches", transform, f"{n} groups")
    spark.stop()
    shuffle = shuffle_by_group(logdir)
    print("\n| Configuration | median of 5 (s) | shuffle bytes | shuffle records | note |")
    print("| --- | --- | --- | --- | --- |")
    for name, t, note in rows:
        b, r = shuffle.get("measure:" + name, [0, 0])
        print(f"| {name} | {t} | {b:,} | {r:,} | {note} |")


if __name__ == "__main__":
    main()
