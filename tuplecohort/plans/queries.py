"""Registered queries over the test tables, each with a plain-SQL twin.

Every query reads whole tables (``events``, ``orders``, ``lineitem``) and
exercises one or more operators of the library; ``SQL`` holds the matching
DuckDB statement.  Column names and types agree between the two; sums of
two-decimal data are rounded to 2 places and estimates to 6.
"""

from __future__ import annotations

import datetime
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import slot
from ..functions.metrics import Metric
from ..functions.sketch import (a_not_b, collapse_tuples, combine_sketches, filter_tuples, intersect_sketches,
                                sketch_bounds, sketch_estimate, sketch_mean, sketch_retained, sketch_slot_sum,
                                sketch_sum, sketch_sum_bounds)
from ..operators.build import tuple_sketch
from ..operators.lattice import cube_sketches
from ..operators.merge import merge_sketches
from ..operators.rollup import collapse_rows, filter_rows, tuple_rollup
from ..operators.sets import intersect_groups
from ..operators.sliding import sliding_sketches
from ..operators.top import top_groups
from ..operators.transforms import order_by_estimate, sketch_entries, transform_chain
from ..session import scratch_path
from ..sources.dyadic import write_dyadic
from ..sources.store import read_sketches, stream_table, write_sketches
from . import oracle as O
from .cohort import cohort_exact, cohort_sketch, time_bucket

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def est_cols(sketch: str | Column = "sketch") -> list[Column]:
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    return [F.round(sketch_estimate(s), 6).alias("est_keys"),
            sketch_retained(s).cast("bigint").alias("retained"),
            s["theta"].alias("theta")]


# Shared definitions (Spark side and SQL side side by side).
def WEEK():
    return time_bucket("ts", "week").alias("week")



WEEK_SQL = "CAST(date_trunc('week', ts) AS DATE)"
def DAY():
    return time_bucket("ts", "day").alias("day")



DAY_SQL = "CAST(ts AS DATE)"
def VIEW_PURCHASE():
    return [Metric(F.lit(1.0), F.col("event_type") == "view"),
            Metric(F.lit(1.0), F.col("event_type") == "purchase")]



VIEW_PURCHASE_SQL = [("1.0", "event_type = 'view'"), ("1.0", "event_type = 'purchase'")]
COHORT = "$0 >= 4 && $1 > 0"
COHORT_SQL = "v0 >= 4 AND v1 > 0"
T60 = O.T60


def _cohort_sketch_sql(k: int) -> str:
    return O.with_(O.build("s", "events", [(WEEK_SQL, "week")], "user_id", VIEW_PURCHASE_SQL, k)) \
        + O.estimate("s", ["week"], COHORT_SQL)


# --- flagship: weekly cohort -------------------------------------------------

@query("cohort_weekly_exact", f"""
WITH t AS (
  SELECT {WEEK_SQL} AS week, CAST(user_id AS VARCHAR) AS k,
         sum(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END) AS v0,
         sum(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS v1
  FROM events WHERE user_id IS NOT NULL AND CAST(user_id AS VARCHAR) <> ''
  GROUP BY 1, 2)
SELECT week, CAST(count(*) FILTER (WHERE {COHORT_SQL}) AS BIGINT) AS keys FROM t GROUP BY week
""")
def cohort_weekly_exact(spark, sf):
    return cohort_exact(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), COHORT, by=WEEK())


@query("cohort_weekly_sketch", _cohort_sketch_sql(4096))
def cohort_weekly_sketch(spark, sf):
    c = cohort_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), COHORT, by=WEEK(),
                      k=4096)
    return c.withColumn("est_keys", F.round("est_keys", 6))


@query("cohort_weekly_sampled", _cohort_sketch_sql(64))
def cohort_weekly_sampled(spark, sf):
    c = cohort_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), COHORT, by=WEEK(), k=64)
    return c.withColumn("est_keys", F.round("est_keys", 6))


# Exact regime (k above the keys per week): the estimate is the exact count
# whatever the hash, so the md5 twin applies to the xxhash64 build too.
@query("cohort_weekly_sketch_xxhash", _cohort_sketch_sql(4096))
def cohort_weekly_sketch_xxhash(spark, sf):
    c = cohort_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), COHORT, by=WEEK(),
                      k=4096, hash="xxhash64")
    return c.withColumn("est_keys", F.round("est_keys", 6))


# --- exact tuple tables -------------------------------------------------------

@query("tuple_rollup_events", """
SELECT CAST(user_id AS VARCHAR) AS user_key,
       round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0.0 END), 2) AS v_click,
       round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END), 2) AS v_view,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS v_purchase
FROM events
WHERE value IS NOT NULL AND user_id IS NOT NULL AND CAST(user_id AS VARCHAR) <> ''
GROUP BY 1
""")
def tuple_rollup_events(spark, sf):
    ms = [Metric("value", F.col("event_type") == t) for t in ("click", "view", "purchase")]
    r = tuple_rollup(table(spark, sf, "events"), "user_id", ms)
    return r.select(F.col("key").alias("user_key"),
                    *[F.round(slot(F.col("values"), i), 2).alias(n)
                      for i, n in enumerate(["v_click", "v_view", "v_purchase"])])


@query("rollup_unfiltered_metric", """
SELECT CAST(l_partkey AS VARCHAR) AS part_key,
       round(sum(l_quantity), 2) AS q_all,
       round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END), 2) AS q_returned,
       round(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0.0 END), 2) AS price_open
FROM lineitem
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
  AND l_partkey IS NOT NULL AND CAST(l_partkey AS VARCHAR) <> ''
GROUP BY 1
""")
def rollup_unfiltered_metric(spark, sf):
    ms = [Metric("l_quantity"),  # unfiltered: always-true predicate
          Metric("l_quantity", F.col("l_returnflag") == "R"),
          Metric("l_extendedprice", "l_linestatus = 'O'")]
    r = tuple_rollup(table(spark, sf, "lineitem"), "l_partkey", ms)
    return r.select(F.col("key").alias("part_key"),
                    *[F.round(slot(F.col("values"), i), 2).alias(n)
                      for i, n in enumerate(["q_all", "q_returned", "price_open"])])


_FORMS = ["p_in", "p_between", "p_like", "p_null", "p_bool", "p_regex", "p_interval",
          "p_colcmp", "p_contains"]
_FORMS_SQL = [
    "l_returnflag IN ('A', 'R')",
    "l_discount BETWEEN 0.02 AND 0.05",
    "l_returnflag LIKE 'A%'",
    "l_shipdate IS NULL",
    "(l_quantity >= 10 AND NOT l_returnflag = 'N') OR l_linestatus = 'F'",
    "regexp_matches(CAST(l_orderkey AS VARCHAR), '7$')",
    "l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'",
    "l_returnflag IS NOT DISTINCT FROM l_linestatus",
    "contains(l_returnflag || l_linestatus, 'NO')",
]


@query("metric_predicate_forms", f"""
SELECT CAST(l_partkey AS VARCHAR) AS part_key,
{",".join(f"  round(sum(CASE WHEN {p} THEN l_quantity ELSE 0.0 END), 2) AS {n}" for p, n in zip(_FORMS_SQL, _FORMS))}
FROM lineitem
WHERE l_quantity IS NOT NULL AND l_partkey IS NOT NULL AND CAST(l_partkey AS VARCHAR) <> ''
GROUP BY 1
""")
def metric_predicate_forms(spark, sf):
    c = F.col
    preds = [
        c("l_returnflag").isin("A", "R"),
        c("l_discount").between(0.02, 0.05),
        c("l_returnflag").like("A%"),
        c("l_shipdate").isNull(),
        ((c("l_quantity") >= 10) & ~(c("l_returnflag") == "N")) | (c("l_linestatus") == "F"),
        c("l_orderkey").cast("string").rlike("7$"),
        (c("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (c("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")),
        c("l_returnflag").eqNullSafe(c("l_linestatus")),
        F.concat(c("l_returnflag"), c("l_linestatus")).contains("NO"),
    ]
    r = tuple_rollup(table(spark, sf, "lineitem"), "l_partkey",
                     [Metric("l_quantity", p) for p in preds])
    return r.select(F.col("key").alias("part_key"),
                    *[F.round(slot(F.col("values"), i), 2).alias(n) for i, n in enumerate(_FORMS)])


@query("null_metric_drops_row", """
SELECT CAST(user_id AS VARCHAR) AS user_key,
       round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END), 2) AS v_view,
       round(sum(CASE WHEN event_type = 'purchase' THEN v2 ELSE 0.0 END), 2) AS v_purchase
FROM (SELECT *, CASE WHEN hour(ts) < 6 THEN NULL ELSE value END AS v2 FROM events)
WHERE value IS NOT NULL AND v2 IS NOT NULL
  AND user_id IS NOT NULL AND CAST(user_id AS VARCHAR) <> ''
GROUP BY 1
""")
def null_metric_drops_row(spark, sf):
    ev = table(spark, sf, "events").withColumn(
        "v2", F.when(F.hour("ts") < 6, F.lit(None)).otherwise(F.col("value")))
    ms = [Metric("value", F.col("event_type") == "view"),
          Metric("v2", F.col("event_type") == "purchase")]
    r = tuple_rollup(ev, "user_id", ms)
    return r.select(F.col("key").alias("user_key"),
                    F.round(slot(F.col("values"), 0), 2).alias("v_view"),
                    F.round(slot(F.col("values"), 1), 2).alias("v_purchase"))


_NULL_KEY_SRC = ("(SELECT *, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' "
                 "THEN '' ELSE CAST(user_id AS VARCHAR) END AS ukey FROM events)")


@query("null_empty_key", O.with_(O.build("s", _NULL_KEY_SRC, [("event_type", "event_type")],
                                          "ukey", [("value", "TRUE")], 4096))
       + O.estimate("s", ["event_type"]))
def null_empty_key(spark, sf):
    ev = table(spark, sf, "events")
    et = F.col("event_type")
    ev = ev.withColumn("ukey", F.when(et == "error", F.lit(None))
                       .when(et == "signup", F.lit("")).otherwise(F.col("user_id").cast("string")))
    sk = tuple_sketch(ev, "ukey", [Metric("value")], by="event_type", k=4096)
    return sk.select("event_type", *est_cols())


@query("multi_value_key", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(kv AS VARCHAR) AS key,
       round(sum(o_totalprice), 2) AS total
FROM (SELECT *, UNNEST([o_orderstatus, o_orderpriority, o_orderstatus]) AS kv FROM orders)
WHERE o_totalprice IS NOT NULL AND kv IS NOT NULL AND kv <> ''
GROUP BY 1, 2
""")
def multi_value_key(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "keys", F.array("o_orderstatus", "o_orderpriority", "o_orderstatus"))
    r = tuple_rollup(o, "keys", [Metric("o_totalprice")],
                     by=F.year("o_orderdate").cast("bigint").alias("order_year"))
    return r.select("order_year", "key", F.round(slot(F.col("values"), 0), 2).alias("total"))


# --- sketches: build, merge, combine, estimate --------------------------------

_DAILY_SQL_METRICS = [("value", "TRUE"), ("1.0", "event_type = 'view'")]


def _daily_metrics():
    return [Metric("value"), Metric(F.lit(1.0), F.col("event_type") == "view")]


_SLOT_SUMS = [("round(coalesce(sum(e.v0), 0), 2)", "v0_sum"),
              ("round(coalesce(sum(e.v1), 0), 2)", "v1_sum")]


def _slot_sums(s="sketch"):
    return [F.round(sketch_slot_sum(s, 0), 2).alias("v0_sum"),
            F.round(sketch_slot_sum(s, 1), 2).alias("v1_sum")]


_MERGE_DAILY_SQL = O.with_(
    O.build("d", "events", [("event_type", "event_type"), (DAY_SQL, "day")], "user_id",
            _DAILY_SQL_METRICS, 64),
    O.merge("m", "d", ["event_type"], 2, 64)) + O.estimate("m", ["event_type"], extra=_SLOT_SUMS)


@query("merge_daily_to_total", _MERGE_DAILY_SQL)
def merge_daily_to_total(spark, sf):
    daily = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(),
                         by=["event_type", DAY()], k=64)
    merged = merge_sketches(daily, "sketch", by="event_type", k=64, num_values=2)
    return merged.select("event_type", *est_cols(), *_slot_sums())


@query("store_roundtrip", _MERGE_DAILY_SQL)
def store_roundtrip(spark, sf):
    daily = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(),
                         by=["event_type", DAY()], k=64)
    path = scratch_path(spark, "daily-sketches")
    write_sketches(daily, path, partition_by=["day"])
    stored = read_sketches(spark, path)
    merged = merge_sketches(stored, "sketch", by="event_type", k=64, num_values=2)
    return merged.select("event_type", *est_cols(), *_slot_sums())


@query("combine_two_halves", O.with_(
    O.build("hb", "events", [("event_type", "event_type"), ("coalesce(hour(ts) < 12, false)", "am")], "user_id",
            _DAILY_SQL_METRICS, 64),
    O.merge("c", "hb", ["event_type"], 2, 64)) + O.estimate("c", ["event_type"], extra=_SLOT_SUMS))
def combine_two_halves(spark, sf):
    # One build over the table by half of the day (a row without a time is in the second), then one row per type.
    am = F.coalesce(F.hour("ts") < 12, F.lit(False)).alias("am")
    halves = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(), by=["event_type", am], k=64)
    both = halves.groupBy("event_type").agg(
        F.first(F.when(F.col("am"), F.col("sketch")), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("am"), F.col("sketch")), ignorenulls=True).alias("b"))
    c = both.select("event_type", combine_sketches("a", "b", k=64).alias("sketch"))
    return c.select("event_type", *est_cols(), *_slot_sums())


@query("finalize_estimate", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id", [("value", "TRUE")], 64))
    + O.estimate("s", ["event_type"]))
def finalize_estimate(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric("value")],
                      by="event_type", k=64)
    return sk.select("event_type", *est_cols())


@query("sketch_ungrouped_parts", O.with_(
    O.build("s", "lineitem", [], "l_partkey", [("l_quantity", "TRUE")], 1024))
    + O.estimate("s", [], extra=[("round(coalesce(sum(e.v0), 0), 2)", "v0_sum")]))
def sketch_ungrouped_parts(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_partkey", [Metric("l_quantity")], k=1024)
    return sk.select(*est_cols(), F.round(sketch_slot_sum("sketch", 0), 2).alias("v0_sum"))


@query("sketch_entries", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id",
            [("value", "TRUE"), ("1.0", "hour(ts) < 12")], 64))
    + "SELECT event_type, h, round(v0, 2) AS v0, round(v1, 2) AS v1 FROM s_e")
def sketch_entries_q(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id",
                      [Metric("value"), Metric(F.lit(1.0), F.hour("ts") < 12)],
                      by="event_type", k=64)
    e = sketch_entries(sk, "sketch", keep=["event_type"])
    return e.select("event_type", "h", F.round(slot(F.col("values"), 0), 2).alias("v0"),
                    F.round(slot(F.col("values"), 1), 2).alias("v1"))


@query("missing_column_empty", f"""
SELECT DISTINCT event_type, CAST(0.0 AS DOUBLE) AS est_keys, CAST(0 AS BIGINT) AS retained,
       CAST({T60} AS BIGINT) AS theta
FROM events
""")
def missing_column_empty(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "no_such_column", [Metric("value")],
                      by="event_type", missing_ok=True)
    return sk.select("event_type", *est_cols())


# --- transforms: filter, collapse, chains, outer references --------------------

@query("filter_numeric_truthy", O.with_(
    O.build("s", "events", [(WEEK_SQL, "week")], "user_id", VIEW_PURCHASE_SQL, 4096))
    + O.estimate("s", ["week"], "v0 - 3 > 0"))
def filter_numeric_truthy(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), by=WEEK(), k=4096)
    f = sk.withColumn("f", filter_tuples("sketch", "$0 - 3"))  # a number: kept when > 0
    return f.select("week", *est_cols("f"))


@query("filter_no_survivors", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id", [("value", "TRUE")], 64))
    + f"""SELECT a.event_type, a.est_keys AS f_est, a.theta AS f_theta,
       b.est_keys AS c_est, b.retained AS c_retained, b.theta AS c_theta
FROM ({O.estimate("s", ["event_type"], "v0 < 0")}) a
JOIN ({O.estimate("s", ["event_type"])}) b ON a.event_type = b.event_type""")
def filter_no_survivors(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric("value")],
                      by="event_type", k=64)
    f = sk.withColumn("f", filter_tuples("sketch", "$0 < 0"))
    c = f.withColumn("c", combine_sketches("f", "sketch"))
    return c.select("event_type",
                    F.round(sketch_estimate("f"), 6).alias("f_est"), F.col("f")["theta"].alias("f_theta"),
                    F.round(sketch_estimate("c"), 6).alias("c_est"),
                    sketch_retained("c").cast("bigint").alias("c_retained"),
                    F.col("c")["theta"].alias("c_theta"))


_THREE_SQL = [("value", f"event_type = '{t}'") for t in ("view", "click", "purchase")]


def _three():
    return [Metric("value", F.col("event_type") == t) for t in ("view", "click", "purchase")]


@query("collapse_sum", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id", _THREE_SQL, 4096))
    + O.estimate("s", ["event_type"],
                 extra=[("round(coalesce(sum(e.v0 + e.v1 + e.v2), 0), 2)", "total")]))
def collapse_sum(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", _three(), by="event_type", k=4096)
    c = sk.withColumn("c", collapse_tuples("sketch", "$0 + $1 + $2"))
    return c.select("event_type", *est_cols("c"),
                    F.round(sketch_slot_sum("c", 0), 2).alias("total"))


@query("collapse_null_to_zero", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id", _THREE_SQL, 4096))
    + O.estimate("s", ["event_type"], extra=[("CAST(0.0 AS DOUBLE)", "total")]))
def collapse_null_to_zero(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", _three(), by="event_type", k=4096)
    c = sk.withColumn("c", collapse_tuples("sketch", "$9"))  # no slot 9: null -> 0.0
    return c.select("event_type", *est_cols("c"),
                    F.round(sketch_slot_sum("c", 0), 2).alias("total"))


@query("chain_filter_collapse_filter", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id",
            [("1.0", "event_type = 'view'"), ("value", "event_type = 'purchase'")], 64))
    + O.estimate("s", ["event_type"], "v0 >= 1 AND v0 * 2 + v1 > 10",
                 extra=[("round(coalesce(sum(e.v0 * 2 + e.v1), 0), 2)", "total")]))
def chain_filter_collapse_filter(spark, sf):
    ms = [Metric(F.lit(1.0), F.col("event_type") == "view"),
          Metric("value", F.col("event_type") == "purchase")]
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", ms, by="event_type", k=64)
    out = transform_chain(sk, "sketch", [("filter", "$0 >= 1"), ("collapse", "$0 * 2 + $1"),
                                         ("filter", "$0 > 10")], out="c")
    return out.select("event_type", *est_cols("c"),
                      F.round(sketch_slot_sum("c", 0), 2).alias("total"))


@query("filter_outer_aggregate", O.with_(
    O.build("s", "events", [("event_type", "event_type")], "user_id", [("value", "TRUE")], 64),
    """a AS (SELECT th.event_type, sum(e.v0) / count(e.h) AS avg_v,
    CAST(count(e.h) AS DOUBLE) / (CAST(th.theta AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE)) AS est_all
  FROM s_th th LEFT JOIN s_e e ON th.event_type = e.event_type GROUP BY th.event_type, th.theta)""",
    "x_th AS (SELECT * FROM s_th)",
    "x_e AS (SELECT s_e.*, a.avg_v, a.est_all FROM s_e JOIN a ON s_e.event_type = a.event_type)")
    + O.estimate("x", ["event_type"], "v0 > avg_v AND est_all >= 1"))
def filter_outer_aggregate(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric("value")],
                      by="event_type", k=64)
    sk = sk.withColumn("avg_v", sketch_slot_sum("sketch", 0) / sketch_retained("sketch")) \
           .withColumn("est_all", sketch_estimate("sketch"))
    # avg_v and est_all are other columns of the same row (outer references).
    f = sk.withColumn("f", filter_tuples("sketch", "$0 > avg_v && est_all >= 1"))
    return f.select("event_type", *est_cols("f"))


@query("order_by_estimate", O.with_(
    O.build("s", "events", [(WEEK_SQL, "week")], "user_id", [("1.0", "TRUE")], 4096))
    + f"SELECT week, est_keys FROM ({O.estimate('s', ['week'])}) q "
      "ORDER BY est_keys DESC NULLS FIRST, week LIMIT 3")
def order_by_estimate_q(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric(F.lit(1.0))], by=WEEK(),
                      k=4096)
    top = order_by_estimate(sk, "sketch", ascending=False, then=["week"], limit=3)
    return top.select("week", F.round(sketch_estimate("sketch"), 6).alias("est_keys"))


# --- orders and lineitem -----------------------------------------------------

_ORDER_METRICS_SQL = [("1.0", "o_orderpriority = '1-URGENT'"), ("o_totalprice", "TRUE")]
_ORDER_COND = "$0 >= 2 && $1 > 300000"
_ORDER_COND_SQL = "v0 >= 2 AND v1 > 300000"
_YEAR_SQL = "CAST(year(o_orderdate) AS BIGINT)"


def _order_metrics():
    return [Metric(F.lit(1.0), F.col("o_orderpriority") == "1-URGENT"), Metric("o_totalprice")]


def _order_year():
    return F.year("o_orderdate").cast("bigint").alias("order_year")


@query("orders_customer_cohort", f"""
WITH t AS (
  SELECT {_YEAR_SQL} AS order_year, CAST(o_custkey AS VARCHAR) AS k,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS v0,
         sum(o_totalprice) AS v1
  FROM orders WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL
  GROUP BY 1, 2)
SELECT order_year, CAST(count(*) FILTER (WHERE {_ORDER_COND_SQL}) AS BIGINT) AS keys
FROM t GROUP BY order_year
""")
def orders_customer_cohort(spark, sf):
    return cohort_exact(table(spark, sf, "orders"), "o_custkey", _order_metrics(), _ORDER_COND,
                        by=_order_year())


@query("orders_customer_cohort_sketch", O.with_(
    O.build("s", "orders", [(_YEAR_SQL, "order_year")], "o_custkey", _ORDER_METRICS_SQL, 256))
    + O.estimate("s", ["order_year"], _ORDER_COND_SQL))
def orders_customer_cohort_sketch(spark, sf):
    c = cohort_sketch(table(spark, sf, "orders"), "o_custkey", _order_metrics(), _ORDER_COND,
                      by=_order_year(), k=256)
    return c.withColumn("est_keys", F.round("est_keys", 6))


_LI_METRICS_SQL = [("l_quantity", "TRUE"), ("l_extendedprice", "l_discount > 0.05")]
_LI_SQL = O.with_(O.build("s", "lineitem", [("l_returnflag", "l_returnflag")], "l_orderkey",
                          _LI_METRICS_SQL, 4096)) + O.estimate("s", ["l_returnflag"],
                                                               extra=_SLOT_SUMS)


def _li_metrics():
    return [Metric("l_quantity"), Metric("l_extendedprice", F.col("l_discount") > 0.05)]


@query("lineitem_order_sketch", _LI_SQL)
def lineitem_order_sketch(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_orderkey", _li_metrics(),
                      by="l_returnflag", k=4096)
    return sk.select("l_returnflag", *est_cols(), *_slot_sums())


@query("lineitem_order_sketch_presampled", _LI_SQL)
def lineitem_order_sketch_presampled(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_orderkey", _li_metrics(),
                      by="l_returnflag", k=4096, presample=True)
    return sk.select("l_returnflag", *est_cols(), *_slot_sums())


@query("exact_filter_collapse", """
WITH t AS (
  SELECT CAST(l_partkey AS VARCHAR) AS part_key, sum(l_quantity) AS v0,
         sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END) AS v1
  FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_partkey IS NOT NULL
  GROUP BY 1)
SELECT part_key, round(v0 * 2 + v1, 2) AS score FROM t WHERE v0 > 500
""")
def exact_filter_collapse(spark, sf):
    r = tuple_rollup(table(spark, sf, "lineitem"), "l_partkey",
                     [Metric("l_quantity"), Metric("l_extendedprice", F.col("l_returnflag") == "R")])
    r = collapse_rows(filter_rows(r, "$0 > 500"), "$0 * 2 + $1")
    return r.select(F.col("key").alias("part_key"),
                    F.round(slot(F.col("values"), 0), 2).alias("score"))


# --- streaming: per-batch sketches kept current, then merged ----------------------

@query("stream_cohort_sketch", _cohort_sketch_sql(4096))
def stream_cohort_sketch(spark, sf):
    from ..streaming.incremental import read_stream_sketches, stream_sketches
    stream = _event_stream(spark, sf)
    path = scratch_path(spark, "stream-weekly-sketches")
    q = stream_sketches(stream, path, "user_id", VIEW_PURCHASE(), by=WEEK(), k=4096,
                        trigger={"availableNow": True})
    q.awaitTermination()
    merged = read_stream_sketches(spark, path, by="week", k=4096, num_values=2)
    f = merged.withColumn("cohort", filter_tuples("sketch", COHORT))
    return f.select("week", *est_cols("cohort"))


# --- skew: one key and one group each hold a third of all rows ---------------------

_SKEW_SRC = ("(SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS skew_key, "
             "CASE WHEN l_orderkey % 3 = 1 THEN 'hot' ELSE l_returnflag END AS skew_group "
             "FROM lineitem)")


def _skewed_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumn(
        "skew_key", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    ).withColumn(
        "skew_group", F.when(F.col("l_orderkey") % 3 == 1, F.lit("hot"))
        .otherwise(F.col("l_returnflag")))


@query("skewed_key_and_group_sketch", O.with_(
    O.build("s", _SKEW_SRC, [("skew_group", "skew_group")], "skew_key", _LI_METRICS_SQL, 1024))
    + O.estimate("s", ["skew_group"], extra=_SLOT_SUMS))
def skewed_key_and_group_sketch(spark, sf):
    sk = tuple_sketch(_skewed_lineitem(spark, sf), "skew_key", _li_metrics(), by="skew_group",
                      k=1024)
    return sk.select("skew_group", *est_cols(), *_slot_sums())


@query("skewed_key_rollup", f"""
SELECT CAST(skew_key AS VARCHAR) AS key, round(sum(l_quantity), 2) AS q_all,
       round(sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0.0 END), 2) AS price_disc
FROM {_SKEW_SRC} t
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND skew_key IS NOT NULL
GROUP BY 1
""")
def skewed_key_rollup(spark, sf):
    r = tuple_rollup(_skewed_lineitem(spark, sf), "skew_key", _li_metrics())
    return r.select("key", F.round(slot(F.col("values"), 0), 2).alias("q_all"),
                    F.round(slot(F.col("values"), 1), 2).alias("price_disc"))


# --- daily sketches merged to weeks, filtered after the merge -----------------------

@query("weekly_cohort_from_daily_sketches", O.with_(
    O.build("d", "events", [(DAY_SQL, "day"), (WEEK_SQL, "week")], "user_id",
            VIEW_PURCHASE_SQL, 64),
    O.merge("w", "d", ["week"], 2, 64)) + O.estimate("w", ["week"], COHORT_SQL))
def weekly_cohort_from_daily_sketches(spark, sf):
    daily = tuple_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), by=DAY(), k=64)
    daily = daily.withColumn("week", time_bucket("day", "week"))
    weekly = merge_sketches(daily, "sketch", by="week", k=64, num_values=2)
    f = weekly.withColumn("cohort", filter_tuples("sketch", COHORT))
    return f.select("week", *est_cols("cohort"))


# --- presampling with a metric that is null for most keys ----------------------------

_RARE_SQL = [("CASE WHEN l_orderkey % 20 = 0 THEN l_quantity END", "TRUE")]


def _rare_metric():
    return [Metric(F.when(F.col("l_orderkey") % 20 == 0, F.col("l_quantity")))]


@query("presample_null_metric", O.with_(
    O.build("s", "lineitem", [("l_returnflag", "l_returnflag")], "l_orderkey", _RARE_SQL, 64))
    + O.estimate("s", ["l_returnflag"]))
def presample_null_metric(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_orderkey", _rare_metric(), by="l_returnflag", k=64,
                      presample=True)
    return sk.select("l_returnflag", *est_cols())


@query("presample_null_metric_ungrouped", O.with_(
    O.build("s", "lineitem", [], "l_orderkey", _RARE_SQL, 64)) + O.estimate("s", []))
def presample_null_metric_ungrouped(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_orderkey", _rare_metric(), k=64, presample=True)
    return sk.select(*est_cols())


# --- merge of sketches of different sizes, and of a column that is not there ----------

@query("merge_mixed_k", O.with_(
    O.build("a", "(SELECT * FROM events WHERE event_id % 2 = 0)", [("event_type", "event_type")], "user_id",
            [("1.0", "TRUE")], 64),
    O.build("b", "(SELECT * FROM events WHERE coalesce(event_id % 2, 1) <> 0)", [("event_type", "event_type")], "user_id",
            [("1.0", "TRUE")], 1024),
    "p_th AS (SELECT * FROM a_th UNION ALL SELECT * FROM b_th)",
    "p_e AS (SELECT * FROM a_e UNION ALL SELECT * FROM b_e)",
    O.merge("m", "p", ["event_type"], 1, 64)) + O.estimate("m", ["event_type"]))
def merge_mixed_k(spark, sf):
    ev = table(spark, sf, "events")
    # The whole table, half of it in small sketches and half (null and negative odd ids included) in large ones.
    odd = F.coalesce(F.col("event_id") % 2, F.lit(1)) != 0
    parts = [tuple_sketch(ev.where(rows), "user_id", [Metric(F.lit(1.0))], by="event_type", k=k)
             for rows, k in ((~odd, 64), (odd, 1024))]
    merged = merge_sketches(parts[0].unionByName(parts[1]), "sketch", by="event_type", k=64)
    return merged.select("event_type", *est_cols())


@query("missing_sketch_empty", f"""
SELECT DISTINCT event_type, CAST(0 AS DOUBLE) AS est_keys, CAST(0 AS BIGINT) AS retained,
       CAST({O.T60} AS BIGINT) AS theta FROM events
""")
def missing_sketch_empty(spark, sf):
    merged = merge_sketches(table(spark, sf, "events"), "no_such_sketch", by="event_type", out="sketch",
                            missing_ok=True)
    return merged.select("event_type", *est_cols())


# --- logic over numbers, ratios -------------------------------------------------------

def _weekly_sql(cond=None, extra=()):
    return O.with_(O.build("s", "events", [(WEEK_SQL, "week")], "user_id", VIEW_PURCHASE_SQL, 4096)) \
        + O.estimate("s", ["week"], cond, extra)


def _weekly(spark, sf):
    return tuple_sketch(table(spark, sf, "events"), "user_id", VIEW_PURCHASE(), by=WEEK(), k=4096)


@query("expr_or_not", _weekly_sql("(v0 > 0 AND v1 > 3) OR NOT (v1 > 0)"))
def expr_or_not(spark, sf):
    f = _weekly(spark, sf).withColumn("f", filter_tuples("sketch", "$0 && $1 > 3 || !$1"))
    return f.select("week", *est_cols("f"))


@query("expr_numeric_logic", _weekly_sql("v0 - 3 > 0 AND (v1 > 2 OR v0 > 5)"))
def expr_numeric_logic(spark, sf):
    f = _weekly(spark, sf).withColumn("f", filter_tuples("sketch", "($0 - 3) && ($1 > 2 || $0 > 5)"))
    return f.select("week", *est_cols("f"))


@query("expr_ratio", _weekly_sql(extra=[
    ("round(coalesce(sum(CASE WHEN e.v1 = 0 THEN 0 ELSE e.v0 / e.v1 END), 0), 6)", "ratio_sum")]))
def expr_ratio(spark, sf):
    c = _weekly(spark, sf).withColumn("c", collapse_tuples("sketch", "$0 / $1"))
    return c.select("week", *est_cols("c"), F.round(sketch_slot_sum("c", 0), 6).alias("ratio_sum"))


# --- a finalized estimate as an outer reference that splits the keys; an order with nulls ----

@query("filter_outer_estimate", O.with_(
    O.build("s", "events", [(WEEK_SQL, "week")], "user_id", [("1.0", "TRUE")], 4096),
    """a AS (SELECT th.week, CAST(count(e.h) AS DOUBLE) / (CAST(th.theta AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE))
    AS est_all FROM s_th th LEFT JOIN s_e e ON th.week = e.week GROUP BY th.week, th.theta)""",
    "x_th AS (SELECT * FROM s_th)", "x_e AS (SELECT s_e.*, a.est_all FROM s_e JOIN a ON s_e.week = a.week)")
    + O.estimate("x", ["week"], "v0 * 10 > est_all"))
def filter_outer_estimate(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric(F.lit(1.0))], by=WEEK(), k=4096)
    sk = sk.withColumn("est_all", sketch_estimate("sketch"))
    f = sk.withColumn("f", filter_tuples("sketch", "$0 * 10 > est_all"))
    return f.select("week", *est_cols("f"))


@query("order_by_estimate_nulls", O.with_(
    O.build("s", "events", [(DAY_SQL, "day")], "user_id", [("1.0", "TRUE")], 4096))
    + f"""SELECT day, CASE WHEN dayofmonth(day) % 7 = 0 THEN NULL ELSE est_keys END AS est_keys
FROM ({O.estimate('s', ['day'])}) q ORDER BY est_keys DESC NULLS FIRST, day LIMIT 12""".replace(
        "ORDER BY est_keys", "ORDER BY CASE WHEN dayofmonth(day) % 7 = 0 THEN NULL ELSE est_keys END"))
def order_by_estimate_nulls(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric(F.lit(1.0))], by=DAY(), k=4096)
    sk = sk.withColumn("sketch", F.when(F.dayofmonth("day") % 7 != 0, F.col("sketch")))
    top = order_by_estimate(sk, "sketch", ascending=False, then=["day"], limit=12)
    return top.select("day", F.round(sketch_estimate("sketch"), 6).alias("est_keys"))


# --- streams: a restart and a snapshot; the exact cohort with a watermark ---------------

def _event_stream(spark, sf):
    return stream_table(spark, f"{sf.rstrip('/')}/events.parquet")


@query("stream_restart_compact", _cohort_sketch_sql(4096))
def stream_restart_compact(spark, sf):
    from ..streaming.incremental import compact_sketches, read_stream_sketches, stream_sketches
    path = scratch_path(spark, "stream-restart-sketches")
    for _ in range(2):   # the second start finds nothing new
        stream_sketches(_event_stream(spark, sf), path, "user_id", VIEW_PURCHASE(), by=WEEK(), k=4096,
                        trigger={"availableNow": True}).awaitTermination()
    snapshot = scratch_path(spark, "stream-restart-snapshot")
    compact_sketches(spark, path, snapshot, by="week", k=4096, num_values=2)
    merged = read_stream_sketches(spark, path, by="week", k=4096, num_values=2, snapshot=snapshot)
    f = merged.withColumn("cohort", filter_tuples("sketch", COHORT))
    return f.select("week", *est_cols("cohort"))


@query("stream_cohort_exact", f"""
WITH t AS (
  SELECT {WEEK_SQL} AS bucket, CAST(user_id AS VARCHAR) AS k,
         {", ".join(f"sum(CASE WHEN {p} THEN {v} ELSE 0.0 END) AS v{i}" for i, (v, p) in enumerate(VIEW_PURCHASE_SQL))}
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)
SELECT bucket, CAST(count(*) FILTER (WHERE {COHORT_SQL}) AS BIGINT) AS keys FROM t
WHERE bucket + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY bucket
""")
def stream_cohort_exact_q(spark, sf):
    from ..streaming.incremental import stream_cohort_exact
    out = scratch_path(spark, "stream-cohort-exact")
    counted = stream_cohort_exact(_event_stream(spark, sf), "ts", "user_id", VIEW_PURCHASE(), COHORT)
    counted.writeStream.outputMode("append").option("checkpointLocation", out + "-checkpoint") \
        .trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    return spark.read.schema(counted.schema).parquet(out)


# --- bounded partial results of the build; parameters as they are checked ----------------

@query("lineitem_order_sketch_bounded", _LI_SQL)
def lineitem_order_sketch_bounded(spark, sf):
    sk = tuple_sketch(table(spark, sf, "lineitem"), "l_orderkey", _li_metrics(), by="l_returnflag", k=4096,
                      partials="bounded")
    return sk.select("l_returnflag", *est_cols(), *_slot_sums())


@query("parameter_checks", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(5 AS INTEGER) AS rejected FROM events GROUP BY event_type
""")
def parameter_checks(spark, sf):
    ev, one = table(spark, sf, "events"), [Metric(F.lit(1.0))]
    wrong = [lambda: tuple_sketch(ev, "user_id", []), lambda: tuple_sketch(ev, "user_id", one, k=100),
             lambda: tuple_sketch(ev, "user_id", one, num_values=2), lambda: tuple_sketch(ev, "no_such_column", one),
             lambda: Metric(None)]
    rejected = 0
    for build in wrong:
        try:
            build()
        except ValueError:
            rejected += 1
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("rejected", F.lit(rejected))


# --- set operations, bounds ----------------------------------------------------------------

def _halves_sql(k: int) -> list[str]:
    """Sketches of the two halves of the day per type (CTEs a, b), and their common theta (t)."""
    return [O.build("a", "(SELECT * FROM events WHERE coalesce(hour(ts) < 12, false))", [("event_type", "event_type")],
                    "user_id", _DAILY_SQL_METRICS, k),
            O.build("b", "(SELECT * FROM events WHERE NOT coalesce(hour(ts) < 12, false))", [("event_type", "event_type")],
                    "user_id", _DAILY_SQL_METRICS, k),
            f"""t AS (SELECT event_type, least(coalesce(a.theta, {O.T60}), coalesce(b.theta, {O.T60})) AS theta
  FROM a_th a FULL JOIN b_th b USING (event_type))""",
            "i_th AS (SELECT * FROM t)", "d_th AS (SELECT * FROM t)",
            """i_e AS (SELECT a.event_type, a.h, a.v0 + b.v0 AS v0, a.v1 + b.v1 AS v1 FROM a_e a
  JOIN b_e b ON a.event_type = b.event_type AND a.h = b.h JOIN t ON t.event_type = a.event_type AND a.h < t.theta)""",
            """d_e AS (SELECT a.* FROM a_e a JOIN t ON t.event_type = a.event_type AND a.h < t.theta
  WHERE NOT EXISTS (SELECT 1 FROM b_e b WHERE a.event_type = b.event_type AND a.h = b.h))"""]


def _set_sql(k: int) -> str:
    return O.with_(*_halves_sql(k)) + f"""SELECT x.event_type, x.est_keys AS both_est, x.theta AS both_theta, x.v0_sum AS both_v0,
  x.v1_sum AS both_v1, y.est_keys AS only_est, y.theta AS only_theta, y.v0_sum AS only_v0, y.v1_sum AS only_v1
FROM ({O.estimate('i', ['event_type'], extra=_SLOT_SUMS)}) x
JOIN ({O.estimate('d', ['event_type'], extra=_SLOT_SUMS)}) y USING (event_type)"""


def _halves(spark, sf, k):
    am = F.coalesce(F.hour("ts") < 12, F.lit(False)).alias("am")
    halves = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(), by=["event_type", am], k=k)
    return halves.groupBy("event_type").agg(
        F.first(F.when(F.col("am"), F.col("sketch")), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("am"), F.col("sketch")), ignorenulls=True).alias("b"))


def _sets(spark, sf, k):
    s = _halves(spark, sf, k).select("event_type", intersect_sketches("a", "b").alias("i"), a_not_b("a", "b").alias("d"))
    out = [F.col("event_type")]
    for c, name in (("i", "both"), ("d", "only")):
        out += [F.round(sketch_estimate(c), 6).alias(f"{name}_est"), F.col(c)["theta"].alias(f"{name}_theta"),
                *[F.round(sketch_slot_sum(c, j), 2).alias(f"{name}_v{j}") for j in (0, 1)]]
    return s.select(*out)


@query("set_operations_sampled", _set_sql(64))
def set_operations_sampled(spark, sf):
    return _sets(spark, sf, 64)


@query("set_operations_exact", _set_sql(4096))
def set_operations_exact(spark, sf):
    return _sets(spark, sf, 4096)


@query("intersect_weeks", O.with_(
    O.build("w", "events", [("event_type", "event_type"), (WEEK_SQL, "week")], "user_id", [("1.0", "TRUE")], 64),
    "n AS (SELECT event_type, count(*) AS n, min(theta) AS theta FROM w_th GROUP BY event_type)",
    "i_th AS (SELECT event_type, theta FROM n)",
    """i_e AS (SELECT e.event_type, e.h, sum(e.v0) AS v0 FROM w_e e JOIN n ON n.event_type = e.event_type AND e.h < n.theta
  GROUP BY e.event_type, e.h, n.n HAVING count(*) = n.n)""")
    + O.estimate("i", ["event_type"], extra=[("round(coalesce(sum(e.v0), 0), 2)", "v0_sum")]))
def intersect_weeks(spark, sf):
    weekly = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric(F.lit(1.0))], by=["event_type", WEEK()], k=64)
    every = intersect_groups(weekly, "sketch", by="event_type", k=64)
    return every.select("event_type", *est_cols(), F.round(sketch_slot_sum("sketch", 0), 2).alias("v0_sum"))


@query("estimate_bounds", O.with_(
    O.build("s", "events", [("event_type", "event_type"), (DAY_SQL, "day")], "user_id", [("value", "TRUE")], 64),
    f"""x AS (SELECT th.event_type, th.day, CAST(count(e.h) AS DOUBLE) AS n,
    CAST(th.theta AS DOUBLE) / CAST({O.T60} AS DOUBLE) AS p, coalesce(sum(e.v0), 0) AS s, coalesce(sum(e.v0 * e.v0), 0) AS ss
  FROM s_th th LEFT JOIN s_e e ON {O.nse('th', 'e', ['event_type', 'day'])} GROUP BY th.event_type, th.day, th.theta)""")
    + """SELECT event_type, day, round(greatest(n, (2 * n + 4 * (1 - p) - sqrt(4 * (1 - p) * (4 * (1 - p) + 4 * n))) / (2 * p)), 4) AS lower,
  round((2 * n + 4 * (1 - p) + sqrt(4 * (1 - p) * (4 * (1 - p) + 4 * n))) / (2 * p), 4) AS upper,
  round(s / p, 2) AS total, round(s / p - 2 * sqrt((1 - p) * ss) / p, 2) AS total_lower, round(s / nullif(n, 0), 8) AS mean
FROM x""")
def estimate_bounds(spark, sf):
    sk = tuple_sketch(table(spark, sf, "events"), "user_id", [Metric("value")], by=["event_type", DAY()], k=64)
    b = sketch_bounds("sketch")
    return sk.select("event_type", "day", F.round(b["lower"], 4).alias("lower"), F.round(b["upper"], 4).alias("upper"),
                     F.round(sketch_sum("sketch", 0), 2).alias("total"),
                     F.round(sketch_sum_bounds("sketch", 0)["lower"], 2).alias("total_lower"),
                     F.round(sketch_mean("sketch", 0), 8).alias("mean"))


# --- stored index for any range of days; a lattice of groupings; certain top groups --------

_RANGE = (datetime.date(2024, 1, 4), datetime.date(2024, 1, 28))


@query("dyadic_range", O.with_(
    O.build("d", "events", [("event_type", "event_type"), (DAY_SQL, "day")], "user_id", _DAILY_SQL_METRICS, 64),
    f"r_th AS (SELECT * FROM d_th WHERE day BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}')",
    f"r_e AS (SELECT * FROM d_e WHERE day BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}')",
    O.merge("m", "r", ["event_type"], 2, 64)) + O.estimate("m", ["event_type"], extra=_SLOT_SUMS))
def dyadic_range(spark, sf):
    daily = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(), by=["event_type", DAY()], k=64)
    index = write_dyadic(daily, scratch_path(spark, "dyadic"), by=["event_type"], k=64, num_values=2)
    return index.merged(*_RANGE).select("event_type", *est_cols(), *_slot_sums())


_CUBE = ["l_returnflag", "l_linestatus", "l_year"]
_CUBE_SRC = "(SELECT *, CAST(year(l_shipdate) AS BIGINT) AS l_year FROM lineitem)"


def _cube_sql() -> str:
    from itertools import combinations
    ctes, selects = [], []
    for r in range(len(_CUBE), -1, -1):
        for j, by in enumerate(combinations(_CUBE, r)):
            name = f"g{r}{j}"
            ctes.append(O.build(name, _CUBE_SRC, [(c, c) for c in by], "l_partkey", [("l_quantity", "TRUE")], 256))
            cols = ", ".join(c if c in by else f"CAST(NULL AS {'BIGINT' if c == 'l_year' else 'VARCHAR'}) AS {c}" for c in _CUBE)
            bits = sum(1 << (len(_CUBE) - 1 - i) for i, c in enumerate(_CUBE) if c not in by)
            est = O.estimate(name, list(by), extra=[("round(coalesce(sum(e.v0), 0), 2)", "v0_sum")])
            selects.append(f"SELECT {cols}, CAST({bits} AS BIGINT) AS grouping_id, est_keys, retained, theta, v0_sum FROM ({est}) q")
    return O.with_(*ctes) + "\nUNION ALL ".join(selects)


@query("cube_sketches", _cube_sql())
def cube_sketches_q(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_year", F.year("l_shipdate").cast("bigint"))
    cube = cube_sketches(li, "l_partkey", [Metric("l_quantity")], _CUBE, k=256)
    return cube.select(*_CUBE, "grouping_id", *est_cols(), F.round(sketch_slot_sum("sketch", 0), 2).alias("v0_sum"))


@query("top_groups", O.with_(
    O.build("d", "orders", [("CAST(o_custkey % 97 AS BIGINT)", "desk"), (_YEAR_SQL, "order_year")], "o_custkey",
            [("o_totalprice", "TRUE")], 64),
    O.merge("m", "d", ["desk"], 1, 64)) + f"""SELECT desk, est_keys, retained, theta FROM ({O.estimate('m', ['desk'])}) q
ORDER BY est_keys DESC, desk LIMIT 10""")
def top_groups_q(spark, sf):
    parts = tuple_sketch(table(spark, sf, "orders"), "o_custkey", [Metric("o_totalprice")],
                         by=[(F.col("o_custkey") % 97).cast("bigint").alias("desk"), _order_year()], k=64)
    path = scratch_path(spark, "top-groups-parts")
    write_sketches(parts, path)
    return top_groups(read_sketches(spark, path), 10, by="desk", k=64).select("desk", *est_cols())


# --- sliding windows; a stream kept in tiers -------------------------------------------------

@query("sliding_week_by_day", O.with_(
    O.build("d", "events", [("event_type", "event_type"), (DAY_SQL, "day")], "user_id", _DAILY_SQL_METRICS, 64),
    """w AS (SELECT event_type, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS wday
  FROM d_th WHERE day IS NOT NULL GROUP BY event_type)""",
    *[f"""r_{x} AS (SELECT w.wday, d.* EXCLUDE (day), w.wday AS day FROM d_{x} d JOIN w
  ON d.event_type IS NOT DISTINCT FROM w.event_type AND d.day BETWEEN w.wday - 6 AND w.wday)""" for x in ("th", "e")],
    O.merge("m", "r", ["event_type", "day"], 2, 64)) + O.estimate("m", ["event_type", "day"], extra=_SLOT_SUMS))
def sliding_week_by_day(spark, sf):
    daily = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(), by=["event_type", DAY()], k=64)
    path = scratch_path(spark, "sliding-days")
    write_sketches(daily, path)
    week = sliding_sketches(read_sketches(spark, path), 7, by=["event_type"], k=64, num_values=2)
    return week.select("event_type", "day", *est_cols(), *_slot_sums())


@query("stream_sliding_weeks", O.with_(
    O.build("d", "events", [("event_type", "event_type"), (WEEK_SQL, "week")], "user_id", _DAILY_SQL_METRICS, 64),
    *[f"r_{x} AS (SELECT * FROM d_{x} WHERE week > (SELECT max(week) FROM d_th) - 21)" for x in ("th", "e")],
    O.merge("m", "r", ["event_type"], 2, 64)) + O.estimate("m", ["event_type"], extra=_SLOT_SUMS))
def stream_sliding_weeks(spark, sf):
    from ..streaming.tiers import SlidingSketches
    number = F.floor(F.datediff("week", F.lit(datetime.date(1970, 1, 5))) / 7).alias("period")
    weekly = tuple_sketch(table(spark, sf, "events"), "user_id", _daily_metrics(), by=["event_type", WEEK()], k=64)
    path = scratch_path(spark, "sliding-weeks")
    write_sketches(weekly.select("event_type", number, "sketch"), path, partition_by=["period"])
    parts = read_sketches(spark, path)
    kept = SlidingSketches(spark, scratch_path(spark, "sliding-kept"), 3, by=["event_type"], k=64, num_values=2)
    weeks = parts.where(F.col("period").isNotNull()).select("period").distinct().orderBy("period")   # folder names
    for row in weeks.toLocalIterator():
        kept.add(parts.where(F.col("period") == row[0]), row[0])
    return kept.merged().select("event_type", *est_cols(), *_slot_sums())


@query("stream_tiered_sketch", _cohort_sketch_sql(4096))
def stream_tiered_sketch(spark, sf):
    from ..streaming.tiers import TieredSketches, stream_tiered
    ev, source = table(spark, sf, "events"), scratch_path(spark, "stream-files")
    ev.repartition(6).write.parquet(source)              # a file is a micro-batch
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(source)
    tiers = TieredSketches(spark, scratch_path(spark, "stream-tiers"), by=["week"], k=4096, num_values=2, fan=2)
    stream_tiered(stream, tiers, "user_id", VIEW_PURCHASE(), by=WEEK(), trigger={"availableNow": True}).awaitTermination()
    f = tiers.merged().withColumn("cohort", filter_tuples("sketch", COHORT))
    return f.select("week", *est_cols("cohort"))
