"""Cohort counts per time bucket: "keys with >= 4 views and >= 1 purchase".

Two forms of the same question:

* :func:`cohort_exact`: ``groupBy(bucket, key)`` with one conditional sum per
  metric, then ``count_if(cond)`` per bucket.  Two shuffles, both after
  partial aggregates; every bucket present in the input appears, with 0 when
  no key qualifies.
* :func:`cohort_sketch`: the same through a tuple sketch per bucket (bounded
  size, mergeable, storable), filtered by the condition and estimated.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import TupleExpr, predicate_on
from ..functions.metrics import ColumnOrName, Metric, check_metrics
from ..functions.sketch import filter_tuples, sketch_estimate, sketch_retained
from ..operators.build import DEFAULT_K, tuple_sketch
from ..operators.rows import KEY, group_columns, group_names, prepared


def time_bucket(ts: ColumnOrName, unit: str = "week") -> Column:
    """Start date of the ``unit`` bucket (ISO weeks start on Monday).

    Computed from the calendar date, so a ``TIMESTAMP_NTZ`` column buckets the
    same under any session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    d = F.to_date(c)
    if unit == "day":
        return d
    if unit == "week":
        return F.date_sub(d, F.weekday(d))
    if unit in ("month", "quarter", "year"):
        return F.trunc(d, unit)
    raise ValueError(f"unsupported bucket unit {unit!r}")


def cohort_exact(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric],
                 cond: TupleExpr, by: Sequence[ColumnOrName] | ColumnOrName,
                 name: str = "keys") -> DataFrame:
    """``by..., name BIGINT``: exact number of keys per group whose tuple meets ``cond``."""
    df, by_names = group_names(df, group_columns(by))
    metrics = check_metrics(metrics)
    rows = prepared(df, by_names, key, metrics)   # rows without a key keep their group
    sums = [F.sum(f"__tc_m{i}").alias(f"__tc_s{i}") for i in range(len(metrics))]
    tuples = rows.groupBy(*by_names, KEY).agg(*sums)
    tuples = tuples.select(*by_names, KEY, F.array(*[F.col(f"__tc_s{i}") for i in range(len(metrics))]).alias("__tc_values"))
    hit = F.col(KEY).isNotNull() & predicate_on("__tc_values", cond)
    return tuples.groupBy(*by_names).agg(F.count_if(hit).alias(name))


def cohort_sketch(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric],
                  cond: TupleExpr, by: Sequence[ColumnOrName] | ColumnOrName,
                  k: int = DEFAULT_K, hash: str = "md5", presample: bool = False,
                  name: str = "est_keys") -> DataFrame:
    """``by..., name DOUBLE, retained BIGINT, theta BIGINT``: estimated cohort size per group."""
    df, by_names = group_names(df, group_columns(by))
    sk = tuple_sketch(df, key, metrics, by=by_names, k=k, hash=hash, presample=presample,
                      out="__tc_sketch")
    c = filter_tuples("__tc_sketch", cond)
    return sk.select(
        *by_names,
        sketch_estimate(c).alias(name),
        sketch_retained(c).cast("bigint").alias("retained"),
        c["theta"].alias("theta"),
    )


def weekly_cohort(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric], cond: TupleExpr,
                  ts: ColumnOrName, exact: bool = True, k: int = DEFAULT_K, hash: str = "md5",
                  presample: bool = False) -> DataFrame:
    """The flagship question per ISO week: ``week DATE`` plus ``keys`` (exact) or
    ``est_keys, retained, theta`` (through a sketch)."""
    week = time_bucket(ts, "week").alias("week")
    if exact:
        return cohort_exact(df, key, metrics, cond, by=week)
    return cohort_sketch(df, key, metrics, cond, by=week, k=k, hash=hash, presample=presample)
