"""Exact tuple table: one row per (group, distinct key) with its tuple.

The exact twin of the sketch build: ``groupBy(by, key)`` with one conditional
sum per metric.  Catalyst plans a partial aggregate before the single shuffle,
so a hot key costs one row per map task, not one per input row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import TupleExpr, predicate_on, value_on
from ..functions.metrics import ColumnOrName, Metric, check_metrics
from .rows import KEY, group_columns, group_names, key_text, prepared


def tuple_rollup(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric],
                 by: Sequence[ColumnOrName] | ColumnOrName | None = None,
                 key_name: str = "key", values_name: str = "values") -> DataFrame:
    """``by..., key STRING, values ARRAY<DOUBLE>``: exact per-key tuples."""
    metrics = check_metrics(metrics)
    df, by_names = group_names(df, group_columns(by))
    rows = prepared(df, by_names, key, metrics, keep_invalid=False)
    sums = [F.sum(f"__tc_m{i}").alias(f"__tc_s{i}") for i in range(len(metrics))]
    agg = rows.groupBy(*by_names, KEY).agg(*sums)
    return agg.select(
        *by_names,
        key_text(F.col(KEY)).alias(key_name),
        F.array(*[F.col(f"__tc_s{i}") for i in range(len(metrics))]).alias(values_name),
    )


def filter_rows(df: DataFrame, pred: TupleExpr, values: str = "values") -> DataFrame:
    """Exact-table filter: keep keys whose tuple satisfies ``pred``."""
    return df.where(predicate_on(values, pred))


def collapse_rows(df: DataFrame, expr: TupleExpr, values: str = "values") -> DataFrame:
    """Exact-table collapse: replace each tuple by ``[expr]`` (null -> 0.0)."""
    return df.withColumn(values, F.array(value_on(values, expr)))


def count_keys(df: DataFrame, by: Sequence[str] | str | None = None,
               name: str = "keys") -> DataFrame:
    """Distinct keys per group of an exact tuple table (the exact estimate)."""
    by = group_columns(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
