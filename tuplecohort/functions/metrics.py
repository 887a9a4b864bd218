"""Filtered metrics: a numeric column paired with a row predicate.

A tuple holds one slot per metric.  For every input row each slot receives the
metric value when the row matches the metric's predicate and 0.0 otherwise.
Null rules (checked by the tests, one per rule):

* a null in *any* metric column drops the whole row, even for slots whose
  predicate does not match;
* a predicate that is false or null contributes 0.0, but the key still
  counts as present;
* null or empty keys are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True, eq=False)
class Metric:
    """One tuple slot: ``column`` summed over rows where ``where`` holds.

    ``where`` may be a boolean Column or a SQL string; it defaults to always
    true (an unfiltered metric).
    """

    column: ColumnOrName
    where: Union[Column, str, bool] = True
    name: str | None = field(default=None)

    def __post_init__(self):
        if self.column is None:
            raise ValueError("Metric needs a metric column")
        if self.where is None:
            raise ValueError("Metric needs a predicate; use True for an unfiltered metric")

    def value_column(self) -> Column:
        return as_column(self.column).cast("double")

    def predicate(self) -> Column:
        if isinstance(self.where, bool):
            return F.lit(self.where)
        if isinstance(self.where, str):
            return F.expr(self.where)
        return self.where

    def filtered(self) -> Column:
        """Value if the predicate matches, else 0.0 (a null predicate is no match)."""
        return F.when(self.predicate(), self.value_column()).otherwise(F.lit(0.0))


def check_metrics(metrics: Sequence[Metric], num_values: int | None = None) -> list[Metric]:
    metrics = list(metrics)
    if not metrics:
        raise ValueError("at least one Metric is required")
    for m in metrics:
        if not isinstance(m, Metric):
            raise TypeError(f"expected Metric, got {type(m).__name__}")
    if num_values is not None and num_values != len(metrics):
        raise ValueError(
            f"num_values={num_values} does not match the {len(metrics)} metric filters given")
    return metrics


def check_k(k: int) -> int:
    if not isinstance(k, int) or k < 16 or k & (k - 1):
        raise ValueError(f"k (nominal entries) must be a power of two >= 16, got {k!r}")
    return k


def rows_with_complete_metrics(metrics: Sequence[Metric]) -> Column:
    """True when no metric column is null (whole-row drop rule)."""
    cond = F.lit(True)
    for m in metrics:
        cond = cond & m.value_column().isNotNull()
    return cond


def valid_key(key: Column) -> Column:
    """A key counts unless it is null or the empty string."""
    k = key.cast("string")
    return k.isNotNull() & (k != F.lit(""))
