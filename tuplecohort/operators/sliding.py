"""Sketches over a sliding window of days, for every day at once.

A window of w days is cut by the binary digits of w (7 = 4 + 2 + 1).  Sketches of 1, 2, 4, ... days that end on any day
are merged from two of half their length, and each window from one per digit that is set.  So an entry is shuffled
about 2 log2(w) times instead of w times, and what is shuffled after the first merge is bounded by k a group and day.
Parts of a window never overlap, so sums count every day once.

Defined cases: a day without a sketch has windows too as long as one of its last w days has one (its own day counts as
empty); rows with a null day are left out; several rows of a day are merged; a gap of
w days or more has days without a row; rows end with a group's last sketch, or w - 1 days later with ``tail=True``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K
from ..functions.metrics import check_k
from ..sources.store import as_sketch_column
from .merge import merge_sketches


def sliding_sketches(daily: DataFrame, window: int, day: str = "day", by: Sequence[str] = (), sketch: str = "sketch",
                     k: int = DEFAULT_K, num_values: int = 1, tail: bool = False) -> DataFrame:
    """``by..., day DATE, sketch``: per group and day, the merged sketch of the ``window`` days that end on it."""
    if window < 1:
        raise ValueError("window must be 1 or more")
    check_k(k)
    by = list(by)
    groups = [*by, day]
    one = as_sketch_column(daily, sketch).where(F.col(day).isNotNull()) \
        .select(*by, F.col(day).cast("date").alias(day), sketch)

    def merged(df: DataFrame) -> DataFrame:
        return merge_sketches(df, sketch, by=groups, k=k, num_values=num_values)

    def later(df: DataFrame, days: int) -> DataFrame:
        return df.withColumn(day, F.date_add(day, days))

    span, size, done, parts = merged(one), 1, 0, []
    while True:
        if window & size:                 # the part of this digit ends ``done`` days before the window does
            parts.append(later(span, done))
            done += size
        if 2 * size > window:
            break
        span, size = merged(span.unionByName(later(span, size))), 2 * size
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    result = merged(every)
    if tail:
        return result
    ends = one.groupBy(*[F.col(c).alias(f"__tc_b{i}") for i, c in enumerate(by)]).agg(F.max(day).alias("__tc_last"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__tc_b{i}"))
    return result.join(ends, same & (F.col(day) <= F.col("__tc_last")), "left_semi")
