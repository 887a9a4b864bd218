"""The groups with the highest estimates, merging only groups that can be among them.

The estimate of a merged sketch is bounded by the sizes and thetas of its parts alone.
With t the smallest theta of a group's parts, c the most entries of a part that has
theta t, and s the entries of all its parts together:

* the estimate is c / t at least: those c keys are all below the merged theta t, or
  the merge keeps k keys of more than k, at a theta of t or less;
* if s is at most k, the merge samples nothing further, and the estimate is s / t at
  most.  Otherwise no bound is known and the group stays.

A group whose upper bound is below the n-th highest lower bound cannot be among the
first n.  The bounds read two leaves of the stored sketches (theta and the hashes, for
their number); entries with tuples are read, shuffled and merged for the groups that
are left.  Bounds are certain, so the result is that of ordering all merged sketches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K, THETA_MAX
from ..functions.metrics import check_k
from ..functions.sketch import sketch_estimate
from ..session import scratch_path
from .merge import merge_sketches

_P = "__tc_"


def group_bounds(df: DataFrame, sketch: str, by: Sequence[str], k: int) -> DataFrame:
    """``by..., __tc_lower, __tc_upper`` of the estimate of each group's merged sketch; upper is null if none is known."""
    s = F.col(sketch)
    rows = df.select(*by, F.coalesce(s["theta"], F.lit(THETA_MAX)).alias(_P + "t"),
                     F.coalesce(F.size(s["entries"]["h"]), F.lit(0)).cast("bigint").alias(_P + "n"))
    # The smallest theta, and of the parts that have it the one with the most entries.
    first = F.min(F.struct(F.col(_P + "t").alias("t"), (-F.col(_P + "n")).alias("n"))).alias(_P + "f")
    got = rows.groupBy(*by).agg(first, F.sum(_P + "n").alias(_P + "s"))
    share = F.col(_P + "f")["t"].cast("double") / F.lit(float(THETA_MAX))
    return got.select(*by, (F.least(-F.col(_P + "f")["n"], F.lit(k)) / share).alias(_P + "lower"),
                      F.when(F.col(_P + "s") <= k, F.col(_P + "s") / share).alias(_P + "upper"))


def top_groups(df: DataFrame, n: int, sketch: str = "sketch", by: Sequence[str] | str = (), k: int = DEFAULT_K,
               num_values: int = 1, name: str = "est_keys") -> DataFrame:
    """``by..., sketch, name``: the ``n`` groups with the highest estimates of their merged sketches, highest first,
    ties in the order of ``by``.  ``df`` has any number of sketches a group (null ones count as empty)."""
    by = [by] if isinstance(by, str) else list(by)
    check_k(k)
    if not by:
        raise ValueError("top_groups needs at least one group column")
    spark = df.sparkSession
    path = scratch_path(spark, "top-groups-bounds")
    group_bounds(df, sketch, by, k).write.parquet(path)
    bounds = spark.read.parquet(path)
    floor = bounds.orderBy(F.col(_P + "lower").desc()).limit(n).agg(
        F.min(_P + "lower").alias("lo"), F.count(F.lit(1)).alias("n")).first()      # one row
    if floor["n"] == n:
        # Doubles are rounded once on each side; the slack keeps a tie from being cut by a last digit.
        bounds = bounds.where(F.col(_P + "upper").isNull() | (F.col(_P + "upper") >= floor["lo"] * (1 - 1e-12)))
    left = bounds.select(*[F.col(b).alias(f"{_P}b{i}") for i, b in enumerate(by)])
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"{_P}b{i}"))
    merged = merge_sketches(df.join(left, same, "left_semi"), sketch, by=by, k=k, num_values=num_values)
    return merged.withColumn(name, sketch_estimate(F.col(sketch))) \
                 .orderBy(F.col(name).desc(), *[F.col(b).asc() for b in by]).limit(n)
