"""The bottom-k tail shared by build and merge.

Input: one row per (group, hash) with its summed tuple, plus at most one
*marker* row per group (``h`` null) that carries the group's incoming
theta in ``_t``.  Rows may also carry ``_t`` themselves (it is constant per
group).  Output: one sketch per group.

Plan: ``row_number() over (partition by group order by h nulls first) <= k+2``
becomes a partial group limit before the shuffle and a final one after it, so
even a group holding every key of the table moves at most ``k + 2`` rows per
upstream task; the final ``collect_list`` sees at most ``k + 2`` rows per group.

With P upstream partitions the last task of a hot group still reads up to
``P * (k + 2)`` rows.  For large P a second level splits that: rows are first
limited per (group, bucket), where bucket = upstream partition id mod F,
then per group, so no task reads more than about ``max(P / F, F) * (k + 2)``
rows rows.  F follows from what the last task would read, ``P * (k + 2)`` rows, over
the rows one task should read (``TASK_ROWS``), and is sqrt(P) at most.  The
bottom k+2 of a group is contained in the union of the bottom k+2 of its
buckets, so the result is the same; the price is one more (bounded) exchange,
which F = 1 saves.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import THETA_MAX
from ..functions.sketch import make_sketch
from ..session import ensure_group_limit

# Internal column names (reserved prefix, so user group columns never clash).
H = "__tc_h"          # 60-bit key hash; null marks a group-marker row
V = "__tc_values"     # tuple (ARRAY<DOUBLE>)
T = "__tc_theta"      # incoming theta (markers, or constant per group)
HK = "__tc_hashkind"  # hash kind code carried per row (merge)
_CONST_GROUP = "__tc_g"
_BUCKET = "__tc_b"
_RN1 = "__tc_rn1"
_RN = "__tc_rn"
_E = "__tc_e"
TASK_ROWS = 2_000_000


def auto_fanout(spark, k: int) -> int:
    """Buckets for the two-level limit, from the rows that its last task would read.

    With AQE the initial partition count may be set separately; the larger
    of the two is what an exchange starts from."""
    p = 0
    for key in ("spark.sql.shuffle.partitions",
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        try:
            p = max(p, int(spark.conf.get(key, None) or 0))
        except ValueError:
            pass
    return max(1, min(math.ceil(p * (k + 2) / TASK_ROWS), math.ceil(math.sqrt(p))))


def finish(rows: DataFrame, by: list[str], k: int, num_values, hash_kind,
           out: str = "sketch", fanout: int | None = None) -> DataFrame:
    """``by..., out`` with one sketch per group of ``rows`` (columns ``by..., H, V, T``).

    ``hash_kind``: a string, or a function mapping the rows' ``HK`` column
    (aggregated per group) to the hash kind."""
    ensure_group_limit(rows.sparkSession, k)
    part = list(by)
    if not part:
        rows = rows.withColumn(_CONST_GROUP, F.lit(0))
        part = [_CONST_GROUP]
    fanout = auto_fanout(rows.sparkSession, k) if fanout is None else fanout
    order = F.col(H).asc_nulls_first()
    if fanout > 1:
        bucketed = rows.withColumn(_BUCKET, F.pmod(F.spark_partition_id(), F.lit(fanout)))
        w1 = Window.partitionBy(*part, _BUCKET).orderBy(order)
        rows = bucketed.withColumn(_RN1, F.row_number().over(w1)) \
            .where(F.col(_RN1) <= k + 2).drop(_RN1, _BUCKET)
    w = Window.partitionBy(*part).orderBy(order)
    limited = rows.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= k + 2)
    entry = F.when(F.col(H).isNotNull(),
                   F.struct(F.col(H).alias("h"), F.col(V).alias("values")))
    carried = [F.max(HK).alias(HK)] if callable(hash_kind) else []
    grouped = limited.groupBy(*part).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, k + 1).alias(_E),
        F.coalesce(F.min(T), F.lit(THETA_MAX)).alias(T),
        *carried,
    )
    # Entries below the group's incoming theta (a suffix of the sorted list is
    # cut); then the new theta is the (k+1)-th hash when there is one.
    kept = F.filter(_E, lambda e: e["h"] < F.col(T))
    n = F.size(kept)
    theta = F.when(n > k, F.element_at(kept, k + 1)["h"]).otherwise(F.col(T))
    num_values = num_values if not isinstance(num_values, int) else F.lit(num_values)
    if callable(hash_kind):  # carried per row (constant per group)
        hash_kind = hash_kind(F.col(HK))
    else:
        hash_kind = F.lit(hash_kind)
    sketch = make_sketch(theta, F.lit(k), num_values, hash_kind, F.slice(kept, 1, k))
    return grouped.select(*by, sketch.alias(out))
