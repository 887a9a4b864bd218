"""Build tuple sketches from raw rows (the filtered-doubles aggregation).

Every row's key is hashed; each task adds up its own tuples by (group, hash) and
keeps at most ``k + 2`` hashes a group (``partials``), so the first shuffle, on
(group, hash), is bounded by groups and tasks, not by keys.  After it the tuples
of conditional sums are exact, and the group's ``k`` smallest hashes are kept by
the bottom-k tail (second shuffle, on the group, bounded to ``k + 2`` rows per
task and group).  ``partials="all"`` leaves out the per-task limit: the key itself
is grouped, entirely in the JVM, and every distinct key goes through the first
shuffle (the better choice when groups are known to hold fewer than ``k`` keys).
``partials="auto"`` takes the bounded way from ``BOUNDED_FROM`` bytes of input on, as
the plan's own estimate has it: under that, all keys fit one shuffle anyway and the
limit only costs its Arrow batches.  The sketches are the same either way.

``presample=True`` adds a first pass for tables with many keys per group: an
HLL count of the distinct keys that count (complete metrics, valid key) per
group gives a loose threshold ``theta0`` (4x slack over ``k``); rows whose key
hash is above it are turned into markers *before* the first shuffle, so that
shuffle carries about ``4k`` keys per group instead of all of them.  The result equals the one-pass
build whenever more than ``k`` keys fall below ``theta0``, which the slack
makes the case unless the HLL count is off by a factor of four; if it ever is
not, the group's sketch is still a valid (exact-below-theta0) sketch with
``theta = theta0``.  The thresholds are a table of the groups with more than
``4k`` keys, so it has at most (all keys) / 4k rows; it is joined like any other
table and Spark picks a broadcast or a shuffle by its size.  No job runs while
the DataFrame is built.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K, THETA_MAX, check_hash_kind, key_hash
from ..functions.metrics import ColumnOrName, Metric, check_k, check_metrics
from ..functions.sketch import empty_sketch
from .bottomk import H, T, V, finish
from .partials import bounded_partials, can_bound, plan_bytes
from .rows import KEY, group_columns, group_names, has_column, hashed_key, prepared

PRESAMPLE_SLACK = 4
BOUNDED_FROM = 1 << 30
_T0 = "__tc_theta0"
_G = "__tc_g_"
_ONE = "__tc_one"

def tuple_sketch(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric],
                 by: Sequence[ColumnOrName] | ColumnOrName | None = None,
                 k: int = DEFAULT_K, hash: str = "md5", num_values: int | None = None,
                 presample: bool = False, missing_ok: bool = False,
                 out: str = "sketch",
                 fanout: int | None = None, partials: str = "auto") -> DataFrame:
    """``by..., out`` where ``out`` is a tuple sketch of at most ``k`` keys.

    ``metrics``: one :class:`Metric` per tuple slot.  ``missing_ok``: when the
    key column does not exist, return an empty sketch per group instead of
    raising.  ``hash``: ``"md5"`` (portable) or ``"xxhash64"`` (faster).
    ``fanout``: buckets of the two-level group limit (see ``bottomk``); None
    picks it from ``spark.sql.shuffle.partitions``.  ``partials``: ``"bounded"``,
    ``"all"`` or ``"auto"``, see above; group columns of types that tasks cannot group (floating
    point, nested) are built as ``"all"``."""
    if partials not in ("auto", "bounded", "all"):
        raise ValueError(f"partials must be 'auto', 'bounded' or 'all', got {partials!r}")
    metrics = check_metrics(metrics, num_values)
    check_k(k)
    check_hash_kind(hash)
    n = len(metrics)
    df, by_names = group_names(df, group_columns(by))

    if not has_column(df, key):
        if not missing_ok:
            raise ValueError(f"key column {key!r} not found; pass missing_ok=True for empty sketches")
        groups = df.select(*by_names).distinct() if by_names else \
            df.sparkSession.range(1).select()
        return groups.select(*by_names, empty_sketch(n, k, hash).alias(out))

    rows = prepared(df, by_names, key, metrics)
    sums = [F.sum(f"__tc_m{i}").alias(f"__tc_s{i}") for i in range(n)]
    def values(present):
        return F.when(present, F.array(*[F.col(f"__tc_s{i}") for i in range(n)]))

    theta0 = _presample_thresholds(df, by_names, key, metrics, k) if presample else None

    bounded = partials == "bounded" or (partials == "auto" and plan_bytes(df) >= BOUNDED_FROM)
    if theta0 is None and bounded and can_bound(rows, by_names):
        named = [f"__tc_m{i}" for i in range(n)]
        key_col = hashed_key(rows)
        # md5 is dear: tasks compute it once per distinct key; xxhash64 is cheaper than moving the key.
        of_key = key_col.cast("string").alias(KEY) if hash == "md5" else \
            F.when(F.col(KEY).isNotNull(), key_hash(key_col, hash)).alias(H)
        part = bounded_partials(rows.select(*by_names, of_key, *named), by_names, H, named, k,
                                key=KEY if hash == "md5" else None)
        agg = part.groupBy(*by_names, H).agg(*sums)
        tuples = agg.select(*by_names, H, values(F.col(H).isNotNull()).alias(V), F.lit(None).cast("bigint").alias(T))
    elif theta0 is None:
        agg = rows.groupBy(*by_names, KEY).agg(*sums)
        present = F.col(KEY).isNotNull()
        tuples = agg.select(*by_names, F.when(present, key_hash(hashed_key(rows), hash)).alias(H),
                            values(present).alias(V), F.lit(None).cast("bigint").alias(T))
    else:
        h = key_hash(hashed_key(rows), hash)
        hashed = rows.withColumn(_ONE, F.lit(0))
        cond = F.col(_ONE) == theta0[_G + "one"]
        for i, b in enumerate(by_names):
            cond = cond & F.col(b).eqNullSafe(theta0[f"{_G}{i}"])
        hashed = hashed.join(theta0, cond, "left").select(rows["*"], theta0[_T0].alias(T))
        hashed = hashed.withColumn(T, F.coalesce(T, F.lit(THETA_MAX)))
        hashed = hashed.withColumn(H, F.when(F.col(KEY).isNotNull() & (h < F.col(T)), h))
        agg = hashed.groupBy(*by_names, H).agg(*sums, F.min(T).alias(T))
        tuples = agg.select(*by_names, H, values(F.col(H).isNotNull()).alias(V), T)

    return finish(tuples, by_names, k, n, hash, out=out, fanout=fanout)


def _presample_thresholds(df: DataFrame, by: list[str], key: ColumnOrName,
                          metrics: Sequence[Metric], k: int) -> DataFrame:
    """``__tc_g_one`` (constant), ``__tc_g_0..`` (the group) and ``__tc_theta0`` of the groups with
    more than ``PRESAMPLE_SLACK * k`` keys.  Only keys that the build keeps are counted."""
    keyed = prepared(df, by, key, metrics, keep_invalid=False)
    target = float(PRESAMPLE_SLACK * k)
    groups = [F.lit(0).alias(_G + "one"), *[F.col(b).alias(f"{_G}{i}") for i, b in enumerate(by)]]
    n = F.col("__tc_n")
    counts = keyed.select(*groups, KEY).groupBy(_G + "one", *[f"{_G}{i}" for i in range(len(by))]) \
                  .agg(F.approx_count_distinct(F.col(KEY), 0.02).alias("__tc_n")).where(n > target)
    t0 = (F.lit(float(THETA_MAX)) * (F.lit(target) / n)).cast("bigint")
    return counts.select(_G + "one", *[f"{_G}{i}" for i in range(len(by))], t0.alias(_T0))
