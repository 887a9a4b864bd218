"""Intersection of all the sketches of a group (rows of one table)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K, THETA_MAX
from ..functions.metrics import ColumnOrName, check_k
from ..functions.sketch import ENTRIES_TYPE, make_sketch
from .merge import hash_code, hash_name
from .rows import group_columns, group_names

_X, _G = "__tc_x", "__tc_one"


def intersect_groups(df: DataFrame, sketch: str = "sketch",
                     by: Sequence[ColumnOrName] | ColumnOrName | None = None, k: int = DEFAULT_K,
                     num_values: int = 1, out: str | None = None) -> DataFrame:
    """``by..., out``: the keys that every sketch of the group holds, tuples summed.

    Plan: one aggregate for the groups' smallest theta and number of sketches; entries below that theta are
    counted per (group, hash) with partial counts, and those in every sketch are kept.  At most the entries of
    one sketch are left per group, so the final list is bounded by ``k``.  A null sketch counts as empty: its
    group has an empty intersection.  Widths other than ``num_values`` and mixed hash kinds raise."""
    out = out or sketch
    check_k(k)
    df, by_names = group_names(df, group_columns(by))
    n = num_values
    df = df.withColumn(_G, F.lit(0))          # a group of its own when there are no others
    part, keys = [*by_names, _G], [f"__tc_b{i}" for i in range(len(by_names) + 1)]
    s = F.col(sketch)
    theta = F.when(s["num_values"] != F.lit(n), F.raise_error(F.concat(
        F.lit(f"cannot intersect sketches: expected num_values={n}, got "), s["num_values"].cast("string")))
        .cast("bigint")).otherwise(s["theta"])
    head = df.select(*part, theta.alias("__tc_t"), F.when(s.isNotNull(), hash_code(s["hash"])).alias("__tc_c"))
    head = head.groupBy(*part).agg(
        F.coalesce(F.min("__tc_t"), F.lit(THETA_MAX)).alias("__tc_t"), F.count(F.lit(1)).alias("__tc_n"),
        F.min("__tc_c").alias("__tc_lo"), F.max("__tc_c").alias("__tc_hi"))
    mixed = F.raise_error(F.lit("cannot intersect sketches built with different hash kinds")).cast("int")
    head = head.select(*part, "__tc_t", "__tc_n", F.when(F.col("__tc_lo") != F.col("__tc_hi"), mixed)
                       .otherwise(F.coalesce("__tc_lo", F.lit(0))).alias("__tc_c"))
    entries = df.select(*[F.col(b).alias(c) for b, c in zip(part, keys)], F.explode(s["entries"]).alias(_X)) \
                .select(*keys, F.col(_X)["h"].alias("__tc_h"), F.col(_X)["values"].alias("__tc_v"))
    met = entries.groupBy(*keys, "__tc_h").agg(F.count(F.lit(1)).alias("__tc_m"),
                                                *[F.sum(F.get("__tc_v", i)).alias(f"__tc_s{i}") for i in range(n)])
    same = F.lit(True)
    for b, c in zip(part, keys):
        same = same & F.col(b).eqNullSafe(F.col(c))
    # Only what is in every sketch, below the group's theta: no more entries than the smallest sketch has.
    met = met.join(head, same & (F.col("__tc_m") == F.col("__tc_n")) & (F.col("__tc_h") < F.col("__tc_t")), "inner") \
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
                 F.col("__tc_h").alias("h"), F.array(*[F.col(f"__tc_s{i}") for i in range(n)]).alias("values")))).alias("__tc_e"))
    found = head.join(met, same, "left")
    kept = F.coalesce(F.col("__tc_e"), F.array().cast(ENTRIES_TYPE))
    theta = F.when(F.size(kept) > k, F.element_at(kept, k + 1)["h"]).otherwise(F.col("__tc_t"))
    result = make_sketch(theta, F.lit(k), F.lit(n), hash_name(F.col("__tc_c")), F.slice(kept, 1, k))
    return found.select(*by_names, result.alias(out))
