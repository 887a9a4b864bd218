"""Merge stored sketches: union within each group, summing tuples of equal keys.

Plan: every non-null input sketch yields, in one ``explode``, a marker row
(its theta) followed by its entries; one aggregate on (group, hash) sums the tuples slot by
slot and takes the smallest theta; the bottom-k tail then keeps the ``k``
smallest hashes below that theta.  Null sketches are skipped, and a group
of only empty or null sketches still yields an (empty) sketch.  Widths and hash kinds are checked per row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K, HASH_KINDS
from ..functions.metrics import ColumnOrName, check_k
from ..functions.sketch import ENTRIES_TYPE, empty_sketch
from .bottomk import H, HK, T, V, finish
from .rows import group_columns, group_names, has_column

_X = "__tc_x"


def merge_sketches(df: DataFrame, sketch: str = "sketch",
                   by: Sequence[ColumnOrName] | ColumnOrName | None = None,
                   k: int = DEFAULT_K, num_values: int = 1,
                   out: str | None = None, fanout: int | None = None,
                   missing_ok: bool = False) -> DataFrame:
    """``by..., out``: one merged sketch per group of ``df``.

    ``k`` (output size) and ``num_values`` (tuple width; other widths raise) are
    parameters and never read from the data, so building the DataFrame runs no job.
    ``missing_ok``: when the sketch column does not exist, return an empty sketch
    per group instead of raising."""
    out = out or sketch
    df, by_names = group_names(df, group_columns(by))
    check_k(k)
    n = num_values
    if not has_column(df, sketch):
        if not missing_ok:
            raise ValueError(f"sketch column {sketch!r} not found; pass missing_ok=True for empty sketches")
        groups = df.select(*by_names).distinct() if by_names else df.sparkSession.range(1).select()
        return groups.select(*by_names, empty_sketch(n, k).alias(out))
    sk = F.col(sketch)
    checked_theta = F.when(
        sk["num_values"] != F.lit(n),
        F.raise_error(F.concat(F.lit(f"cannot merge sketches: expected num_values={n}, got "),
                               sk["num_values"].cast("string")))).otherwise(sk["theta"])
    # Hash kind as a small integer, so every aggregate below stays a hash aggregate.
    code = F.when(sk.isNotNull(), hash_code(sk["hash"]))
    # One pass: each sketch yields a marker row (its theta) followed by its entries.
    # A null sketch yields only a marker without theta: it is skipped, but its
    # group still gets a (possibly empty) sketch.
    marker = F.struct(F.lit(None).cast("bigint").alias(H),
                      F.lit(None).cast("array<double>").alias(V),
                      checked_theta.alias(T), code.alias(HK))
    entries = F.transform(F.coalesce(sk["entries"], F.array().cast(ENTRIES_TYPE)), lambda e: F.struct(
        e["h"].alias(H), e["values"].alias(V),
        F.lit(None).cast("bigint").alias(T), code.alias(HK)))
    rows = df.select(*by_names, F.explode(F.concat(F.array(marker), entries)).alias(_X)) \
        .select(*by_names, *[F.col(_X)[c].alias(c) for c in (H, V, T, HK)])
    sums = [F.sum(F.get(F.col(V), i)).alias(f"__tc_s{i}") for i in range(n)]
    agg = rows.groupBy(*by_names, H).agg(
        *sums, F.min(T).alias(T), F.min(HK).alias("__tc_hcmin"), F.max(HK).alias("__tc_hcmax"))
    hash_kind = F.when(F.col("__tc_hcmin") != F.col("__tc_hcmax"),
                       F.raise_error(F.lit("cannot merge sketches built with different hash kinds"))
                       ).otherwise(F.col("__tc_hcmin"))
    values = F.when(F.col(H).isNotNull(), F.array(*[F.col(f"__tc_s{i}") for i in range(n)]))
    tuples = agg.select(*by_names, H, values.alias(V), T, hash_kind.alias(HK))
    return finish(tuples, by_names, k, n, lambda c: F.coalesce(hash_name(c), F.lit(HASH_KINDS[0])),
                  out=out, fanout=fanout)


def hash_code(name):
    whens = None
    for i, kind in enumerate(HASH_KINDS):
        whens = F.when(name == kind, F.lit(i)) if whens is None else whens.when(name == kind, F.lit(i))
    return whens.otherwise(F.raise_error(F.concat(F.lit("unknown hash kind "), name)))


def hash_name(code):
    whens = None
    for i, kind in enumerate(HASH_KINDS):
        whens = F.when(code == i, F.lit(kind)) if whens is None else whens.when(code == i, F.lit(kind))
    return whens
