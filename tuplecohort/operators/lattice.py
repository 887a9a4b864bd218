"""Sketches for many groupings of the same columns, each merged from a finer one.

One scan builds the sketches of the finest grouping; every coarser grouping merges
those of the smallest grouping already there that has all its columns (fewest
sketches), so entries are shuffled once per step of the lattice and not once per
grouping from the bottom: a cube over n columns reads the raw rows once, and each
of its 2^n - 1 merges starts from bounded sketches.  Each grouping is written to the
checkpoint folder before others read it, so none is computed twice and a lost
executor costs no more than its tasks.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_K
from ..functions.metrics import ColumnOrName, Metric
from ..session import scratch_path
from .build import tuple_sketch
from .merge import merge_sketches
from .rows import group_columns, group_names

GROUPING = "grouping_id"


def grouping_sketches(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric], by: Sequence[ColumnOrName],
                      sets: Sequence[Sequence[str]], k: int = DEFAULT_K, hash: str = "md5", out: str = "sketch") -> DataFrame:
    """``by..., grouping_id, out``: one sketch per group of every grouping in ``sets`` (lists of names of ``by``).

    Columns that a grouping leaves out are null; bit i of ``grouping_id`` (from the right, last column first, as
    in SQL) tells that column from a null of the data.  Repeated groupings count once."""
    df, names = group_names(df, group_columns(by))
    wanted = list(dict.fromkeys(tuple(n for n in names if n in set(s)) for s in sets))
    unknown = {c for s in sets for c in s} - set(names)
    if unknown:
        raise ValueError(f"groupings name columns that are not in by: {sorted(unknown)}")
    if not wanted:
        raise ValueError("at least one grouping is required")
    spark = df.sparkSession
    made: dict[tuple[str, ...], tuple[DataFrame, int]] = {}

    def keep(grouping: tuple[str, ...], sketches: DataFrame) -> None:
        path = scratch_path(spark, "lattice")
        sketches.write.parquet(path)
        back = spark.read.schema(sketches.schema).parquet(path)
        made[grouping] = (back, back.count())           # from file footers

    finest = tuple(n for n in names if any(n in w for w in wanted))
    keep(finest, tuple_sketch(df, key, metrics, by=list(finest), k=k, hash=hash, out=out))
    for grouping in sorted(wanted, key=len, reverse=True):
        if grouping not in made:
            source = min((m for m in made if set(grouping) < set(m)), key=lambda m: made[m][1])
            keep(grouping, merge_sketches(made[source][0], out, by=list(grouping), k=k, num_values=len(metrics)))
    types = {n: df.schema[n].dataType for n in names}
    result = None
    for grouping in wanted:
        bits = sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in grouping)
        rows = made[grouping][0].select(*[F.col(n) if n in grouping else F.lit(None).cast(types[n]).alias(n) for n in names],
                                        F.lit(bits).cast("bigint").alias(GROUPING), out)
        result = rows if result is None else result.unionByName(rows)
    return result


def cube_sketches(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric], by: Sequence[ColumnOrName],
                  k: int = DEFAULT_K, hash: str = "md5", out: str = "sketch") -> DataFrame:
    """All groupings of the columns of ``by``, the empty one included; see :func:`grouping_sketches`."""
    df, names = group_names(df, group_columns(by))
    sets = [c for r in range(len(names), -1, -1) for c in combinations(names, r)]
    return grouping_sketches(df, key, metrics, names, sets, k, hash, out)


def rollup_sketches(df: DataFrame, key: ColumnOrName, metrics: Sequence[Metric], by: Sequence[ColumnOrName],
                    k: int = DEFAULT_K, hash: str = "md5", out: str = "sketch") -> DataFrame:
    """The groupings by all, all but the last, ... and none of the columns of ``by``; see :func:`grouping_sketches`."""
    df, names = group_names(df, group_columns(by))
    return grouping_sketches(df, key, metrics, names, [names[:i] for i in range(len(names), -1, -1)], k, hash, out)
