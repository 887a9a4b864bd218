"""Stored sketches at powers of two of a day, for merges over any range of days.

Level j holds one sketch per group and block of 2^j days (blocks are aligned: day
number div 2^j, days counted from 1970-01-01).  Any range of n days is a union of
at most 2 log2(n) + 2 whole blocks (:func:`range_cover`), so a query over a year reads and merges
some ten sketches a group instead of 365.  Merging is associative: the result is
that of merging the days themselves.

Layout: Parquet partitioned by ``level`` and ``block``, so a range reads only the
folders of its cover.  Level 0 is what is given; each further level merges the one
below, read back from its files, so every sketch is read once and written once.

Defined cases: days without a sketch are in no block of level 0 and add nothing; a
null day is in no range and is left out; a range outside the data, or one that ends
before it begins, is empty; days before 1970 have negative numbers.  Levels go up to
the first whose block holds all the days of the data (two blocks if the epoch is among them).
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import DEFAULT_K
from ..operators.merge import merge_sketches
from .store import as_sketch_column, check_sketch_column

_EPOCH = datetime.date(1970, 1, 1)


def day_number(day: datetime.date) -> int:
    return (day - _EPOCH).days


def range_cover(first: int, last: int, top: int = 62) -> list[tuple[int, int]]:
    """The fewest (level, block) that make up the days ``first`` to ``last`` (numbers, both included), in order;
    no level is above ``top``."""
    cover = []
    while first <= last:
        level = 0
        while level < top and first % (2 << level) == 0 and first + (2 << level) - 1 <= last:
            level += 1
        cover.append((level, first >> level))
        first += 1 << level
    return cover


def write_dyadic(daily: DataFrame, path: str, day: str = "day", by: Sequence[str] = (), sketch: str = "sketch",
                 k: int = DEFAULT_K, num_values: int = 1) -> "DyadicIndex":
    """Write the index of ``daily`` (one sketch per day and group) to a new ``path``; returns it."""
    check_sketch_column(daily, sketch)
    spark, by = daily.sparkSession, list(by)
    number = F.datediff(F.col(day).cast("date"), F.lit(_EPOCH))
    rows = daily.where(F.col(day).isNotNull()).select(*by, number.cast("long").alias("block"), sketch)
    rows = rows.select(*by, sketch, F.lit(0).alias("level"), "block")
    rows.write.partitionBy("level", "block").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    ends = stored.where(F.col("level") == 0).agg(F.min("block"), F.max("block")).first()   # from folder names
    level, lo, hi = 0, *(ends if ends[0] is not None else (0, 0))
    # Days before and after the epoch share no block at any level: two blocks, -1 and 0, then hold all.
    while (lo >> level, hi >> level) != (-1, 0) and lo >> level != hi >> level:
        level += 1
        below = as_sketch_column(spark.read.schema(rows.schema).parquet(path).where(F.col("level") == level - 1), sketch)
        half = below.withColumn("block", F.shiftright(F.col("block").cast("long"), 1)).drop("level")
        merged = merge_sketches(half, sketch, by=[*by, "block"], k=k, num_values=num_values)
        merged.withColumn("level", F.lit(level)).write.mode("append").partitionBy("level", "block").parquet(path)
    return DyadicIndex(spark, path, rows.schema, tuple(by), sketch, k, num_values, level)


@dataclass(frozen=True)
class DyadicIndex:
    """A written index; ``top`` is its highest level."""

    spark: SparkSession
    path: str
    schema: StructType
    by: tuple[str, ...]
    sketch: str
    k: int
    num_values: int
    top: int

    def parts(self, first: datetime.date, last: datetime.date) -> DataFrame:
        """The stored sketches that make up a range of days (both included)."""
        cover = range_cover(day_number(first), day_number(last), self.top)
        wanted = F.lit(False)
        for level in sorted({c[0] for c in cover}):
            wanted = wanted | ((F.col("level") == level) & F.col("block").isin([b for v, b in cover if v == level]))
        return as_sketch_column(self.spark.read.schema(self.schema).parquet(self.path).where(wanted), self.sketch)

    def merged(self, first: datetime.date, last: datetime.date) -> DataFrame:
        """``by..., sketch`` of a range of days (both included): one merge of the blocks of its cover."""
        return merge_sketches(self.parts(first, last), self.sketch, by=list(self.by), k=self.k, num_values=self.num_values)
