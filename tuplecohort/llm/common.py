"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re
import sys
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Pattern of a word in the contracts that count white-space separated words.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage).

    The shuffle files of the write are deleted as soon as it is done.
    rows: no more rows than these are expected; a small table is then written in few files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with own_shuffles(spark):
        (df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


#: Spark deletes an execution's shuffle files at its end while this is on.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions in here leave no shuffle files behind; the session's setting is then as it was."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


#: Rows of a file of a table whose number of rows is known.
FILE_ROWS = 500_000


def release(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`stored` whose successors are written; nothing may read them after."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path is not None:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


#: Bits of a key filter for each key, and at most (32 MB): with more than 4 million keys more other rows pass.
FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 28
#: Bits of a bitmap of Spark's bitmap functions.
_BITMAP = 1 << 15


def near_keys(rows: DataFrame, at: Column, keys: DataFrame, key: Column, others: bool = False) -> DataFrame:
    """The ``rows`` whose hash ``at`` may be that of a key (``key`` of the written table ``keys``), or all others.

    A Bloom filter of one hash, at most MOST_FILTER_BITS large whatever the number of keys, meets the rows where
    they are read, so that a join with the keys shuffles the texts it is about and not those of all documents.
    All rows with a key are among the first; the join after it decides.  Both hashes are 64-bit numbers, not null."""
    bits = max(_BITMAP, min(MOST_FILTER_BITS, 1 << (FILTER_BITS * max(1, keys.count()) - 1).bit_length()))
    place = F.pmod(key, F.lit(bits))
    # Keys are shuffled as numbers: partial bitmaps would be 4 kB for every map that a task has a key of.
    maps = keys.select(place.alias("nk_place")).withColumn("nk_map", F.shiftright("nk_place", 15)) \
               .repartition("nk_map").groupBy("nk_map").agg(
        F.bitmap_construct_agg(F.col("nk_place") % _BITMAP).alias("nk_bits"))
    mine = F.pmod(at, F.lit(bits))
    byte = F.substring("nk_bits", (F.shiftright(mine, 3) % (_BITMAP // 8) + 1).cast("int"), F.lit(1))
    held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (mine % 8).cast("int")) == 1
    return rows.join(F.broadcast(maps), (F.shiftright(mine, 15) == F.col("nk_map")) & held,
                     "left_anti" if others else "left_semi")


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver notice which shuffles nothing refers to any more, so that executors delete their files.

    Else those of other actions than :func:`stored` stay until the driver happens to collect its garbage, which a long
    loop over small tables rarely makes it do."""
    gc.collect()
    spark._jvm.System.gc()


#: A key is heavy with more than one row in so many; fewer keys than that are.
HEAVY = 1000


def join_counted(rows: DataFrame, key: str, table: DataFrame, table_key: str, n: str, total: int) -> DataFrame:
    """Left join of ``rows`` with a table that has a row per key and the number ``n`` of ``rows`` with it.

    Heavy keys (fewer than HEAVY rows) are broadcast, and their rows are dealt out evenly in the join with the
    others, so a key of a third of all rows is no burden to one task.  ``n`` and ``table_key`` are dropped."""
    heavy = F.col(n) * HEAVY > total
    more = [c for c in table.columns if c not in (table_key, n)]
    first = table.filter(heavy).select(F.col(table_key).alias("jc_hk"), *[F.col(c).alias(f"jc_h_{c}") for c in more])
    rest = table.filter(~heavy).select(F.col(table_key).alias("jc_lk"), *[F.col(c).alias(f"jc_l_{c}") for c in more])
    names = rows.columns
    got = rows.join(F.broadcast(first), F.col(key) == F.col("jc_hk"), "left")
    spread = F.concat(F.lit("-"), F.xxhash64(F.monotonically_increasing_id()).cast("string"))
    got = got.withColumn("jc_key", F.when(F.col("jc_hk").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(spread))
    got = got.join(rest, F.col("jc_key") == F.col("jc_lk"), "left")
    return got.select(*names, *[F.coalesce(f"jc_h_{c}", f"jc_l_{c}").alias(c) for c in more])


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that the driver and every executor can write to."""
    path = scratch_path(spark, name)
    m = re.match(r"^file:/*(/.*)$", path)
    if m:
        return "file://" + m[1]
    return path if re.match(r"^\w+://", path) else "file://" + path


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path of a shared URI (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri)


def fresh_name(prefix: str, suffix: str) -> str:
    """A file name no other task attempt uses; only names in a stored manifest are ever read."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def bare(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns, so that further columns of any name cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def null_safe(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process, across its tasks."""
    name = "tuplecohort_worker_cache"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64 constants), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
