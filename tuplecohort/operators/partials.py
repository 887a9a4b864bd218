"""Bounded partial results before the first shuffle of a sketch build.

A partial aggregate of (group, key) sends every distinct key of a task to the
first shuffle, although a key with ``k + 1`` smaller distinct hashes in its group
within the same task can never be kept.  Spark's group limit ranks rows, not
aggregated keys, and only ahead of a shuffle on the group alone, so the rows of
a hot key would travel one by one and a hot group to one task.

Here every task adds up its own (group, hash) tuples in Arrow batches, cuts each
group to its ``k + 2`` smallest hashes, and sends on the rest: at most ``k + 2``
keys a group and task, each with one row.  The shuffle, the exact sums and the
bottom-k tail after it are those of the plain build, so the result is the same.

Memory: a task holds ``HELD_ROWS`` rows or so.  If its groups are so many that
the cut rows alone are over half of that, they are handed on as they are and the
task starts afresh, as a partial aggregate does.
"""

from __future__ import annotations

import hashlib
import sys
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The functions travel with their tasks, so executors need pyarrow but not this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD_ROWS = 1 << 18
#: Types of group columns that Arrow groups as Spark does (floating-point zeros and NaNs differ).
GROUP_TYPES = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType,
               T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType)


def can_bound(rows: DataFrame, by: list[str]) -> bool:
    """Whether the group columns are of types that tasks can group."""
    return all(isinstance(rows.schema[b].dataType, GROUP_TYPES)
               and getattr(rows.schema[b].dataType, "collation", "UTF8_BINARY") == "UTF8_BINARY" for b in by)


def plan_bytes(df: DataFrame) -> float:
    """The optimizer's estimate of the size of ``df`` (no job); infinite where the session does not show it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:      # Spark Connect
        return float("inf")


def _codes(table: pa.Table, by: list[str]) -> np.ndarray:
    """A number for each row's group."""
    code = np.zeros(table.num_rows, np.int64)
    for b in by:
        d = table.column(b).combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]      # stays small whatever the number of columns
    return code


def combine(table: pa.Table, by: list[str], h: str, sums: list[str], limit: int) -> pa.Table:
    """One row per (group, hash) with its sums: the rows without a hash, and the ``limit`` smallest hashes of each group."""
    names = table.schema.names
    got = table.group_by([*by, h], use_threads=False).aggregate([(s, "sum") for s in sums])
    got = got.rename_columns([c.removesuffix("_sum") if c.endswith("_sum") and c.removesuffix("_sum") in sums else c
                              for c in got.schema.names]).select(names).cast(table.schema)
    hashes = got.column(h).combine_chunks()
    real = np.flatnonzero(pc.is_valid(hashes).to_numpy(zero_copy_only=False))
    if len(real) <= limit:
        return got
    code, value = _codes(got, by)[real], hashes.take(pa.array(real)).to_numpy()
    order = np.lexsort((value, code))
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    sizes = np.diff(np.append(first, len(code)))
    if sizes.max() <= limit:
        return got
    nth = np.arange(len(code)) - np.repeat(first, sizes)
    keep = np.ones(got.num_rows, bool)
    keep[real[order[nth >= limit]]] = False
    return got.filter(pa.array(keep))


def md5_hashes(keys: pa.Array) -> pa.Array:
    """The 60-bit md5 hash of each key (text), as ``functions.hashing`` defines it; null for null."""
    digests = b"".join(hashlib.md5(k or b"", usedforsecurity=False).digest() for k in keys.cast(pa.binary()).to_pylist())
    top = np.frombuffer(digests, ">u8")[::2].astype(np.uint64) >> np.uint64(4)
    return pa.array(top.astype(np.int64), mask=pc.is_null(keys).to_numpy(zero_copy_only=False))


def bounded_partials(rows: DataFrame, by: list[str], h: str, sums: list[str], k: int, key: str | None = None,
                     held_rows: int = HELD_ROWS) -> DataFrame:
    """``by..., h, sums...``: ``rows`` reduced within each task; same sums and bottom ``k`` after a shuffle.

    ``rows`` has the hash ``h``, or a text column ``key``: then a task hashes each of its distinct keys once (md5)."""
    limit = k + 2
    schema = T.StructType([rows.schema[b] for b in by] + [T.StructField(h, T.LongType())] + [rows.schema[c] for c in sums])

    def hashed(block: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(block)
        if key is None:
            return table.select([*by, h, *sums])
        got = table.group_by([*by, key], use_threads=False).aggregate([(c, "sum") for c in sums])
        d = got.column(key).combine_chunks().dictionary_encode()
        return pa.table([*[got.column(b) for b in by], md5_hashes(d.dictionary).take(d.indices),
                         *[got.column(c + "_sum") for c in sums]], names=[*by, h, *sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(held_rows, 2 * limit)
        held, block, n, n_held = [], [], 0, 0
        for batch in batches:
            block.append(batch)
            n += batch.num_rows
            if n + n_held >= most:
                held = [combine(pa.concat_tables([*held, hashed(block)]), by, h, sums, limit)]
                block, n, n_held = [], 0, held[0].num_rows
                if n_held > most // 2:
                    yield from held[0].to_batches()
                    held, n_held = [], 0
        if block:
            held = [combine(pa.concat_tables([*held, hashed(block)]), by, h, sums, limit)]
        for table in held:
            yield from table.to_batches()

    return rows.mapInArrow(run, schema)
