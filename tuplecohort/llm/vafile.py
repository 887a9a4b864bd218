"""Exact top-k search by inner product with a vector-approximation file, in two passes.

Equal vectors form a class; a class keeps its k + 1 copies of smallest vec_id, as no
further copy can be among the k answers of any query.  Classes are dealt into blocks of
bounded size.  A block writes one byte per class and dimension: the number of a cell, of
which every dimension of every block has its own, equally filled, so that an outlier
widens one cell of one dimension and nothing else.  Each cell knows its least and its
largest component; with a query q they bound the product of a component, and the sums
over all dimensions bound the inner product.

Pass 1 moves cells only.  A block of queries meets a block of cells: matrix products
give both bounds of every pair, and a pair stays if its upper bound reaches the block's
k-th largest lower bound.  The k-th largest lower bound over all blocks then removes most
of what stayed.

Pass 2 joins the rest with the exact vectors, which are shuffled for these classes alone,
in the order of the upper bounds (that is, of the lower bounds of their distance): first
the best 2k a query; their k-th exact score leaves those whose bound still reaches it, and
with these read the k-th result is certain.

Scores are exact integers; ties go to the smaller vec_id.  The pairs of blocks are the
unit of work, so no task holds more than a few blocks.

Defined cases: vectors that are null or hold null, NaN or infinite components, and
rows with a null vec_id, take no part; vectors of another length than the query
have no score with it; rows with equal ids are queries and candidates of their own, and
each answers the other's query, never its own; components or inner products that do
not fit a 64-bit integer raise; with fewer than k candidates all are returned;
an empty table gives an empty result.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bare, join_counted, near_keys, stored

CELLS = 256
QUERY_BLOCK = 2048
VECTOR_BLOCK = 8192
#: Components of a block at most.
BLOCK_SIZE = 1 << 20
SCALE = 256


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim, vec (array<bigint> of floor(scale * component)) of the rows that take part."""
    e = bare(embeddings, "vec_id", "embedding")
    e = e.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    e = e.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).filter(fine)
    fits = F.forall("x", lambda v: F.abs(v) * F.lit(float(scale)) < float(1 << 62))
    whole = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("bigint"))
    return e.select("vec_id", F.size("x").alias("dim"), F.when(fits, whole).otherwise(
        F.raise_error(F.concat(F.lit("a component does not fit a 64-bit integer, vec_id "), F.col("vec_id")))).alias("vec"))


@dataclass(frozen=True)
class VAFile:
    """A written file.  ``vectors``: vec_id, rid, digest of every row (queries are some of these rows);
    ``classes``: cls, digest, dim, vec, copies (the k + 1 first rows); ``blocks``: the cells."""

    vectors: DataFrame
    classes: DataFrame
    blocks: DataFrame
    k: int


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _blocks_of(batches, rows: int, make):
    """Blocks of at most ``rows`` vectors and BLOCK_SIZE components, each of one length, of a stream of (cls, dim, vec)."""
    held: dict[int, list] = {}
    count = 0

    def flush(dim):
        parts = held.pop(dim)
        return make(dim, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    for batch in batches:
        cls, dims = batch.column("cls").to_numpy(), batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            ids, vec = cls[at], _matrix(batch.column("vec").take(pa.array(at)), dim)
            most = max(1, min(rows, BLOCK_SIZE // max(1, dim)))
            while len(ids):
                mine = sum(len(p[0]) for p in held.get(dim, []))
                take = min(len(ids), most - mine)
                held.setdefault(dim, []).append((ids[:take], vec[:take]))
                ids, vec, count = ids[take:], vec[take:], count + take * max(1, dim)
                if mine + take == most:
                    count -= most * max(1, dim)
                    yield flush(dim)
        while count > 2 * BLOCK_SIZE:              # vectors of many lengths: the fullest goes early
            dim = max(held, key=lambda d: sum(len(p[0]) for p in held[d]) * max(1, d))
            count -= sum(len(p[0]) for p in held[dim]) * max(1, dim)
            yield flush(dim)
    for dim in list(held):
        yield flush(dim)


def quantise(vec: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of every component, and (dim, cells) least and largest component of each equally filled cell."""
    n, dim = vec.shape
    cells = max(1, min(cells, max(16, n // 8), n))
    cell = np.empty((n, dim), np.uint8)
    low, high = np.empty((dim, cells), np.int64), np.empty((dim, cells), np.int64)
    starts = np.arange(cells) * n // cells
    for d in range(dim):
        line = np.sort(vec[:, d])
        low[d] = line[starts]
        high[d, :-1] = line[np.searchsorted(line, low[d, 1:], "left") - 1]    # unused where a mark repeats
        high[d, -1] = line[-1]
        cell[:, d] = np.searchsorted(low[d], vec[:, d], "right") - 1
    return cell, low, high


def write_va_file(vectors: DataFrame, cells: int = CELLS, block: int = VECTOR_BLOCK, k: int = 5) -> VAFile:
    """The file of ``vectors`` (see :func:`whole_vectors`) for searches of up to ``k`` answers a query."""
    digest = F.unhex(F.sha2(F.concat_ws(",", F.col("vec").cast("array<string>")), 256))
    vectors = stored(vectors.withColumn("rid", F.monotonically_increasing_id())       # a row's own number: ids may repeat
                     .withColumn("digest", digest), "va-vectors")
    order = Window.partitionBy("digest").orderBy("vec_id", "rid")
    first = vectors.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    classes = first.groupBy("digest").agg(F.first("dim").alias("dim"), F.first("vec").alias("vec"),
                                          F.array_sort(F.collect_list(F.struct("vec_id", "rid"))).alias("copies"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "va-classes")

    def blocks(batches):
        def make(dim, cls, vec):
            cell, low, high = quantise(vec, cells)
            return pa.RecordBatch.from_pylist([{"dim": dim, "cls": cls, "cell": cell.tobytes(), "low": low.tobytes(),
                                                "high": high.tobytes(), "cells": low.shape[1] if dim else 1}], _BLOCK)
        yield from _blocks_of(batches, block, make)

    _BLOCK = pa.schema([("dim", pa.int32()), ("cls", pa.list_(pa.int64())), ("cell", pa.binary()), ("low", pa.binary()),
                        ("high", pa.binary()), ("cells", pa.int32())])
    cell_blocks = stored(classes.select("cls", "dim", "vec").mapInArrow(
        blocks, "dim int, cls array<bigint>, cell binary, low binary, high binary, cells int"), "va-file")
    return VAFile(vectors, classes, cell_blocks, k)


def block_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray, n: int):
    """For every query of a block: its number, the candidates whose upper bound reaches the n-th largest lower bound,
    their lower and their upper bounds.  low, high: least and largest component by candidate and dimension."""
    largest = [max((max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in part), default=0)
               for part in ([q], [low, high])]
    most = largest[0] * largest[1] * q.shape[1]
    if most >= 1 << 63:
        raise OverflowError("an inner product of these vectors does not fit a 64-bit integer")
    # Doubles add whole numbers exactly up to 2^53; beyond that the bounds are widened by more than their rounding.
    slack = 0.0 if most < 1 << 53 else most * 2.0 ** -50 * q.shape[1]
    low, high = low.T.astype(np.float64), high.T.astype(np.float64)
    for at in range(0, len(q), 64):       # bounds of 64 queries at a time
        p, m = np.maximum(q[at:at + 64], 0).astype(np.float64), np.minimum(q[at:at + 64], 0).astype(np.float64)
        under, over = p @ low + m @ high - slack, p @ high + m @ low + slack
        for r in range(len(p)):
            cand = np.arange(under.shape[1])
            if len(cand) > n:
                kth = np.partition(under[r], len(cand) - n)[len(cand) - n]
                cand = np.flatnonzero(over[r] >= kth)
            yield at + r, cand, under[r, cand], over[r, cand]


def candidates(va: VAFile, asked: DataFrame, n: int, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Pass 1: q_cls, cls, under, over of the classes that may be among the n best of a class of ``asked`` (cls, dim, vec)."""
    def blocks(batches):
        def make(dim, cls, vec):
            return pa.RecordBatch.from_pylist([{"dim": dim, "q_cls": cls, "q": np.ascontiguousarray(vec).tobytes()}],
                                              pa.schema([("dim", pa.int32()), ("q_cls", pa.list_(pa.int64())), ("q", pa.binary())]))
        yield from _blocks_of(batches, query_block, make)

    q = stored(asked.mapInArrow(blocks, "dim int, q_cls array<bigint>, q binary"), "va-queries")
    # Blocks are dealt to as many slots as there are blocks; every query slot meets every slot of cells once.
    q_slots, v_slots = max(1, q.count()), max(1, va.blocks.count())
    left = q.withColumn("qs", F.pmod(F.xxhash64(F.get("q_cls", F.lit(0))), F.lit(q_slots)).cast("int")) \
            .withColumn("vs", F.explode(F.sequence(F.lit(0), F.lit(v_slots - 1)))).withColumnRenamed("dim", "q_dim")
    right = va.blocks.withColumn("v_vs", F.pmod(F.xxhash64(F.get("cls", F.lit(0))), F.lit(v_slots)).cast("int")) \
              .withColumn("v_qs", F.explode(F.sequence(F.lit(0), F.lit(q_slots - 1))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        for v in b.to_pylist():
            dim, ids = v["dim"], np.array(v["cls"], np.int64)
            cell = np.frombuffer(v["cell"], np.uint8).reshape(len(ids), dim)
            marks = [np.frombuffer(v[c], np.int64).reshape(dim, v["cells"]) for c in ("low", "high")]
            low, high = (m[np.arange(dim), cell] for m in marks)
            for row in a.to_pylist():
                q_ids = np.array(row["q_cls"], np.int64)
                q = np.frombuffer(row["q"], np.int64).reshape(len(q_ids), dim)
                for r, cand, under, over in block_bounds(q, low, high, n):
                    for to, x in zip(found, (np.full(len(cand), q_ids[r]), ids[cand], under, over)):
                        to.append(x)
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(np.concatenate(x) if x else [], t) for x, t in zip(found, kinds)],
                        names=["q_cls", "cls", "under", "over"])

    found = left.groupBy("q_dim", "qs", "vs").cogroup(right.groupBy("dim", "v_qs", "v_vs")) \
                .applyInArrow(meet, "q_cls bigint, cls bigint, under double, over double")
    found = stored(found, "va-candidates")
    return _reaching(found, found, "under", n)


def _reaching(rows: DataFrame, known: DataFrame, value: str, n: int) -> DataFrame:
    """The ``rows`` whose upper bound reaches the n-th largest ``value`` that is known for their query."""
    best = Window.partitionBy("q_cls").orderBy(F.col(value).desc())
    kth = known.select("q_cls", value).withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= n) \
               .groupBy(F.col("q_cls").alias("k_cls")).agg(F.min(value).alias("kth"), F.count(F.lit(1)).alias("nth"))
    kth = kth.filter(F.col("nth") == n).select("k_cls", "kth")
    return rows.join(kth, F.col("q_cls") == F.col("k_cls"), "left") \
               .filter(F.col("kth").isNull() | (F.col("over") >= F.col("kth"))).drop("k_cls", "kth")


def exact_scores(va: VAFile, pairs: DataFrame, asked: DataFrame, total: int) -> DataFrame:
    """q_cls, cls, copies, score of the ``pairs``; only the vectors of their classes are shuffled."""
    keys = stored(pairs.groupBy(F.col("cls").alias("t_cls")).agg(F.count(F.lit(1)).alias("n")), "va-read")
    read = near_keys(va.classes.select("cls", "vec", "copies"), F.xxhash64("cls"), keys, F.xxhash64("t_cls"))
    read = read.join(keys, F.col("cls") == F.col("t_cls"), "inner") \
               .select(F.col("t_cls").cast("string").alias("t_key"), "n", "vec", "copies")
    got = join_counted(pairs.select("q_cls", "cls", F.col("cls").cast("string").alias("key")), "key", read, "t_key", "n", total)
    got = got.join(asked.select(F.col("cls").alias("a_cls"), F.col("vec").alias("q")), F.col("q_cls") == F.col("a_cls"), "inner")
    score = F.aggregate(F.zip_with("q", "vec", lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return got.select("q_cls", "cls", "copies", score.alias("score"))


def top_k(va: VAFile, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score, exact_reads for every row of ``queries`` (rows of ``va.vectors``) against all."""
    if k > va.k:
        raise ValueError(f"the file answers up to {va.k} a query, not {k}")
    n = k + 1                                     # a query row leaves itself out of the n best of its class
    per = stored(queries.groupBy(F.col("digest").alias("p_digest")).agg(F.count(F.lit(1)).alias("n")), "va-asked")
    asked = stored(va.classes.join(per, F.col("digest") == F.col("p_digest"), "inner").select("cls", "digest", "dim", "vec", "n"),
                   "va-asked-classes")
    near = stored(candidates(va, asked.select("cls", "dim", "vec"), n, query_block), "va-near")
    order = Window.partitionBy("q_cls").orderBy(F.col("over").desc(), "cls")
    near = stored(near.withColumn("nth", F.row_number().over(order)), "va-ordered")
    total = near.count()
    first = stored(exact_scores(va, near.filter(F.col("nth") <= 2 * n), asked, total), "va-first")
    rest = stored(_reaching(near.filter(F.col("nth") > 2 * n), first, "score", n), "va-rest")
    scored = first.unionByName(exact_scores(va, rest, asked, total))
    # Of a class in the n best by (score, first copy) at most the first n copies count.
    best = Window.partitionBy("q_cls").orderBy(F.col("score").desc(), F.get("copies", F.lit(0))["vec_id"])
    reads = scored.groupBy(F.col("q_cls").alias("r_cls")).agg(F.count(F.lit(1)).alias("exact_reads"))
    scored = scored.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= n)
    each = F.transform("copies", lambda c: F.struct((-F.col("score")).alias("less"), c["vec_id"].alias("vec_id"),
                                                    c["rid"].alias("rid")))
    answers = scored.select("q_cls", each.alias("each")).groupBy("q_cls").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("each"))), 1, n).alias("answers"))
    answers = answers.join(reads, F.col("q_cls") == F.col("r_cls"), "inner") \
                     .join(asked.select("cls", F.hex("digest").alias("t_digest"), "n"), F.col("q_cls") == F.col("cls"), "inner") \
                     .select("t_digest", "n", "answers", "exact_reads")
    rows = queries.select(F.col("vec_id").alias("query_id"), "rid", F.hex("digest").alias("digest"))
    got = join_counted(rows, "digest", answers, "t_digest", "n", max(1, queries.count()))
    own = F.slice(F.filter("answers", lambda a: a["rid"] != F.col("rid")), 1, k)
    got = got.select("query_id", "exact_reads", F.posexplode(own).alias("at", "a"))
    return got.select("query_id", (F.col("at") + 1).alias("rank"), F.col("a")["vec_id"].alias("vec_id"),
                      (-F.col("a")["less"]).alias("score"), "exact_reads")
