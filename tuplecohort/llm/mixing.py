"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies,
``target / source size`` (0 to 2).  Its whole part is granted; the fractional
parts are rounded by the pivotal method: two fractional documents are paired
and copy mass, weighted by their sizes, moves from one to the other, at random
in either direction and with unchanged expectation, until one of them is 0 or
1.  The weighted sum of a source stays exactly on its target in every step.

The pairing runs in buckets of about ``BUCKET`` documents.  Each bucket leaves
at most one fractional document; those residuals meet in groups of ``FAN_IN``
buckets, again and again, until one per source is left, which a coin decides.
So a source misses its target by less than the size of one document.

With ``within`` (a column) every value of it is a mix of its own: weights, share and
caps hold among the sources of that value.

Defined cases: a null text has size 0 and takes 0; null sources form one source
that comes last; an empty table gives an empty result; repeated rows are
documents of their own; a source with only empty texts has target 0.  Only
``doc_id``, ``text`` and ``source`` are read, so further columns cannot clash.
Buckets and coins are keyed hashes of the rows, so reruns agree.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKET = 4096
FAN_IN = 64
SEED = 20240229
#: Fractions this near to 0 or 1 count as integral (rounding of doubles).
_EPS = 1e-12

_ROWS = "doc_id bigint, source string, h bigint, size bigint, base int, p double, node bigint"


def source_of(within: str | None = None) -> Column:
    """What a row is mixed under: its source or, with ``within``, a string of that column's value and the source.

    The strings of one value sort as the sources do, null last."""
    source = F.col("source").cast("string")
    if within is None:
        return source
    value = F.col(f"`{within}`").cast("string")
    return F.concat(F.coalesce(F.concat(F.lit("S"), F.length(value).cast("string"), F.lit(" "), value), F.lit("T")),
                    F.coalesce(F.concat(F.lit("S"), source), F.lit("T")))


def document_sizes(docs: DataFrame, within: str | None = None) -> DataFrame:
    """doc_id, source (:func:`source_of`), h (hash of the text), size (white-space separated words); with ``within`` also part."""
    part = [] if within is None else [F.col(f"`{within}`").cast("string").alias("part")]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), source_of(within).alias("source"), *part,
                       F.xxhash64("text").alias("h"),
                       F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("bigint").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP, parts: tuple[str, ...] = ()) -> DataFrame:
    """Per source: source_size, n_docs, weight and target; the sources of each value of ``parts`` share by themselves.

    Weighted shares with a cap have a closed form: with the sources in order of
    cap / weight, the capped ones come first, and a source is capped when its
    share of what the ones before it leave would exceed its cap.  All work is on
    one row per source.
    """
    per = sizes.groupBy("source", *parts).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    whole = Window.partitionBy(*parts)
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.row_number().over(by_name) - 1) % len(weights) + 1))
    per = per.withColumn("cap", F.col("source_size") * float(cap))
    order = whole.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("level", (share * F.sum("source_size").over(whole)
                                   - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("weight").over(rest))
    per = per.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    per = per.withColumn("lam", F.max(F.when(F.col("open"), F.col("level"))).over(whole))
    return per.select("source", "source_size", "n_docs", "weight",
                      F.when(F.col("open"), F.least(F.col("lam") * F.col("weight"), F.col("cap")))
                      .otherwise(F.col("cap")).alias("target"))


def pivot_pair(pi: float, ai: int, pj: float, aj: int, u: float) -> tuple[float, float]:
    """Move copy mass between two documents so that one becomes integral.

    ``ai * pi + aj * pj`` is kept, and so is the expectation of each.
    """
    ratio = ai / aj
    up = min(1.0 - pi, pj / ratio)            # towards i
    down = min(pi, (1.0 - pj) / ratio)        # towards j
    if u * (up + down) < down:
        if 1.0 - pi <= pj / ratio:
            return 1.0, pj - (1.0 - pi) * ratio
        return pi + up, 0.0
    if pi <= (1.0 - pj) / ratio:
        return 0.0, pj + pi * ratio
    return pi - down, 1.0


def _coins(seed: int, level: int, source: str | None, node: int) -> random.Random:
    key = f"{seed}|{level}|{'N' if source is None else 'S' + source}|{node}"
    return random.Random(hashlib.sha256(key.encode()).digest())


def _round_nodes(level: int, last: bool, seed: int):
    """mapInArrow function over rows sorted by (source, node): at most one fractional row a node leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, carry, coins = None, None, None   # carry: the fractional row of the node at hand
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                doc, src, h, size, base, p, node = row
                if coins is None or (src, node) != at:
                    out += _left_over(carry, coins, last)
                    at, carry, coins = (src, node), None, _coins(seed, level, src, node)
                if carry is None:
                    carry = row
                    continue
                pi, pj = pivot_pair(carry[5], carry[3], p, size, coins.random())
                left = None
                for r in ((*carry[:5], pi, node), (*row[:5], pj, node)):
                    if r[5] <= _EPS or r[5] >= 1 - _EPS:
                        out.append((*r, r[4] + (r[5] > 0.5)))
                    else:
                        left = r
                carry = left
            yield _batch(out)
        yield _batch(_left_over(carry, coins, last))

    return run


def _left_over(carry: tuple | None, coins: random.Random | None, last: bool) -> list[tuple]:
    if carry is None:
        return []
    return [(*carry, carry[4] + (coins.random() < carry[5]) if last else None)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int32()]
    names = ["doc_id", "source", "h", "size", "base", "p", "node", "copies"]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
                seed: int = SEED, bucket: int = BUCKET, fan_in: int = FAN_IN, within: str | None = None) -> DataFrame:
    """One row per document: doc_id, source (:func:`source_of`), h, size, source_size, target, copies."""
    sizes = stored(document_sizes(docs, within), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, cap, () if within is None else ("part",)), "mix-targets")
    # targets is a written table with one row per source, so Spark broadcasts it by its size.
    t = targets.select(F.col("source").alias("t_source"), "source_size", "n_docs", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sizes.join(t, sizes["source"].eqNullSafe(t["t_source"]), "inner").withColumn("rate", rate)
    rows = rows.withColumn("base", F.floor("rate").cast("int")).withColumn("p", F.col("rate") - F.col("base"))
    settled = F.when((F.col("size") == 0) | (F.col("p") <= _EPS), F.col("base")) \
               .when(F.col("p") >= 1 - _EPS, F.col("base") + 1)
    node = F.pmod(F.xxhash64("doc_id", "h", F.lit(seed)), F.ceil(F.col("n_docs") / bucket))
    rows = rows.withColumn("node", node).withColumn("copies", settled)
    cols = ["doc_id", "source", "h", "size", "base", "p", "node", "copies"]
    parts = [rows.filter("copies is not null").select(cols)]
    todo = rows.filter("copies is null").select(cols[:-1])
    most = targets.agg(F.max(F.ceil(F.col("n_docs") / bucket))).first()[0] or 1
    nodes, level = int(most), 0
    while True:
        last = nodes <= 1
        done = (todo.repartition("source", "node").sortWithinPartitions("source", "node", "doc_id", "size", "h")
                .mapInArrow(_round_nodes(level, last, seed), _ROWS + ", copies int"))
        done = stored(done, f"mix-level{level}")
        parts.append(done.filter("copies is not null").select(cols))
        if last:
            break
        todo = done.filter("copies is null").select(*cols[:-1]) \
                   .withColumn("node", F.floor(F.col("node") / fan_in).cast("bigint"))
        nodes, level = -(-nodes // fan_in), level + 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("doc_id", F.col("source").alias("o_source"), "h", "size", "copies")
    return out.join(t, out["o_source"].eqNullSafe(t["t_source"]), "inner") \
              .select("doc_id", F.col("o_source").alias("source"), "h", "size", "source_size", "target", "copies")


def apply_mix(docs: DataFrame, mix: DataFrame, within: str | None = None) -> DataFrame:
    """The documents, each as many times as the mix (of the same ``within``) takes it, with the columns of ``docs``.

    Rows are matched by (doc_id, source, text hash); rows equal in all three share
    their copies evenly.
    """
    cols = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"),
                        F.col("doc_id").cast("bigint").alias("k_id"), source_of(within).alias("k_src"),
                        F.xxhash64("text").alias("k_h"))
    m = mix.groupBy("doc_id", "source", "h").agg(F.sum("copies").cast("int").alias("c"),
                                                 F.count(F.lit(1)).cast("int").alias("m")).filter("c > 0")
    j = keyed.join(m, keyed["k_h"].eqNullSafe(m["h"]) & keyed["k_id"].eqNullSafe(m["doc_id"])
                   & keyed["k_src"].eqNullSafe(m["source"]), "inner")
    single = j.filter("m = 1").withColumn("times", F.col("c"))
    w = Window.partitionBy("k_id", "k_src", "k_h").orderBy("k_id")
    again = j.filter("m > 1").withColumn("rn", F.row_number().over(w)) \
             .withColumn("times", F.floor(F.col("c") / F.col("m")).cast("int")
                         + (F.col("rn") <= F.col("c") % F.col("m")).cast("int")).drop("rn").filter("times > 0")
    both = single.unionByName(again)
    return both.select("r", F.explode(F.sequence(F.lit(1), "times")).alias("nth")).select("r.*")
