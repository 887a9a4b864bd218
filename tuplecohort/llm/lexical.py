"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton.  A document is scanned as UTF-8 bytes in
which every separator is a space and A-Z are a-z, and the automaton holds each term
between two spaces, so it reports whole terms only and counts them straight from the
text: no index of the documents is built, and no term of theirs is ever sorted or
shuffled.  The automaton's outputs are term numbers; a table maps them to items.

1. The items' distinct terms go into slices of ``SLICE_BYTES`` bytes or so (a slice
   holds whole items), so an automaton is bounded whatever the number of items.
2. A first scan counts documents, their terms, and the documents that hold each term.
3. A second scan scores every document against every item of the slice and keeps, per
   task and item, the ``K`` best so far; a score below the K-th best of its task is
   left at once.  Ranks are taken over groups of tasks first, then over all.

Scores are whole numbers: with N documents that hold a term, L terms in all, n in the
document, df documents that hold the term and tf of it in the document, w is
floor(1000 ln((2 N + 2) / (2 df + 1))), m is 100 - 50 + (50 n N) div L, and a term
adds w ((10^9 tf) div (1000 tf + 20 m)).

Defined cases: a null or empty text has no terms and takes no part; items without
terms have no results; repeated rows of ``docs`` are documents of their own, each with
its rank; equal scores go by ascending doc_id, null last; rows of ``items`` equal in
id and text are one item, rows with equal ids and other texts are ranked apart; texts
of any length are scanned in pieces cut at spaces; empty tables give no rows.  Only
``doc_id``, ``text`` and ``item_id``, ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bare, stored, worker_cache

K = 50
#: Bytes of terms in the automaton of a slice (an item with more is a slice of its own).
SLICE_BYTES = 4 << 20
PIECE = 1 << 20
#: Groups of tasks that are ranked before all are.
GROUPS = 64
#: Scored rows that a task holds before it drops those below an item's K best.
HELD = 200_000
_LAST = np.iinfo(np.int64).max

_SPACED = bytearray(range(256))
for _b in range(128):
    if not chr(_b).isalnum():
        _SPACED[_b] = 0x20
    elif chr(_b).isupper():
        _SPACED[_b] = _b + 32
_SPACED = bytes(_SPACED)


def spaced(text: str | None) -> bytes:
    """The text's bytes with a space for every separator and a-z for A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPACED)


def count_terms(raw: bytes) -> int:
    space = np.frombuffer(b" " + raw, np.uint8) == 0x20
    return int(np.count_nonzero(space[:-1] & ~space[1:]))


class TermScan:
    """The automaton of a slice's terms."""

    def __init__(self, terms: list[bytes]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word(" " + term.decode("latin-1") + " ", i)
        self.automaton.make_automaton()

    def __call__(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the terms found, how often)."""
        hits, at = [], 0
        while at < len(raw):
            end = at + PIECE
            if end < len(raw):
                end = raw.find(b" ", end)
                end = len(raw) if end < 0 else end
            hits += map(itemgetter(1), self.automaton.iter(" " + raw[at:end].decode("latin-1") + " "))
            at = end
        return np.unique(np.array(hits, np.int64), return_counts=True)


def scan_of(key: str, terms: list[bytes]) -> TermScan:
    """The slice's automaton, made once in a worker; only the last one used is kept."""
    cache = worker_cache()
    if cache.get("scan", ("", None))[0] != key:
        cache["scan"] = (key, TermScan(terms))
    return cache["scan"][1]


def item_terms(items: DataFrame, slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, int]:
    """(written items: no, item_id, slice, terms as distinct binaries; number of slices)."""
    rows = bare(items, "item_id", "text").filter(F.col("text").isNotNull()).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(spaced(t).split())) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(terms, pa.list_(pa.binary()))],
                                             names=["item_id", "h", "terms"])

    kind = rows.schema["item_id"].dataType.simpleString()
    found = rows.withColumn("h", F.xxhash64("item_id", "text")).mapInArrow(
        run, f"item_id {kind}, h bigint, terms array<binary>").filter(F.size("terms") > 0)
    found = stored(found.withColumn("no", F.monotonically_increasing_id()), "lexical-terms")
    size = F.sum(F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t) + 16))
    total = found.agg(size).first()[0] or 0
    n = -(-total // slice_bytes)
    return stored(found.select("no", "item_id", F.pmod("h", F.lit(max(1, n))).cast("int").alias("slice"), "terms"),
                  "lexical-items"), n


class Slice:
    """What a slice's scans need, bounded by the slice: terms, and per term the items that hold it."""

    def __init__(self, rows: list) -> None:
        self.key = uuid.uuid4().hex
        self.numbers = [r["no"] for r in rows]
        self.terms = sorted({t for r in rows for t in map(bytes, r["terms"])})
        place = {t: i for i, t in enumerate(self.terms)}
        pairs = sorted((place[bytes(t)], k) for k, r in enumerate(rows) for t in r["terms"])
        self.item_of = np.array([k for _, k in pairs], np.int64)
        self.count = np.bincount([t for t, _ in pairs], minlength=len(self.terms))
        self.first = np.cumsum(self.count) - self.count


def statistics(docs: DataFrame, part: Slice) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms in all, documents that hold each of the slice's terms)."""
    key, terms = part.key, part.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, df, n_docs, n_terms = scan_of(key, terms), np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                raw = spaced(text.as_py())
                if n := count_terms(raw):
                    n_docs, n_terms = n_docs + 1, n_terms + n
                    df[scan(raw)[0]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [n_docs, n_terms]))],
                                         names=["term", "n"])

    found = bare(docs, "text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n"))
    counts = dict(tuple(r) for r in found.collect())        # a row per term of the slice at most
    df = np.zeros(len(terms), np.int64)
    for t, n in counts.items():
        if t >= 0:
            df[t] = n
    return counts.get(-1, 0), counts.get(-2, 0), df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The k best (score, document) of every item among what was added."""

    def __init__(self, n_items: int, k: int, held: int) -> None:
        self.k, self.held, self.n_held = k, max(held, 4 * k * n_items), 0
        self.floor = np.ones(n_items, np.int64)
        self.rows: list[tuple[np.ndarray, ...]] = []

    def add(self, doc_id: int | None, scores: np.ndarray) -> None:
        item = np.flatnonzero(scores >= self.floor)
        if len(item):
            doc = np.full(len(item), _LAST if doc_id is None else doc_id)
            self.rows.append((item, scores[item], doc, np.full(len(item), doc_id is None)))
            self.n_held += len(item)
            if self.n_held > self.held:
                self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        """(item, score, document, whether its id is null) of the best so far."""
        if not self.rows:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        item, score, doc, null = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((null, doc, -score, item))
        item = item[order]
        new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        nth = np.arange(len(item)) - np.repeat(new, np.diff(np.append(new, len(item))))
        keep = order[nth < self.k]
        full = nth == self.k - 1
        self.floor[item[full]] = score[order[full]]
        self.rows = [(item[nth < self.k], score[keep], doc[keep], null[keep])]
        self.n_held = len(keep)
        return self.rows[0]


def slice_ranks(docs: DataFrame, part: Slice, n_docs: int, n_terms: int, df: np.ndarray, k: int, held: int) -> DataFrame:
    """no, doc_id, score and part (of the task) of each task's k best documents of every item of the slice."""
    key, terms, numbers = part.key, part.terms, part.numbers
    first, count, item_of, weight = part.first, part.count, part.item_of, term_weights(n_docs, df)
    # Sums of whole numbers are exact in doubles below 2^53; beyond that they are added as integers.
    exact = float(np.bincount(item_of, np.repeat(weight, count).astype(float)).max(initial=0)) * 1e6 < 2 ** 53

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        scan, best = scan_of(key, terms), Best(len(numbers), k, held)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = spaced(text.as_py())
                if not (n := count_terms(raw)):
                    continue
                term, tf = scan(raw)
                if not len(term):
                    continue
                m = 50 + (50 * n * n_docs) // n_terms
                adds = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                each = count[term]
                at = np.arange(each.sum()) + np.repeat(first[term] - (np.cumsum(each) - each), each)
                if exact:
                    scores = np.bincount(item_of[at], np.repeat(adds, each).astype(float), len(numbers)).astype(np.int64)
                else:
                    scores = np.zeros(len(numbers), np.int64)
                    np.add.at(scores, item_of[at], np.repeat(adds, each))
                best.add(doc_id, scores)
        item, score, doc, null = best.prune()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(numbers, np.int64)[item]), pa.array(doc, mask=null), pa.array(score),
             pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int32))], names=["no", "doc_id", "score", "part"])

    rows = bare(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "no bigint, doc_id bigint, score bigint, part int")


def search(docs: DataFrame, items: DataFrame, k: int = K, slice_bytes: int = SLICE_BYTES, held: int = HELD) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item, scores above 0."""
    listed, n_slices = item_terms(items, slice_bytes)
    found = listed.select("no", F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"),
                          F.lit(0).alias("part")).filter("false")
    for s in range(n_slices):
        rows = listed.filter(F.col("slice") == s).select("no", "terms").collect()      # bounded by slice_bytes
        if rows:
            part = Slice(rows)
            n_docs, n_terms, df = statistics(docs, part)
            if n_docs:
                found = found.unionByName(stored(slice_ranks(docs, part, n_docs, n_terms, df, k, held), "lexical-best"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("group", F.pmod("part", F.lit(GROUPS)))
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("no", "group").orderBy(*order))).filter(F.col("r") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(*order))).filter(F.col("rank") <= k)
    names = listed.select(F.col("no").alias("i_no"), "item_id")
    return found.join(names, F.col("no") == F.col("i_no"), "inner").select("item_id", "rank", "doc_id", "score")
