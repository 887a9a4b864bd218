"""Removal of repeated byte strings by merging the suffix orders of shards.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts at
another place, in any document.  Every shard (input partition) lists its suffixes;
the merge interleaves the suffixes of all shards by refinement: suffixes with a
common prefix form a group, every round looks at more bytes, and a group settles as
soon as its answer is known, so that no suffix is compared or sorted again.

* Suffixes are handled in runs.  The starts whose next ``WINDOW`` bytes have the same
  smallest hashed ``GRAM``-gram (the anchor) follow each other; equal strings of
  LENGTH bytes have their anchors at the same place, so a start is given by its anchor
  and its distance before it (0 to WINDOW - 1).
* Round 0 groups the runs of all shards by the bytes that every string of such a run
  has in common, the LENGTH - WINDOW + 1 bytes from the anchor.  A run alone in its
  group repeats nothing and is done.  Runs whose whole extent (the preceding
  WINDOW - 1 bytes, as steps back through the text take them, and LENGTH bytes from
  the anchor) is equal to another's are repeated as a whole and done.
* Later rounds split what is left into distances of a fixed grid (``STEPS``) and do
  the same with the longer common and the shorter whole extent, down to single
  starts, where both are the string itself.

The byte-by-byte interleave of whole Burrows-Wheeler transforms would take up to
LENGTH passes over every byte; with runs it takes one pass over the text and rounds
over what is still open, a few hundredths of the runs.  The result is exact.  Groups
are only counted (with partial counts before the shuffle), never collected, so a
passage in a third of all documents is no burden to one task.

Defined cases: a null text is empty; shorter texts than LENGTH repeat nothing; copies
(repeated rows included) lose all their strings of LENGTH bytes, each of them; texts
are taken as UTF-8 and may be cut inside a character; an empty table gives an empty
result.  Documents are told apart by 64 bits of a hash of id and text, and groups by
128 bits.  Only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import near_keys, stored
from .wordhash import SpanHash

LENGTH = 200
WINDOW = 100
GRAM = 24
#: Widths of the distance grid in the rounds after the first.
STEPS = (10, 1)
PIECE = 1 << 20
_SPANS = "key bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"


class Runs:
    """Runs of starts of texts that lie one after the other in one byte array."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """begin, end: places of the texts; all positions here are places in ``data``."""
        self.hash = SpanHash(data)
        self.first = self.last = self.anchor = self.text = np.zeros(0, np.int64)
        n = len(data)
        if n < LENGTH:
            return
        at = np.arange(n - GRAM + 1)
        # The hash decides, then the place: the leftmost of equal n-grams.
        bits = np.uint64(max(1, int(n).bit_length()))
        low = (self.hash(at, at + GRAM) >> bits << bits) | at.astype(np.uint64)
        size = 1
        while size * 2 <= WINDOW:
            low = np.minimum(low[:len(low) - size], low[size:])
            size *= 2
        low = np.minimum(low[:len(low) - (WINDOW - size)], low[WINDOW - size:])
        anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        counts = np.maximum(end - begin - LENGTH + 1, 0)
        text = np.repeat(np.arange(len(begin)), counts)
        start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[text]
        if not len(start):
            return
        of = anchor[start]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (text[1:] != text[:-1])]))
        self.first, self.anchor, self.text = start[new], of[new], text[new]
        self.last = start[np.concatenate([new[1:] - 1, [len(start) - 1]])]

    def common(self) -> np.ndarray:
        return self.hash(self.anchor, self.anchor + LENGTH - WINDOW + 1)

    def whole(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the whole extent, whether the text has it)."""
        a, b = self.anchor - (WINDOW - 1), self.anchor + LENGTH
        has = (a >= begin[self.text]) & (b <= end[self.text])
        return self.hash(np.where(has, a, 0), np.where(has, b, 0)), has


def _batches_of_runs(raws: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray, Runs, np.ndarray, np.ndarray]]:
    """Runs of texts, PIECE bytes or so at a time.

    Yields (texts, offset of each part in its text, begin, end, runs, first start to
    take, end of the starts to take); parts of a long text overlap, and each run is
    taken from the part where it begins.
    """
    parts: list[tuple[int, int, int, int]] = []      # text, from, to, starts from here on belong to the next part
    for t, raw in enumerate(raws):
        for p in range(0, max(1, len(raw)), PIECE):
            parts.append((t, max(0, p - WINDOW), min(len(raw), p + PIECE + LENGTH + 2 * WINDOW), p))
    at = 0
    while at < len(parts):
        stop, size = at, 0
        while stop < len(parts) and (stop == at or size + parts[stop][2] - parts[stop][1] <= PIECE):
            size += parts[stop][2] - parts[stop][1]
            stop += 1
        run = parts[at:stop]
        lens = np.array([b - a for _, a, b, _ in run])
        end = np.cumsum(lens)
        begin = end - lens
        data = np.frombuffer(b"".join(raws[t][a:b] for t, a, b, _ in run), np.uint8)
        runs = Runs(data, begin, end)
        take = begin + np.array([p - a for _, a, _, p in run])
        yield [t for t, *_ in run], np.array([a for _, a, _, _ in run]), begin, end, runs, take, take + PIECE
        at = stop


def _raw(texts: pa.Array) -> list[bytes]:
    return [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in texts.to_pylist()]


def suffix_runs(docs: DataFrame) -> DataFrame:
    """The runs of all documents: key, anchor (place in the text), common and whole (hashes; whole may be null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for texts, shift, begin, end, runs, take, until in _batches_of_runs(_raw(batch.column(1))):
                mine = (runs.first >= take[runs.text]) & (runs.first < until[runs.text]) if len(runs.first) else []
                if not np.any(mine):
                    continue
                whole, has = runs.whole(begin, end)
                key = keys[np.array(texts)[runs.text[mine]]]
                place = runs.anchor[mine] - begin[runs.text[mine]] + shift[runs.text[mine]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(place, pa.int64()),
                     pa.array(runs.common()[mine].view(np.int64)), pa.array(whole[mine].view(np.int64), mask=~has[mine])],
                    names=["key", "anchor", "common", "whole"])

    return docs.select("key", "text").mapInArrow(run, "key bigint, anchor bigint, common bigint, whole bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text")


def first_round(runs: DataFrame) -> DataFrame:
    """Per document with open or repeated runs: key, done (anchors of repeated runs), open (anchor, common).

    One run of each settled kind stays open where others of its group are, for these to be compared with.
    """
    groups = runs.groupBy(F.col("common").alias("g")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
    left = stored(runs.join(groups, F.col("common") == F.col("g"), "left_semi"), "repeats-runs")
    same = left.filter("whole is not null").groupBy(F.col("common").alias("s_common"), F.col("whole").alias("s_whole")) \
               .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "anchor")).alias("one")).filter("n > 1")
    same = stored(same.select("s_common", "s_whole", "one"), "repeats-same")
    left = left.join(same.select("s_common", "s_whole"),
                     (F.col("whole") == F.col("s_whole")) & (F.col("common") == F.col("s_common")), "left") \
               .select("key", "anchor", "common", F.col("s_whole").isNotNull().alias("settled"))
    left = stored(left, "repeats-settled")
    still = left.filter("not settled").select(F.col("common").alias("o_common")).distinct()
    ones = same.join(still, F.col("s_common") == F.col("o_common"), "left_semi") \
               .select("one.key", "one.anchor", F.col("s_common").alias("common"), F.lit(False).alias("settled"))
    return left.unionByName(ones).groupBy("key").agg(
        F.collect_set(F.when(F.col("settled"), F.col("anchor"))).alias("done"),
        F.collect_set(F.when(~F.col("settled"), F.struct("anchor", "common"))).alias("open"))


def candidate_texts(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Documents with open or repeated runs: key, raw, done (first, last start of repeated runs) and open runs with
    their surroundings (anchor, common, lo and hi distance, off: place of the anchor in ctx, ctx)."""
    d = per_doc.withColumnRenamed("key", "p_key")
    rows = near_keys(docs, docs["key"], per_doc, per_doc["key"])
    rows = rows.join(d, F.col("key") == F.col("p_key"), "inner").select("key", "text", "done", "open").dropDuplicates(["key"])
    open_type = pa.struct([("anchor", pa.int64()), ("common", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                           ("off", pa.int32()), ("ctx", pa.binary())])
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = _raw(batch.column(1))
            ranges: list[dict[int, tuple[int, int]]] = [{} for _ in raws]
            for texts, shift, begin, _, runs, take, until in _batches_of_runs(raws):
                if len(runs.first):
                    mine = (runs.first >= take[runs.text]) & (runs.first < until[runs.text])
                    move = shift[runs.text[mine]] - begin[runs.text[mine]]
                    for t, a, f, l in zip(runs.text[mine], (runs.anchor[mine] + move).tolist(),
                                          (runs.first[mine] + move).tolist(), (runs.last[mine] + move).tolist()):
                        ranges[texts[t]][a] = (f, l)
            done, opened = [], []
            for raw, known, d, o in zip(raws, ranges, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                done.append([dict(zip(("first", "last"), known[a])) for a in sorted(d)])
                mine = []
                for x in sorted(o, key=lambda x: x["anchor"]):
                    a, (f, l) = x["anchor"], known[x["anchor"]]
                    left = max(0, a - WINDOW + 1)
                    mine.append({"anchor": a, "common": x["common"], "lo": a - l, "hi": a - f, "off": a - left,
                                 "ctx": raw[left:a + LENGTH]})
                opened.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raws, pa.binary()), pa.array(done, pa.list_(span)), pa.array(opened, pa.list_(open_type))],
                names=["key", "raw", "done", "open"])

    schema = ("key bigint, raw binary, done array<struct<first: bigint, last: bigint>>, open array<struct<anchor: bigint, "
              "common: bigint, lo: int, hi: int, off: int, ctx: binary>>")
    return stored(rows.mapInArrow(run, schema), "repeats-texts")


def later_rounds(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """Repeated starts among the open runs: key, first, last.  copies: rows of each key (several for repeated rows)."""
    runs = texts.filter(F.size("open") > 0).select("key", F.explode("open").alias("o")).select("key", "o.*")
    runs = stored(runs.join(copies, F.col("key") == F.col("c_key"), "inner").drop("c_key"), "repeats-open")
    todo, width, found = runs.select("key", "anchor", F.lit(0).alias("cell")), WINDOW, []
    for r, step in enumerate(STEPS):
        t = todo.select(F.col("key").alias("t_key"), F.col("anchor").alias("t_anchor"), "cell")
        rows = runs.join(t, (F.col("key") == F.col("t_key")) & (F.col("anchor") == F.col("t_anchor")), "inner")
        a = F.greatest(F.floor(F.col("lo") / step), (F.col("cell") * (width // step)).cast("bigint"))
        b = F.least(F.floor(F.col("hi") / step), ((F.col("cell") + 1) * (width // step) - 1).cast("bigint"))
        rows = rows.withColumn("a", a).withColumn("b", b).filter("a <= b") \
                   .withColumn("at", F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))))
        near, far = F.col("at") * step, F.least((F.col("at") + 1) * step - 1, F.lit(WINDOW - 1))
        rows = rows.withColumn("near", near).withColumn("far", far)
        common = F.xxhash64(F.expr(f"substring(ctx, off - near + 1, {LENGTH} - (far - near))"))
        fits = (F.col("off") >= F.col("far")) & (F.col("off") - F.col("near") + LENGTH <= F.octet_length("ctx"))
        whole = F.when(fits, F.xxhash64(F.expr(f"substring(ctx, off - far + 1, {LENGTH} + (far - near))")))
        rows = stored(rows.select("key", "anchor", "copies", F.col("common").alias("group"), "at",
                                  F.greatest("near", "lo").alias("near"), F.least("far", "hi").alias("far"),
                                  common.alias("c"), whole.alias("w")), f"repeats-round{r}")
        several = rows.groupBy(F.col("group").alias("g"), F.col("at").alias("g_at"), F.col("c").alias("g_c")).agg(
            F.sum("copies").alias("n")).filter("n > 1").select("g", "g_at", "g_c")
        rows = rows.join(several, (F.col("c") == F.col("g_c")) & (F.col("group") == F.col("g"))
                         & (F.col("at") == F.col("g_at")), "left_semi")
        same = rows.filter("w is not null").groupBy(
            F.col("group").alias("s"), F.col("at").alias("s_at"), F.col("c").alias("s_c"), F.col("w").alias("s_w")).agg(
            F.sum("copies").alias("n"), F.min(F.struct("key", "anchor")).alias("one")).filter("n > 1")
        same = stored(same, f"repeats-same{r}")
        rows = rows.join(same.select("s", "s_at", "s_c", "s_w", F.lit(True).alias("same")), (F.col("w") == F.col("s_w")) & (F.col("c") == F.col("s_c")) & (F.col("group") == F.col("s"))
                         & (F.col("at") == F.col("s_at")), "left")
        rows = stored(rows.select("key", "anchor", "group", "at", "c", "near", "far",
                                  F.coalesce("same", F.lit(False)).alias("same")), f"repeats-settled{r}")
        found.append(rows.filter("same").select("key", (F.col("anchor") - F.col("far")).alias("first"),
                                                (F.col("anchor") - F.col("near")).alias("last")))
        rest = rows.filter("not same")
        still = rest.select("group", F.col("at").alias("r_at"), F.col("c").alias("r_c")).distinct()
        ones = same.join(still, (F.col("s_c") == F.col("r_c")) & (F.col("s") == F.col("group"))
                         & (F.col("s_at") == F.col("r_at")), "left_semi")
        todo, width = rest.select("key", "anchor", F.col("at").alias("cell")).unionByName(
            ones.select("one.key", "one.anchor", F.col("s_at").alias("cell"))).distinct(), step
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per document that loses bytes: key, n_removed, spans (maximal removed runs), kept (the bytes that stay)."""
    d = _keyed(docs)
    per_doc = stored(first_round(suffix_runs(d)), "repeats-first")
    texts = candidate_texts(d, per_doc)
    copies = d.groupBy(F.col("key").alias("c_key")).agg(F.count(F.lit(1)).alias("copies"))
    more = later_rounds(texts, copies).groupBy(F.col("key").alias("m_key")).agg(
        F.collect_list(F.struct("first", "last")).alias("more"))
    rows = texts.select("key", "raw", "done").join(more, F.col("key") == F.col("m_key"), "left") \
                .select("key", "raw", "done", "more").filter((F.size("done") > 0) | F.col("more").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, raw, done, more in zip(*(c.to_pylist() for c in batch.columns)):
                change = np.zeros(len(raw) + 1, np.int32)
                for s in done + (more or []):
                    change[s["first"]] += 1
                    change[s["last"] + LENGTH] -= 1
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                spans = [{"start": int(a), "stop": int(b)} for a, b in zip(edge[0::2], edge[1::2])]
                out.append((key, int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary()]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             names=["key", "n_removed", "spans", "kept"])

    return rows.mapInArrow(run, _SPANS)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans, kept_sha256 (of the bytes that stay)."""
    found = repeated_spans(docs).select(F.col("key").alias("f_key"), "n_removed", "spans", F.sha2("kept", 256).alias("sha"))
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    base = _keyed(docs).select("doc_id", "key", F.octet_length(raw).cast("bigint").alias("n_bytes"),
                               F.sha2(raw, 256).alias("all_sha"))
    return base.join(stored(found, "repeats-found"), F.col("key") == F.col("f_key"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("spans"),
        F.coalesce("sha", "all_sha").alias("kept_sha256"))
