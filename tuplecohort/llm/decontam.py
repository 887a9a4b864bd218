"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every item is cut into windows of ``WINDOW`` consecutive words (an item of fewer
words is one window).  A document is searched for exact occurrences of them:

1. The shingles of ``SHINGLE`` words of all documents that occur in any item are
   kept with their positions; their counts over all documents rank the shingles.
2. Containment has to be complete, so the necessary prefix of a window, in the
   order of rarity, is its one rarest shingle.  A window with a shingle that no
   document has is out.
3. Joining on the prefix shingle and the place it has in the window gives the
   start of a possible occurrence; it must lie in the document as a whole
   (positional and length bounds).
4. The words of the document from that start are compared with the window's.

Words are runs of digits, a-z (after A-Z became a-z) and all non-ASCII characters.
Steps 1 to 3 compare words in Unicode lower case, character by character, which can
only add candidates; step 4 is exact.

Defined cases: a null text has no words, as an empty one; items without words have
no window; a null item_id counts as an item that shows as nothing in lists; rows of
``docs`` that are equal in id and text each get the same answer; a null doc_id is
an id like any other; empty tables give no hits or no rows.  Only ``doc_id``,
``text`` and ``item_id``, ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bare, near_keys, stored

WINDOW = 13
SHINGLE = 3
#: One hit word in so many words makes a document contaminated.
HIT_RATE = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def exact_words(text: Column) -> Column:
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(WORD), F.lit(0))


def folded_words(text: Column) -> Column:
    """As :func:`exact_words` but in Unicode lower case: the same number of words, and equal words stay equal."""
    # Capital sigma is the one letter whose lower case depends on what stands around it, beyond word separators too.
    low = F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(WORD), F.lit(0))


def _shingles(words: str, size: int) -> Column:
    """Array of hashes, one for each position of a shingle of ``size`` words (column ``words``)."""
    # Positions near the end have no whole shingle; the slice drops them.
    all_ = F.transform(F.col(words), lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + k) for k in range(1, size)]))
    return F.slice(all_, 1, F.greatest(F.size(F.col(words)) - (size - 1), F.lit(0)))


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per item and window: item_id, wid (hash), wtext (words joined by spaces), len, size, hashes."""
    items = bare(benchmark, "item_id", "text")
    items = items.select("item_id", exact_words(F.col("text")).alias("w"), folded_words(F.col("text")).alias("f"))
    items = items.withColumn("n", F.size("w")).filter("n > 0").withColumn("len", F.least("n", F.lit(window)))
    w = items.select("item_id", "w", "f", "len", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("len") + 1)).alias("p"))
    w = w.select("item_id", "len", F.array_join(F.slice("w", F.col("p"), F.col("len")), " ").alias("wtext"),
                 F.slice("f", F.col("p"), F.col("len")).alias("f"))
    by_size = [F.when(F.least("len", F.lit(shingle)) == s, _shingles("f", s)) for s in range(1, shingle + 1)]
    return w.select("item_id", F.xxhash64("wtext").alias("wid"), "wtext", "len",
                    F.least("len", F.lit(shingle)).alias("size"), F.coalesce(*by_size).alias("hashes"))


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """All occurrences: doc_id, th (hash of the text), start (word, from 0), len, item_id."""
    docs = bare(docs, "doc_id", "text").withColumn("th", F.xxhash64("text"))
    items = stored(item_windows(benchmark, window, shingle), "decontam-items")
    wins = items.select("wid", "wtext", "len", "size", "hashes").distinct()
    tokens = stored(wins.select("size", F.explode("hashes").alias("t_hash")).distinct(), "decontam-tokens")
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect())   # at most ``shingle`` values
    d = docs.select("doc_id", "th", folded_words(F.col("text")).alias("f")).withColumn("n", F.size("f"))
    seen = None
    for s in sizes:
        one = d.select("doc_id", "th", "n", F.posexplode(_shingles("f", s)).alias("pos", "hash"))
        t = tokens.filter(F.col("size") == s).select("t_hash")
        one = one.join(t, F.col("hash") == F.col("t_hash"), "left_semi").withColumn("size", F.lit(s))
        seen = one if seen is None else seen.unionByName(one)
    if seen is None:
        seen = d.select("doc_id", "th", "n", F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("hash"),
                        F.lit(1).alias("size")).filter("false")
    seen = stored(seen, "decontam-shingles")

    # Rarity over all documents, and the rarest shingle of each window.
    count = seen.groupBy(F.col("size").alias("c_size"), F.col("hash").alias("c_hash")).agg(F.count(F.lit(1)).alias("c"))
    each = wins.select("wid", "wtext", "len", "size", F.size("hashes").alias("m"), F.posexplode("hashes").alias("at", "hash"))
    each = each.join(count, (F.col("size") == F.col("c_size")) & (F.col("hash") == F.col("c_hash")), "inner")
    prefix = each.groupBy("wid", "wtext", "len", "size", "m").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("c", "hash", "at")).alias("rarest"))
    prefix = stored(prefix.filter("found = m").select("wid", "wtext", F.col("len").cast("int").alias("len"),
                                                      F.col("size").alias("p_size"), F.col("rarest.hash").alias("p_hash"),
                                                      F.col("rarest.at").alias("p_at")), "decontam-prefix")

    cand = seen.join(prefix.select("wid", "len", "p_size", "p_hash", "p_at"),
                     (F.col("size") == F.col("p_size")) & (F.col("hash") == F.col("p_hash")), "inner")
    cand = cand.withColumn("start", F.col("pos") - F.col("p_at")) \
               .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n")))
    per_doc = stored(cand.groupBy(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th"))
                     .agg(F.collect_set(F.struct("start", "len", "wid")).alias("cands")), "decontam-candidates")

    # The words of documents with candidates, at the places in question.
    text = near_keys(docs, F.xxhash64("doc_id", "th"), per_doc, F.xxhash64("c_id", "c_th"))
    text = text.join(per_doc, text["th"].eqNullSafe(per_doc["c_th"]) & text["doc_id"].eqNullSafe(per_doc["c_id"]), "inner") \
               .withColumn("w", exact_words(F.col("text")))
    at = F.transform("cands", lambda c: F.struct(
        c["start"].alias("start"), c["len"].alias("len"), c["wid"].alias("wid"),
        F.array_join(F.slice(F.col("w"), c["start"] + 1, c["len"]), " ").alias("found")))
    rows = text.select("doc_id", "th", F.explode(at).alias("a")).select("doc_id", "th", "a.*").distinct()
    good = rows.join(prefix.select(F.col("wid").alias("g_wid"), "wtext"),
                     (F.col("wid") == F.col("g_wid")) & (F.col("found") == F.col("wtext")), "inner") \
               .select("doc_id", "th", "start", "len", "wid", "wtext")
    of = items.select("item_id", F.col("wid").alias("i_wid"), F.col("wtext").alias("i_text")).distinct()
    return good.join(of, (F.col("wid") == F.col("i_wid")) & (F.col("wtext") == F.col("i_text")), "inner") \
               .select("doc_id", "th", "start", "len", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  hit_rate: int = HIT_RATE) -> DataFrame:
    """One row per document: doc_id, th, n_words, n_hit, n_items, items (sorted list of strings), contaminated."""
    hits = stored(find_windows(docs, benchmark, window, shingle), "decontam-hits")
    in_order = Window.partitionBy("doc_id", "th").orderBy("start", "stop")
    spans = hits.select("doc_id", "th", "start", (F.col("start") + F.col("len")).alias("stop")).distinct()
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.col("stop") - F.least("stop", F.greatest("start", F.coalesce(before, F.lit(0)))))
    n_hit = spans.groupBy("doc_id", "th").agg(F.sum("new").alias("n_hit"))
    what = hits.select("doc_id", "th", "item_id").distinct().groupBy("doc_id", "th").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    found = n_hit.join(what.withColumnsRenamed({"doc_id": "w_id", "th": "w_th"}),
                       F.col("th").eqNullSafe(F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("w_id")), "inner") \
                 .select(F.col("doc_id").alias("f_id"), F.col("th").alias("f_th"), "n_hit", "n_items", "items")
    base = bare(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64("text").alias("th"),
        F.coalesce(F.regexp_count(F.lower("text"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_words"))
    out = base.join(found, F.col("th").eqNullSafe(F.col("f_th")) & F.col("doc_id").eqNullSafe(F.col("f_id")), "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select("doc_id", "th", "n_words", n.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n > 0) & (hit_rate * n >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("b_id"),
                                                                       F.col("th").alias("b_th")).distinct()
    bad = stored(bad, "decontam-bad")
    at, key = F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])), F.xxhash64("b_id", "b_th")
    maybe = near_keys(docs, at, bad, key).join(bad, F.xxhash64(docs["text"]).eqNullSafe(F.col("b_th"))
                                               & docs["doc_id"].eqNullSafe(F.col("b_id")), "left_anti")
    return near_keys(docs, at, bad, key, others=True).unionByName(maybe)
