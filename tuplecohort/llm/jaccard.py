"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct ``SHINGLE``-word shingles; documents link when
the Jaccard similarity of their sets is at least ``PERCENT`` / 100.

1. Equal sets collapse into one; all that follows is between different sets.
2. Prefix filter.  With the tokens of all sets in one fixed order, two similar sets
   share a token among the first ``n - ceil(t n) + 1`` of each.  The order puts
   rare tokens first: tokens in the lowest part of the hash range (1.6 times the
   share that a prefix takes, and a little) are counted exactly over all documents;
   those in one set only come first (they link nothing and are never indexed), then
   the others by count, then the rest of the hash range.  Small sets, of which such
   a part is too little, are joined in a class of their own that counts all tokens;
   sets near its border are in both.
3. Index-level skipping.  In a short index list two sets are compared only if their
   sizes and the positions of the token leave enough room, and if the counted tokens
   that they share (known for the sets of the index) make it possible.  A long list
   first links its sets to a leader (stars); lists that hold one component then are
   skipped whole.  The sets that stay open are put into blocks of bounded size, those
   already connected together; two blocks skip each other by their ranges of size, or
   if both are of one component.  A set is shuffled once for each block that its block
   meets, so the meetings are dealt into portions of bounded size, done one after another.
4. Answer-level skipping.  A set is compared with a block by counting its overlap with
   one of the block's sets and deriving the other overlaps from the differences between
   these sets alone, and not at all if it is connected to all of them.
5. Connected components of all verified links.

All links found are comparisons of whole sets; a pair is only left out if it
cannot reach the threshold or its two sets are already connected.

Words are compared by a pair of polynomial hashes modulo two primes (62 bits), shingles
by 64-bit hashes of these, sets by 64 bits of a digest.

Defined cases: a null text and a text without words have the empty set, linked with
nothing, not even with each other; a text with fewer than ``SHINGLE`` words is one
shingle; a null doc_id counts as larger than any other; repeated rows have equal
sets; a component of null ids only has component_id null; an empty table gives an
empty result.  Only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_shuffles, near_keys, release, stored
from .components import components
from .wordhash import shingle_set, word_hashes

SHINGLE = 3
PERCENT = 90
#: Sets of at most so many tokens are in the class that counts all tokens.
SMALL = 64
STAR_ROUNDS = 2
#: A block holds about so many sets and tokens at most (one set may have more tokens).
BLOCK, BLOCK_TOKENS = 1024, 1 << 17
#: A portion of the meetings shuffles about so many bytes, or so many times those of all sets that stayed open if that is more.
PORTION, PORTION_TIMES = 64 << 20, 2
#: Longer lists are not turned into pairs.
SHORT_LIST = 32
_SETS = "doc_id bigint, th bigint, cid bigint, n int, counted int, small array<bigint>, large array<bigint>"


def _needed(n: np.ndarray | int, percent: int):
    return -(-percent * n // 100)


def _alpha(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of sets of a and b tokens that reaches the threshold."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def counted_below(percent: int) -> int:
    """Tokens with a smaller hash are counted in the large class: rather more than a prefix takes."""
    return int(2 ** 62 * min(1.0, 4 * (1.6 * (100 - percent) / 100 + 0.02)))


def _digest(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, th (hash of the text), cid (digest of the set, null if empty), n, and the tokens for the prefix join.

    ``small`` and ``large`` hold the tokens that the two classes need: the counted ones
    (``counted`` of them in the large class), and as many more as the prefix takes.
    Only the first row of a partition with a set has them.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["doc_id", "th", "cid", "n", "counted", "small", "large"]
    below = counted_below(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for doc, th, words in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                          word_hashes(part.column(2).to_pylist())):
                    s = shingle_set(words, size)
                    n = len(s)
                    if not n:
                        out.append((doc, th, None, 0, 0, None, None))
                        continue
                    cid, small, large = _digest(s), None, None
                    counted = int(np.searchsorted(s, np.uint64(below)))
                    if cid not in known:
                        known.add(cid)
                        if n * percent <= SMALL * 100:
                            small = s.view(np.int64)
                        if n > SMALL:
                            prefix = n - _needed(n, percent) + 1
                            large = s[:max(counted, prefix)].view(np.int64)
                    out.append((doc, th, cid, n, counted, small, large))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, _SETS)


def prefix_index(sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The index and, for the sets in it, the counted tokens that they share with others.

    Index rows: cls, token, cid, n, pos (tokens before it in the order), length (of the list; lists of one set are
    out).  Sketch rows: cls, cid, n, m (counted tokens, shared or not), shared (array).
    """
    rows = None
    for cls, col in ((0, "small"), (1, "large")):
        r = sets.filter(F.col(col).isNotNull()).select(F.lit(cls).cast("byte").alias("cls"), "cid",
                                                       F.explode(col).alias("token"))
        rows = r if rows is None else rows.unionByName(r)
    count = rows.groupBy(F.col("cls").alias("c_cls"), F.col("token").alias("c_token")).agg(
        F.min("cid").alias("a"), F.max("cid").alias("b"), F.count(F.lit(1)).alias("c")).filter("a < b") \
        .select("c_cls", "c_token", "c")
    shared = rows.join(count, (F.col("token") == F.col("c_token")) & (F.col("cls") == F.col("c_cls")), "inner") \
                 .select("cls", "cid", "token", "c")
    info = sets.filter("cid is not null").groupBy(F.col("cid").alias("i_cid")).agg(
        F.first("n").alias("n"), F.first("counted").alias("counted"))
    shared = shared.join(info, F.col("cid") == F.col("i_cid"), "inner")
    late = (F.col("cls") == 1) & ~F.col("token").between(0, counted_below(percent) - 1)
    shared = shared.withColumn("late", late)
    of_set = Window.partitionBy("cls", "cid")
    # Copies of a set may have come from several partitions: dense_rank counts a token once.
    shared = shared.withColumn("rank", F.dense_rank().over(of_set.orderBy("late", "c", "token")))
    shared = shared.withColumn("n_shared", F.coalesce(F.max(F.when(~F.col("late"), F.col("rank"))).over(of_set), F.lit(0)))
    counted = F.when(F.col("cls") == 0, F.col("n")).otherwise(F.col("counted"))
    pos = F.when(F.col("late"), counted).otherwise(counted - F.col("n_shared") + F.col("rank") - 1)
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # A set with as many unshared tokens as a prefix has is similar to no other set.
    shared = shared.withColumn("pos", pos.cast("int")).withColumn("m", counted.cast("int")) \
                   .filter(F.col("late") | (counted - F.col("n_shared") < prefix))
    shared = stored(shared.select("cls", "token", "cid", "n", "m", "pos", "late", (F.col("late") | (F.col("pos") < prefix))
                                  .alias("in_prefix")).distinct(), "jaccard-shared")
    index = shared.filter("in_prefix")
    lists = index.groupBy(F.col("cls").alias("s_cls"), F.col("token").alias("s_token")).agg(
        F.count(F.lit(1)).alias("length")).filter("length > 1")
    index = index.join(lists, (F.col("token") == F.col("s_token")) & (F.col("cls") == F.col("s_cls")), "inner") \
                 .select("cls", "token", "cid", "n", "pos", "length")
    index = stored(index, "jaccard-lists")
    named = index.select(F.col("cls").alias("n_cls"), F.col("cid").alias("n_cid")).distinct()
    # A set that is in the index through uncounted tokens only has an empty sketch.
    sketch = shared.join(named, (F.col("cid") == F.col("n_cid")) & (F.col("cls") == F.col("n_cls")), "left_semi") \
                   .groupBy("cls", "cid", "n", "m").agg(F.collect_list(F.when(~F.col("late"), F.col("token"))).alias("shared"))
    sketch = stored(sketch, "jaccard-sketches")
    release(shared)
    return index, sketch


def could_be_similar(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (cls, a, b) whose counted tokens leave it possible.

    Similar sets of x and y tokens share alpha at least, so of m counted tokens of x no more than
    x - alpha are missing in y.
    """
    def side(p: str) -> DataFrame:
        return sketches.select(*[F.col(c).alias(f"{p}_{c}") for c in ("cls", "cid", "n", "m", "shared")])

    x, y = side("x"), side("y")
    rows = pairs.join(x, (F.col("a") == F.col("x_cid")) & (F.col("cls") == F.col("x_cls")), "inner") \
                .join(y, (F.col("b") == F.col("y_cid")) & (F.col("cls") == F.col("y_cls")), "inner")
    alpha = _alpha(F.col("x_n"), F.col("y_n"), percent)
    need = alpha + F.greatest(F.col("x_m") - F.col("x_n"), F.col("y_m") - F.col("y_n"))
    return rows.filter(F.size(F.array_intersect("x_shared", "y_shared")) >= need).select("a", "b").distinct()


def whole_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cid, tokens (sorted hashes as bytes) of every wanted set (w_cid), made again from a document that has it."""
    pick = sets.join(wanted, F.col("cid") == F.col("w_cid"), "left_semi").groupBy("cid").agg(
        F.min(F.struct("doc_id", "th")).alias("d")).select("cid", F.col("d.doc_id").alias("p_id"), F.col("d.th").alias("p_th"))
    picked = stored(pick, "jaccard-picked")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = near_keys(rows, F.xxhash64("doc_id", "th"), picked, F.xxhash64("p_id", "p_th"))
    rows = rows.join(picked, rows["th"].eqNullSafe(F.col("p_th")) & rows["doc_id"].eqNullSafe(F.col("p_id")), "inner") \
               .select("cid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                got = [shingle_set(w, size) for w in word_hashes(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g.tobytes() for g in got], pa.binary())],
                                                 names=["cid", "tokens"])

    # Rows that are equal in id and text give one set several times.
    found = stored(rows.mapInArrow(run, "cid bigint, tokens binary").dropDuplicates(["cid"]), "jaccard-sets")
    release(picked)
    return found


def _in(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_, values)
    at[at == len(sorted_)] = 0
    return sorted_[at] == values


def _similar(overlap, n: int, m, percent: int):
    return 100 * overlap >= percent * (n + m - overlap)


def verify_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar."""
    b = sets.select(F.col("cid").alias("b_cid"), F.col("tokens").alias("b_tokens"))
    rows = pairs.join(sets, F.col("a") == F.col("cid"), "inner").select("a", "b", "tokens") \
                .join(b, F.col("b") == F.col("b_cid"), "inner").select("a", "b", "tokens", "b_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(bool(_similar(int(_in(p, q).sum()), len(p), len(q), percent)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


class Block:
    """Connected sets, held as one of them and the others' differences from it."""

    def __init__(self, cids: list[int], sets: list[np.ndarray]) -> None:
        self.cids, self.ref = cids, sets[0]
        self.sizes = np.array([len(s) for s in sets])
        more = [s[~_in(self.ref, s)] for s in sets]
        less = [self.ref[~_in(s, self.ref)] for s in sets]
        self.more, self.more_of = self._sorted(more)
        self.less, self.less_of = self._sorted(less)

    @staticmethod
    def _sorted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all parts in order, and the part of each."""
        tokens, of = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(tokens, kind="stable")
        return tokens[order], of[order]

    def _counts(self, tokens: np.ndarray, of: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many tokens of x each of the parts has."""
        first = np.searchsorted(tokens, x)
        times = np.searchsorted(tokens, x, "right") - first
        at = np.arange(int(times.sum())) + np.repeat(first - (np.cumsum(times) - times), times)
        return np.bincount(of[at], minlength=len(self.cids))

    def similar(self, x: np.ndarray, percent: int) -> np.ndarray:
        """Places of the block's sets similar to x: one overlap is counted, the others are derived from it."""
        overlap = int(_in(x, self.ref).sum()) + self._counts(self.more, self.more_of, x) - self._counts(self.less, self.less_of, x)
        return np.flatnonzero(_similar(overlap, len(x), self.sizes, percent))


def compare_blocks(meets: DataFrame, blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sets of two blocks, as many as connect what is connected, for each row of ``meets``.

    meets: x, y (blocks), blocks: block, cid, comp (component so far).  A block has a bounded number of sets.
    """
    def side(name: str) -> DataFrame:
        s = sets.select(F.col("cid").alias("t_cid"), "tokens")
        m = meets.select(F.col("x").alias("m_x"), F.col("y").alias("m_y"))
        rows = blocks.join(s, F.col("cid") == F.col("t_cid"), "inner").join(m, F.col("block") == F.col(f"m_{name}"), "inner")
        # New names for every column: both sides come from the same tables.
        return rows.select(*[F.col(c).alias(d) for c, d in (("m_x", "x"), ("m_y", "y"), ("cid", "cid"), ("comp", "comp"),
                                                            ("tokens", "tokens"))])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            ids, comps = right["cid"].to_pylist(), right["comp"].to_pylist()
            block = Block(ids, [np.frombuffer(t, np.uint64) for t in right["tokens"].to_pylist()])
            up: dict[int, int] = {}

            def root(c: int) -> int:
                while up.get(c, c) != c:
                    c = up[c]
                return c

            for cid, comp, t in zip(*(left[c].to_pylist() for c in ("cid", "comp", "tokens"))):
                if all(root(c) == root(comp) for c in comps):
                    continue
                for i in block.similar(np.frombuffer(t, np.uint64), percent).tolist():
                    if root(comp) != root(comps[i]):
                        up[root(comp)] = root(comps[i])
                        out.append((cid, ids[i]))
        cols = list(zip(*out)) if out else [[], []]
        return pa.table([pa.array(x, pa.int64()) for x in cols], names=["a", "b"])

    return side("x").groupBy("x", "y").cogroup(side("y").groupBy("x", "y")).applyInArrow(meet, "a bigint, b bigint")


def _near(a_n: Column, a_pos: Column, b_n: Column, b_pos: Column, percent: int) -> Column:
    """Size and positional bounds of two sets in a list."""
    return (a_n * percent <= b_n * 100) & (b_n * percent <= a_n * 100) \
        & (F.least(a_n - a_pos, b_n - b_pos) >= _alpha(a_n, b_n, percent))


def short_list_pairs(index: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that meet in a short list and could be similar."""
    short = index.filter(F.col("length") <= SHORT_LIST)
    x = short.select("cls", "token", F.col("cid").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"))
    y = short.select(F.col("cls").alias("b_cls"), F.col("token").alias("b_token"), F.col("cid").alias("b"),
                     F.col("n").alias("b_n"), F.col("pos").alias("b_pos"))
    rows = x.join(y, (F.col("token") == F.col("b_token")) & (F.col("cls") == F.col("b_cls")) & (F.col("a") < F.col("b"))
                  & _near(F.col("a_n"), F.col("a_pos"), F.col("b_n"), F.col("b_pos"), percent), "inner")
    return could_be_similar(rows.select("cls", "a", "b").distinct(), sketches, percent)


def long_list_links(index: DataFrame, sketches: DataFrame, sets: DataFrame, links: DataFrame, percent: int,
                    rounds: int = STAR_ROUNDS) -> DataFrame:
    """Links of sets that meet in long lists, beside what ``links`` connects already: all that connect components."""
    long = index.filter(F.col("length") > SHORT_LIST)
    nodes = stored(long.select(F.col("cid").alias("node")).distinct(), "jaccard-long")
    n_nodes = nodes.count()

    def labelled(found: DataFrame) -> DataFrame:
        found = components(found)
        cc = found.withColumnsRenamed({"node": "c_node", "comp": "c_comp"})
        label = stored(nodes.join(cc, F.col("node") == F.col("c_node"), "left")
                       .select("node", F.coalesce("c_comp", "node").alias("comp")), "jaccard-label", n_nodes)
        release(found)
        return label

    def open_lists(label: DataFrame) -> DataFrame:
        """Rows of the long lists that hold two components or more."""
        rows = long.join(label, F.col("cid") == F.col("node"), "inner").drop("node")
        two = rows.groupBy(F.col("cls").alias("o_cls"), F.col("token").alias("o_token")).agg(
            F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("o_cls", "o_token")
        return rows.join(two, (F.col("token") == F.col("o_token")) & (F.col("cls") == F.col("o_cls")), "left_semi")

    label = labelled(links)
    for r in range(rounds):
        rows = stored(open_lists(label), f"jaccard-open{r}")
        # The leader of a list: the set whose token comes earliest at first, any other one in later rounds.
        lead = F.struct("pos", "cid") if r == 0 else F.struct(F.xxhash64("cid", F.lit(r)), "cid")
        heads = rows.groupBy(F.col("cls").alias("h_cls"), F.col("token").alias("h_token")).agg(
            F.min(F.struct(lead.alias("k"), F.col("comp").alias("comp"))).alias("h"))
        heads = heads.select("h_cls", "h_token", F.col("h.k.cid").alias("lead"), F.col("h.comp").alias("l_comp"))
        near = rows.join(heads, (F.col("token") == F.col("h_token")) & (F.col("cls") == F.col("h_cls")), "inner") \
                   .filter(F.col("comp") != F.col("l_comp"))
        often = near.groupBy("cls", "cid", "lead").agg(F.count(F.lit(1)).alias("k"))
        best = often.groupBy("cls", "cid").agg(F.max(F.struct("k", "lead")).alias("b")) \
                    .select("cls", F.col("cid").alias("a"), F.col("b.lead").alias("b"))
        new = stored(verify_pairs(could_be_similar(best, sketches, percent), sets, percent), f"jaccard-star{r}")
        links = links.unionByName(new)
        release(rows, label)
        label = labelled(links)

    # What is still open: sets that meet in such lists, directly or by way of others, in blocks of bounded size.
    rows = stored(open_lists(label), "jaccard-open")
    heads = rows.groupBy(F.col("cls").alias("h_cls"), F.col("token").alias("h_token")).agg(F.min("cid").alias("head"))
    met = rows.join(heads, (F.col("token") == F.col("h_token")) & (F.col("cls") == F.col("h_cls")), "inner") \
              .select(F.col("cid").alias("a"), F.col("head").alias("b"))
    met = components(met)
    canopy = met.select(F.col("node").alias("k_node"), F.col("comp").alias("canopy"))
    sizes = rows.select("cid", "n", "comp").distinct()
    sizes = sizes.join(canopy, F.col("cid") == F.col("k_node"), "inner").select("canopy", "cid", "n", "comp")
    # Connected sets stand together, so that a block of one component skips all blocks of that component.
    of = sizes.groupBy("canopy", F.col("comp").alias("z_comp")).agg(F.count(F.lit(1)).alias("z"), F.sum("n").alias("z_tokens")) \
              .withColumnRenamed("canopy", "z_canopy")
    sizes = sizes.join(of, (F.col("comp") == F.col("z_comp")) & (F.col("canopy") == F.col("z_canopy")), "inner")

    def blocks_for(n: str, tokens: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(tokens) / BLOCK_TOKENS))

    large = (F.col("z") >= BLOCK) | (F.col("z_tokens") >= BLOCK_TOKENS)
    part = F.when(large, F.struct(F.col("comp").alias("of"), F.pmod(F.xxhash64("cid"), blocks_for("z", "z_tokens")).alias("p")))
    lone = sizes.filter(~large).groupBy(F.col("canopy").alias("y_canopy")).agg(F.count(F.lit(1)).alias("y"),
                                                                               F.sum("n").alias("y_tokens"))
    sizes = sizes.join(lone, F.col("canopy") == F.col("y_canopy"), "left")
    rest = F.struct(F.lit(0).cast("bigint").alias("of"),
                    (-1 - F.pmod(F.xxhash64("comp"), blocks_for("y", "y_tokens"))).alias("p"))
    blocks = stored(sizes.select("canopy", F.xxhash64("canopy", F.coalesce(part, rest)).alias("block"), "cid", "n", "comp"),
                    "jaccard-blocks", n_nodes)
    release(met, label, nodes, rows)
    each = stored(blocks.groupBy("canopy", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("c_lo"),
                                                        F.max("comp").alias("c_hi"), (F.sum("n") * 8).alias("bytes")),
                  "jaccard-block-list")
    last = compare_in_portions(block_meetings(each, percent), blocks.select("block", "cid", "comp"), sets, percent,
                               each.agg(F.sum("bytes")).first()[0] or 0)
    release(each, blocks)
    return links if last is None else links.unionByName(last)


def block_meetings(each: DataFrame, percent: int) -> DataFrame:
    """x, y (blocks that may hold similar sets not yet connected) and the bytes of their sets."""
    other = each.select(*[F.col(c).alias(f"o_{c}") for c in each.columns])
    one = (F.col("c_lo") == F.col("c_hi")) & (F.col("o_c_lo") == F.col("o_c_hi")) & (F.col("c_lo") == F.col("o_c_lo"))
    return each.join(other, (F.col("canopy") == F.col("o_canopy")) & (F.col("block") <= F.col("o_block"))
                     & (F.col("lo") * percent <= F.col("o_hi") * 100) & (F.col("o_lo") * percent <= F.col("hi") * 100) & ~one,
                     "inner").select(F.col("block").alias("x"), F.col("o_block").alias("y"),
                                     (F.col("bytes") + F.col("o_bytes")).alias("bytes"))


def compare_in_portions(meets: DataFrame, blocks: DataFrame, sets: DataFrame, percent: int, held: int) -> DataFrame | None:
    """:func:`compare_blocks` of all ``meets`` (x, y, bytes), so many at a time that the shuffle files of no portion take much
    more than PORTION or PORTION_TIMES times ``held`` (bytes of all sets in blocks); None if no blocks meet."""
    meets = stored(meets, "jaccard-meets")
    portions = -(-(meets.agg(F.sum("bytes")).first()[0] or 0) // max(PORTION, PORTION_TIMES * held))
    found = None
    for k in range(portions):
        mine = meets.filter(F.pmod(F.xxhash64("x", "y"), F.lit(portions)) == k).select("x", "y")
        part = stored(compare_blocks(mine, blocks, sets, percent), f"jaccard-rest{k}")
        found = part if found is None else found.unionByName(part)
    release(meets)
    return found


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, th, n_shingles, component_id (smallest doc_id of its component)."""
    docs = docs.select("doc_id", "text")
    sets = stored(shingle_sets(docs, size, percent), "jaccard-rows")
    index, sketches = prefix_index(sets.select("cid", "n", "counted", "small", "large"), percent)
    pairs = stored(short_list_pairs(index, sketches, percent), "jaccard-pairs")
    drop_shuffles(docs.sparkSession)
    wanted = pairs.select("a").union(pairs.select("b")).union(
        index.filter(F.col("length") > SHORT_LIST).select("cid")).toDF("w_cid").distinct()
    whole = whole_sets(docs, sets.select("doc_id", "th", "cid"), wanted, size)
    links = stored(verify_pairs(pairs, whole, percent), "jaccard-short")
    drop_shuffles(docs.sparkSession)
    found = stored(long_list_links(index, sketches, whole, links, percent), "jaccard-links")
    release(index, sketches, pairs, whole, links)
    comp = components(found)
    first = sets.filter("cid is not null").groupBy(F.col("cid").alias("f_cid")).agg(F.min("doc_id").alias("first_id"))
    first = first.join(comp, F.col("f_cid") == F.col("node"), "left") \
                 .select("f_cid", "first_id", F.coalesce("comp", "f_cid").alias("comp"))
    first = stored(first, "jaccard-first")
    release(comp, found)
    least = first.groupBy(F.col("comp").alias("l_comp")).agg(F.min("first_id").alias("component_id"))
    of = first.join(least, F.col("comp") == F.col("l_comp"), "inner").select("f_cid", "comp", "component_id")
    out = sets.select("doc_id", "th", "cid", "n").join(of, F.col("cid") == F.col("f_cid"), "left")
    return out.select("doc_id", "th", F.col("n").cast("bigint").alias("n_shingles"),
                      F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.col("comp").alias("component"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates, with all their columns.

    Of each component the row with the smallest doc_id stays (then the smallest text
    hash; of rows equal in both one stays).  Texts with an empty set all stay.
    """
    found = stored(jaccard_components(docs, size, percent), "jaccard-found")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    keep = found.filter("component is not null").groupBy("component").agg(F.min(first).alias("k")) \
                .select(F.col("k.doc_id").alias("k_id"), F.col("k.th").alias("k_th"))
    rows = found.groupBy(F.col("doc_id").alias("r_id"), F.col("th").alias("r_th")).agg(F.count(F.lit(1)).alias("rows"))
    keep = keep.join(rows, F.col("k_th").eqNullSafe(F.col("r_th")) & F.col("k_id").eqNullSafe(F.col("r_id")), "inner") \
               .select("k_id", "k_th", "rows")
    empty = found.filter("component is null").select("doc_id", "th").distinct().withColumn("rows", F.lit(1).cast("bigint"))
    keep = stored(keep.union(empty).toDF("k_id", "k_th", "rows"), "jaccard-keep")
    release(found)
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"), F.col("doc_id").cast("bigint").alias("d_id"),
                    F.xxhash64("text").alias("d_th"))
    d = d.join(keep, F.col("d_th").eqNullSafe(F.col("k_th")) & F.col("d_id").eqNullSafe(F.col("k_id")), "inner")
    again = d.filter("rows > 1").withColumn(
        "nth", F.row_number().over(Window.partitionBy("d_id", "d_th").orderBy("d_id"))).filter("nth = 1")
    return d.filter("rows = 1").select("r").unionByName(again.select("r")).select("r.*")
