"""Alignment of two tokenizers over a corpus, each distinct text once.

1. The documents are shuffled by their full text (copies counted before the shuffle),
   so that every distinct text is encoded and aligned once, whatever its copies.
2. A byte-level tokenizer A encodes a space and the text, a piece tokenizer B the
   text.  Byte offsets where tokens of both end cut the tokens into groups; every A
   token is linked with every B token of its group.  Long texts are encoded in blocks
   cut where both tokenizers have a boundary (:func:`parts.cut_parts`).  The parts
   between such boundaries (mostly words) are aligned once and remembered, all new
   ones of some texts together; a text is put together from its parts (:class:`Parts`).
3. The distinct id pairs of a text, weighted by its copies, are added up, within a task
   first: the pair table says how many documents hold a pair linked, and which pairs
   are the most frequent of their A id.
4. The measures of a text are sums over its links of what the pair table says.  The
   ``HEAD`` most frequent pairs, a table of fixed size, are looked up in place; links
   of the others, each of them rarer than any of those, meet the pair table in a join.
5. Measures go to the documents by the digest of the text.  Texts with more than one
   document in ``HEAVY`` (fewer than HEAVY of them) are broadcast, so a text that a
   third of all documents share is no burden to one task.

Defined cases: null and empty texts, and texts whose tokens of A or B do not spell a
space and the text (e.g. with U+2581), have zeros and the empty string; repeated rows
are documents of their own, with equal measures; a null doc_id is kept; an empty table
gives no rows; texts are taken whole, whatever their length.  Only ``doc_id`` and
``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bare, stored, worker_cache
from .parts import _AFTER_SPACE, BYTE_OF, ByteLevel

HEAD = 1 << 16
HEAVY = 1000
#: Longer texts are encoded in blocks of about so many characters.
BLOCK = 1 << 16
#: Texts of so many characters in all look for new parts together.
GROUP = 1 << 19
#: Parts are remembered within about so many bytes, then begun anew; what a part takes beside its text, spelling and codes.
PARTS_BYTES, OVERHEAD = 96 << 20, 300
#: A task adds up so many pairs before it hands them on.
HELD_PAIRS = 2_000_000
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
#: Not at the end of the text: a lone space there belongs to the block before it.
_CUT = re.compile(r"(?<=\S) (?!\Z)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Parts of a text that follow each other with a space between, each of ``size`` characters or more but the last."""
    at = 0
    while (cut := _CUT.search(text, at + size)) is not None:
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def cut(block: str) -> list[str]:
    """Parts of a block that follow each other with a space between; both tokenizers have a boundary before each such space."""
    plain = block[:1] != " " and block[-1:] != " " and _AFTER_SPACE.search(block) is None
    return block.split(" ") if plain else _CUT.split(block)


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, and the sum of the times of each."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[:len(codes)])
    return codes[first], np.add.reduceat(times[order], first) if len(codes) else times


class Aligner:
    """Two tokenizers, and the bytes and spelling of each of their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = ByteLevel(a_path, plain_specials=True)
        if self.a.fast is None:
            raise ValueError(f"not a plain byte-level tokenizer: {a_path}")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.blocks = not any(re.search("[^▁]▁", p) for p in pieces)
        vocab = self.a.tok.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            a_bytes[i] = bytes(BYTE_OF[c] for c in t)
        self.b_bytes = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(p))
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (a_bytes, self.b_bytes))
        self.n_b = len(pieces)
        # The spelling of an id before the next id of its side, and at the end of its side of a group.
        spell = [np.array([f"{i}{s}" for i in range(n)], object) for n, s in
                 ((len(a_bytes), ","), (len(a_bytes), "|"), (self.n_b, ","), (self.n_b, ";"))]
        self.a_next, self.a_last, self.b_next, self.b_last = spell

    def align(self, text: str) -> tuple[int, int, int, str, np.ndarray] | None:
        """(A tokens, B tokens, groups, spelling of the groups, codes a * n_b + b of all links), or None."""
        found = self.align_parts([text])
        return None if found is None else (*found[0][0, :3].tolist(), found[1][0], found[2])

    def align_parts(self, parts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray] | None:
        """(a row of n_a, n_b, n_groups, n_links for each part, their spellings, codes of all links in order), or None
        if not all of them can be spelt.  The tokenizers have a boundary before each part."""
        text = " ".join(parts)
        a = self.a.ids(" " + text).astype(np.int64)
        b = np.array(self.b.encode(text), np.int64)
        whole = (" " + text).encode()
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != whole or int(self.a_len[a].sum()) != len(whole):
            return None
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        cuts = np.intersect1d(a_end, b_end)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        # Every A token with the B tokens of its group.
        each = n_b[a_group]
        b_first = np.cumsum(n_b) - n_b
        at = np.arange(int(each.sum())) + np.repeat(b_first[a_group] - (np.cumsum(each) - each), each)
        codes = np.repeat(a, each) * self.n_b + b[at]
        a_spelt, b_spelt = self.a_next[a], self.b_next[b]
        ends = np.cumsum(n_a) - 1
        a_spelt[ends] = self.a_last[a[ends]]
        ends = np.cumsum(n_b) - 1
        b_spelt[ends] = self.b_last[b[ends]]
        spelt = np.empty(len(a) + len(b), object)
        spelt[np.arange(len(a)) + b_first[a_group]] = a_spelt
        spelt[np.arange(len(b)) + np.cumsum(n_a)[b_group]] = b_spelt
        # The part of each group, by the byte at which it ends.
        part_end = np.cumsum([len(p.encode()) + 1 for p in parts])
        last = np.minimum(np.searchsorted(cuts, part_end), len(cuts) - 1)
        if not np.array_equal(cuts[last], part_end):
            return None
        up_to = np.stack([np.cumsum(n_a), np.cumsum(n_b), np.arange(1, len(cuts) + 1), np.cumsum(n_a * n_b)], 1)[last]
        to = (up_to[:, 0] + up_to[:, 1]).tolist()
        spelt = spelt.tolist()
        return (np.diff(up_to, axis=0, prepend=0), ["".join(spelt[i:j])[:-1] for i, j in zip([0, *to[:-1]], to)], codes)

    def text(self, text: str) -> tuple[int, int, int, int, str, np.ndarray] | None:
        """(n_a, n_b, n_groups, n_links, sha256 of the groups, codes) of a whole text, or None."""
        n, sha, codes = np.zeros(3, np.int64), hashlib.sha256(), []
        for k, block in enumerate(blocks(text) if self.blocks else [text]):
            found = self.align(block)
            if found is None:
                return None
            n += found[:3]
            sha.update((";" if k else "").encode() + found[3].encode())
            codes.append(found[4])
        codes = np.concatenate(codes)
        return *n.tolist(), len(codes), sha.hexdigest(), codes


def groups(numbered: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """The texts, those of about GROUP characters together."""
    some, size = [], 0
    for i, text in numbered:
        some.append((i, text))
        size += len(text) + 1
        if size >= GROUP:
            yield some
            some, size = [], 0
    if some:
        yield some


class Parts:
    """Alignments of texts, put together from those of their parts, which are remembered within bounds."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner = aligner
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.spelt: list[str] = []
        self.numbers, self.first, self.codes, self.held = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def learn(self, new: list[str]) -> None:
        """Remember the parts.  What ends in white space has no boundary after it and is aligned by itself."""
        todo = [[p for p in new if not p[-1:].isspace()], *[[p] for p in new if p[-1:].isspace()]][::-1]
        numbers, codes, n_codes = [self.numbers], [self.codes], len(self.codes)
        while todo:
            parts = todo.pop()
            if not parts:
                continue
            found = self.aligner.align_parts(parts)
            if found is None and len(parts) > 1:
                todo += [parts[len(parts) // 2:], parts[:len(parts) // 2]]
                continue
            # A part that can't be spelt makes the tokens of its block negative.
            n, spelt, c = found or (np.array([[-(1 << 40), 0, 0, 0]]), [""], self.codes[:0])
            self.place.update(zip(parts, range(len(self.spelt), len(self.spelt) + len(parts))))
            self.spelt += spelt
            numbers.append(n)
            codes.append(c)
            self.held += sum(map(len, parts)) + sum(map(len, spelt)) + 8 * len(c) + OVERHEAD * len(parts)
        self.numbers, self.codes = np.concatenate(numbers), np.concatenate(codes)
        self.first = np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3]

    def of_blocks(self, some: list[str]) -> list[tuple[np.ndarray, str, np.ndarray, np.ndarray] | None]:
        """Of each block (n_a, n_b, n_groups, n_links), spelling, sorted distinct codes and the links of each, or None."""
        if self.held > PARTS_BYTES:
            self.forget()
        parts = [cut(b) for b in some]
        if new := list(dict.fromkeys(p for ps in parts for p in ps if p not in self.place)):
            self.learn(new)
        out = []
        for ps in parts:
            where = list(map(self.place.__getitem__, ps))
            at = np.array(where)
            n = self.numbers[at].sum(0)
            if n[0] < 0:
                out.append(None)
                continue
            at, times = np.unique(at, return_counts=True)
            links = self.numbers[at, 3]
            of = np.arange(int(links.sum())) + np.repeat(self.first[at] - (np.cumsum(links) - links), links)
            out.append((n, ";".join(map(self.spelt.__getitem__, where)), *summed(self.codes[of], np.repeat(times, links))))
        return out

    def of_texts(self, texts: list[str]) -> list[tuple | None]:
        """Of each text (n_a, n_b, n_groups, n_links, sha256 of the groups, sorted distinct codes, links of each), or None."""
        if not self.aligner.blocks:
            found = [self.aligner.text(t) for t in texts]
            return [None if f is None else (*f[:5], *np.unique(f[5], return_counts=True)) for f in found]
        sums: list[list | None] = [[np.zeros(4, np.int64), hashlib.sha256(), [], []] for _ in texts]
        for some in groups((i, b) for i, t in enumerate(texts) for b in blocks(t)):
            for (i, _), found in zip(some, self.of_blocks([b for _, b in some])):
                if found is None or sums[i] is None:
                    sums[i] = None
                    continue
                n, sha, codes, times = sums[i]
                sha.update(((";" if codes else "") + found[1]).encode())
                n += found[0]
                codes.append(found[2])
                times.append(found[3])
        out = []
        for s in sums:
            if s is not None:
                n, sha, codes, times = s
                both = (codes[0], times[0]) if len(codes) == 1 else summed(np.concatenate(codes), np.concatenate(times))
                s = (*n.tolist(), sha.hexdigest(), *both)
            out.append(s)
        return out


class Pairs:
    """Adds up weights of codes, within bounds."""

    def __init__(self) -> None:
        self.codes, self.weights, self.n = [], [], 0

    def add(self, codes: np.ndarray, weight: int) -> None:
        self.codes.append(codes)
        self.weights.append(np.full(len(codes), weight, np.int64))
        self.n += len(codes)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, at, np.concatenate(self.weights))
        self.codes, self.weights, self.n = [codes], [sums], len(codes)
        return codes, sums


def distinct_texts(docs: DataFrame) -> DataFrame:
    """text, copies: the documents' texts, shuffled by the full text."""
    rows = bare(docs, "text").filter(F.col("text").isNotNull() & (F.col("text") != ""))
    return rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def aligned_texts(batches: Iterator[pa.RecordBatch], parts: Parts) -> Iterator[tuple[str, int, tuple | None]]:
    """Each text of the batches (text, copies), its copies and what :meth:`Parts.of_texts` gives for it."""
    for batch in batches:
        copies = batch.column(1).to_pylist()
        for some in groups((i, text.as_py()) for i, text in enumerate(batch.column(0))):
            for (i, text), found in zip(some, parts.of_texts([text for _, text in some])):
                yield text, copies[i], found


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The written alignment.  A row per distinct text: key (SHA-256), copies, n_a .. n_links, groups_sha256, codes
    (sorted distinct link codes) and times (links of each); and rows of code and n, the pair counts of a task."""
    schema = ("key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              "codes binary, times array<int>, code bigint, n bigint")
    kinds = [pa.binary(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def texts_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] + [pa.nulls(len(rows), pa.int64())] * 2
        return pa.RecordBatch.from_arrays(cols, names=names)

    def pairs_of(pairs: Pairs) -> Iterator[pa.RecordBatch]:
        codes, sums = pairs.sums()
        for at in range(0, len(codes), 100_000):
            c, s = pa.array(codes[at:at + 100_000]), pa.array(sums[at:at + 100_000])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(c), k) for k in kinds[:9]], c, s], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        if ("align", a_path, b_path) not in cache:
            cache["align", a_path, b_path] = Parts(Aligner(a_path, b_path))
        parts, pairs, rows, held = cache["align", a_path, b_path], Pairs(), [], 0
        for text, copies, found in aligned_texts(batches, parts):
            if found is None:
                continue
            codes, times = found[5:]
            pairs.add(codes, copies)
            rows.append((hashlib.sha256(text.encode()).digest(), copies, *found[:5], codes.astype("<u4" if wide else "<u8")
                         .tobytes(), times.astype(np.int32)))
            held += len(codes)
            if held > 500_000:
                yield texts_of(rows)
                rows, held = [], 0
            if pairs.n > HELD_PAIRS:
                pairs.sums()
                if pairs.n > HELD_PAIRS // 2:
                    yield from pairs_of(pairs)
                    pairs = Pairs()
        if rows:
            yield texts_of(rows)
        yield from pairs_of(pairs)

    n_a, n_b = vocabularies(a_path, b_path)
    wide = n_a * n_b < 1 << 32                  # codes fit in four bytes
    return stored(distinct_texts(docs).mapInArrow(run, schema), "align-texts")


def vocabularies(a_path: str, b_path: str) -> tuple[int, int]:
    import sentencepiece
    from tokenizers import Tokenizer

    return (Tokenizer.from_file(a_path).get_vocab_size(),
            sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size())


def pair_table(aligned: DataFrame, n_b: int) -> DataFrame:
    """code, n (documents that hold the pair linked), best (whether no pair of its A id has more)."""
    pairs = aligned.filter("code is not null").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = stored(pairs.withColumn("a", F.expr(f"code div {n_b}")), "align-pair-counts")
    most = pairs.groupBy(F.col("a").alias("m_a")).agg(F.max("n").alias("most"))      # a row per id of A at most
    return stored(pairs.join(F.broadcast(most), F.col("a") == F.col("m_a"), "inner")
                  .select("code", "n", (F.col("n") == F.col("most")).alias("best")), "align-pairs")


def frequent(pairs: DataFrame, most: int) -> DataFrame:
    """The most frequent pairs: all of n at least some number, ``most`` rows or fewer."""
    scale = F.floor(F.log2("n") * 8).cast("int")
    sizes = pairs.groupBy(scale.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()     # 8 rows a doubling of n
    held, least = 0, None
    for b, c in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        if held + c > most:
            break
        held, least = held + c, b
    return pairs.filter(F.lit(False) if least is None else scale >= least)


def text_measures(aligned: DataFrame, pairs: DataFrame, wide: bool, head: int = HEAD) -> DataFrame:
    """key, copies, n_a .. n_links, groups_sha256, n_best, count_sum of every distinct text."""
    top = frequent(pairs, head).orderBy("code").toArrow()                                  # ``head`` rows at most
    top_code, top_n, top_best = (top.column(c).to_numpy() for c in ("code", "n", "best"))
    schema = ("key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              "n_best bigint, count_sum bigint, code bigint, times bigint")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_best, count_sum = [], []
            rest: list[list] = [[], [], []]
            keys, times_of = batch.column(0).to_pylist(), batch.column(8)
            for key, codes, times in zip(keys, batch.column(7), times_of):
                codes = np.frombuffer(codes.as_buffer(), "<u4" if wide else "<u8").astype(np.int64)
                times = times.values.to_numpy().astype(np.int64)
                known = np.zeros(len(codes), bool)
                best = total = 0
                if len(top_code):
                    at = np.minimum(np.searchsorted(top_code, codes), len(top_code) - 1)
                    known = top_code[at] == codes
                    at, of = at[known], times[known]
                    best, total = int(of[top_best[at]].sum()), int((of * top_n[at]).sum())
                n_best.append(best)
                count_sum.append(total)
                if not known.all():
                    some = np.flatnonzero(~known)
                    rest[0] += [key] * len(some)
                    rest[1].append(codes[some])
                    rest[2].append(times[some])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                                              pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            if rest[0]:
                m = len(rest[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rest[0], pa.binary()), *[pa.nulls(m, pa.int64())] * 5, pa.nulls(m, pa.string()),
                     *[pa.nulls(m, pa.int64())] * 2, pa.array(np.concatenate(rest[1])), pa.array(np.concatenate(rest[2]))],
                    names=names)

    texts = aligned.filter("key is not null").drop("code", "n")
    found = stored(texts.mapInArrow(run, schema), "align-measures")
    table = pairs.select(F.col("code").alias("p_code"), "n", "best")
    rare = found.filter("code is not null").select(F.col("key").alias("r_key"), "code", "times") \
                .join(table, F.col("code") == F.col("p_code"), "inner") \
                .groupBy("r_key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("r_best"),
                                      F.sum(F.col("times") * F.col("n")).alias("r_sum"))
    out = found.filter("copies is not null").join(rare, F.col("key") == F.col("r_key"), "left")
    return stored(out.select("key", "copies", *_MEASURES, "groups_sha256",
                             (F.col("n_best") + F.coalesce("r_best", F.lit(0))).alias("n_best"),
                             (F.col("count_sum") + F.coalesce("r_sum", F.lit(0))).alias("count_sum")), "align-text-measures")


def align_documents(docs: DataFrame, a_path: str, b_path: str, head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    n_a, n_b = vocabularies(a_path, b_path)
    aligned = align_texts(docs, a_path, b_path)
    texts = text_measures(aligned, pair_table(aligned, n_b), n_a * n_b < 1 << 32, head)
    rows = bare(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("d_key"))
    rows = stored(rows, "align-documents")
    total = texts.agg(F.sum("copies")).first()[0] or 0
    heavy = F.col("copies") * HEAVY > total              # fewer than HEAVY texts
    numbers = [*_MEASURES, "n_best", "count_sum"]
    first = rows.filter("d_key is not null").join(F.broadcast(texts.filter(heavy)), F.col("d_key") == F.col("key"), "left")
    rest = first.filter("key is null").select("doc_id", "d_key") \
                .join(texts.filter(~heavy), F.col("d_key") == F.col("key"), "left")
    none = rows.filter("d_key is null").select("doc_id", *[F.lit(None).cast("bigint").alias(c) for c in numbers],
                                               F.lit(None).cast("string").alias("groups_sha256"))
    out = first.filter("key is not null").select("doc_id", *numbers, "groups_sha256") \
               .unionByName(rest.select("doc_id", *numbers, "groups_sha256")).unionByName(none)
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
