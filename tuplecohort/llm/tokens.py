"""Token-id files in Simple-8b word-aligned coding.

Ids are packed into 64-bit words.  The top 4 bits of a word select how many ids
it holds and at what width (table ``SELECTORS``); the packer takes the largest
count that fits, greedily.  An id of more than 60 bits is escaped: the selector
``ESCAPE`` says that the next word is the id itself.

A file holds documents in ascending ``doc_id`` order::

    magic | words of all blocks | document ids | null flags | document lengths
          | per block: first word, number of ids | sizes (5 x u64) | magic

Blocks hold ``BLOCK`` ids (the last one of a file fewer) and start at a known
word, so any block is decoded by itself, as a whole, with array operations.
Writing streams: a task keeps one block of ids and the lengths of its documents.

Files go to a shared folder.  Every task attempt writes under a name of its own
and returns it as a row of the manifest; readers open only files named there, so
lost executors and repeated attempts do no harm.

Defined cases: a null text is empty, so its document is the end id alone; a null
``doc_id`` sorts first; rows with equal ids follow in order of their text hash,
repeated rows included; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_name, open_folder, shared_folder, stored, worker_cache

MAGIC = b"S8BIDS01"
BLOCK = 65536
END_ID = 2
ESCAPE = 15
#: selector -> (ids in a word, bits each); selectors 0 and 1 hold runs of zeros.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
             (5, 12), (4, 15), (3, 20), (1, 60))
_MANIFEST = "part int, uri string, n_docs bigint, n_ids bigint, n_words bigint"
_READ = "doc_id bigint, part int, ordinal bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


_SMALL_WIDTHS = np.array([int(i).bit_length() for i in range(1 << 16)], np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, as uint8."""
    if int(ids.max()) < 1 << 16:
        return _SMALL_WIDTHS[ids.astype(np.uint16)]
    w, x = np.zeros(len(ids), np.uint8), ids
    for _ in range(4):
        w += _SMALL_WIDTHS[(x & np.uint64(0xFFFF)).astype(np.uint16)] * (x < 1 << 16)
        w += np.uint8(16) * (x >= 1 << 16)
        x = np.where(x >= 1 << 16, x >> np.uint64(16), np.uint64(0))
    return w


def pack(ids: np.ndarray) -> np.ndarray:
    """Ids (any unsigned integers) to 64-bit words."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = _widths(ids)
    # For every position, the selector with the largest count that fits there.  A
    # window that fits one selector fits all with smaller counts, so the search ends
    # with the first selector that fits nowhere.
    choice = np.where(width <= SELECTORS[-1][1], len(SELECTORS) - 1, ESCAPE).astype(np.uint8)
    high, reach = width, 1             # high[i]: widest of ids[i : i + reach]
    for sel in reversed(range(len(SELECTORS))):
        count, bits = SELECTORS[sel]
        if count > n:
            break
        while reach < count:
            step = min(reach, count - reach)
            high = np.maximum(high[:len(high) - step], high[step:])
            reach += step
        fits = high <= bits
        if not fits.any():
            break
        np.putmask(choice[:len(fits)], fits, np.uint8(sel))
    counts = np.array([c for c, _ in SELECTORS] + [1], np.uint8)[choice].tobytes()
    at, starts = 0, []
    while at < n:                       # the greedy chain
        starts.append(at)
        at += counts[at]
    first = np.array(starts, np.int64)
    sel = choice[first]
    slots = np.arange(len(first))
    if (sel == ESCAPE).any():
        slots += np.cumsum(sel == ESCAPE) - (sel == ESCAPE)
    words = np.zeros(int(slots[-1]) + 1 + int(sel[-1] == ESCAPE), np.uint64)
    for s in np.unique(sel):
        mine, where = first[sel == s], slots[sel == s]
        word = np.full(len(mine), np.uint64(s) << np.uint64(60))
        if s == ESCAPE:
            words[where + 1] = ids[mine]
        else:
            count, bits = SELECTORS[s]
            for k in range(count if bits else 0):
                word |= ids[mine + k] << np.uint64(k * bits)
        words[where] = word
    return words


def unpack(words: np.ndarray) -> np.ndarray:
    """Words to ids (uint64); one vector operation per selector and slot."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    if (sel == ESCAPE).any():           # words that follow an escape are plain ids
        plain = np.zeros(len(words), bool)
        for i in np.flatnonzero(sel == ESCAPE):
            if not plain[i] and i + 1 < len(words):
                plain[i + 1] = True
        sel[plain] = ESCAPE + 1
    counts = np.array([c for c, _ in SELECTORS] + [0, 1], np.int64)[sel]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]), np.uint64)
    first = ends - counts
    for s in np.unique(sel):
        if s == ESCAPE:
            continue
        mine = sel == s
        if s == ESCAPE + 1:
            out[first[mine]] = words[mine]
            continue
        count, bits = SELECTORS[s]
        if bits:
            mask, w, at = np.uint64((1 << bits) - 1), words[mine], first[mine]
            for k in range(count):
                out[at + k] = (w >> np.uint64(k * bits)) & mask
    return out


class IdFileWriter:
    """Streams documents into one file."""

    def __init__(self, sink) -> None:
        self.sink = sink
        sink.write(MAGIC)
        self.docs, self.nulls, self.lengths, self.blocks = [], [], [], []
        self.held, self.n_held, self.n_words, self.n_ids = [], 0, 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= BLOCK:
            self._block(BLOCK)

    def _block(self, n: int) -> None:
        ids = np.concatenate(self.held)
        self.held, self.n_held = [ids[n:]], len(ids) - n
        words = pack(ids[:n])
        self.sink.write(words.astype("<u8").tobytes())
        self.blocks.append((self.n_words, n))
        self.n_words += len(words)
        self.n_ids += n

    def close(self) -> None:
        if self.n_held:
            self._block(self.n_held)
        body = [np.array(self.docs, "<i8").tobytes(), np.array(self.nulls, "u1").tobytes(),
                np.array(self.lengths, "<u8").tobytes(), np.array(self.blocks, "<u8").tobytes()]
        sizes = np.array([len(self.docs), len(self.blocks), self.n_words, self.n_ids, sum(map(len, body))], "<u8")
        self.sink.write(b"".join(body) + sizes.tobytes() + MAGIC)
        self.sink.close()


def read_id_file(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of a file; holds one block and one document at a time."""
    end = source.size()
    source.seek(end - 48)
    tail = source.read(48)
    if tail[40:] != MAGIC:
        raise ValueError("not a token-id file, or a file cut short")
    n_docs, n_blocks, n_words, _, n_body = (int(x) for x in np.frombuffer(tail[:40], "<u8"))
    source.seek(end - 48 - n_body)
    body = source.read(n_body)
    docs = np.frombuffer(body, "<i8", n_docs)
    nulls = np.frombuffer(body, "u1", n_docs, 8 * n_docs)
    lengths = np.frombuffer(body, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    blocks = np.frombuffer(body, "<u8", 2 * n_blocks, 17 * n_docs).reshape(-1, 2).astype(np.int64)
    ends = np.append(blocks[1:, 0], n_words)
    held, n_held, nxt = [], 0, 0
    for d in range(n_docs):
        need = int(lengths[d])
        while n_held < need:
            a, b = int(blocks[nxt, 0]), int(ends[nxt])
            source.seek(len(MAGIC) + 8 * a)
            held.append(unpack(np.frombuffer(source.read(8 * (b - a)), "<u8"))[:blocks[nxt, 1]])
            n_held, nxt = n_held + len(held[-1]), nxt + 1
        ids = np.concatenate(held) if len(held) != 1 else held[0]
        held, n_held = [ids[need:]], len(ids) - need
        yield (None if nulls[d] else int(docs[d])), ids[:need]


#: Lower-case letters up to U+00FF; each is its own lower case and its own composed form.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_WORD = re.compile(f"([{_LETTERS}]+)([.,]?)|[.,]")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level spelling of a byte (as a Latin-1 character): itself if it prints, else the next sign from U+0100.
_SPELT = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class PartIds(dict):
    """Remembers the ids of text parts, as bytes of unsigned 32-bit integers; works out a new part on demand."""

    def __init__(self, tok, keep: int) -> None:
        super().__init__()
        self.encode, self.model, self.keep = tok.encode, tok.model, keep
        # Whether a word of plain letters is one pre-token, spelt byte by byte, and a mark after it another.
        self.plain = [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(_LETTERS + "."))] \
            == [self.spelt(_LETTERS), "."]

    @staticmethod
    def spelt(word: str) -> str:
        return word.encode().decode("latin-1").translate(_SPELT)

    def __missing__(self, part: bytes) -> bytes:
        text = part.decode()
        if self.plain and (m := _WORD.fullmatch(text.lower())) and len(text.lower()) == len(text):
            if m[2]:
                found = self[part[:-1]] + self[part[-1:]]
            else:
                found = np.array([t.id for t in self.model.tokenize(self.spelt(text.lower()))], np.uint32).tobytes()
        else:
            found = np.array(self.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        if len(self) >= self.keep:
            self.clear()
        self[part] = found
        return found


def tokenizer_encoder(path: str, keep: int = 1_000_000) -> Callable[[str], np.ndarray]:
    """Encoder of whole texts with a tokenizer file of the ``tokenizers`` library.

    For a tokenizer whose normaliser makes white space and case equal and whose
    pre-tokens end at white space (``_by_parts``), a text's ids are those of its
    parts between white space.  Parts are encoded by the library and remembered
    (at most ``keep`` of them).  Any other tokenizer encodes each text as a whole.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    if not _by_parts(path):
        return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)
    ids_of = PartIds(tok, keep).__getitem__
    return lambda text: np.frombuffer(b"".join(map(ids_of, _parts(text))), np.uint32)


def _by_parts(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (steps == ["NFC", "Replace", "Lowercase"] and splits[0].get("type") == "Split"
            and splits[0].get("invert") is True and "\\s" in str(splits[0].get("pattern")))


def _parts(text: str) -> list[bytes]:
    """The text's parts between white space (bytes 0x20, 0x09 to 0x0D).

    A-Z become lower case, so that there are fewer different parts, unless that
    could change how characters compose or make the name of a special token.
    """
    raw = text.encode()
    low = raw.lower()
    if b"<|" in low or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low.decode())):
        return raw.split()
    return low.split()


def write_id_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, name: str = "token-files") -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files of ascending doc_id; returns the stored manifest."""
    folder = shared_folder(docs.sparkSession, name)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, out, uri = None, None, None
        part, n_docs = TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    cache = worker_cache()
                    if ("encoder", tokenizer_path) not in cache:
                        cache["encoder", tokenizer_path] = tokenizer_encoder(tokenizer_path)
                    encode = cache["encoder", tokenizer_path]
                    where, base = open_folder(folder)
                    where.create_dir(base, recursive=True)
                    file = fresh_name(f"part-{part:05d}", ".s8b")
                    uri = f"{folder}/{file}"
                    out = IdFileWriter(where.open_output_stream(f"{base}/{file}"))
                out.add(doc_id, np.append(encode(text.as_py() or ""), np.uint32(end_id)))
                n_docs += 1
        rows = []
        if out is not None:
            out.close()
            rows = [(part, uri, n_docs, out.n_ids, out.n_words)]
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["part", "uri", "n_docs", "n_ids", "n_words"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return stored(rows.mapInArrow(write, _MANIFEST), name + "-manifest")


def read_id_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document read back from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, path = open_folder(uri)
                rows, at, held = [], 0, 0
                with where.open_input_file(path) as source:
                    for k, (doc_id, ids) in enumerate(read_id_file(source)):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, part, k, at, len(ids), crc, *([ids.astype(np.int64)] if with_ids else [])))
                        at, held = at + len(ids), held + len(ids) * with_ids
                        if len(rows) >= 10_000 or held > 1_000_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "part", "ordinal", "local_start", "n_tokens", "ids_crc32"]
        kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 4
        if with_ids:
            names, kinds = [*names, "ids"], [*kinds, pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    # The manifest has one row per file; each file starts where those before it end.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select(F.col("part").alias("m_part"),
                           F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = manifest.select("part", "uri").repartition(max(1, manifest.count()), "uri")
    rows = files.mapInArrow(read, _READ + (", ids array<bigint>" if with_ids else ""))
    return rows.join(base, rows["part"] == base["m_part"], "inner") \
               .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
                       *(["ids"] if with_ids else []))
