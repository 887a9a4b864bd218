"""Best-fit packing of documents into sequences, improved by swap-based local search.

1. Every document is encoded; one longer than ``SIZE`` ids is cut into pieces of
   ``SIZE`` ids, of which the first may be shorter.
2. Pieces of one length are interchangeable, so the packing is worked out for the
   counts of pieces by length: at most ``SIZE`` numbers, whatever the corpus.  Bins
   with the same lengths in them are one *kind* with a number of bins; a step of
   best fit (longest pieces first, into the fullest bin with room) or of the search
   treats all bins of a kind at once.
3. Local search between underfull kinds: move a piece, exchange one for one, two for
   one or one for two, so that the fuller bin gets fuller (the sum of squared fills
   rises with every step) until bins are empty, no step is left, or no fewer bins are
   possible.  ``EFFORT`` bounds the pairs of kinds that are looked at, not the input.
4. Each piece has a rank among all pieces of its length (counts per task and length,
   summed in order); length and rank give its sequence and place in the plan.

Nothing but the counts by length leaves the executors: the plan is bounded by the
lengths, pieces meet only the offsets of their own task, and ids are never shuffled.

Defined cases: a null text is empty, so its document is the end id alone; null and
repeated doc_ids are kept, a row each; repeated rows are packed as often as they
occur; very long texts become many pieces; an empty table gives no rows.  Only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bare, stored, worker_cache
from .parts import ByteLevel

SIZE = 1024
END_ID = 2
#: Pairs of kinds of bins that the local search may look at.
EFFORT = 50_000
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"

#: A kind of bin: (length, how many of it), longest first.
Kind = tuple[tuple[int, int], ...]


def piece_ends(n: int, size: int) -> list[int]:
    """Ends of the pieces of a document of n ids; only the first piece may be shorter than ``size``."""
    return list(range((n - 1) % size + 1, n + 1, size))


def document_pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """The written pieces: doc_id, piece, start, length, ids_crc32, and part, nth (place in the task's pieces of that length)."""
    rows = bare(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache = worker_cache()
        if ("pack", tokenizer_path) not in cache:
            cache["pack", tokenizer_path] = ByteLevel(tokenizer_path)
        encode, part, seen = cache["pack", tokenizer_path].ids, TaskContext.get().partitionId(), [0] * (size + 1)
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                at = 0
                for k, end in enumerate(piece_ends(len(ids), size)):
                    out.append((doc_id, k, at, end - at, zlib.crc32(ids[at:end]), part, seen[end - at]))
                    seen[end - at] += 1
                    at = end
                if len(out) >= 10_000:
                    yield made()
                    out = []
        if out:
            yield made()

    return stored(rows.mapInArrow(run, _PIECES), "packing-pieces")


def _kind(lengths: dict[int, int]) -> Kind:
    return tuple(sorted(((x, n) for x, n in lengths.items() if n), reverse=True))


def _fill(kind: Kind) -> int:
    return sum(x * n for x, n in kind)


def best_fit(counts: dict[int, int], size: int) -> dict[Kind, int]:
    """Best fit, longest pieces first, of counts by length; kinds of bins with their numbers."""
    by_room: dict[int, dict[Kind, int]] = {}
    rooms: list[int] = []                     # sorted keys of by_room

    def put(kind: Kind, n: int) -> None:
        if n:
            room = size - _fill(kind)
            if room not in by_room:
                by_room[room] = {}
                rooms.insert(bisect_left(rooms, room), room)
            by_room[room][kind] = by_room[room].get(kind, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):              # no bin has room: new ones
                room, kind, bins = size, (), -(-left // (size // length))
            else:
                room = rooms[at]
                kind, bins = by_room[room].popitem()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            each = room // length
            whole, rest = divmod(min(left, bins * each), each)
            put((*kind, (length, each)), whole)
            if rest:
                put((*kind, (length, rest)), 1)
            if kind:
                put(kind, bins - whole - bool(rest))
            left -= whole * each + rest
    return {kind: n for some in by_room.values() for kind, n in some.items()}


def best_step(low: Kind, high: Kind, size: int) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
    """(ids moved, lengths from low, lengths from high): the exchange that fills ``high`` most, or none."""
    room = size - _fill(high)
    xs, ys = [x for x, _ in low], [y for y, _ in high]
    two_x = {x + z: (x, z) for i, (x, n) in enumerate(low) for z in ([x] if n > 1 else []) + xs[i + 1:]}
    two_y = {y + z: (y, z) for i, (y, n) in enumerate(high) for z in ([y] if n > 1 else []) + ys[i + 1:]}
    gives = {x: (x,) for x in reversed(xs)}
    takes = {0: ()} | {y: (y,) for y in reversed(ys)}
    best = None
    for give, take in ((gives, takes), (two_x, takes), (gives, two_y)):
        sums = sorted(give)
        for y, back in take.items():
            at = bisect_left(sums, y + room + 1) - 1      # the largest that still fits
            if at >= 0 and sums[at] > y and (best is None or sums[at] - y > best[0]):
                best = (sums[at] - y, give[sums[at]], back)
    return best


def local_search(kinds: dict[Kind, int], size: int, effort: int = EFFORT) -> dict[Kind, int]:
    """Fewer bins by moves and exchanges between underfull bins; every step raises the sum of squared fills."""
    kinds = dict(kinds)
    stuck: set[tuple[Kind, Kind]] = set()

    def change(kind: Kind, n: int) -> None:
        kinds[kind] = kinds.get(kind, 0) + n
        if not kinds[kind]:
            del kinds[kind]

    def after(kind: Kind, out: tuple[int, ...], back: tuple[int, ...]) -> Kind:
        lengths = dict(kind)
        for x in out:
            lengths[x] -= 1
        for x in back:
            lengths[x] = lengths.get(x, 0) + 1
        return _kind(lengths)

    while effort > 0:
        open_ = sorted((_fill(k), k) for k in kinds if _fill(k) < size)
        if sum((size - f) * kinds[k] for f, k in open_) < size:
            break                                          # no fewer bins are possible
        step = None
        for i, (f, low) in enumerate(open_):               # the emptiest bins give, the fullest take
            for g, high in reversed(open_[i:]):
                if (low, high) in stuck or (low == high and kinds[low] < 2):
                    continue
                effort -= 1
                step = best_step(low, high, size)
                if step is not None or effort <= 0:
                    break
                stuck.add((low, high))
            if step is not None or effort <= 0:
                break
        if step is None:
            break
        _, out, back = step
        n = kinds[low] // 2 if low == high else min(kinds[low], kinds[high])
        for kind, new in ((low, after(low, out, back)), (high, after(high, back, out))):
            change(kind, -n)
            if new:
                change(new, n)
    return kinds


def packing_plan(counts: dict[int, int], size: int = SIZE, effort: int = EFFORT) -> dict[int, np.ndarray]:
    """Per length a table of places, by rank: first rank, pieces a bin, first sequence, offset of the first of them in the bin."""
    plan: dict[int, list[tuple[int, int, int, int]]] = {}
    rank, sequence = dict.fromkeys(counts, 0), 0
    for kind, n in sorted(local_search(best_fit(counts, size), size, effort).items(), reverse=True):
        offset = 0
        for length, each in kind:
            plan.setdefault(length, []).append((rank[length], each, sequence, offset))
            rank[length] += each * n
            offset += length * each
        sequence += n
    if rank != counts:
        raise AssertionError("the plan does not hold every piece once")
    return {length: np.array(rows, np.int64) for length, rows in plan.items()}


def pack(pieces: DataFrame, size: int = SIZE, effort: int = EFFORT) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    each = stored(pieces.groupBy(F.col("part").alias("c_part"), F.col("length").alias("c_length")).agg(
        F.count(F.lit(1)).alias("n")), "packing-counts")
    counts = {r[0]: r[1] for r in each.groupBy("c_length").agg(F.sum("n")).collect()}      # at most ``size`` rows
    plan = packing_plan(counts, size, effort)
    before = Window.partitionBy("c_length").orderBy("c_part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("c_part", "c_length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = pieces.join(base, (F.col("part") == F.col("c_part")) & (F.col("length") == F.col("c_length")), "inner") \
                 .withColumn("rank", F.col("base") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                mine = np.flatnonzero(length == x)
                rows_of = plan[x]
                at = rows_of[np.searchsorted(rows_of[:, 0], rank[mine], "right") - 1]
                bin_, nth = np.divmod(rank[mine] - at[:, 0], at[:, 1])
                sequence[mine], offset[mine] = at[:, 2] + bin_, at[:, 3] + nth * x
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(document_pieces(docs, tokenizer_path, size, end_id), size)
