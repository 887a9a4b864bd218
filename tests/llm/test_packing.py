"""Packing of documents: encoding, the plan, and whole results against the library and bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import edge_rows, table
from tuplecohort.llm import packing
from tuplecohort.llm.parts import ByteLevel, cut_parts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "it's 'tis he'll\tx  y<|endoftext|> z", "123 4,5 a1b2 _x_ <|x|> ...",
       "Üñ café é  x  y　 z \x1c w", "a\n\n b\r\n", "日本 語 🎉 🎉🎉", "x\x00 y", "▁a b▁ c", "ab\x1c cd\x85 ef",
       " " * 60_000 + "x", "a" * 20_000]


def test_ids_equal_the_library():
    ours, lib = ByteLevel(PATH), Tokenizer.from_file(PATH)
    plain, lib_plain = ByteLevel(PATH, plain_specials=True), Tokenizer.from_file(PATH)
    lib_plain.encode_special_tokens = True
    assert ours.fast is not None
    for text in ODD:
        assert ours.ids(text).tolist() == lib.encode(text, add_special_tokens=False).ids
        assert plain.ids(text).tolist() == lib_plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    ours, lib = ByteLevel(path), Tokenizer.from_file(path)
    assert ours.fast is None
    assert ours.ids("Some words, here.").tolist() == lib.encode("Some words, here.", add_special_tokens=False).ids


def test_parts_are_encoded_alone():
    ours = ByteLevel(PATH, plain_specials=True)
    for text in ODD:
        first, *rest = cut_parts(text)
        assert " ".join([first, *rest]) == text
        assert np.concatenate([ours.ids(first), *[ours.ids(" " + p) for p in rest]]).tolist() == ours.ids(text).tolist()


def test_piece_ends():
    assert packing.piece_ends(5, 4) == [1, 5]
    assert packing.piece_ends(8, 4) == [4, 8]
    assert packing.piece_ends(3, 4) == [3]


def bins(plan: dict[int, np.ndarray], counts: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
    got = defaultdict(list)
    for length, n in counts.items():
        rows = plan[length]
        for rank in range(n):
            first, each, sequence, offset = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            k, nth = divmod(rank - first, each)
            got[sequence + k].append((offset + nth * length, length))
    return got


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_without_gaps(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 64, 1024])
    counts = defaultdict(int)
    for _ in range(rng.choice([1, 20, 3000])):
        counts[rng.randint(max(1, size // 4), size) if seed % 2 else rng.randint(1, size)] += 1
    got = bins(packing.packing_plan(dict(counts), size, effort=3000), counts)
    assert sum(map(len, got.values())) == sum(counts.values())
    for places in got.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_search_empties_bins_that_best_fit_cannot():
    # Best fit: (6 4) (5 5) would need 3 and 3 3 elsewhere; lengths chosen so that best fit takes one bin more.
    size, counts = 10, {4: 2, 3: 4}                    # best fit: 4+4, 3+3+3, 3; optimal: 4+3+3, 4+3+3
    start = packing.best_fit(counts, size)
    assert sum(start.values()) == 3
    assert sum(packing.local_search(start, size).values()) == 2


def test_steps_raise_the_squared_fill():
    rng = random.Random(3)
    for _ in range(300):
        size = 50
        kinds = []
        for _ in range(2):
            lengths = defaultdict(int)
            while sum(x * n for x, n in lengths.items()) < rng.randint(5, 45):
                lengths[rng.randint(1, 5)] += 1
            kinds.append(packing._kind(lengths))
        low, high = sorted(kinds, key=packing._fill)
        step = packing.best_step(low, high, size)
        f, g = packing._fill(low), packing._fill(high)
        if step:
            d, out, back = step
            assert d == sum(out) - sum(back) > 0 and g + d <= size
            assert (f - d) ** 2 + (g + d) ** 2 > f * f + g * g
        else:                                           # not even a plain move fits
            assert all(x > size - g for x, _ in low)


def check(rows: list, texts: list[tuple], size: int) -> int:
    lib = Tokenizer.from_file(PATH)
    want, got = [], []
    for doc_id, text in texts:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cut = [0, *packing.piece_ends(len(ids), size)]
        want += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
    places = defaultdict(list)
    for r in rows:
        got.append((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= size
    assert len(places) >= -(-sum(w[3] for w in want) // size)
    return len(places)


@pytest.mark.parametrize("size", [16, 1024])
def test_whole_result(spark, size):
    rows = edge_rows()
    found = packing.pack_documents(table(spark, rows).repartition(5), PATH, size).collect()
    n = check(found, [(r[0], r[1]) for r in rows], size)
    assert n <= -(-sum(r["length"] for r in found) // size) + 1


def test_empty_table(spark):
    assert packing.pack_documents(table(spark, []), PATH).collect() == []
