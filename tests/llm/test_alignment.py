"""Alignment against a token-by-token version with the libraries themselves."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.fixtures import edge_rows, table
from tuplecohort.llm import alignment
from tuplecohort.llm.parts import BYTE_OF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "  a  b ", "a\tb \n c", "x <|endoftext|> y", "<s> <0x41> </s>", "▁x a", "日本 語 🎉🎉", "ﬁ İ é́ \x00 \x1c",
       "don't stop, it's 12,345.67", "a" * 300, "word\n\n\nword  \r\n", "ñandú über Straße", "﻿bom ​ zero"]


def groups_of(text, tok, sp):
    """[(A ids, B ids)] of the groups, or None."""
    a = [(i, bytes(BYTE_OF[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None
    out, i, j, x, y = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            out[-1][0].append(a[i][0])
            x, i = x + len(a[i][1]), i + 1
        else:
            out[-1][1].append(b[j][0])
            y, j = y + len(b[j][1]), j + 1
        if x == y and out[-1][0] and out[-1][1]:
            out.append(([], []))
    return out[:-1]


def brute(rows):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    found = [(d, groups_of(t, tok, sp) if t else None) for d, t in rows]
    count = Counter()
    for _, g in found:
        count.update({(x, y) for p, q in g or [] for x in p for y in q})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for d, g in found:
        if g is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for p, q in g for x in p for y in q]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((d, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(links),
                    sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    rows = edge_rows() + [(500 + i, t, "en", "a") for i, t in enumerate(ODD)]
    rows += [(600 + i, "The same page, over and over.", "en", "hot") for i in range(60)]
    return rows + [(700 + i, " ".join("".join(rng.choice("aeioutrsn,.") for _ in range(rng.randint(1, 9))) for _ in range(30)),
                    "en", "b") for i in range(40)]


@pytest.mark.parametrize("head,heavy,held", [(1 << 16, 1000, 2_000_000), (200, 1, 300), (0, 5, 2_000_000)])
def test_equals_brute_force(spark, monkeypatch, head, heavy, held):
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    monkeypatch.setattr(alignment, "HELD_PAIRS", held)
    rows = fixture()
    found = alignment.align_documents(table(spark, rows).repartition(4), A, B, head)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute([(r[0], r[1]) for r in rows])


def test_blocks_change_nothing():
    aligner = alignment.Aligner(A, B)
    assert aligner.blocks
    rng = random.Random(8)
    for text in [*ODD, "some words of twenty letters ", "some words of twenty letters  ", " ".join(rng.choice(ODD) for _ in range(200))]:
        assert " ".join(alignment.blocks(text, 20)) == text
        whole = aligner.align(text)
        if whole is None:
            assert aligner.text(text) is None
            continue
        parts = [aligner.align(b) for b in alignment.blocks(text, 20)]
        assert ";".join(p[3] for p in parts) == whole[3]
        assert [sum(p[i] for p in parts) for i in range(3)] == list(whole[:3])


@pytest.mark.parametrize("group,held,block", [(1 << 19, 96 << 20, 1 << 16), (40, 0, 20), (1, 5000, 20)])
def test_parts_change_nothing(monkeypatch, group, held, block):
    for name, value in (("GROUP", group), ("PARTS_BYTES", held)):
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment.blocks, "__defaults__", (block,))
    rng = random.Random(9)
    texts = [*ODD, *[sep.join(rng.choice(ODD + ["the", "of", "and"]) for _ in range(60)) for sep in (" ", "  ", "\n ") for _ in range(4)],
             *[" ".join(rng.choice([x for x in ODD if "▁" not in x]) for _ in range(90)) for _ in range(4)], "plain words", "plain  words "]
    aligner = alignment.Aligner(A, B)
    for text, got in zip(texts, alignment.Parts(aligner).of_texts(texts)):
        whole = aligner.align(text)
        assert (got is None) == (whole is None)
        if whole is not None:
            codes = Counter(whole[4].tolist())
            assert got[:5] == (*whole[:3], len(whole[4]), hashlib.sha256(whole[3].encode()).hexdigest())
            assert got[5].tolist() == sorted(codes) and got[6].tolist() == [codes[c] for c in sorted(codes)]


def test_a_part_is_encoded_once():
    aligner = alignment.Aligner(A, B)
    encode, given = aligner.b.encode, []
    aligner.b = type("Counted", (), {"encode": lambda self, text: given.append(text) or encode(text)})()
    rng = random.Random(3)
    words = [f"word{i}" for i in range(50)]
    parts = alignment.Parts(aligner)
    for _ in range(3):
        assert None not in parts.of_texts([" ".join(rng.choice(words) for _ in range(400)) for _ in range(20)])
    assert sorted(" ".join(given).split()) == sorted(words)


def test_empty_table(spark):
    assert alignment.align_documents(table(spark, []), A, B).collect() == []
