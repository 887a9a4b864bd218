"""WARC archives and token-id files: round trips and edge cases."""

import gzip
import hashlib
import zlib

import numpy as np
import pytest

from tuplecohort.llm import common, tokens, warc
from tuplecohort.llm.common import open_folder

from .fixtures import edge_rows, table

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [1, 2, 300, 49408, 1 << 31, 1 << 60, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 241, 5000])
def test_simple8b_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64)
    if n > 1000:
        ids[100:700] = 0
        ids[900:903] = [(1 << 60) - 1, 1 << 60, (1 << 64) - 1]
        ids[903:905] = np.uint64(15) << np.uint64(60)
    assert (tokens.unpack(tokens.pack(ids)) == ids).all()


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    tok, encode = Tokenizer.from_file(TOKENIZER), tokens.tokenizer_encoder(TOKENIZER, keep=50)
    texts = [t or "" for _, t, _, _ in edge_rows()] + [
        "x<|endoftext|>y <|EndOfText|>", "a ẖ H̱ é ́", "it's DON'T. ΣΑΣ Éa, Ößü.", "a\x1cb\x85c\xa0d",
        "...,. a.,b .x ,", "ŒUVRE ǅ ½ 12,5. ª º µ ß ÿ Ÿ", "K K Å İI"]
    for t in texts + texts:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, t[:60]


def test_token_files(spark):
    from tokenizers import Tokenizer

    rows = edge_rows()
    docs = table(spark, rows).repartition(3)
    manifest = tokens.write_id_files(docs, TOKENIZER)
    got = tokens.read_id_files(manifest, with_ids=True).orderBy("start").collect()
    tok = Tokenizer.from_file(TOKENIZER)
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i))
    want = {}
    for i, t, _, _ in rows:
        want.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    at = 0
    for r in got:
        assert r.start == at and list(r.ids) in want[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        want[r.doc_id].remove(list(r.ids))
        at += r.n_tokens
    assert not any(want.values())


def test_token_files_of_empty_table(spark):
    manifest = tokens.write_id_files(table(spark, []), TOKENIZER)
    assert manifest.count() == 0 and tokens.read_id_files(manifest).count() == 0


PAGES = [(1, "u1", "a" * 100), (2, "u2", "a" * 100), (2, "u2", "a" * 100), (3, None, "a" * 100), (4, "u", "a" * 99),
         (5, "u", "a" * 99), (6, "u\r\nX: y", None), (7, "u", ""), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 30_000),
         (None, "u", "é\r\n\r\nWARC/1.1\r\n" * 30_000), (None, "u", "b" * 200), (9, "u", "  <p>" * 50)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "page_id bigint, url string, html string, digest string, payload string")


def test_warc_round_trip(spark):
    chunks = warc.record_chunks(warc.with_revisits(pages(spark, PAGES).repartition(2)), chunk=1000)
    manifest = warc.write_warc(chunks)
    table_ = warc.read_warc(manifest, chunk=700).cache()
    assert table_.filter("octet_length(data) > 700").count() == 0
    got = sorted((tuple(r) for r in warc.record_summary(table_).collect()), key=repr)
    first = {}
    for i, _, html in PAGES:
        raw = (html or "").encode()
        if i is not None:
            first[raw] = min(i, first.get(raw, i))
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        again = len(raw) >= 100 and raw in first and first[raw] != i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                     first[raw] if again else None))
    assert got == sorted(want, key=repr)
    # The chunks of a response, in order, are its payload; digests are those of the payload so far.
    rec = table_.filter("page_id = 8").orderBy("chunk_no").collect()
    assert b"".join(r.data for r in rec) == PAGES[8][2].encode()
    h = hashlib.sha256()
    for r in rec:
        h.update(r.data)
        assert r.digest_so_far == h.hexdigest()


def test_warc_files_are_warc(spark):
    manifest = warc.archive(pages(spark, PAGES[:4]))
    raw = b""
    for (uri,) in manifest.select("uri").collect():
        where, path = open_folder(uri)
        raw += gzip.decompress(where.open_input_stream(path, compression=None).read())
    assert raw.count(b"WARC/1.1\r\n") == 4 and raw.count(b"WARC-Type: revisit") == 3 and raw.endswith(b"\r\n\r\n")


def test_pages_with_equal_ids_and_other_payloads(spark):
    rows = [(1, "u", "a" * 200), (1, "u", "bb" * 150), (2, "u", "a" * 200), (3, "u", "bb" * 150), (1, "v", "a" * 200)]
    got = warc.record_summary(warc.read_warc(warc.archive(pages(spark, rows)))).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got if r.page_id > 1) \
        == [(2, 200, "revisit", 1), (3, 300, "revisit", 1)]
    assert sorted(r.payload_bytes for r in got if r.page_id == 1) == [200, 200, 300]
    assert {r.payload_digest for r in got if r.payload_bytes == 200} == {hashlib.sha256(b"a" * 200).hexdigest()}


@pytest.mark.parametrize("heavy", [1, 1000])
def test_counted_join(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [("b", 100), ("c", 101), (None, 102)], "k string, i int")
    found = spark.createDataFrame([("hot", 50, "x"), ("b", 1, "y")], "t string, n bigint, v string")
    got = {r.i: r.v for r in common.join_counted(rows, "k", found, "t", "n", 53).collect()}
    assert got == {**dict.fromkeys(range(50), "x"), 100: "y", 101: None, 102: None}


def test_warc_of_empty_table(spark):
    manifest = warc.archive(pages(spark, []))
    assert warc.record_summary(warc.read_warc(manifest)).count() == 0


def test_cut_archive_is_an_error(tmp_path):
    f = tmp_path / "x.warc"
    f.write_bytes(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(ValueError, match="cut short"):
        list(warc.walk_warc(f.open("rb")))
