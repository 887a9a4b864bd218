"""Vector-approximation files and language ID."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tuplecohort.llm import langid, vafile

from .fixtures import edge_rows, table

SMALL = "/root/testdata/sf0.01"


def brute(rows, k):
    v = []                                   # by row: ids may repeat
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            v.append((i, [math.floor(256 * x) for x in e]))
    out = []
    for r, (q, a) in enumerate(v):
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for t, (i, b) in enumerate(v) if t != r and len(a) == len(b))
            out += [(q, rank + 1, i, -n) for rank, (n, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("cells,block,q_block", [(256, 8192, 512), (4, 16, 4)])
def test_top_k(spark, cells, block, q_block):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(i + 200, [1.0] * 8) for i in range(12)] + [(300, None), (301, [None] * 8), (302, [float("nan")] * 8),
             (303, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (350, [1.0, 2.0]), (351, [3.0, 4.0]), (400, []),
             (50, [0.5] * 8), (50, [0.5] * 8), (1000, [-1e3, 1e6] + [0.0] * 6)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, dim int, block int")
    va = vafile.write_va_file(vafile.whole_vectors(df.repartition(3)), cells=cells, block=block)
    got = vafile.top_k(va, va.vectors.filter("vec_id % 50 = 0"), k=5, query_block=q_block)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, 5)


def test_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-4e5, 4e5) for _ in range(16)]) for i in range(120)]      # products above 2^53
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    va = vafile.write_va_file(vafile.whole_vectors(df), block=32)
    got = vafile.top_k(va, va.vectors.filter("vec_id % 50 = 0"), k=5)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, 5)
    for x in (2e7, 1e30):                                 # scores, or components, that no 64-bit integer holds
        df = spark.createDataFrame([(i, [x] * 1024) for i in range(3)], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="fit a 64-bit integer"):
            va = vafile.write_va_file(vafile.whole_vectors(df))
            vafile.top_k(va, va.vectors, k=5).collect()


def test_top_k_reads_few_exact_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    va = vafile.write_va_file(vafile.whole_vectors(df))
    got = vafile.top_k(va, va.vectors.filter("vec_id % 50 = 0"), k=5)
    assert got.agg(F.max("exact_reads")).first()[0] < 100


def test_copies_and_outliers_cost_no_exact_reads(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(i, [0.25] * 8) for i in range(600, 1000)] + [(1000, [1e6] * 8)]     # one class of 400 rows; one outlier
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    va = vafile.write_va_file(vafile.whole_vectors(df), block=128)
    assert va.classes.count() == 602 and va.classes.agg(F.max(F.size("copies"))).first()[0] == 6
    asked = va.vectors.filter("vec_id % 50 = 0")
    got = vafile.top_k(va, asked, k=5)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, 5)
    assert got.agg(F.max("exact_reads")).first()[0] < 150       # of 602 classes, with 16 cells a dimension
    with pytest.raises(ValueError):
        vafile.top_k(va, asked, k=6)


def test_top_k_of_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    va = vafile.write_va_file(vafile.whole_vectors(df))
    assert vafile.top_k(va, va.vectors).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.identify(docs, model, ["doc_id", "lang"]).filter(langid.held_out(F.col("doc_id")))
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.97
    assert got.filter("score < 0 or score > 1").count() == 0
    texts = ["x", "de la que", "der und " * 50_000]
    assert [model.predict([t])[0][0] for t in texts] == [p for p, _ in model.predict(texts)]
    assert [p for p in model.predict([None, "", "12 !?", "\u00bd", "\u2167 \u2461", *texts])][:5] == [("und", 0.0)] * 5


def test_fit_sample_is_bounded_by_bytes(spark):
    row = lambda lang, n, size: (lang, n, bytearray(size), bytearray(0), bytearray(0))
    rows = [row("a", i, 10) for i in range(1, 30)] + [row("a", 0, 500), row("b", 0, 90), row("b", 1, 70), row("c", 0, 5)]
    df = spark.createDataFrame(rows, "lang string, n int, codes binary, words binary, times binary")
    got = sorted((r.lang, r.n) for r in langid.within(df, 300).collect())
    assert got == [("a", i) for i in range(1, 11)] + [("b", 1), ("c", 0)]
    assert langid.within(df, 1 << 20).count() == len(rows) and langid.within(df.limit(0), 300).count() == 0
    docs = spark.createDataFrame([("le la les de du " * 200, "fr"), ("the of and in to " * 200, "en")], "text string, lang string")
    assert langid.learn(docs, fit_bytes=1).languages == ["en", "fr"]          # no language goes


def test_kernel_of_pieces(monkeypatch):
    text = "".join(random.Random(2).choice("abcde éß") for _ in range(5000))
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "PIECE", 64)
    assert (langid.presence(text) == whole).all()


def test_edge_cases(spark):
    docs = table(spark, edge_rows())
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    rows = langid.identify(docs, model, ["doc_id", "text", "score"]).toDF("doc_id", "text", "old", "pred", "value").collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert (r.pred == "und") == (not r.text or not any(c.isalpha() for c in r.text))
        assert r.old == "x"
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns
    none = langid.learn(table(spark, []))
    assert {r.lang_pred for r in langid.identify(docs, none, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(table(spark, []), model, ["doc_id"]).count() == 0


def test_texts_of_unlearned_languages_go(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    planted = ["Все люди рождаются свободными и равными в своем достоинстве", "你好",
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
               "xqzvk wjqpf zzkxv qwrtp bvcxz mnqwk jhgfd plkjq", None, "", "12 !?"]
    rows = [(i, t, "en", "a") for i, t in enumerate(planted)] + [(100, "Released under the MIT License. 7f3a9c0b1e22d4", "en", "a")]
    assert [r.doc_id for r in langid.keep_known(table(spark, rows), model).collect()] == [100]
    # Clean texts stay, short ones too.
    clean = docs.filter(langid.held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    assert langid.keep_known(clean, model).count() == clean.count()


def test_word_ngrams_of_pieces(monkeypatch):
    text = "".join(random.Random(3).choice("abcde éß1-") for _ in range(5000))
    whole = langid.word_counts(text)
    monkeypatch.setattr(langid, "PIECE", 64)
    assert all((a == b).all() for a, b in zip(langid.word_counts(text), whole))


def test_copies_do_not_crowd_out_a_language(spark, monkeypatch):
    rng = random.Random(4)

    def texts(n, alphabet):
        return ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(n)]

    # The copies of one page are nearly all rows of one language and the first by hash, or not, of another.
    many = [("de", t) for page in texts(1, "abcd ") for t in [page] * 3000] + [("de", t) for t in texts(20, "abcd ")]
    more = [("fr", t) for t in texts(6, "efgh ") for _ in range(50)] + [("en", t) for t in texts(400, "ijkl ")]
    docs = table(spark, [(i, t, la, "a") for i, (la, t) in enumerate(many + more)], clash=False)
    fitted = []
    monkeypatch.setattr(langid, "fit", lambda rows, *rest: fitted.extend(rows))
    langid.learn(docs.repartition(7), per_language=8, landmarks=4)
    count = {la: [c.tobytes() for k, c in fitted if k == la] for la in ("de", "fr", "en")}
    assert {la: (len(c), len(set(c))) for la, c in count.items()} == {"de": (8, 8), "fr": (6, 6), "en": (8, 8)}
