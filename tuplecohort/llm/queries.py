"""Registered queries of this subpackage and their SQL twins.

``op<N>_<name>`` runs operator N with production parameters over its whole
table.  Where SQL can express the result, ``SQL`` holds the DuckDB statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontam, jaccard, langid, lexical, mixing, packing, repeats, secret_forest, surrogates, tokens, vafile, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back chunk by chunk."""
    manifest = warc.archive(table(spark, sf_dir, "pages"))
    return warc.record_summary(warc.read_warc(manifest))


SQL["op1_warc_chunks"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""


@query
def op2_va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every query vector (vec_id divisible by 50)."""
    va = vafile.write_va_file(vafile.whole_vectors(table(spark, sf_dir, "embeddings")))
    found = vafile.top_k(va, va.vectors.filter("vec_id % 50 = 0"), k=5)
    return found.select("query_id", "rank", "vec_id", "score")


SQL["op2_va_top_k"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.rid, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as Simple-8b files and read back."""
    import public_tokenizers

    manifest = tokens.write_id_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokens.read_id_files(manifest)


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL["op5_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS l FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS t
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM i)
), dw AS (
  SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS t
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)
), occ AS (SELECT doc_id, p, l, item_id FROM dw JOIN win USING (l, t)),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM occ) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query
def op6_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of all documents with the forest's score."""
    found = secret_forest.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word_no", "nth", F.length("finding").alias("length"),
                        F.sha2("finding", 256).alias("finding_sha256"), F.round("score", 6).alias("score"), "is_secret")


@query
def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents under 200-byte strings that occur at another place too."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    found = surrogates.replace_entities(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "entities")


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document so that the sources meet their target weights."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_shingles", "component_id")


SQL["op10_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(3, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.a = d.doc_id
"""


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_aho_corasick_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op12_aho_corasick_rank"] = f"""
WITH d AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, {_TERMS_SQL} AS w FROM documents) WHERE len(w) > 0),
c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
i AS (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS t FROM benchmark),
w AS (SELECT item_id, t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM i JOIN df USING (t), c),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
  FROM w JOIN tf USING (t), c GROUP BY item_id, doc_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""


@query
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers in all documents."""
    import public_tokenizers

    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
