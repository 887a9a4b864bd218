"""The document scan against a plain count of all terms."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
from tests.llm.fixtures import edge_rows, table, words
from tuplecohort.llm import lexical
from tuplecohort.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    tf = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in tf:
            n = sum(c.values())
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id string, text string, score string, no int")


@pytest.mark.parametrize("slice_bytes,k,held", [(4 << 20, 50, 200_000), (600, 3, 0)])
def test_equals_brute_force(spark, slice_bytes, k, held):
    rng = random.Random(2)
    rows = edge_rows() + [(200 + i, " ".join(words(rng, rng.randint(1, 60), 40)) + "?", "en", "a") for i in range(60)] \
        + [(400 + i, "Some w1, w1. repeated-TEXT é é", "en", "a") for i in range(70)]
    items = [(f"i{i}", " ".join(words(rng, 12, 60))) for i in range(12)] + [
        ("e", ""), ("n", None), ("p", "!!!"), ("u", "É é repeated"), ("a", "w1 W1 w1"), ("none", "zzz yyy"), (None, "two words")]
    found = lexical.search(table(spark, rows).repartition(4), items_of(spark, items), k, slice_bytes, held).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(brute([(r[0], r[1]) for r in rows], items, k), key=repr)


def test_pieces_of_long_texts():
    scan = lexical.TermScan([b"ab", b"c"])
    raw = lexical.spaced("ab c " * 500_000 + "x" * 3_000_000 + " ab abc")
    assert [x.tolist() for x in scan(raw)] == [[0, 1], [500_001, 500_000]]
    assert lexical.count_terms(raw) == 1_000_003


def test_large_sums_stay_whole():
    best = lexical.Best(1, 2, 0)
    for d, s in ((5, 2 ** 60), (4, 2 ** 60), (3, 2 ** 60 - 1), (None, 2 ** 60 + 1)):
        best.add(d, lexical.np.array([s]))
    item, score, doc, null = best.prune()
    assert score.tolist() == [2 ** 60 + 1, 2 ** 60] and doc[1] == 4 and null.tolist() == [True, False]


def test_empty_tables(spark):
    some = items_of(spark, [("a", "w1")])
    assert lexical.search(table(spark, []), some).collect() == []
    assert lexical.search(table(spark, edge_rows()), some.filter("false")).collect() == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(SQL["op12_aho_corasick_rank"]).fetchall()
    found = QUERIES["op12_aho_corasick_rank"](spark, SF_SMALL)
    assert found.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, found.collect())) == sorted(want)
