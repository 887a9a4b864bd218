"""Decontamination, Jaccard join and repeated bytes, each against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tuplecohort.llm import common, decontam, jaccard, repeats
from tuplecohort.llm.components import components

from .fixtures import edge_rows, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_windows(docs, items):
    wins = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOW))
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[p:p + n]), set()).add(i)
    out = []
    for d, t, *_ in docs:
        w = WORD.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[tuple(w[p:p + n])]
        out.append((d, len(w), len(hit), len(found), sorted(str(i) for i in found if i is not None),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontamination(spark):
    rng = random.Random(3)
    a, b, c = words(rng, 40, 30), words(rng, 13, 30), ["ÉTÉ", "kelvin", "x9"]
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, ", ".join(c)), (4, None), (5, "!!!"), (6, "solo"), (7, "two words"),
             (8, " ".join(a[5:25])), (8, " ".join(a[5:25])), (None, "nullitem here now")]
    rows = edge_rows() + [
        (20, "pre " + " ".join(a[3:20]).upper() + " post", "en", "a"), (21, " ".join(words(rng, 400, 30) + b), "en", "a"),
        (22, "ÉTÉ KELVIN x9 été kelvin x9", "en", "a"), (23, "Kelvin solo ÉTÉ Kelvin x9", "en", "a"),
        (24, " ".join(a[:13] * 3), "en", "a"), (25, "nullitem here now", "en", "a"), (26, "solo solo", "en", "a"),
        (26, "solo solo", "en", "a"), (27, " ".join(a[:12]), "en", "a"), (28, " ".join(words(rng, 3000, 30)), "en", "a")]
    docs = table(spark, rows).repartition(3)
    bench = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id bigint, text string, len string, wid string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated)
           for r in decontam.contamination(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(brute_windows(rows, items), key=repr)
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[-1] for r in got)


def test_decontamination_of_capital_sigma(spark):
    items = [(1, "ΟΔΟΣ ΑΘΗΝΑ"), (2, "ΣΟΦΟΣ x ΛΟΓΟΣ"), (3, "ΟΔΟς ΝΕΑ")]
    rows = [(1, "ΟΔΟΣ.ΑΘΗΝΑ", "el", "a"), (2, "ΟΔΟΣ:ΑΘΗΝΑ", "el", "a"), (3, "a ΣΟΦΟΣ'X'ΛΟΓΟΣ", "el", "a"),
            (4, "ΟΔΟΣ ΝΕΑ", "el", "a"), (5, "οδος αθηνα", "el", "a")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated)
           for r in decontam.contamination(table(spark, rows), bench).collect()]
    assert sorted(got, key=repr) == sorted(brute_windows(rows, items), key=repr)
    assert sum(r[2] > 0 for r in got) == 3


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_near_keys_loses_no_key(spark, monkeypatch, most):
    """At any number of keys, also where the filter is far too small for them."""
    monkeypatch.setattr(common, "MOST_FILTER_BITS", most)
    rows = spark.range(30_000).select("id", F.xxhash64("id").alias("h"))
    for n in (0, 1, 6_000):
        keys = common.stored(spark.range(n).select((F.col("id") * 3).alias("k")), "near-keys")
        near, far = (common.near_keys(rows, rows["h"], keys, F.xxhash64("k"), others=o) for o in (False, True))
        assert near.join(keys, F.col("id") == F.col("k"), "left_semi").count() == n
        assert far.join(keys, F.col("id") == F.col("k"), "left_semi").isEmpty()
        passed = near.count()
        assert passed + far.count() == 30_000
        assert most == 1 << 15 or passed <= n + 1_500


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontam.contamination(table(spark, []), bench).count() == 0
    got = decontam.contamination(table(spark, edge_rows()), bench.filter("false"))
    assert got.count() == len(edge_rows()) and got.filter("n_hit > 0").count() == 0


def brute_components(rows, size, percent):
    sets = []
    for _, t, *_ in rows:
        w = [x for x in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))]
        k = min(size, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    out = []
    for i, (d, *_) in enumerate(rows):
        mine = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(mine, default=None)))
    return out, [root(i) for i in range(len(rows))], sets


def near_rows(seed):
    """Families of copies with edits, some far enough apart to be linked by a chain only; sizes around the class border."""
    rng = random.Random(seed)
    rows, at = [], 1000
    for n in (12, 40, 64, 66, 70, 76, 150, 300):
        base = words(rng, n, 300)
        for k in range(14):
            w = list(base)
            for _ in range(rng.randrange(1 + n // 40)):
                w[rng.randrange(len(w))] = "e%d" % rng.randrange(50)
            if rng.random() < 0.5:
                base = w
            at += 1
            rows.append((at, " ".join(w), "en", "a"))
    line = words(rng, 25, 300)
    rows += [(2000 + i, " ".join(words(rng, 60, 3000) + line + words(rng, 60, 3000)), "en", "b") for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,percent,block", [(3, 90, 128), (5, 80, 4)])
def test_jaccard_components(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "SHORT_LIST", 32 if block > 100 else 3)
    rows = near_rows(size) + edge_rows()
    got = jaccard.jaccard_components(table(spark, rows).repartition(3), size, percent)
    want, group, sets = brute_components(rows, size, percent)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) \
        == sorted(want, key=repr)


def test_meetings_of_blocks_are_compared_in_bounded_portions(spark, monkeypatch):
    """No comparison shuffles much more than its bound, however many blocks meet; together they find all links."""
    for name, value in (("BLOCK", 8), ("SHORT_LIST", 3), ("STAR_ROUNDS", 0), ("PORTION", 1 << 14), ("PORTION_TIMES", 1)):
        monkeypatch.setattr(jaccard, name, value)
    at_once, compare = [], jaccard.compare_blocks

    def counted(meets, blocks, sets, percent):
        side = blocks.join(sets.select("cid", F.length("tokens").alias("bytes")), "cid").groupBy("block").agg(
            F.sum("bytes").alias("bytes"))
        both = meets.select(F.explode(F.array("x", "y")).alias("block")).join(side, "block")
        at_once.append((both.agg(F.sum("bytes")).first()[0] or 0, side.agg(F.sum("bytes")).first()[0]))
        return compare(meets, blocks, sets, percent)

    monkeypatch.setattr(jaccard, "compare_blocks", counted)
    rows = near_rows(5)[:120]
    got = jaccard.jaccard_components(table(spark, rows).repartition(3), 5, 80)
    want, _, _ = brute_components(rows, 5, 80)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) \
        == sorted(want, key=repr)
    held = at_once[0][1]
    assert len(at_once) > 2 and sum(b for b, _ in at_once) > 3 * held
    assert max(b for b, _ in at_once) < 2 * held


def test_jaccard_pairs_without_counted_tokens(spark, monkeypatch):
    # With so few counted tokens, sets stand in the index through uncounted ones only.
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "counted_below", lambda percent: 1)
    rows = near_rows(12)[:60]
    found = jaccard.jaccard_components(table(spark, rows).repartition(5), 3, 90).collect()
    expected, _, _ = brute_components(rows, 3, 90)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(expected)
    assert len({r.component_id for r in found}) < len(found)


def test_keep_one_of_each(spark):
    rows = near_rows(1) + edge_rows()
    docs = table(spark, rows).repartition(3)
    kept = jaccard.keep_one_of_each(docs, 5, 80)
    want, group, sets = brute_components(rows, 5, 80)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    first = {}
    for (d, *_), g, s in zip(rows, group, sets):
        if s:
            first[g] = min(first.get(g, (True, 0)), (d is None, d or 0))
    empties = Counter(d for (d, *_), s in zip(rows, sets) if not s)
    assert ids == Counter(None if n else d for n, d in first.values()) + empties
    assert jaccard.keep_one_of_each(table(spark, []), 5, 80).count() == 0


def test_block_derives_overlaps():
    import numpy as np
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) < 0.97], rng.integers(0, 1 << 62, 3, dtype=np.uint64)]))
            for _ in range(20)]
    block = jaccard.Block(list(range(20)), sets)
    for x in sets + [base[:200], np.unique(rng.integers(0, 1 << 62, 50, dtype=np.uint64))]:
        want = [i for i, s in enumerate(sets)
                if 100 * (c := len(np.intersect1d(x, s))) >= 90 * (len(x) + len(s) - c)]
        assert block.similar(x, 90).tolist() == want


def test_words_that_defeat_sums_modulo_a_power_of_two(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word, "en", "a"), (2, word.translate(str.maketrans("ab", "ba")), "en", "a"), (3, word, "en", "b")]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def shuffles_on_disk(spark):
    it = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while it.hasNext():
        m = re.match(r"shuffle_(\d+)_", it.next().getName())
        found |= {int(m[1])} if m else set()
    return found


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffles_on_disk(spark)
    was = spark.conf.get(common.CLEANUP_CONF, None)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    rows = rows.groupBy("k").count().join(rows.repartition(9, "k"), "k").groupBy("count").agg(F.sum("id").alias("s"))
    got = common.stored(rows, "test-shuffles")
    until = time.monotonic() + 5          # executors delete them in the background
    while (left := shuffles_on_disk(spark) - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left
    assert {tuple(r) for r in got.collect()} == {(143, 428571), (142, 70929)} and spark.conf.get(common.CLEANUP_CONF, None) == was


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95)], "a bigint, b bigint")
    got = dict(tuple(r) for r in components(links).collect())
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in (90, 95, 100)} == {90}


def brute_repeats(rows):
    seen = Counter()
    raws = [(t or "").encode() for _, t, *_ in rows]
    for b in raws:
        seen.update(b[p:p + 200] for p in range(len(b) - 199))
    out = []
    for (d, *_), b in zip(rows, raws):
        change = [0] * (len(b) + 1)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                change[p] += 1
                change[p + 200] -= 1
        gone, kept, n, level, spans = False, bytearray(), 0, 0, 0
        for i, c in enumerate(b):
            level += change[i]
            spans += level > 0 and not gone
            gone = level > 0
            n += gone
            if not gone:
                kept.append(c)
        out.append((d, len(b), n, spans, hashlib.sha256(bytes(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_repeated_bytes(spark, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(6)
    text = lambda n: " ".join(words(rng, n))
    p, q = text(60), text(33)
    rows = [r for r in edge_rows() if r[0] != 10] + [
        (200, p + text(20), "en", "a"), (201, text(9) + p, "en", "a"), (202, text(9) + p[7:] + "x", "en", "a"),
        (203, p[:199], "en", "a"), (204, p[:200], "en", "a"), (205, p[1:], "en", "a"), (206, "a" * 200, "en", "a"),
        (207, "a" * 201, "en", "a"), (208, "ab" * 250, "en", "a"), (209, q + q + q, "en", "a"), (210, q[:100] + p[100:], "en", "a"),
        (211, "é" * 150 + text(10), "en", "a"), (212, "é" * 99 + "x" + "é" * 99, "en", "a"), (213, text(800) + p + text(700), "en", "a"),
        (214, p[:230] + "Z" + p[231:], "en", "a"), (215, text(5) + q[:203], "en", "a"), (216, q[2:205] + text(5), "en", "a")]
    got = repeats.remove_repeats(table(spark, rows).repartition(4))
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got.collect()), key=repr)
    assert have == sorted(brute_repeats(rows), key=repr)


def test_repeated_bytes_of_empty_table(spark):
    assert repeats.remove_repeats(table(spark, [])).count() == 0
