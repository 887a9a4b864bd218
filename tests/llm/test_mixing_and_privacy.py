"""Mixing, secret scan, surrogates and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tuplecohort.llm import mixing, secret_forest, surrogates

from .fixtures import edge_rows, table, words

SMALL = "/root/testdata/sf0.01"


def targets_of(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Reshare round by round, as the contract puts it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        part = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if part[s] > cap * sizes[s]]
        if not over:
            return target | part
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mix(spark):
    rng = random.Random(8)
    rows = edge_rows() + [(1000 + i, " ".join(words(rng, rng.randrange(200))), "en", rng.choice("abcde") if i % 3 else "hot")
                          for i in range(900)] + [(5000, "solo", "en", "tiny"), (5001, "", "en", "void")]
    docs = table(spark, rows).repartition(5)
    got = [r.asDict() for r in mixing.mix_sources(docs, bucket=16, fan_in=3).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, size(t)) for i, t, _, s in rows)
    total, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, _, s in rows:
        total[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = targets_of(total)
    for r in got:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for s in total:
        assert abs(taken[s] - want[s]) <= largest[s], s
    again = [r.asDict() for r in mixing.mix_sources(docs.repartition(2), bucket=16, fan_in=3).collect()]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(got, key=key) == sorted(again, key=key)
    out = mixing.apply_mix(docs, mixing.mix_sources(docs, bucket=16, fan_in=3))
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) \
        == Counter({i: n for i in {r["doc_id"] for r in got} if (n := sum(r["copies"] for r in got if r["doc_id"] == i))})


def test_mix_within_a_column(spark):
    rng = random.Random(9)
    rows = edge_rows() + [(1000 + i, " ".join(words(rng, rng.randrange(200))), rng.choice(["en", "de", "de S1", None]),
                           rng.choice(["a", "b", "1 x", None])) for i in range(400)]
    docs = table(spark, rows).repartition(4)
    mix = mixing.mix_sources(docs, bucket=16, fan_in=3, within="lang")
    # Each value's rows come out with the targets that they have alone.
    want = Counter()
    for lang in {la for _, _, la, _ in rows}:
        alone = mixing.mix_sources(docs.filter(F.col("lang").eqNullSafe(lang)), bucket=16, fan_in=3)
        want.update((r.doc_id, r.h, r.size, r.source_size, round(r.target, 6)) for r in alone.collect())
    got = mix.collect()
    assert Counter((r.doc_id, r.h, r.size, r.source_size, round(r.target, 6)) for r in got) == want
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.copies * r["size"]
        target[r.source], largest[r.source] = r.target, max(largest[r.source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    out = mixing.apply_mix(docs, mix, within="lang")
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) == \
        Counter({i: n for i in {r.doc_id for r in got} if (n := sum(r.copies for r in got if r.doc_id == i))})


def test_pivot_keeps_the_mean():
    rng = random.Random(1)
    seen = Counter()
    for _ in range(20_000):
        a, b = mixing.pivot_pair(0.3, 4, 0.6, 10, rng.random())
        assert 4 * a + 10 * b == pytest.approx(0.3 * 4 + 0.6 * 10)
        assert min(a, 1 - a, b, 1 - b) == pytest.approx(0, abs=1e-9)
        seen["a"] += a
        seen["b"] += b
    assert seen["a"] / 20_000 == pytest.approx(0.3, abs=0.02) and seen["b"] / 20_000 == pytest.approx(0.6, abs=0.02)


def test_mix_of_empty_table(spark):
    docs = table(spark, [])
    mix = mixing.mix_sources(docs)
    assert mix.count() == 0 and mixing.apply_mix(docs, mix).count() == 0


def secret_rows():
    rng = random.Random(9)
    rows = []
    for i in range(240):
        w = words(rng, 30) + ["internationalisation", "misunderstanding" * 1, "counterproductive"]
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        if i % 4 == 0:
            w.insert(7, f'token = "{hexes}"')
        if i % 4 == 1:
            w.insert(3, "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)))
        if i % 4 == 2:
            w.insert(9, f"commit {hexes}")
        rows.append((i, " ".join(w), "en", "repo/src/main.py"))
    return rows


def test_secret_forest(spark):
    docs = table(spark, secret_rows() + edge_rows())
    got = secret_forest.scan(docs).collect()
    by = defaultdict(set)
    for r in got:
        by[r.finding].add(r.is_secret)
    for i, text, *_ in secret_rows():
        for f in re.findall(r"AKIA\w{16}", text) + re.findall(r'token = "(\w+)"', text):
            assert True in by[f]
        for f in ("internationalisation", "counterproductive"):
            assert by[f] == {False}
    assert sum(r.is_secret for r in got) < len(got) / 2


def test_candidates_by_context(spark):
    key = "abcdEFGH12345678"
    texts = ['password = "hunter.2!" and pwd=p@ss~1;x', f"db_secret: {key}a", "note: hunter.2!", "the password hunter.2!",
             f"x={key}/.{key}/.tail", "passwd=passwd", "token:a.b-c.d=e", "pwd=short", "", "API_KEY= 'ab1.!~'"]
    got = secret_forest.candidates(table(spark, [(i, t, "en", None) for i, t in enumerate(texts)])).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.doc_id, r.word_no, r.nth)):
        found[r.doc_id].append(r.finding)
    assert found == {0: ["hunter.2!", "p@ss~1"], 1: [key + "a"], 4: [key + "/"] * 2, 5: ["passwd"], 6: ["a.b-c.d"],
                     9: ["ab1.!~"]}
    two = sorted((r for r in got if r.doc_id == 4), key=lambda r: r.nth)
    assert [r.left for r in two] == ["x=", f"x={key}/."] and [r.right for r in two] == [f".{key}/.tail", ".tail"]
    assert next(r.left for r in got if r.doc_id == 5) == "passwd="


def test_training_bound_counts_distinct_findings(spark):
    docs = table(spark, secret_rows()[:20] + [secret_rows()[0]] * 200)
    found = secret_forest.with_features(secret_forest.candidates(docs), secret_forest.dictionary(docs))
    labelled = found.withColumn("label", F.col("finding").rlike("[0-9]").cast("double"))
    assert secret_forest.train(labelled, per_label=4) is not None      # copies do not crowd a label out


def test_secret_scan_with_reviewed_findings_and_without(spark):
    docs = table(spark, secret_rows()[:40])
    plain = secret_forest.candidates(docs)
    reviewed = plain.withColumn("label", F.col("finding").rlike("[0-9]").cast("double"))
    got = secret_forest.scan(docs, labelled=reviewed)
    assert got.count() == plain.count() and got.filter("is_secret <> (finding rlike '[0-9]')").count() == 0
    none = secret_forest.scan(docs, labelled=reviewed.filter("label = 1"))
    assert none.filter("not is_secret").count() == 0
    assert secret_forest.scan(table(spark, [])).count() == 0


PRIVATE = [
    (301, "Write to Ann.Lee99@Mail.example.com or ann.lee99@mail.example.com, call +1 (417) 555-3020.", "en", "a"),
    (302, "Call +1 417 555 3020 or +1 (417) 555-3021; host 10.1.2.3, card 4111 1111 1111 1111 or 4111111111111111", "en", "a"),
    (303, "Frau Petra Klein und Herr Klein, Mr. Smith; Госпожа Анна Иванова; Κύριος Παππας.", "de", "b"),
    (303, "Frau Petra Klein und Herr Klein, Mr. Smith; Госпожа Анна Иванова; Κύριος Παππας.", "de", "b"),
    (304, "version 1.2.3 and 1.2.3.4.5, 2024-01-02, no entity 12", "en", "a")]


def test_surrogates(spark):
    rows = PRIVATE + edge_rows()
    got = surrogates.replace_entities(table(spark, rows)).collect()
    old = {i: t for i, t, *_ in rows}
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in got}
    assert by[304].text == old[304] and not by[304].entities and by[303].text != old[303]
    mail = [e.surrogate for e in by[301].entities if e.kind == "email"]
    assert len(mail) == 2 and mail[0].lower() == mail[1] and mail[0][0].isupper() and mail[0].endswith(".com")
    digits = lambda s: re.sub(r"\D", "", s)
    phone = [e.surrogate for i in (301, 302) for e in by[i].entities if e.kind == "phone"]
    assert digits(phone[0]) == digits(phone[1]) != digits(phone[2])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phone[0]) and re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", phone[1])
    card = [e.surrogate for e in by[302].entities if e.kind == "card"]
    assert digits(card[0]) == card[1] != "4111111111111111" and surrogates.luhn_valid(card[1]) and card[1][0] == "4"
    names = {old[303][e.start:e.stop]: (e.kind, e.surrogate) for e in by[303].entities}
    assert set(names) == {"Petra Klein", "Klein", "Smith", "Анна Иванова", "Παππας"}
    assert names["Petra Klein"][0] == "name_f" and names["Smith"][0] == "name_m"
    assert re.fullmatch(r"[А-Я][а-я]+ [А-Я][а-я]+", names["Анна Иванова"][1])
    assert len({s for _, s in names.values()}) == len(names)
    for r in got:
        for e in r.entities:
            assert old[r.doc_id][e.start:e.stop] not in (r.text or "") or e.kind.startswith("name")
    assert surrogates.replace_entities(table(spark, [])).count() == 0
    again = surrogates.replace_entities(table(spark, rows).repartition(3)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in again)


def test_surrogates_of_hard_spellings(spark):
    """Lower case that is longer, short telephone numbers, a family name with and without the given name, other scripts."""
    rows = [(1, "mail aİb@mail.com, then", "en", "a"), (2, "call +1 55 12 or +44 20 7946 0958 or +351 21 123 4567", "en", "a"),
            (3, "Frau Petra Klein, Frau Klein, Frau Petra Vogt", "de", "a"), (4, "иван.петров@почта.mail.com ünal@x.com 联系ann@x.com。", "ru", "a")]
    by = {r.doc_id: r for r in surrogates.replace_entities(table(spark, rows)).collect()}
    assert re.fullmatch(r"mail [a-z][A-Z][a-z]@[a-z]{4}\.com, then", by[1].text)
    phones = [e.surrogate for e in by[2].entities]
    assert re.fullmatch(r"\+1 \d\d \d\d", phones[0]) and re.fullmatch(r"\+44 \d\d \d{4} \d{4}", phones[1])
    assert re.fullmatch(r"\+351 \d\d \d{3} \d{4}", phones[2])
    full, last, other = (e.surrogate for e in by[3].entities)
    assert full.split()[1] == last and other.split()[0] == full.split()[0] and other.split()[1] != last
    assert re.match(r"[а-я]{4}\.[а-я]{6}@", by[4].text) and not re.search("иван|петров|ü|ann", by[4].text)
    assert re.search(r" 联系[a-z]{3}@[a-z]\.com。$", by[4].text)
    assert surrogates.replace_entities(table(spark, rows), b"other").filter("doc_id = 3").first().text != by[3].text


def test_a_shape_that_is_used_up_gets_longer():
    """Every digit of a used-up shape finds an end, as surrogates grow from some attempt on."""
    for kind, form, found in (("phone", "+155123", "+1 55 12 3"), ("email", "a@b.co", "A@b.co"), ("card", "4" + "0" * 15, "4" + "0" * 15),
                              ("family_f", "Klein", "Klein")):
        late = [surrogates.surrogate(kind, form, a) for a in (surrogates.WIDEN, surrogates.WIDEN + 9)]
        assert len(form) < len(late[0]) < len(late[1]) or kind == "family_f" and len(late[0]) < len(late[1])
        assert len(surrogates.in_format(kind, found, late[0])) >= len(found) + (kind != "family_f")


def test_an_endless_search_raises(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "surrogate", lambda kind, form, attempt, key: "same")
    monkeypatch.setattr(surrogates, "MOST_ATTEMPTS", 2)
    with pytest.raises(RuntimeError, match="2 attempts"):
        surrogates.assign(spark.createDataFrame([("ip", "1.2.3.4"), ("ip", "1.2.3.5")], "kind string, form string"), b"k")


def test_collisions_are_resolved(spark, monkeypatch):
    """A stand-in that hits few values, real ones among them, until later attempts."""
    def poor(kind, form, attempt, key):
        return f"s{hash((form, attempt)) % 3 if attempt < 2 else form + str(attempt)}"

    monkeypatch.setattr(surrogates, "surrogate", poor)
    entities = spark.createDataFrame([("ip", f"s{i}") for i in range(12)] + [("email", "s1")], "kind string, form string")
    got = surrogates.assign(entities, b"k").collect()
    assert len(got) == 13 and len({(r.kind, r.new) for r in got}) == 13
    assert not {(r.kind, r.new) for r in got} & {(r.kind, r.form) for r in got}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    from .test_joins_and_repeats import brute_windows, near_rows
    rng = random.Random(2)
    item = " ".join(words(rng, 20))
    rows = near_rows(7) + edge_rows() + [(4000, item + " and more words", "en", "a"), (4001, "x" * 30 + " " + item.upper(), "en", "b")]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], str(tmp_path))
        if name != "token_files":
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert seen[1].filter("text is null or not text rlike '\\\\p{L}'").count() == 0
    clean = {r.doc_id for r in seen[3].select("doc_id").collect()}
    for i, _, _, _, _, bad in brute_windows([(r.doc_id, r.text) for r in seen[2].collect()], [(1, item)]):
        assert (i in clean) != bad
    assert seen[5].count() == seen[4].count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen[4].count()


def test_pipeline_mixes_the_languages_found(spark, tmp_path):
    import corpus_pipeline

    # Held-out documents come without a language or with a wrong one; the mix is to know them by their texts.
    true = spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang in ('en', 'de')").select("doc_id", "text", "lang", "source")
    wrong = F.when(F.col("doc_id") % 2 == 0, "en").otherwise(F.lit(None))
    given = true.withColumn("lang", F.when(corpus_pipeline.langid.held_out(F.col("doc_id")), wrong).otherwise(F.col("lang")))
    given = given.withColumns({"pred": F.lit("x"), "c0": F.lit("y"), "part": F.lit("z"), "lang_pred": F.lit("w")})
    given.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    corpus_pipeline.language_id(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/found")
    found = spark.read.parquet(f"{tmp_path}/found")
    assert found.columns == docs.columns and found.filter("pred <> 'x' or c0 <> 'y' or part <> 'z' or lang_pred <> 'w'").isEmpty()
    of = {r.doc_id: r.lang for r in true.collect()}
    rows = found.collect()
    assert len(rows) == len(of) and sum(r.lang == of[r.doc_id] for r in rows) > 0.97 * len(of)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, largest, taken = defaultdict(Counter), Counter(), Counter()
    for r in rows:
        sizes[r.lang][r.source] += size(r.text)
        largest[r.lang, r.source] = max(largest[r.lang, r.source], size(r.text))
    for r in corpus_pipeline.mix_sources(spark, found, str(tmp_path)).collect():
        taken[r.lang, r.source] += size(r.text)
    assert set(sizes) == {"en", "de"}
    for lang, per in sizes.items():
        for source, target in targets_of(per).items():
            assert abs(taken[lang, source] - target) <= largest[lang, source], (lang, source)


def test_pipeline_of_empty_table(spark, tmp_path):
    import corpus_pipeline

    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
