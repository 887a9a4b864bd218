"""Keyed surrogates for personal data: the same entity always gets the same stand-in of the same kind.

Entities are found in whole texts by pattern: e-mail addresses, telephone numbers,
IPv4 addresses, card numbers, and names after a title.  Each is reduced to a canonical
form (case and punctuation dropped, a name without its title), so that its spellings
corefer.  An HMAC of kind, canonical form and attempt number, under a secret key,
drives the surrogate:

* digits become digits, letters letters of the same case and script (Latin, Cyrillic
  or Greek; of other scripts, Latin ones), marks stay;
* the country code of a telephone number, the leading digit and the check digit's
  validity of a card, and the top-level domain of an address are kept; octets are 1-254;
* a name gets a name of the same gender (by its title) and script, with the number of
  words it had.  Its last word is the family name, the others are given names, and each
  word has its own stand-in: "Frau Petra Klein" and "Frau Klein" keep their family name
  in common, and so do "Petra" and another Petra of that gender.

Collision checks: two entities of a kind (of names: two words) must not share a
surrogate, and none may be an entity that occurs.  Losers try again with the next
attempt number until no collision is left.  Checks compare one row per distinct entity,
in Spark.  From attempt WIDEN on, a surrogate is longer by a character an attempt (a
syllable in names), so that a shape with fewer values than entities is no endless
search; IPv4 addresses cannot be longer.  After MOST_ATTEMPTS an error is raised.

The secret key is a parameter, or else the session's ``spark.tuplecohort.surrogate.secret``;
without either the key of the tests serves, which is no secret.

Defined cases: a null text stays null, with no entities; very long texts are searched
as a whole, in one row; an entity that is part of a
longer one (by start, then length) is part of that one; repeated rows are equal
after, too; an empty table gives an empty result.  Only ``doc_id`` and ``text`` are
read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

TEST_KEY = b"tuplecohort surrogate key (replace in production)"
SECRET = "spark.tuplecohort.surrogate.secret"
WIDEN = 4
MOST_ATTEMPTS = 64
#: Country codes of one digit and of two (ITU-T E.164); all others have three.
_ONE_DIGIT = "17"
_TWO_DIGITS = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
               "81 82 84 86 90 91 92 93 94 95 98").split()
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Госпожа", "Κυρία")
_MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
_UPPER_WORD = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][a-zß-öø-ÿα-ωά-ώа-яё]+"
#: Characters of addresses: digits and Latin, Greek and Cyrillic letters; other scripts may stand next to an address without a space.
_MAIL = "0-9A-Za-zÀ-ɏḀ-ỿͰ-ϿЀ-ӿ"
_PATTERNS = (
    ("email", rf"(?<![{_MAIL}_.+-])[{_MAIL}][{_MAIL}_.+-]*@[{_MAIL}-]+(?:\.[{_MAIL}-]+)+"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)"
              r"|(?<![\w.])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"),
    ("card", r"(?<![\w.-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])"),
    ("name", rf"(?<!\w)(?:{'|'.join(_FEMALE + _MALE)})\.? {_UPPER_WORD}(?:[ -]{_UPPER_WORD}){{0,2}}"),
)
#: Every entity but a name has a digit or an @; a name stands after a title.
_SIGN = re.compile(r"[\d@]")
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS))
#: Syllables for names, by script; the ending tells the gender.
_ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
              "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
_NAMES = {
    "latin": ("bcdfghjklmnprstvz", "aeiou", "a", "o"),
    "cyrillic": ("бвгджзклмнпрстфх", "аеиоу", "а", "ов"),
    "greek": ("βγδζκλμνπρστφχ", "αεηιου", "α", "ος"),
}


def _script(word: str) -> str:
    c = word[-1]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical form) of a text's entities, in order; they do not overlap."""
    if not _SIGN.search(text) and not any(t in text for t in _FEMALE + _MALE):
        return []
    out = []
    for m in _ANY.finditer(text):
        kind, found = m.lastgroup, m.group()
        if kind == "card" and not 13 <= sum(c.isdigit() for c in found) <= 19:
            continue
        if kind == "email":
            # A letter whose lower case is longer stays, so that places in the form are places in the text.
            form = "".join(c.lower() if len(c.lower()) == 1 else c for c in found).rstrip(".-")
            out.append((m.start(), m.start() + len(form), kind, form))
            continue
        if kind == "name":
            title, _, rest = found.partition(" ")
            kind, form = "name_f" if title.rstrip(".") in _FEMALE else "name_m", rest
            out.append((m.end() - len(rest), m.end(), kind, form))
            continue
        if kind == "ip":
            form = ".".join(str(int(x)) for x in found.split("."))
        else:
            form = ("+" if found[0] == "+" else "") + "".join(c for c in found if c.isdigit())
        out.append((m.start(), m.end(), kind, form))
    return out


class _Bytes:
    """Endless keyed bytes."""

    def __init__(self, key: bytes, label: str) -> None:
        self.key, self.label, self.n, self.held = key, label.encode(), 0, b""

    def below(self, n: int) -> int:
        while True:
            if not self.held:
                self.held = hmac.new(self.key, self.label + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
                self.n += 1
            v, self.held = self.held[0], self.held[1:]
            if v < 256 - 256 % n:
                return v % n


def luhn_valid(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def _same_shape(text: str, draw: _Bytes) -> str:
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = _ALPHABETS[_script(c)]
            new = letters[draw.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def country_code(digits: str) -> str:
    return digits[:1 if digits[0] in _ONE_DIGIT else 2 if digits[:2] in _TWO_DIGITS else 3]


def name_parts(kind: str, form: str) -> list[tuple[str, str]]:
    """(kind, form) of the words of a name, with ("", mark) for what is between them; another entity as it is."""
    if not kind.startswith("name_"):
        return [(kind, form)]
    words = re.split(r"([ -])", form)
    return [("", w) if w in " -" else (("family" if i == len(words) - 1 else "given") + kind[4:], w)
            for i, w in enumerate(words)]


def stand_in(kind: str, form: str, attempts: dict[tuple[str, str], int], key: bytes) -> str:
    """The surrogate of an entity, by the attempts (0 if not told) of itself or, of a name, of its words."""
    return "".join(surrogate(k, f, attempts.get((k, f), 0), key) if k else f for k, f in name_parts(kind, form))


def surrogate(kind: str, form: str, attempt: int, key: bytes = TEST_KEY) -> str:
    """The stand-in, in canonical form, of an entity's (of names: a word's) canonical form."""
    draw = _Bytes(key, f"{kind}|{attempt}|{form}")
    wider = max(0, attempt - WIDEN + 1)
    if kind == "email":
        head, _, top = form.rpartition(".")
        return _same_shape("x" * wider + head, draw) + "." + top
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "phone":
        keep = 1 + len(country_code(form[1:])) if form[0] == "+" else 0
        return form[:keep] + _same_shape(form[keep:] + "0" * wider, draw)
    if kind == "card":
        body = form[0] + _same_shape(form[1:-1] + "0" * wider, draw)
        if luhn_valid(form):
            return next(body + d for d in "0123456789" if luhn_valid(body + d))
        return body + _same_shape(form[-1], draw)
    hard, soft, female, male = _NAMES[_script(form)]
    stem = "".join(hard[draw.below(len(hard))] + soft[draw.below(len(soft))] for _ in range(2 + draw.below(2) + wider))
    return (stem + hard[draw.below(len(hard))] + (female if kind.endswith("_f") else male)).capitalize()


def in_format(kind: str, found: str, new: str) -> str:
    """A surrogate's canonical form in the spelling of an occurrence."""
    if kind in ("phone", "card"):
        digits = iter(new.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in found) + "".join(digits)
    if kind == "email":
        more = len(new) - len(found)
        return new[:more] + "".join(n.upper() if c.isupper() else n for c, n in zip(found, new[more:]))
    return new


def entity_table(docs: DataFrame) -> DataFrame:
    """Every distinct entity, of names every distinct word: kind, form, n (occurrences)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [p for t in batch.column(0).to_pylist() if t for _, _, k, f in find_entities(t)
                   for p in name_parts(k, f) if p[0]]
            cols = list(zip(*got)) if got else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in cols], names=["kind", "form"])

    return docs.select("text").mapInArrow(run, "kind string, form string").groupBy("kind", "form") \
               .agg(F.count(F.lit(1)).alias("n"))


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [surrogate(k, f, a, key) for k, f, a in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], names=["kind", "form", "attempt", "new"])

    return entities.select("kind", "form", "attempt").mapInArrow(run, "kind string, form string, attempt int, new string")


def _key(df: DataFrame, key: bytes | None) -> bytes:
    if key is None:
        secret = df.sparkSession.conf.get(SECRET, None)
        return TEST_KEY if secret is None else secret.encode()
    return key


def assign(entities: DataFrame, key: bytes | None = None) -> DataFrame:
    """kind, form, attempt, new: a surrogate for each distinct entity, no two the same and none an entity that occurs."""
    key = _key(entities, key)
    real = stored(entities.select("kind", "form"), "surrogate-entities")
    table = stored(_with_surrogates(real.withColumn("attempt", F.lit(0)), key), "surrogate-table")
    for _ in range(MOST_ATTEMPTS):
        first = table.groupBy(F.col("kind").alias("c_kind"), F.col("new").alias("c_new")).agg(
            F.min(F.struct("attempt", "form")).alias("w"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = table.join(first, (F.col("new") == F.col("c_new")) & (F.col("kind") == F.col("c_kind")), "inner") \
                      .filter(F.struct("attempt", "form") != F.col("w")).select("kind", "form", "attempt")
        known = real.select(F.col("kind").alias("r_kind"), F.col("form").alias("r_form"))
        taken = table.join(known, (F.col("new") == F.col("r_form")) & (F.col("kind") == F.col("r_kind")), "left_semi") \
                     .select("kind", "form", "attempt")
        losers = stored(shared.union(taken).distinct(), "surrogate-losers")
        if losers.isEmpty():
            return table
        again = _with_surrogates(losers.withColumn("attempt", F.col("attempt") + 1), key)
        out = losers.select(F.col("kind").alias("l_kind"), F.col("form").alias("l_form"))
        stay = table.join(out, (F.col("form") == F.col("l_form")) & (F.col("kind") == F.col("l_kind")), "left_anti")
        table = stored(stay.unionByName(again), "surrogate-table")
    raise RuntimeError(f"entities without a surrogate of their own after {MOST_ATTEMPTS} attempts")


def replace_entities(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """One row per document: doc_id, text with surrogates, entities (start and stop in the old text, kind, surrogate).

    Nearly every entity keeps its first attempt, which needs no look-up; only
    documents with an entity of a later attempt are joined with these.
    """
    key = _key(docs, key)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    later = assign(entity_table(d), key).filter("attempt > 0").select("kind", "form", "attempt")
    later = stored(later, "surrogate-later")
    d = d.withColumn("key", F.xxhash64("doc_id", "text"))
    if later.isEmpty():
        rows = d.withColumn("later", F.array().cast("array<struct<kind: string, form: string, attempt: int>>"))
    else:
        def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = [(k, *p) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t
                       for e in find_entities(t) for p in name_parts(e[2], e[3]) if p[0]]
                cols = list(zip(*got)) if got else [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.string()), pa.array(list(cols[2]), pa.string())],
                    names=["o_key", "o_kind", "o_form"])

        seen = d.select("key", "text").mapInArrow(occurrences, "o_key bigint, o_kind string, o_form string").distinct()
        per = seen.join(later, (F.col("o_form") == F.col("form")) & (F.col("o_kind") == F.col("kind")), "inner") \
                  .groupBy("o_key").agg(F.collect_set(F.struct("kind", "form", "attempt")).alias("later"))
        rows = d.join(stored(per, "surrogate-per-document"), F.col("key") == F.col("o_key"), "left").drop("o_key")
    entity = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, entities = [], []
            for text, later_ in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if text is None:
                    texts.append(None)
                    entities.append([])
                    continue
                attempts = {(x["kind"], x["form"]): x["attempt"] for x in later_ or []}
                out, mine, at = [], [], 0
                for start, stop, kind, form in find_entities(text):
                    new = in_format(kind, text[start:stop], stand_in(kind, form, attempts, key))
                    out += [text[at:start], new]
                    mine.append({"start": start, "stop": stop, "kind": kind, "surrogate": new})
                    at = stop
                texts.append("".join(out) + text[at:])
                entities.append(mine)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(entities, pa.list_(entity))],
                                             names=["doc_id", "text", "entities"])

    return rows.select("doc_id", "text", "later").mapInArrow(
        run, "doc_id bigint, text string, entities array<struct<start: int, stop: int, kind: string, surrogate: string>>")
