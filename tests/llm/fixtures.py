"""Small tables for the edge cases that every operator has to handle."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that an input may have besides, under names the operators use inside.
CLASH = ("key", "cid", "n", "token", "size", "copies", "h", "th", "comp", "start", "score", "found", "r", "k0")


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return ["w%d" % rng.randrange(vocabulary) for _ in range(n)]


def table(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    """rows: (doc_id, text, lang, source)."""
    schema = SCHEMA + "".join(f", `{c}` string" for c in CLASH if clash)
    full = [(i, t, la, s, None if t is None else len(t), *["x"] * (len(CLASH) if clash else 0)) for i, t, la, s in rows]
    return spark.createDataFrame(full, schema)


def edge_rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    base = words(rng, 120)
    near = list(base)
    near[60] = "changed"
    long = " ".join(words(rng, 30_000))
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, " \t\n", None, "b"), (3, None, "en", None),
            (4, "one", "en", "a"), (5, "one", "en", "a"), (5, "one", "en", "a"), (6, "two words", "de", "b"),
            (7, " ".join(base), "en", "a"), (8, " ".join(near), "en", None), (9, " ".join(base).upper(), "en", "a"),
            (None, " ".join(base), None, "b"), (10, long, "en", "c"), (11, "!!! 123 ???", "en", "c"),
            (7, " ".join(base), "en", "a"), (12, "Ünï cödé é́ ﬁ İ \u0001   x", "fr", "é")]
    return rows + [(100 + i, " ".join(words(rng, 40 + i)), "en", "a") for i in range(6)]
