"""Secret scan with a random forest that removes false positives, in DataFrame and Spark ML operations only.

Candidates are the runs of ``MIN_LENGTH`` or more of the characters A-Z a-z 0-9 + / _ -
in the white-space separated words of whole texts, and, in words without such a run, the values
of ``MIN_VALUE`` or more characters of any kind that a name of a credential and ``=`` or ``:`` precede
(``password = "hunter.2!"``).  Each gets features of its length,
its character transitions, the share of its letter trigrams that the corpus dictionary
has, its path, and its neighbouring words.  A random forest (``pyspark.ml``), trained
from labelled findings, gives the probability that it is a secret.

* Dictionary: the trigrams (a-z, so at most 26^3) of the words that make up at least
  one in ``COMMON`` of all words; counted over the whole corpus.
* Training takes at most ``MAX_LABELLED`` distinct labelled findings of each label, those of smallest
  hash (thinned by the hash before they are ranked); the bound holds for fitting only, every candidate is scored.

Defined cases: null and empty texts have no candidates; a null path counts as an
empty one; without labelled findings of both kinds the score is 1.0 for every
candidate (nothing is removed); repeated rows repeat their findings; an empty table
gives no findings; a text may be of any length (its words are one array); of a finding that stands twice in a
word each has the neighbours of its own place.  Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MIN_LENGTH = 16
MIN_VALUE = 6
COMMON = 20_000
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 20, 6, 11
_RUN = rf"[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}"
_SPACE = r"[\x20\x09-\x0D]+"
#: Neighbouring words that speak of credentials, and those that speak of other long strings.
CREDENTIAL = r"(?i)(key|token|secret|passw|pwd|auth|credential|bearer|private)"
OTHERWISE = r"(?i)(example|sample|dummy|test|hash|sha|md5|commit|digest|checksum|uuid|revision|http)"
#: A name of a credential and what stands between it and its value; a value.
_NAMED = CREDENTIAL + r"[\w\-.\]]*[\"']?[=:]+[\"']?"
_VALUE = rf"[^\s\"',;=:]{{{MIN_VALUE},}}"
FEATURES = ("length", "digits", "uppers", "to_digit", "to_letter", "to_upper", "to_lower", "repeats", "vowels", "hexes",
            "marks", "coverage", "depth", "path_other", "assigned", "quoted", "credential", "otherwise")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, word_no, finding, path, left (words before it and what precedes it in its word), right."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
                    F.split(F.col(text_col), _SPACE).alias("w"))
    def named(x, i):               # the cheap tests come first: this sees every word
        l1, l2 = F.coalesce(F.get(F.col("w"), i - 1), F.lit("")), F.coalesce(F.get(F.col("w"), i - 2), F.lit(""))
        own = (F.contains(x, F.lit("=")) | F.contains(x, F.lit(":"))) & x.rlike(_NAMED + _VALUE)
        before = F.right(F.rtrim(l1, F.lit("\"'")), F.lit(1)).isin("=", ":") & F.concat(l2, l1).rlike(_NAMED + "$")
        return (F.length(x) >= MIN_VALUE) & (own | before)

    near = F.transform("w", lambda x, i: F.when(
        (F.length(x) >= MIN_LENGTH) | named(x, i),
        F.struct(i.alias("word_no"), x.alias("word"), F.get(F.col("w"), i - 2).alias("l2"), F.get(F.col("w"), i - 1).alias("l1"),
                 F.get(F.col("w"), i + 1).alias("r1"))))
    d = d.select("doc_id", "path", F.explode(F.filter(near, lambda s: s.isNotNull())).alias("s")).select("doc_id", "path", "s.*")
    d = d.withColumn("runs", F.regexp_extract_all("word", F.lit(f"({_RUN})"), F.lit(1)))
    # Each run at its first place after the run before it; a value after its name in the word, or after the quote.
    runs = F.expr("""aggregate(runs, cast(array() as array<struct<finding:string,at:int>>), (acc, f) -> concat(acc, array(
        named_struct('finding', f, 'at', locate(f, word, coalesce(try_element_at(acc, -1).at
                                                                  + length(try_element_at(acc, -1).finding), 1))))))""")
    lead = F.regexp_extract("word", rf"(?s)^(.*?{_NAMED}){_VALUE}", 1)
    lead = F.when((lead == "") & F.concat_ws("", "l2", "l1").rlike(_NAMED + "$"), F.regexp_extract("word", "^([\"']?)", 1)) \
            .when(lead != "", lead)
    value = F.regexp_extract(F.expr("substring(word, length(lead) + 1)"), f"^({_VALUE})", 1)
    d = d.withColumn("lead", lead).withColumn("value", F.when(F.col("lead").isNotNull(), value))
    values = F.when(F.length("value") > 0, F.array(F.struct(F.col("value").alias("finding"),
                                                            (F.length("lead") + 1).alias("at"))))
    d = d.select("*", F.posexplode(F.when(F.size("runs") > 0, runs).otherwise(values)).alias("nth", "p")).select("*", "p.*")
    return d.select("doc_id", "word_no", "nth", "finding", "path",
                    F.concat_ws(" ", "l2", "l1", F.expr("substring(word, 1, at - 1)")).alias("left"),
                    F.concat_ws(" ", F.expr("substring(word, at + length(finding))"), "r1").alias("right"),
                    (F.col("at") > 1).alias("inside"))


def dictionary(docs: DataFrame, text_col: str = "text", common: int = COMMON) -> DataFrame:
    """The trigrams (column ``gram``) of the common words of all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("([a-z]{3,})"), F.lit(1))).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    kept = counts.filter(F.col("n") * common >= F.lit(total))
    grams = F.expr("transform(sequence(1, length(word) - 2), i -> substring(word, i, 3))")
    return stored(kept.select(F.explode(grams).alias("gram")).distinct(), "secret-dictionary")


def _share(pattern: str) -> Column:
    return F.regexp_count("finding", F.lit(pattern)) / F.length("finding")


def with_features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """The candidates with one double column for each of ``FEATURES`` (and ``f_id``, the hash of a candidate)."""
    f = found.withColumn("f_id", F.xxhash64("finding"))
    texts = f.select("f_id", F.lower("finding").alias("t")).distinct()
    trig = texts.select("f_id", F.explode(F.expr("transform(sequence(1, length(t) - 2), i -> substring(t, i, 3))")).alias("g"))
    trig = trig.filter(F.col("g").rlike("^[a-z]{3}$"))
    known = grams.select(F.col("gram"), F.lit(1).alias("one"))
    cover = trig.join(known, F.col("g") == F.col("gram"), "left").groupBy(F.col("f_id").alias("c_id")).agg(
        (F.sum(F.coalesce("one", F.lit(0))) / F.count(F.lit(1))).alias("coverage"))
    f = f.join(cover, F.col("f_id") == F.col("c_id"), "left").drop("c_id")
    flag = lambda c: c.cast("double")
    around = F.concat_ws(" ", "left", "right")
    cols = {
        "length": F.length("finding"), "digits": _share("[0-9]"), "uppers": _share("[A-Z]"),
        "to_digit": _share("(?<=[A-Za-z])[0-9]"), "to_letter": _share("(?<=[0-9])[A-Za-z]"),
        "to_upper": _share("(?<=[a-z])[A-Z]"), "to_lower": _share("(?<=[A-Z])[a-z]"),
        "repeats": _share(r"(.)(?=\1)"), "vowels": _share("[AEIOUaeiou]"), "hexes": _share("[0-9a-f]"),
        "marks": _share(r"[+/_\-]"), "coverage": F.coalesce("coverage", F.lit(0.0)),
        "depth": F.regexp_count("path", F.lit("[/\\\\.]")), "path_other": flag(F.col("path").rlike(OTHERWISE)),
        "assigned": flag(F.col("left").rlike(r"[=:]\s*[\"']?$")), "quoted": flag(F.col("left").rlike("[\"']$")),
        "credential": flag(F.col("left").rlike(CREDENTIAL)), "otherwise": flag(around.rlike(OTHERWISE)),
    }
    return f.withColumns({k: F.coalesce(cols[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def label_findings(found: DataFrame) -> DataFrame:
    """Findings whose form alone tells what they are: label 1.0 (issued keys, assigned credentials) or 0.0 (words, paths).

    Used where no list of reviewed findings is at hand; rows whose form tells nothing are left out.
    """
    issued = F.col("finding").rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z\-]{10,})$")
    given = F.col("left").rlike(CREDENTIAL + r"[\w\-]*\s*[=:]\s*[\"']?$") & F.col("finding").rlike("[0-9]") \
        & ~F.concat_ws(" ", "left", "right").rlike(OTHERWISE)
    plain = F.col("finding").rlike(r"^([A-Z]?[a-z]+|[A-Z]+|[0-9]+|[a-z]+([/_\-][a-z]+)+)$") & ~issued
    return found.withColumn("label", F.when(issued | given, 1.0).when(plain, 0.0)).filter("label is not null")


def train(labelled: DataFrame, per_label: int = MAX_LABELLED):
    """A forest from labelled candidates with features; None if only one label occurs."""
    order = Window.partitionBy("label").orderBy("h", "doc_id", "word_no")
    sample = labelled.filter("label is not null").withColumn("h", F.xxhash64("finding", "doc_id", "word_no", F.lit(SEED)))
    sample = stored(sample.dropDuplicates(["label", "h"]).select("label", "h", "doc_id", "word_no", *FEATURES), "secret-labelled")
    # About twice the bound is ranked, not all findings of a label; short only if 40,000 fair draws give under 20,000.
    share = sample.groupBy(F.col("label").alias("s_label")).agg((F.lit(2.0 * per_label) / F.count(F.lit(1))).alias("share"))
    sample = sample.join(share, F.col("label") == F.col("s_label"), "inner") \
                   .filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    sample = sample.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_label)
    sample = stored(sample.select("label", "h", "n", *FEATURES), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample.orderBy("label", "n"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id",
         text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Every candidate: doc_id, word_no, nth, finding, path, left, right, score, is_secret.

    labelled: reviewed findings with the columns of :func:`candidates` and ``label``; without
    it :func:`label_findings` labels those of ``docs`` whose form tells.
    """
    grams = dictionary(docs, text_col)
    found = stored(with_features(candidates(docs, id_col, text_col, path_col), grams), "secret-candidates")
    known = label_findings(found) if labelled is None else with_features(labelled, grams)
    model = train(known)
    out = ["doc_id", "word_no", "nth", "finding", "path", "left", "right"]
    if model is None:
        return found.select(*out, F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    score = vector_to_array("probability")[1]
    return model.transform(rows).select(*out, score.alias("score"), (score >= threshold).alias("is_secret"))
