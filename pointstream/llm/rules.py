"""Quality rules in DataFrame operations only.

Counts of each text, and a score: the mean log-likelihood ratio of its hashed words and word pairs between
two multinomials, one of trusted documents and one of all.  Trusted are documents that ``labels`` calls good;
a bounded sample of labels is used, half of it for the multinomials and half for the threshold.  This lies
between what nearly all trusted documents of that half have and the best of the others below.  Counts of the raw
side cover every document.

A text is split and its words are hashed once; pairs and triples of words are hashed from these numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

#: Hash buckets of the multinomials.
BUCKETS = 10_000
#: Labels that are read at the most: those with the least hash of their doc_id.
LABELS = 40_000
MIN_WORDS = 50
#: The threshold is half way from this quantile of trusted documents' scores to the highest lower score of one that
#: isn't; without such a one, the quantile less half its distance from the median.
LOW = 0.0005

#: What separates words, and what counts as a symbol.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _upto(last: Column) -> Column:
    """0 to ``last``, nothing if it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(buckets: int) -> Column:
    """Buckets of the words and of the pairs, from the words' ``hashes``."""
    one = F.transform("hashes", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(_upto(F.size("hashes") - 2), lambda i: F.pmod(F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def _settled(df: DataFrame) -> DataFrame:
    """The same rows, with columns that a filter above can't pull apart: predicates aren't pushed below a
    generator, and so the long expressions here are worked out once a row and never inside one another."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    return df.select(F.explode(F.array(whole)).alias("r")).select("r.*")


def counted(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, the words' hashes, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), and ``carried`` columns."""
    split = docs.select("doc_id", *carried, "text", _words(F.col("text")).alias("words")).select(
        "doc_id",
        *carried,
        _hashes(F.col("words")).alias("hashes"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x, F.lit(SPACE))) > 0).alias("lines"),
    )
    triples = F.transform(_upto(F.size("hashes") - 3), lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)))
    hashed = split.select("*", (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), triples.alias("triples"))
    # where a triple occurs twice, triples in order of hash and place show which have an equal neighbour
    sorted_ = hashed.withColumn("sorted", F.when(F.size(F.array_distinct("triples")) < F.size("triples"), F.sort_array(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(x["h"] == F.get("sorted", k)["h"], F.lit(False))
    places = F.sort_array(F.array_remove(F.transform("sorted", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]).otherwise(-1)), -1))
    placed = sorted_.withColumn("places", F.when(F.col("sorted").isNotNull(), places))
    # each window covers its three words, less what the next one covers too
    fresh = F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3))))
    repeats = F.coalesce(F.aggregate(fresh, F.lit(0), lambda a, x: a + x), F.lit(0))
    return _settled(placed.select(
        "doc_id",
        *carried,
        "hashes",
        F.size("hashes").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        F.col("n_dup_lines").cast("long"),
        repeats.cast("long").alias("n_repeat_words"),
    ))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _scored(docs: DataFrame, ratios: np.ndarray) -> Column:
    table = F.split(F.lit(",".join(map(repr, ratios.tolist()))), ",").cast("array<double>")  # folded to one literal of a fixed size
    grams = _grams(len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, g))
    return F.when(F.size("hashes") > 0, total / (2 * F.size("hashes") - 1)).otherwise(F.lit(0.0))


def cut(scores: list[tuple[float, bool]], low: float = LOW) -> float:
    """The threshold from (score, whether trusted) of labelled documents."""
    good, rest = np.asarray([s for s, g in scores if g]), np.asarray([s for s, g in scores if not g])
    if not len(good):
        return float("-inf")
    least, middle = np.quantile(good, [low, 0.5])
    below = rest[rest < least]
    return float((least + below.max()) / 2 if len(below) else least - (middle - least) / 2)


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = LABELS) -> DataFrame:
    """row (the input row, a struct), doc_id, the counts, score, base_failed and kept for each row of ``docs``.

    Null texts are empty; they fail, as all with fewer than ``MIN_WORDS`` words do.  Without any trusted
    document nothing but the base rules rejects.  ``labels``: doc_id, quality; null and other values than 1
    mean not trusted, and of several rows the largest quality counts.  A row without an id has no label; repeated
    rows are judged each, with the same verdict, and all count; an empty table gives no rows."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"))
    docs = texts(docs)
    order = F.xxhash64(F.col("doc_id").cast("long"))
    labelled = (
        labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
        .where("doc_id is not null").orderBy(order, "doc_id").limit(sample)  # the bound of what is broadcast
        .select("doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), (F.pmod(F.shiftright(F.xxhash64("doc_id"), 20), F.lit(2)) == 0).alias("half"))
    )
    marked = docs.join(F.broadcast(labelled.where("good and half").select("doc_id", "half")), "doc_id", "left")
    grams = marked.select("half", _hashes(_words(F.col("text"))).alias("hashes")).select("half", F.explode(_grams(buckets)).alias("g"))
    counts = grams.groupBy("g").agg(F.count("*").alias("raw"), F.count_if("half").alias("target")).collect()  # ``buckets`` rows at the most
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts:
        raw[r["g"]], target[r["g"]] = r["raw"], r["target"]
    threshold = float("-inf")
    ratios = np.zeros(buckets)
    if target.sum():
        ratios = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
        # one score for each label
        rest = counted(docs.join(F.broadcast(labelled.where("not half").select("doc_id", "good")), "doc_id"), "good").where(~_base_failed())
        rest = rest.select("doc_id", "good", _scored(rest, ratios).alias("score")).groupBy("doc_id").agg(F.first("good").alias("good"), F.min("score").alias("score"))
        threshold = cut([(r["score"], r["good"]) for r in rest.collect()])
    rows = counted(rows, "row")
    rows = rows.select(*(c for c in rows.columns if c != "hashes"), _scored(rows, ratios).alias("score")).withColumn("base_failed", _base_failed())
    return _settled(rows).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))
