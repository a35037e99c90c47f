"""Quality rules and a log-likelihood ratio of hashed n-grams, in DataFrame expressions only.

Two multinomials over ``BUCKETS`` hash buckets of words and neighbouring pairs of words are
counted, in one pass: one over a trusted target (all documents labelled good), one over the
whole raw corpus. A bucket weighs the logarithm of its target count over the count expected from
the raw corpus, both smoothed by ``SMOOTHING`` occurrences. A document's score is the mean weight
of its n-grams, so length plays no part, and every document scoring below ``THRESHOLD`` goes: the
decision is a threshold, not a draw. Weights are whole millionths, which makes sums exact and
the verdict independent of the order of adding.

Rows: a null text has no words and fails the base rule, as do all texts of under ``LEAST_WORDS``
words; rows with equal keys are told apart by their text, rows repeated whole get equal answers;
a null key keeps its row. Without labelled documents every weight is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import keyed_text, written

BUCKETS = 1 << 16
#: Trusted keys that are sent to every task; more meet the documents in a shuffle.
SENT_KEYS = 2_000_000
SMOOTHING = 5.0
THRESHOLD = -0.1
LEAST_WORDS = 50
_MILLION = 1_000_000
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def _words(text: str) -> Column:
    """The words of a text; white space at its ends gives empty ones, which go."""
    return F.array_remove(F.split(text, _SPACE), "")


def _grams(words: str, n: int) -> Column:
    """The hash of each ``n`` neighbouring words."""
    if n == 1:
        return F.transform(words, lambda w: F.xxhash64(w))
    last = F.size(words) - n
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(n)]))


def base_rules(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, told (the text's hash), n_words and the four counts."""
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(_WORD))
    step = docs.select(
        "doc_id",
        F.xxhash64("text").alias("told"),
        _words("text").alias("words"),
        lines.alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
    )
    step = step.select(
        "doc_id", "told", "n_symbols",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _grams("words", 3).alias("windows"),
    )
    # Windows in the order of their hash, each with its place; equal ones lie side by side. Texts
    # whose windows all differ skip the sort.
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    all_differ = F.size(F.array_distinct("windows")) == F.size("windows")
    step = step.withColumn("placed", F.when(all_differ, none).otherwise(placed)).drop("windows")
    at = F.col("placed")
    twice = F.filter(at, lambda x, j: _same(x, F.get(at, j + 1)) | _same(x, F.get(at, j - 1)))
    step = step.withColumn("found", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("placed")
    found = F.col("found")
    # A window adds the words up to the next window found, three at most.
    added = F.transform(found, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(found, k + 1) - p, F.lit(3))))
    repeat_words = F.aggregate(added, F.lit(0), lambda total, x: total + x)
    counts = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    return step.select("doc_id", "told", *counts, repeat_words.cast("long").alias("n_repeat_words"))


def _same(x: Column, other: Column) -> Column:
    return F.coalesce(x["h"] == other["h"], F.lit(False))


def _buckets(docs: DataFrame) -> DataFrame:
    """A row for each word and each pair of neighbouring words: doc_id, told, bucket, and label if any."""
    kept = [c for c in docs.columns if c != "text"]
    words = docs.select(*kept, F.xxhash64("text").alias("told"), _words("text").alias("words"))
    hashes = F.concat(_grams("words", 1), _grams("words", 2))
    found = words.select(*kept, "told", F.explode(hashes).alias("hash"))
    return found.select(*kept, "told", F.pmod("hash", F.lit(BUCKETS)).alias("bucket"))


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per bucket that occurs: bucket, weight in millionths."""
    trusted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
    )
    trusted = written(trusted.select("doc_id", F.lit(True).alias("trusted")), "trusted")
    if trusted.count() <= SENT_KEYS:
        trusted = F.broadcast(trusted)
    grams = _buckets(docs.join(trusted, "doc_id", "left"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("trusted").alias("good"))
    # ``BUCKETS`` rows at most from here on.
    both = written(counts, "buckets")
    raws, goods = both.agg(F.sum("raw"), F.sum("good")).first()
    expected = F.col("raw") * F.lit((goods or 0) / (raws or 1))
    ratio = F.log((F.col("good") + SMOOTHING) / (expected + SMOOTHING))
    return both.select("bucket", F.round(ratio * _MILLION).cast("long").alias("weight"))


def judged(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: doc_id, n_words, the four counts, base_failed, kept, mean_weight."""
    docs = keyed_text(df, key, text)
    table = weights(docs, labels)
    sums = (
        _buckets(docs)
        .join(F.broadcast(table), "bucket")  # ``BUCKETS`` rows of two numbers
        .groupBy(F.col("doc_id").alias("id_"), F.col("told").alias("told_"))
        .agg(F.sum("weight").alias("weight"), F.count("*").alias("grams"))
    )
    rules = base_rules(docs)
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("told") == F.col("told_"))
    joined = rules.join(sums, same, "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = F.col("weight") >= F.col("grams") * F.lit(round(threshold * _MILLION))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(passes, F.lit(False))).alias("kept"),
        (F.col("weight") / F.col("grams") / _MILLION).alias("mean_weight"),
    )
