"""Quality rules (native): counts of a text and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed token unigrams and bigrams: one of
trusted documents (a bounded, hash-ordered sample of ``TRUSTED_ROWS`` labelled rows),
one of the whole raw corpus.  Its mean over a text's n-grams, shrunk a little towards
zero, is compared with one fixed threshold for every document.

Everything is built from SQL functions: the n-grams of a text are an array of bucket
numbers; the corpus counts are an explode with map-side combining into at most
``2 * BUCKETS`` rows; the ratios then go back into the plan as one constant array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, let, table, words, written

BUCKETS = 1 << 13
TRUSTED_ROWS = 8_000
#: Raw-model n-grams that the trusted counts are smoothed with.
PRIOR = 2_000.0
#: N-grams of ratio 0 that a text's mean is smoothed with.
SHRINK = 8
#: A text is kept from this mean log ratio on.
THRESHOLD = -0.25
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
TOKEN = rf"([\p{{L}}\p{{M}}]+|\p{{N}}+|[^\p{{L}}\p{{M}}\p{{N}}{BLANK}]+)"


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(rf"[^{BLANK}]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words_: Column, width: int = WINDOW) -> Column:
    """Words inside a window of ``width`` words that the text has at least twice.

    Windows are compared by 64-bit hashes.  Texts without a repeat, nearly all, stop
    at a distinct count; the others sort their (hash, start) pairs and add up what the
    starts of repeated windows cover."""

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))

        def step(acc: Column, i: Column) -> Column:
            return F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"))

        return F.aggregate(starts, zero, step, lambda acc: acc["n"])

    def repeats(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def same(s: Column) -> Column:
            twice = F.filter(s, lambda r, j: (F.coalesce(F.get(s, j - 1)["h"] == r["h"], F.lit(False))) | F.coalesce(F.get(s, j + 1)["h"] == r["h"], F.lit(False)))
            return covered(F.sort_array(F.transform(twice, lambda r: r["i"])))

        return let(pairs, same)

    n = F.size(words_)
    hashed = F.transform(words_, lambda x: F.xxhash64(x))
    starts = F.sequence(F.lit(0), n - width)
    windows = let(hashed, lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))
    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeats(h)))
    return F.when(n > width, counted).otherwise(F.lit(0))


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), lambda x: F.xxhash64(x))


def first_bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def pair_bucket(h: Column, i: Column) -> Column:
    """Of the tokens at ``i - 1`` and ``i``."""
    return first_bucket(F.xxhash64(F.get(h, i - 1), F.get(h, i))) + F.lit(BUCKETS)


def grams(text: Column) -> Column:
    """Bucket numbers of the token unigrams, then of the bigrams."""

    def buckets(h: Column) -> Column:
        uni = F.transform(h, lambda x: first_bucket(x))
        pairs = F.transform(F.sequence(F.lit(1), F.size(h) - 1), lambda i: pair_bucket(h, i))
        return F.when(F.size(h) > 1, F.concat(uni, pairs)).otherwise(uni)

    return let(token_hashes(text), buckets)


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids labelled good, in hash order."""
    good = labels.where("doc_id is not null and quality > 0").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("trusted"))


def log_ratios(docs: DataFrame, sample: DataFrame) -> list[float]:
    """Per bucket the log ratio of trusted to raw probability, counted over all ``docs``."""
    text = F.coalesce("text", F.lit(""))
    flagged = docs.select("doc_id", text.alias("t")).join(F.broadcast(sample), F.col("doc_id") == F.col("trusted"), "left")
    each = flagged.select(F.col("trusted").isNotNull().cast("long").alias("good"), F.explode(grams(F.col("t"))).alias("b"))
    rows = each.groupBy("b").agg(F.count(F.lit(1)), F.sum("good")).collect()  # one row per bucket
    raw, good = [0] * (2 * BUCKETS), [0] * (2 * BUCKETS)
    for b, r, g in rows:
        raw[b], good[b] = r, g
    out = []
    for k in (0, BUCKETS):
        all_raw, all_good = sum(raw[k : k + BUCKETS]), sum(good[k : k + BUCKETS])
        for r, g in zip(raw[k : k + BUCKETS], good[k : k + BUCKETS]):
            p = (r + 0.5) / (all_raw + 0.5 * BUCKETS)
            out.append(round(math.log((g + PRIOR * p) / (all_good + PRIOR) / p), 6))
    return out


def rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRUSTED_ROWS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, log_ratio`` for every row of ``docs``.

    Null texts are empty: no words, so ``base_failed``.  Null, repeated or dangling
    labels are harmless; without any trusted label the ratio is 0.  Repeated rows stay;
    an empty table gives no rows; other columns are ignored.
    """
    sample = written(trusted_sample(labels, rows), "trusted")
    ratio = log_ratios(docs, sample)
    constant = F.from_json(F.lit("[" + ",".join(map(repr, ratio)) + "]"), "array<double>")
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    split = text.select("doc_id", "t", words(F.col("t")).alias("w"))

    def mean(h: Column) -> Column:
        uni = F.aggregate(h, F.lit(0.0), lambda acc, x: acc + F.get(constant, first_bucket(x)))
        pairs = F.sequence(F.lit(1), F.size(h) - 1)
        bi = F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + F.get(constant, pair_bucket(h, i)))
        n = F.size(h)
        return F.when(n > 1, (uni + bi) / (2 * n - 1 + SHRINK)).otherwise(uni / (n + SHRINK))

    counted = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(without(F.col("t"), "\x20\x09\x0a\x0b\x0c\x0d")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("t")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
        let(token_hashes(F.col("t")), mean).alias("log_ratio"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("log_ratio") >= threshold)
    return counted.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "log_ratio"
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
