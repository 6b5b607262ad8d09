"""Quality classifier by importance resampling.

Two hashed n-gram generative models (bags of token unigrams and bigrams, hashed to
fixed buckets) are counted: one over trusted documents, one over all raw documents.
A document's log importance weight is the mean log ratio of the two over its n-grams,
as if it had ``DRAWS`` of them, so that length does not decide.  Adding Gumbel noise
and keeping the k largest sums draws k documents without replacement in proportion to
their weights: clean texts, whose weights are a few tenths to a few units apart, compete by
chance, and junk, tens of units below, hardly ever wins.

The classifier is fitted on at most ``TRUSTED_ROWS`` labelled rows (a hash-ordered sample,
its documented bound): one half makes the trusted model, the other the cut between junk and
clean.  The raw model counts every document.  k is the number of documents, counted over the
whole corpus, whose ratio is at least the cut.  The k-th largest key
is found exactly from histograms, so no sort of the corpus and no driver-side list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import lean, quoted, row_columns, row_of, table, written

#: Buckets of each n-gram order.
BUCKETS = 1 << 14
TRUSTED_ROWS = 8_000
DRAWS = 30
#: Raw-model n-grams that the trusted counts are smoothed with.
PRIOR = 2_000.0
#: N-grams of ratio 0 that a document's mean is smoothed with.
SHRINK = 8.0
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
PIECE = 100_000


class Hashes(dict):
    """64-bit hashes of tokens, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[token] = h = xxhash.xxh64_intdigest(token)
        return h


def pieces(texts: pa.Array, seen: Hashes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, buckets, owner): the n-grams of texts[first:end], about ``PIECE`` at a time."""
    known, first, held, lengths = seen.__getitem__, 0, [], []

    def cut(end: int):
        h = np.array(held, dtype=np.uint64)
        n = np.array(lengths, dtype=np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        uni = (h >> np.uint64(7)).astype(np.int64) & (BUCKETS - 1)
        inner = owner[1:] == owner[:-1]
        mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        bi = ((mixed >> np.uint64(23)).astype(np.int64) & (BUCKETS - 1))[inner] + BUCKETS
        return first, end, np.concatenate([uni, bi]), np.concatenate([owner, owner[1:][inner]])

    for k, t in enumerate(texts):
        tokens = TOKEN.findall(t.as_py() or "")
        held.extend(map(known, tokens))
        lengths.append(len(tokens))
        if len(held) >= PIECE:
            yield cut(k + 1)
            first, held, lengths = k + 1, [], []
    if lengths:
        yield cut(len(texts))


def labelled_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids in hash order: ``id, good, fit``.  The half with
    ``fit`` counts as trusted, the other half sets the cut: a model rates the texts it has
    counted too high to be cut by them."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    half = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 0
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("id"), F.col("good").cast("int").alias("good"), half.alias("fit"))


def counts(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of all documents and of the trusted ones of ``sample``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, raw, good = Hashes(), np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            trusted = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) > 0
            for first, end, bucket, owner in pieces(batch.column(0), seen):
                raw += np.bincount(bucket, minlength=2 * BUCKETS)
                good += np.bincount(bucket[trusted[first:end][owner]], minlength=2 * BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], ["b", "raw", "good"])

    flagged = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"), "left").select("text", F.when(F.col("fit"), F.col("good")).alias("good"))
    rows = flagged.mapInArrow(lean(count), "b long, raw long, good long").groupBy("b").agg(F.sum("raw"), F.sum("good")).collect()
    raw, good = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for b, r, g in rows:  # at most two rows per bucket order, whatever the corpus
        raw[b], good[b] = r, g
    return raw, good


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Per bucket, the log ratio of the trusted to the raw probability; each order has
    a distribution of its own."""
    out = np.zeros(2 * BUCKETS)
    for w in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        p = (raw[w] + 0.5) / (raw[w].sum() + 0.5 * BUCKETS)
        q = (good[w] + PRIOR * p) / (good[w].sum() + PRIOR)
        out[w] = np.log(q / p)
    return out


def uniform(seed: int) -> Column:
    """In (0, 1), from the id and the text: reruns draw alike, another seed draws anew."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def scored(docs: DataFrame, table_: np.ndarray, seed: int, columns: list[str]) -> DataFrame:
    """``row`` (a struct of ``columns``), ``ratio``, and ``u``, uniform."""
    read = list(dict.fromkeys([*columns, "text"]))
    whole = docs.select(uniform(seed).alias("u"), row_of(docs.select(*map(quoted, read))))
    kept = [f for f in whole.schema["row"].dataType.fields if f.name in columns]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Hashes()
        for batch in batches:
            row = batch.column(1)
            total = np.zeros(batch.num_rows)
            for first, end, bucket, owner in pieces(row.field("text"), seen):
                n = end - first
                sums = np.bincount(owner, weights=table_[bucket], minlength=n)
                total[first:end] = sums / (np.bincount(owner, minlength=n) + SHRINK)
            if len(kept) < len(read):
                row = pa.StructArray.from_arrays([row.field(c) for c in columns], columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), row, pa.array(total)], ["u", "row", "ratio"])

    return whole.mapInArrow(lean(score), StructType([whole.schema["u"], StructField("row", StructType(kept)), StructField("ratio", DoubleType())]))


def learned_cut(ratio: np.ndarray, good: np.ndarray) -> float:
    """The middle of the widest-agreeing gap: the cut with the best balanced accuracy
    between labelled junk and labelled clean rows; without one of the two, below all."""
    if good.all() or not good.any():
        return float("-inf")
    order = np.argsort(ratio, kind="stable")
    r, g = ratio[order], good[order].astype(bool)
    kept_good = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    dropped_bad = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    edges = np.concatenate([[r[0] - 1], (r[1:] + r[:-1]) / 2, [r[-1] + 1]])
    best = kept_good + dropped_bad
    top = np.flatnonzero(best >= best.max() - 1e-12)
    return float(edges[top].mean())


def largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest of the column ``key``, exactly, from at most ``bins`` rows a round."""
    low, high, above = keys.agg(F.min("key"), F.max("key")).first() + (0,)
    if k <= 0 or low is None:
        return float("inf")
    while low < high:
        at = F.least(F.lit(bins - 1), F.floor((F.col("key") - F.lit(low)) / F.lit(high - low) * F.lit(bins)))
        inside = keys.where(F.col("key").between(low, high)).groupBy(at.alias("bin"))
        rows = sorted(inside.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).collect(), key=lambda r: -r[0])
        for _, n, a, b in rows:
            if above + n >= k:
                low, high = a, b
                break
            above += n
        else:
            return low
    return low


def resample(docs: DataFrame, labels: DataFrame, seed: int = 11, rows: int = TRUSTED_ROWS, draws: float = DRAWS, columns: list[str] | None = None) -> DataFrame:
    """The documents drawn: ``row`` (``columns`` of ``docs``, all by default), ``log_weight``,
    ``key``.  Only ``columns``, the ratio and the noise are written between the passes.

    Null and empty texts have ratio 0; labels that are null, repeated or of no
    document are harmless, and without labels of both kinds every document is drawn.
    Rows tied with the k-th key (identical rows) are all drawn.  An empty table gives
    no rows.  Extra columns are carried along.
    """
    columns = list(columns or docs.columns)
    sample = written(labelled_sample(labels, rows), "sample")
    raw, good = counts(docs, sample)
    weighed = written(scored(docs, log_ratios(raw, good), seed, columns), "scored")
    known = weighed.select(F.col("row.doc_id").alias("doc_id"), "ratio").join(F.broadcast(sample.where("not fit")), F.col("doc_id") == F.col("id"))
    seen = known.groupBy("id").agg(F.min("ratio"), F.first("good")).collect()  # one row per id of the sample
    cut = learned_cut(np.array([r[1] for r in seen]), np.array([r[2] > 0 for r in seen])) if seen else float("-inf")
    weight = F.col("ratio") * F.lit(float(draws))
    keyed = weighed.select("row", weight.alias("log_weight"), (weight - F.log(-F.log("u"))).alias("key"), (F.col("ratio") >= cut).alias("above"))
    k = keyed.where("above").count()
    return keyed.where(F.col("key") >= largest(keyed.select("key"), k)).select("row", "log_weight", "key")


def resampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows drawn, with the columns of ``docs``."""
    return resample(docs, labels, **options).select(*row_columns(docs.columns))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, log_weight, gumbel_key`` of the documents that the classifier keeps."""
    got = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), columns=["doc_id"])
    return got.select(F.col("row.doc_id").alias("doc_id"), "log_weight", F.col("key").alias("gumbel_key"))
