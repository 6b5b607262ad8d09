"""Language identification by a linear-chain conditional random field.

Each word of a text gets a language: its features (affixes, letter n-grams, the word, and
the lexicons it stands in) give a score per language, learned transitions tie neighbours,
and forward-backward gives the posterior of every word.  A text's language is the one
with the largest share of its letters; the share is the score.

Training maximises the conditional likelihood of the words' labels on at most
``TRAIN_ROWS`` documents of the learning folds, in hash order; a document's words bear its
label.  The model's size is fixed: hashed features times the learned languages.

Inference runs over all words of a batch at once.  The chain is cut into blocks of
``BLOCK`` words; each block's product of transition matrices carries the forward and
backward messages past it, so the number of steps does not follow the longest text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table, written

TRAIN_ROWS = 1_500
FEATURES = 1 << 15
LEXICON = 2_000
BLOCK = 64
EPOCHS = 4
#: Letters of the words that a worker remembers.
CACHE_LETTERS = 6_000_000
#: Lengths of the n-grams, and of the affixes with their mark.
ORDERS, PREFIXES, SUFFIXES = (1, 2, 3), (3, 4), (3, 4, 5)
FACTOR = np.uint64(0x100000001B3)
UNDETERMINED = "und"

WORD = re.compile(r"[^\W\d_]+")


def crc32_mod(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def mixed(h: np.ndarray) -> np.ndarray:
    """Feature numbers of 64-bit codes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(17)).astype(np.int64) & (FEATURES - 1)


def features(words_: list[str], lexicons: list[set[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words, each between ``^`` and ``$``: the numbers, and the
    place of the word that each belongs to.

    A word has its letter n-grams of ``ORDERS`` at every place, prefixes and suffixes, the
    whole of it, and the lexicons that it stands in; all words are done at once, and one of
    any length whole.
    """
    code = np.frombuffer("".join(f"^{w}$" for w in words_).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words_), dtype=np.int64, count=len(words_))
    end = np.cumsum(size)
    begin = end - size
    owner = np.repeat(np.arange(len(words_)), size)
    left = end[owner] - np.arange(len(code))
    numbers, owners = [], []
    run = code.copy()
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            run = run[:-1] * FACTOR + code[n - 1 :]
        if n in ORDERS:
            whole = left[: len(run)] >= n
            numbers.append(mixed(run[whole] + np.uint64(n << 56)))
            owners.append(owner[: len(run)][whole])
    every = np.arange(len(words_))
    for tag, lengths in ((1, PREFIXES), (2, SUFFIXES)):
        for n in lengths:
            h = np.zeros(len(words_), dtype=np.uint64)
            for k in range(n):
                at = begin + k if tag == 1 else end - 1 - k
                some = size > k
                h[some] = h[some] * FACTOR + code[at[some]]
            numbers.append(mixed(h + np.uint64((tag * 16 + n) << 56)))
            owners.append(every)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max(initial=1)) - 1, FACTOR)]), dtype=np.uint64)
    if len(words_):
        whole = np.add.reduceat(code * power[np.arange(len(code)) - begin[owner]], begin)
        numbers.append(mixed(whole + np.uint64(48 << 56)))
        owners.append(every)
    for k, lexicon in enumerate(lexicons):
        inside = np.array([w in lexicon for w in words_], dtype=bool)
        numbers.append(np.full(inside.sum(), mixed(np.array([(49 << 56) + k], dtype=np.uint64))[0]))
        owners.append(every[inside])
    return np.concatenate(numbers), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    trans: np.ndarray  # languages x languages, log
    start: np.ndarray
    lexicons: list[set[str]]

    def emissions(self, words_: list[str]) -> np.ndarray:
        """Scores of words, a row for each."""
        ids, owner = features(words_, self.lexicons)
        n = len(words_)
        total = np.stack([np.bincount(owner, w[ids], n) for w in np.ascontiguousarray(self.weights.T)], axis=1) if n else np.zeros((0, len(self.languages)))
        return total / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))[:, None]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def posteriors(score: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posterior of each word's label.  ``score`` (words x labels) holds all chains end to
    end, ``first`` marks where one begins."""
    n, k = score.shape
    if n == 0:
        return score
    e = np.exp(score - score.max(axis=1, keepdims=True))
    step = np.exp(trans - trans.max())[None] * e[:, None, :]
    step[first] = (np.exp(start - start.max()) * e[first])[:, None, :]
    step /= step.sum(axis=(1, 2), keepdims=True)
    pad = -n % BLOCK
    step = np.concatenate([step, np.broadcast_to(np.eye(k) / k, (pad, k, k))]).reshape(-1, BLOCK, k, k)
    total = step[:, 0]
    for t in range(1, BLOCK):
        total = total @ step[:, t]
        total /= total.sum(axis=(1, 2), keepdims=True)
    m = len(step)
    ahead, behind = np.empty((m, k)), np.empty((m, k))
    v = np.full(k, 1 / k)
    for b in range(m):
        ahead[b] = v
        v = v @ total[b]
        v /= v.sum()
    v = np.full(k, 1 / k)
    for b in range(m - 1, -1, -1):
        behind[b] = v
        v = total[b] @ v
        v /= v.sum()
    forward = np.empty((m, BLOCK, k))
    v = ahead
    for t in range(BLOCK):
        v = _unit(np.einsum("bi,bij->bj", v, step[:, t]))
        forward[:, t] = v
    v = behind
    for t in range(BLOCK - 1, -1, -1):
        forward[:, t] *= v
        v = _unit(np.einsum("bij,bj->bi", step[:, t], v))
    return _unit(forward.reshape(-1, k)[:n])


def train(texts: list[str | None], langs: list[str], epochs: int = EPOCHS) -> Model:
    """Stochastic gradient ascent of the chains' log likelihood, in minibatches of documents."""
    languages = sorted(set(langs))
    k = len(languages)
    label = {g: i for i, g in enumerate(languages)}
    docs = [(w, label[g]) for t, g in zip(texts, langs) if (w := [x for x in words(t) if any(map(str.isalpha, x))])]
    tallies = [Counter() for _ in languages]
    for w, g in docs:
        tallies[g].update(set(w))
    every = sum(tallies, Counter())
    lexicons = [{w for w, _ in sorted(((w, c) for w, c in t.items() if c >= 2 and 2 * c > every[w]), key=lambda x: (-x[1], x[0]))[:LEXICON]} for t in tallies]
    known = list(every)
    ids, owner = features(known, lexicons)
    ids = ids[np.argsort(owner, kind="stable")]
    rows = dict(zip(known, np.split(ids, np.cumsum(np.bincount(owner, minlength=len(known)))[:-1])))
    weights, trans, start = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k)
    gain = np.full(FEATURES, 1e-6)
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), 32):
            some = [docs[i] for i in order[at : at + 32]]
            flat = [rows[x] for w, _ in some for x in w]
            size = np.array([len(r) for r in flat])
            ids = np.concatenate(flat)
            owner = np.repeat(np.arange(len(flat)), size)
            scale = 1 / np.sqrt(size)
            score = np.stack([np.bincount(owner, weights[ids, j], len(flat)) for j in range(k)], axis=1) * scale[:, None]
            gold = np.repeat([g for _, g in some], [len(w) for w, _ in some])
            first = np.zeros(len(flat), dtype=bool)
            first[np.cumsum([0] + [len(w) for w, _ in some[:-1]])] = True
            p = posteriors(score, first, trans, start)
            error = -p
            error[np.arange(len(flat)), gold] += 1
            each = (error * scale[:, None])[owner]
            grad = np.stack([np.bincount(ids, each[:, j], FEATURES) for j in range(k)], axis=1)
            gain += (grad * grad).sum(axis=1)
            weights += 0.5 * grad / np.sqrt(gain)[:, None]
            # pairwise expectations by the product of neighbours' posteriors
            inner = ~first[1:]
            want = np.zeros((k, k))
            np.add.at(want, (gold[:-1][inner], gold[1:][inner]), 1)
            trans += 0.1 * (want - p[:-1][inner].T @ p[1:][inner]) / max(1, inner.sum())
            start += 0.1 * (np.bincount(gold[first], minlength=k) - p[first].sum(axis=0)) / len(some)
    return Model(languages, weights, trans, start, lexicons)


class Memory(dict):
    """The number of each word met, with its scores and letters in arrays; 0 stands for a
    word without a letter.  Starts afresh when its words have ``limit`` letters."""

    def __init__(self, model: Model, limit: int = CACHE_LETTERS):
        super().__init__()
        self.model, self.limit = model, limit
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.scores = np.zeros((1, max(1, len(self.model.languages))))
        self.letters = np.zeros(1, dtype=np.int64)
        self.held = 0

    def learn(self, found: list[str]) -> None:
        """Remembers the words of ``found`` that are new, and where full only its words."""
        if self.held > self.limit:
            self.reset()
        new = [w for w in dict.fromkeys(found) if w not in self]
        bare = [w for w in new if not any(map(str.isalpha, w))] if self.model.languages else new
        self.update(dict.fromkeys(bare, 0))
        new = [w for w in new if w not in self]
        if new:
            self.update(zip(new, range(len(self.letters), len(self.letters) + len(new))))
            self.scores = np.concatenate([self.scores, self.model.emissions(new)])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, new), dtype=np.int64, count=len(new))])
            self.held += int(self.letters[-len(new) :].sum())


_WORDS: dict[str, Memory] = {}


def predict(texts: list[str | None], memory: Memory) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    model = memory.model
    found, lengths = [], []
    for t in texts:
        own = words(t)
        found += own
        lengths.append(len(own))
    memory.learn(found)
    rows = np.fromiter(map(memory.__getitem__, found), dtype=np.int64, count=len(found))
    owner = np.repeat(np.arange(len(texts)), lengths)[rows > 0]
    rows = rows[rows > 0]
    share = np.zeros((len(texts), max(1, len(model.languages))))
    if len(rows):
        first = np.ones(len(rows), dtype=bool)
        first[1:] = owner[1:] != owner[:-1]
        p = posteriors(memory.scores[rows], first, model.trans, model.start) * memory.letters[rows][:, None]
        for j in range(share.shape[1]):
            share[:, j] = np.bincount(owner, p[:, j], len(texts))
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    best = share.argmax(axis=1)
    top = np.minimum(share.max(axis=1), 1.0)
    return [model.languages[b] if s > 0 else UNDETERMINED for b, s in zip(best, top)], top


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, lang, text`` of at most ``rows`` ids with a known language of the learning
    folds, in hash order; of an id's rows the one whose text has the least hash."""
    known = docs.where("doc_id is not null and lang is not null and text is not null").where(crc32_mod(F.col("doc_id"), 3) != 1)
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("id"))
    own = known.join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
    one = own.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("one"))
    return one.select("doc_id", "one.lang", "one.text")


def identify(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything
    when no language was learned.  A null doc_id is not held out and never learned from;
    repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    sample = written(training_rows(docs, rows), "lang")
    got = sorted(sample.collect())  # at most ``rows``
    model = train([r["text"] for r in got], [r["lang"] for r in got])
    name = f"{model.languages} {float(np.abs(model.weights).sum())!r}"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _WORDS.setdefault(name, Memory(shared.value))
        for old in [k for k in _WORDS if k != name]:
            del _WORDS[old]
        for batch in batches:
            lang, score = [], []
            for k in range(0, batch.num_rows, 100):
                a, b = predict(batch.column(1)[k : k + 100].to_pylist(), memory)
                lang += a
                score.append(b)
            value = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(value)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(crc32_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    return narrow.mapInArrow(lean(each), "doc_id long, held_out boolean, lang_pred string, score double")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
