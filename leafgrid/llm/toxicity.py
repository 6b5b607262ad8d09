"""Toxicity by a subsequence string kernel, a Nyström map and a linear SVM.

The kernel of two words counts their common subsequences of ``ORDER`` letters, gaps
included, each weighted by ``DECAY`` to the power of the stretch it spans in both words;
so ``idiot``, ``idi-ot`` and ``idxiot`` stay alike.  A few ``LANDMARKS`` stand for the
feature space (Nyström), and a squared-hinge SVM in it is solved by Newton steps.

Labels are of documents, so training is multiple-instance: a toxic document has
insulting units among others.  The first guess of a document's unit comes from the letter
n-grams that toxic documents over-use; then the SVM names the unit, the worst units of
clean documents join the negatives, and disguised forms (a letter put in or doubled) join
the positives.  A document's score is a logistic function of its highest unit value, the
mass of its insulting units (each counts by its value, 1 at most), and their share.

Units are words in lower case and runs of three or more single letters put together
(``i d i o t``).  A word with marks or digits is compared in each of its readings: without
its marks, by its pieces between them, with digits as the letters they stand for, and
without digits; its value is that of the worst.  Long words are cut into overlapping
windows, all of which count.  The model (landmarks and weights) has a fixed size and is fitted on at most
``TRAIN_ROWS`` labelled rows in hash order; every document is scored whole.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table, written

TRAIN_ROWS = 3_000
ORDER = 3
DECAY = 0.7
LANDMARKS = 96
#: Letters of a unit; longer words are cut into windows of these, overlapping by half.
LONGEST = 16
ROUNDS = 3
NEGATIVES = 4_000
#: Clean units among which the worst are looked for.
POOL = 40_000
#: What a unit that one document uses by chance may add to its mean share.
CHANCE = 0.006
#: A unit is a witness by itself if so many toxic documents have it, and by so much (log) more often.
LEAST, SURE = 4, 2.5
#: Words, the most frequent ones, among which landmarks are chosen.
CANDIDATES = 1_500
CACHE = 1_000_000

#: Letters and digits between blanks, marks inside included.
TOKEN = re.compile(r"[^\W_]+(?:(?:[^\w\x20\x09-\x0D]|_)+[^\W_]+)*")
SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[\W_]{1,3}[^\W\d_](?![^\W_])){2,}")
NOT_LETTER = re.compile(r"[\W\d_]+")
MARKS = re.compile(r"[\W_]+")
LETTER = re.compile(r"[^\W\d_]")
#: Signs that stand for letters inside a word (fixed values).
STAND_IN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
START, END = "^^", "$"


def units(text: str | None) -> list[str]:
    """The raw units of a text, repeats included; ``fold`` gives what the kernel compares."""
    low = (text or "").lower()
    found = TOKEN.findall(low)
    found += [NOT_LETTER.sub("", x) for x in SPACED.findall(low)]
    return found


def readings(word: str) -> list[str]:
    """The letter strings that a raw unit may be read as."""
    if word.isalpha():
        return [word]
    pieces = MARKS.split(word)
    out = []
    for part in [word, *(pieces if len(pieces) > 1 else [])]:
        if LETTER.search(part):
            out += [NOT_LETTER.sub("", part.translate(STAND_IN)), NOT_LETTER.sub("", part)]
    return list(dict.fromkeys(out))


def fold(word: str) -> list[str]:
    """What the kernel compares of a raw unit: each reading, or the windows of a long one;
    readings shorter than ``ORDER`` have no subsequence and are left out."""
    out = []
    for w in readings(word):
        if ORDER <= len(w) <= LONGEST:
            out.append(START + w + END)
        elif len(w) > LONGEST:
            out += [START + w[k : k + LONGEST] + END for k in range(0, len(w) - LONGEST // 2, LONGEST // 2)]
    return list(dict.fromkeys(out))


# --- kernel -------------------------------------------------------------------------


def codes(words: list[str], width: int) -> np.ndarray:
    """Code points, a column for each word, filled up with -1."""
    out = np.full((width, len(words)), -1, dtype=np.int32)
    for k, w in enumerate(words):
        out[: len(w), k] = [ord(c) for c in w]
    return out


def _grow(same: np.ndarray) -> np.ndarray:
    """The kernel of every pair of one block; axes 0 and 1 are places in the two words."""
    level = same
    for _ in range(ORDER - 1):
        grown = level.copy()
        for j in range(1, grown.shape[1]):
            grown[:, j] += DECAY * grown[:, j - 1]
        for i in range(1, grown.shape[0]):
            grown[i] += DECAY * grown[i - 1]
        level = np.zeros_like(same)
        np.multiply(same[1:, 1:], grown[:-1, :-1], out=level[1:, 1:])
    return level.sum(axis=(0, 1))


def _by_length(words: list[str], block: int) -> Iterator[tuple[int, list[int]]]:
    rows = defaultdict(list)
    for k, w in enumerate(words):
        rows[len(w)].append(k)
    for n, own in rows.items():
        for at in range(0, len(own), block):
            yield n, own[at : at + block]


def kernel(a: list[str], b: list[str], block: int = 96) -> np.ndarray:
    """Unnormalised kernel of every pair, by the usual recursion over prefixes."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    if not a or not b:
        return out
    right = codes(b, max(map(len, b)))
    right[right < 0] = -2
    square = np.float32(DECAY * DECAY)
    for n, some in _by_length(a, block):
        left = codes([a[k] for k in some], n)
        out[some] = _grow((left[:, None, :, None] == right[None, :, None, :]).astype(np.float32) * square)
    return out


def self_kernel(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.float32)
    for n, some in _by_length(words, 4_096):
        c = codes([words[k] for k in some], n)
        out[some] = _grow((c[:, None] == c[None, :]).astype(np.float32) * np.float32(DECAY * DECAY))
    return out


def normalised(words: list[str], landmarks: list[str], landmark_norm: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(self_kernel(words), 1e-12))
    return kernel(words, landmarks) / norm[:, None] / landmark_norm[None, :]


@functools.lru_cache(maxsize=None)
def subsequences(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of every ``ORDER`` of ``n`` letters, and the decay of their stretch."""
    places = np.array(list(combinations(range(n), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return places, DECAY ** (places[:, -1] - places[:, 0] + 1.0)


def flat(code: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The number of each subsequence of each row of letter numbers."""
    out = code[:, places[:, 0]]
    for k in range(1, ORDER):
        out = out * size + code[:, places[:, k]]
    return out


# --- model --------------------------------------------------------------------------


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    norm: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = -1.0
    #: Of the document's features, with a constant.
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, -10.0)

    @functools.cached_property
    def collapsed(self) -> tuple[dict[str, int], np.ndarray]:
        """The letters of the landmarks, numbered from 1, and one weight for each sequence
        of ``ORDER`` (three) letters: the sum over landmarks of beta times the sequence's
        weight in the landmark.  It gives the same values as the landmarks' kernels."""
        letters = {c: k + 1 for k, c in enumerate(sorted(set("".join(self.landmarks))))}
        size = len(letters) + 1
        weight = np.zeros(size**ORDER)
        for mark, beta, norm in zip(self.landmarks, self.beta, self.norm):
            code = np.array([letters[c] for c in mark])
            places, decay = subsequences(len(mark))
            np.add.at(weight, flat(code[None, :], places, size)[0], decay * (beta / norm))
        return letters, weight.astype(np.float32)

    def values(self, folded: list[str]) -> np.ndarray:
        out = np.full(len(folded), self.bias, dtype=np.float32)
        if not folded or not self.landmarks:
            return out
        letters, weight = self.collapsed
        size = len(letters) + 1
        norm = np.sqrt(np.maximum(self_kernel(folded), 1e-12))
        for n, some in _by_length(folded, 2_048):
            code = np.array([[letters.get(c, 0) for c in folded[k]] for k in some])
            places, decay = subsequences(n)
            out[some] += weight[flat(code, places, size)] @ decay.astype(np.float32) / norm[some]
        return out

    def unit_values(self, raw: list[str]) -> list[float]:
        """The value of each raw unit; -inf for those without enough letters."""
        parts = [fold(w) for w in raw]
        value = self.values([x for p in parts for x in p]).tolist()
        out, k = [], 0
        for p in parts:
            out.append(max(value[k : k + len(p)], default=float("-inf")))
            k += len(p)
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = features @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(values: list[float]) -> tuple[float, float, float]:
    """Of the values of a text's distinct units: the highest, the mass of insults, and their share."""
    hits = sum(v if v < 1 else 1.0 for v in values if v > 0)
    return max(-3.0, min(3.0, max(values, default=-3.0))), float(np.log1p(hits)), min(1.0, 20.0 * hits / (len(values) + 10))


def grams(word: str) -> set[str]:
    return {word[k : k + n] for n in (4, 5) for k in range(len(word) - n + 1)}


def shares(bags: list[Counter]) -> Counter:
    """The mean over bags of each unit's share of the bag, 3 % at most of each."""
    out: Counter = Counter()
    for bag in bags:
        n = bag.total()
        for u, c in bag.items():
            out[u] += min(c / n, 0.03) / len(bags)
    return out


def first_witnesses(bags: list[Counter], bad: Counter, good: Counter) -> list[str]:
    """From each toxic bag the unit whose n-grams are most over-used in toxic bags."""
    a, b = Counter(), Counter()
    for into, of in ((a, bad), (b, good)):
        for u, share in of.items():
            for g in grams(u):
                into[g] += share
    floor = CHANCE / len(bags)
    lift = {g: np.log((x + floor) / (b[g] + floor)) for g, x in a.items()}
    value = {g: a[g] * max(0.0, x - 0.7) for g, x in lift.items()}
    best = [max(bag, key=lambda w: (max((value[g] for g in grams(w)), default=0.0), w)) for bag in bags if bag]
    sure = [w for w in best if max((lift[g] for g in grams(w)), default=0.0) > 1.5]
    return sure or best


def disguised(words: Iterable[str], seed: int = 5) -> list[str]:
    """Each word twice more, with one letter put in and with one doubled."""
    rng = np.random.default_rng(seed)
    out = []
    for w in words:
        k, m = rng.integers(2, max(3, len(w)), 2)
        out += [w[:k] + chr(97 + int(rng.integers(26))) + w[k:], w[:m] + w[m - 1] + w[m:]]
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    eye = np.eye(x.shape[1]) * ridge
    eye[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(eye + (x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y) + eye @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 60) -> np.ndarray:
    """Squared hinge with a ridge, by Newton steps with halving on the rows inside the
    margin; the last column of ``x`` is the constant."""
    w, eye = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    eye[-1, -1] = 1e-9

    def loss(v: np.ndarray) -> float:
        slack = np.maximum(0, 1 - y * (x @ v))
        return float((weight * slack * slack).sum() + v @ eye @ v)

    now = loss(w)
    for _ in range(steps):
        inside = y * (x @ w) < 1
        xi, c = x[inside], weight[inside]
        step = np.linalg.solve(eye + (xi * c[:, None]).T @ xi, (xi * c[:, None]).T @ y[inside]) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        then = loss(w + size * step)
        if now - then < 1e-9 * max(now, 1e-12):
            break
        w, now = w + size * step, then
    return w


def spread(words: list[str], n: int) -> list[str]:
    """``n`` words far apart in the kernel, the first being the most frequent."""
    tally = Counter(words)
    pool = [w for w, _ in sorted(tally.items(), key=lambda t: (-t[1], t[0]))][:CANDIDATES]
    if len(pool) <= n:
        return pool
    norm = np.sqrt(np.maximum(self_kernel(pool), 1e-12))
    count = np.array([tally[w] for w in pool], dtype=float)
    chosen, near = [0], np.full(len(pool), -1.0)
    while len(chosen) < n:
        k = chosen[-1]
        near = np.maximum(near, kernel(pool, [pool[k]])[:, 0] / norm / norm[k])
        gain = (1 - near) * count
        gain[chosen] = -1
        chosen.append(int(gain.argmax()))
    return [pool[k] for k in chosen]


def train(texts: list[str | None], toxic: np.ndarray, rounds: int = ROUNDS, landmarks: int = LANDMARKS) -> Model:
    """Fits the model; without labels of both kinds, one that finds nothing toxic."""
    toxic = np.asarray(toxic, dtype=bool)
    bags = [Counter(x for w in units(t) for x in fold(w)) for t in texts]
    # of the copies of a document one is enough, else all its rare units look telling
    seen, one = defaultdict(list), []
    for k, (b, y) in enumerate(zip(bags, toxic)):
        marks = frozenset(sorted(zlib.crc32(u.encode()) for u in b)[:8])
        if all(len(marks & old) < 5 for m in marks for old in seen[m, bool(y)]):
            one.append(k)
            for m in marks:
                seen[m, bool(y)].append(marks)
    texts, bags, toxic = [texts[k] for k in one], [bags[k] for k in one], toxic[one]
    insulting = [b for b, y in zip(bags, toxic) if y and b]
    if not insulting or toxic.all():
        return Model()
    bad, good = shares(insulting), shares([b for b, y in zip(bags, toxic) if not y and b])
    rng = np.random.default_rng(3)
    clean = sorted(good, key=lambda u: (-good[u], u))
    rest = clean[POOL // 4 :]
    pool = clean[: POOL // 4] + [rest[k] for k in rng.permutation(len(rest))[: POOL - POOL // 4]]
    pool = list(dict.fromkeys(pool + [u for u in bad if u in good]))
    share = np.array([good[u] for u in pool])
    negative, against = pool[:NEGATIVES], pool[:400]
    # units that many toxic documents and hardly a clean one have are witnesses wherever they stand
    inside, outside = Counter(u for b in insulting for u in b), Counter(u for b, y in zip(bags, toxic) if not y for u in b)
    rate = len(insulting) / max(1, (~toxic).sum())
    sure = {u for u, n in inside.items() if n >= LEAST and np.log((n + 0.5) / (outside[u] + 0.5) / rate) > SURE}
    over_used = [u for b in insulting for u in b if u in sure]
    positive = first_witnesses(insulting, bad, good) + over_used
    model = Model()
    for turn in range(rounds):
        tally = Counter(positive)
        marks = list(dict.fromkeys(spread(positive, landmarks * 3 // 4) + spread(against, landmarks // 4)))
        norm = np.sqrt(np.maximum(self_kernel(marks), 1e-12))
        gram = normalised(marks, marks, norm).astype(float)
        value, vector = np.linalg.eigh((gram + gram.T) / 2)
        kept = value > 1e-4 * value.max()
        nystrom = vector[:, kept] / np.sqrt(value[kept])
        own = list(tally)
        forms = disguised(own)
        words = own + forms + negative
        x = normalised(words, marks, norm).astype(float) @ nystrom
        x = np.hstack([x, np.ones((len(words), 1))])
        y = np.concatenate([np.ones(len(own) + len(forms)), -np.ones(len(negative))])
        many = np.array([tally[u] for u in own], dtype=float)
        weight = np.concatenate([many, np.repeat(many, 2) / 4, [good[u] for u in negative]])
        for side, all_of_it, power in ((y > 0, 0.4, 0.5), (y < 0, 0.6, 0.25)):  # so that rare units count too
            weight[side] = weight[side] ** power
            weight[side] *= all_of_it / max(weight[side].sum(), 1e-12)
        w = svm(x, y, weight)
        model = Model(marks, norm, (nystrom @ w[:-1]).astype(np.float32), float(w[-1]))
        if turn < rounds - 1:
            harm = np.maximum(model.values(pool) + 1, 0) * share**0.5
            hard = [pool[k] for k in np.argsort(-harm, kind="stable")[: NEGATIVES // 2]]
            negative, against = list(dict.fromkeys(hard + pool[:NEGATIVES])), hard[:400]
    known: dict[str, float] = {}
    got = np.vstack([score_texts(texts[k : k + 500], model, known) for k in range(0, len(texts), 500)])
    model.weights = tuple(logistic(got, toxic.astype(float)).tolist())
    return model


# --- Spark --------------------------------------------------------------------------


def crc32_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled ids of the learning folds, in hash
    order; of an id's rows the one whose text has the least hash."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(crc32_mod(F.col("doc_id"), 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = known.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    own = docs.join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    one = own.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", F.col("label").cast("int").alias("label"))).alias("one"))
    return one.select("doc_id", "one.text", "one.label")


_SCORES: dict[str, dict[str, float]] = {}


def score_texts(texts: Iterable[str | None], model: Model, known: dict[str, float]) -> np.ndarray:
    """A row of ``features`` for each text; ``known`` remembers unit values."""
    raw = [units(t) for t in texts]
    missing = list(dict.fromkeys(w for r in raw for w in r if w not in known))
    if missing:
        if len(known) > CACHE:
            known.clear()
            missing = list(dict.fromkeys(w for r in raw for w in r))
        known.update(zip(missing, model.unit_values(missing)))
    get = known.__getitem__
    return np.array([features(list(map(get, set(r)))) for r in raw]).reshape(-1, 3)


def scores(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _SCORES.setdefault(name, {})
        for old in [k for k in _SCORES if k != name]:
            del _SCORES[old]
        for batch in batches:
            top = []
            for k in range(0, batch.num_rows, 200):
                top.append(model.probability(score_texts(batch.column(1)[k : k + 200].to_pylist(), model, known)))
            p = np.concatenate(top) if top else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    return narrow.mapInArrow(lean(each), "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Fits on the learning folds and scores every row.

    Null and empty texts, and texts without a unit, score as having no insult.  Null, repeated or dangling
    labels are harmless; without labels of both kinds nothing is predicted toxic.  A null
    doc_id is not held out and never learned from.  Repeated rows stay; an empty table
    gives no rows; other columns are ignored.
    """
    sample = written(training_rows(docs, labels, rows), "toxic")
    got = sorted(sample.collect(), key=lambda r: r["doc_id"])  # at most ``rows``
    model = train([r["text"] for r in got], np.array([r["label"] > 0 for r in got], dtype=bool))
    name = f"{model.landmarks} {model.bias} {model.weights}"
    return scores(docs, model, name)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
