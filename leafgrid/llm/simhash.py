"""SimHash near-duplicates by BK-trees over shards of fingerprints.

Fingerprints link at a Hamming distance of ``RADIUS`` or less.  Cut 64 bits into
``blocks`` blocks: two fingerprints within the radius agree on at least
``blocks - RADIUS`` of them, so one of the C(blocks, RADIUS) choices of that many
blocks is equal in both.  Every distinct fingerprint goes to one shard per choice,
named by the choice and the value of its blocks; each shard is a BK-tree whose
children are keyed by their integer distance to the parent, and a search follows
only edges within the radius of the query's own distance.  That finds every link.

In a large shard a row leaves the tree as soon as it is linked: a set of linked rows is
followed from its first row outwards, so a group of copies costs about a look a row and
not one a pair.

A shard's tree meets its queries in one task.  The trees are dealt by a shuffle, not
broadcast to all tasks: together they grow with the corpus, so a broadcast would have
no size bound.  A task turns the links of a shard into a star around the smallest
fingerprint of each linked set, so a shard of n fingerprints gives fewer than n edges.
Exact copies have one fingerprint and never meet in a shard.

All trees of a batch are built and searched together, level by level, in NumPy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, lean, maybe_broadcast, row_columns, row_of, table, written
from .components import stars

RADIUS = 3
BLOCKS = 5
#: Rows of whole shards that a task searches at once.
BATCH_ROWS = 100_000
#: Longs of a query and a tree node that are compared at once.
PAIRS = 1_000_000
#: In a shard of more rows, a row leaves the tree when its linked set first reaches it.
SMALL_SHARD = 48

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CORE = re.compile(r"[^\W_]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SEED = 42


def shingles(words: list[str], n: int) -> list[str]:
    """The runs of ``n`` words, repeats included; the whole sequence if it is shorter."""
    if len(words) <= n:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[k:] for k in range(n)))))


def majority(bits: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(bits * 2 > n, bitorder="little")


def hashes(items: list[str]) -> np.ndarray:
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(x, SEED) for x in items), dtype="<u8", count=len(items))


def fingerprint(hashed: np.ndarray, chunk: int = 65_536) -> int:
    """64 bits, each set if it is set in over half of ``hashed``; 0 without any."""
    n, total = len(hashed), np.zeros(64, dtype=np.int64)
    for k in range(0, n, chunk):
        total += np.unpackbits(hashed[k : k + chunk].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(majority(total, n).view("<u8")[0]) if n else 0


def text_fingerprint(text: str | None, size: int = 3) -> int:
    return fingerprint(hashes(shingles(WORD.findall((text or "").translate(LOWER)), size)))


# --- BK-trees -----------------------------------------------------------------------


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with equal keys: the number of their set, and the first row of each set."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return which, np.minimum.reduceat(order, starts) if len(starts) else starts


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; a row may have one long or several."""
    bits = np.bitwise_count(a ^ b)
    return bits.astype(np.int64) if bits.ndim == 1 else bits.sum(axis=1, dtype=np.int64)


class Forest:
    """One BK-tree per shard.  Node numbers are row numbers."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.parent = np.full(n, -1, dtype=np.int64)
        self.edge = np.zeros(n, dtype=np.int64)
        which, roots = _first_of(shard)
        self.root_of = roots[which] if n else which
        left = np.setdiff1d(np.arange(n), roots, assume_unique=True)
        at = self.root_of[left]
        while len(left):
            d = distance(prints[left], prints[at])
            which, first = _first_of(at, d)
            child = left[first]
            self.parent[child], self.edge[child] = at[first], d[first]
            at = child[which]
            stay = left != at
            left, at = left[stay], at[stay]
        order = np.lexsort((self.edge, self.parent))
        order = order[np.searchsorted(self.parent[order], 0) :]
        self.children = order
        self.begin = np.searchsorted(self.parent[order], np.arange(n))
        self.end = np.searchsorted(self.parent[order], np.arange(n), side="right")

    def near(self, query: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (a, b) with a of ``query`` and b any node of its shard within the radius, in
        pieces; only edges within the radius of a's distance to the parent are followed."""
        wide = 1 if self.prints.ndim == 1 else self.prints.shape[1]
        work = [(query, self.root_of[query])]
        while work:
            query, node = work.pop()
            if len(query) * wide > PAIRS and len(query) > 1:
                half = len(query) // 2
                work += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = distance(self.prints[query], self.prints[node])
            hit = d <= radius
            if hit.any():
                yield query[hit], node[hit]
            count = self.end[node] - self.begin[node]
            some = count > 0
            query, node, d, count = query[some], node[some], d[some], count[some]
            if not len(query):
                continue
            owner = np.repeat(np.arange(len(query)), count)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            child = self.children[self.begin[node][owner] + within]
            follow = np.abs(self.edge[child] - d[owner]) <= radius
            if follow.any():
                work.append((query[owner[follow]], child[follow]))

    def links(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (a, b), a > b, of one shard within the radius, in pieces."""
        for a, b in self.near(np.arange(len(self.prints)), radius):
            later = b < a
            yield a[later], b[later]


def linked_sets(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row of each row's linked set."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            if np.array_equal(x, y):
                break
            low = np.minimum(x, y)
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    return label


def _refused(pairs: Iterator[tuple[np.ndarray, np.ndarray]], close: Callable | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a, b in pairs:
        ok = slice(None) if close is None else close(a, b)
        yield a[ok], b[ok]


def follow_sets(shard: np.ndarray, prints: np.ndarray, radius: int, close: Callable | None = None, patience: int = 16) -> np.ndarray:
    """The smallest row of each row's linked set, for large shards of rows in order.

    In each round the first row left of each shard, and the rows it reaches in turn, leave
    the tree, which is built again when half of it has left.  After ``patience`` rounds that
    reached few rows, the rest is searched with all its rows at once.
    """
    label, left, idle = np.arange(len(shard)), np.arange(len(shard)), 0
    while len(left) and idle < patience:
        forest = Forest(shard[left], prints[left])
        alive = np.ones(len(left), dtype=bool)
        while 2 * alive.sum() >= len(left) and alive.any() and idle < patience:
            rows = np.flatnonzero(alive)
            before = len(rows)
            front = rows[np.unique(shard[left[rows]], return_index=True)[1]]
            alive[front] = False
            while len(front) and alive.any():
                reached = []
                for a, b in forest.near(front, radius):
                    ok = alive[b]
                    a, b = a[ok], b[ok]
                    if len(b) and close is not None:
                        ok = close(left[a], left[b])
                        a, b = a[ok], b[ok]
                    b, first = np.unique(b, return_index=True)
                    label[left[b]] = label[left[a[first]]]
                    alive[b] = False
                    reached.append(b)
                front = np.concatenate(reached) if reached else front[:0]
            idle = idle + 1 if before - alive.sum() < before / 64 else 0
        left = left[alive]
    if len(left):
        near = lambda x: (left[x[0]], left[x[1]])
        rest = linked_sets(len(shard), _refused(map(near, Forest(shard[left], prints[left]).links(radius)), close))
        label[left] = rest[left]
    return label


def star_edges(shard: np.ndarray, prints: np.ndarray, radius: int = RADIUS, close: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (row, smallest row of its linked set) of the rows that have a smaller one; the
    rows of a shard stand together.  ``close(a, b)`` can refuse links."""
    _, which, size = np.unique(shard, return_inverse=True, return_counts=True)
    large = size[which] > SMALL_SHARD
    label = np.arange(len(shard))
    for part, find in ((np.flatnonzero(~large), None), (np.flatnonzero(large), follow_sets)):
        own = (lambda part: None if close is None else lambda a, b: close(part[a], part[b]))(part)
        if not len(part):
            continue
        if find is None:
            got = linked_sets(len(part), _refused(Forest(shard[part], prints[part]).links(radius), own))
        else:
            got = find(shard[part], prints[part], radius, own)
        label[part] = part[got]
    row = np.flatnonzero(label != np.arange(len(label)))
    return row, label[row]


# --- distributed linking ------------------------------------------------------------


def block_keys(fp: Column, blocks: int, radius: int = RADIUS) -> Column:
    """The shard keys of a fingerprint: for each choice of blocks, its number mixed with
    the value of its bits (keys that collide by chance only join two trees)."""
    bounds = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum((((1 << (b - a)) - 1) << a) for a, b in c) for c in combinations(zip(bounds, bounds[1:]), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.array(*[F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)])


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows, cut only where the first column changes."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        whole = pa.Table.from_batches(held)
        key = whole.column(0).to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1])
        if len(change):
            cut = int(change[-1]) + 1
            yield whole.slice(0, cut)
            whole = whole.slice(cut)
        held, n = whole.combine_chunks().to_batches(), whole.num_rows
    if n:
        yield pa.Table.from_batches(held)


def shard_links(prints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Edges ``a, b`` whose components are those of all links between the distinct
    fingerprints of ``prints`` (column ``fp``)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            shard, fp = (t.column(c).to_numpy() for c in (0, 1))
            row, root = star_edges(shard, fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(fp[row]), pa.array(fp[root])], ["a", "b"])

    dealt = prints.select(F.explode(block_keys(F.col("fp"), blocks)).alias("shard"), "fp")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(lean(search), "a long, b long")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of every whole text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((text_fingerprint(t.as_py(), size) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(each), "doc_id long, fp long")


def groups(docs: DataFrame, size: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other; a null doc_id
    keeps its row and is never a component's smallest id unless it has no other;
    repeated rows stay repeated; an empty table gives no rows; other columns are
    ignored.
    """
    printed = written(fingerprints(docs, size), "prints")
    distinct = written(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    root = stars(shard_links(distinct, blocks))
    rooted = distinct.join(root, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = written(rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id"), "groups")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return printed.join(known, F.col("fp") == F.col("of")).select("doc_id", shown.alias("fingerprint"), "component_id")


# --- one document of each group -----------------------------------------------------

#: Words of a shingle, and the similarity of near copies.
SHINGLE, SIMILARITY = 5, 0.8
#: Longs of a text's fingerprint.
LONGS = 32
#: Differing bits of two of these 2048 at which texts are near copies.  Of two texts of like
#: length and similarity J a share acos(2J / (1 + J)) / pi differs, 310 bits at J = 0.8, with
#: a standard deviation of 16; at 0.75 it is 353, at 0.7 393.  One and a half deviations are
#: added, so 14 in 15 pairs at 0.8, 1 in 8 at 0.75 and hardly any at 0.7 are linked.
COPY_BITS = 334
#: Shards of the trees: bands of so many least shingle hashes each.  Texts of similarity J
#: share a given band with probability J ** 5; at 0.8 they miss all once in 2,700 pairs.
BANDS, BAND_ROWS = 20, 5
STREAMS = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) for k in range(LONGS)], dtype=np.uint64)
BAND_SEEDS, BAND_STREAMS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), dtype=np.uint64) | np.uint64(1)


def long_print(hashed: np.ndarray, longs: int = LONGS, chunk: int = 255) -> np.ndarray:
    """``longs`` 64-bit fingerprints from streams mixed out of the same hashes."""
    total = np.zeros(64 * longs, dtype=np.int64)
    for k in range(0, len(hashed), chunk):  # a chunk's sums fit a byte
        h = hashed[k : k + chunk, None] + STREAMS[None, :longs]
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        total += np.add.reduce(np.unpackbits(h.view("u1").reshape(len(h), -1), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return majority(total, len(hashed)).view("<u8")


def shingle_bands(hashed: np.ndarray, chunk: int = 4_096) -> np.ndarray:
    """The band keys of a text's shingles: the number of the band mixed with its minima."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashed), chunk):
        h = hashed[k : k + chunk]
        np.minimum(least, (((h ^ (h >> np.uint64(32)))[None, :] ^ BAND_SEEDS[:, None]) * BAND_STREAMS[:, None]).min(axis=1), out=least)
    least = least.reshape(BANDS, BAND_ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = (key ^ least[:, k]) * STREAMS[1]
        key ^= key >> np.uint64(31)
    return key


def copy_prints(docs: DataFrame) -> DataFrame:
    """``doc_id, th`` (a hash of the text), the longs ``f`` of its fingerprint and of the
    number of its distinct shingles, and its ``bands``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, LONGS + 1), dtype=np.uint64)
            bands = np.zeros((batch.num_rows, BANDS), dtype=np.uint64)
            for k, t in enumerate(batch.column(2)):
                words = CORE.findall((t.as_py() or "").lower())
                if words:
                    hashed = np.unique(hashes(shingles(words, SHINGLE)))
                    out[k, :-1] = long_print(hashed)
                    out[k, -1] = len(hashed)
                    bands[k] = shingle_bands(hashed)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(out), _lists(bands)], ["doc_id", "th", "f", "bands"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return narrow.mapInArrow(lean(each), "doc_id long, th long, f array<long>, bands array<long>")


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.reshape(-1).view(np.int64)))


def _like_sizes(count: np.ndarray) -> Callable:
    """Refuses rows a, b whose numbers of shingles rule out the similarity of near copies."""

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = count[a], count[b]
        return np.minimum(x, y) >= SIMILARITY * np.maximum(x, y)

    return close


def copy_links(nodes: DataFrame) -> DataFrame:
    """Edges ``a, b`` between rows of ``nodes`` (``node, f, bands``) that are near copies.  A
    shard is what shares a band; fingerprints go only to the bands that several rows share."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, BATCH_ROWS // 4):
            band, node = (t.column(c).to_numpy() for c in (0, 1))
            f = t.column(2).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            row, root = star_edges(band, f[:, :-1], COPY_BITS, _like_sizes(f[:, -1].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[row]), pa.array(node[root])], ["a", "b"])

    each = nodes.select("node", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("band").alias("shared"))
    shared = written(shared, "bands")
    few = each.join(maybe_broadcast(shared), F.col("band") == F.col("shared")).select("node", "band")
    sides = nodes.select(F.col("node").alias("of"), "f")
    both = few.join(sides, F.col("node") == F.col("of")).select("band", "node", "f")
    return both.repartition("band").sortWithinPartitions("band", "node").mapInArrow(lean(search), "a long, b long")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each group of near copies: the one
    with the smallest id (not null, if there is one), by text where ids tie.

    Texts are compared by lower-case words without punctuation.  Bands of least hashes of
    the five-word shingles deal the texts to shards, a BK-tree over long fingerprints of the
    shingles finds the pairs of a shard within the radius, and the numbers of shingles must
    allow a similarity of 0.8.  Texts without words are copies of each other; a row repeated
    in full stays once; null texts count as empty; an empty table gives no rows.
    """
    printed = written(copy_prints(docs).withColumn("node", F.xxhash64("f")), "copies")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("least")
    nodes = written(printed.groupBy("node").agg(F.first("f").alias("f"), F.first("bands").alias("bands"), least), "nodes")
    root = stars(copy_links(nodes))
    linked = root.unionAll(root.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "at")
    rooted = nodes.join(linked, F.col("node") == F.col("at")).select("node", "least", "root")
    keep = written(rooted.groupBy(F.col("root").alias("group")).agg(F.min("least").alias("kept")), "keep")
    of_group = rooted.join(maybe_broadcast(keep), F.col("root") == F.col("group")).select(F.col("node").alias("at"), "kept")
    known = nodes.join(of_group, F.col("node") == F.col("at"), "left").select(F.col("node").alias("of"), F.coalesce("kept", "least").alias("kept"))
    known = written(known, "kept")
    gone = printed.join(known, F.col("node") == F.col("of")).where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & F.col("th").eqNullSafe(F.col("kept.th"))))
    gone = written(gone.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")).distinct(), "gone")
    row = docs.select(row_of(docs), F.xxhash64("text").alias("row_th"))
    same = lambda d, t: F.col("row.doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col("row_th") == F.col(t))
    left = row.join(maybe_broadcast(gone), same("gone_id", "gone_th"), "left_anti")
    again = printed.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id"), F.col("th").alias("again_th"))
    again = written(again, "again")
    if not again.isEmpty():
        once = left.join(again, same("again_id", "again_th"), "left_semi").withColumn("row_id", F.col("row.doc_id")).dropDuplicates(["row_id", "row_th"]).drop("row_id")
        left = left.join(again, same("again_id", "again_th"), "left_anti").unionByName(once)
    for stale in (printed, nodes, keep, known):
        discard(stale)
    return left.select(*row_columns(docs.columns))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
