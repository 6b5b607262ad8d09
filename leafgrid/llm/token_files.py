"""Token-id output: flat unsigned-integer files with 64-bit document offsets.

A shard is three files in a shared folder:

* ``NAME.ids``  token ids back to back, ``<u2`` if the vocabulary fits, else ``<u4``
* ``NAME.off``  ``n + 1`` offsets ``<i8`` in ids, from 0, within the shard
* ``NAME.doc``  ``n`` document ids ``<i8``, then ``n`` bytes that are 1 for a null id

Documents are range-partitioned by id, each partition writes one shard, and the
shard's base is the prefix sum of the id counts of the shards before it.  Only those
counts (one row per shard) reach the driver.  A task writes under a name of its own
and renames at the end, so a repeated or lost attempt leaves the same whole file.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, lean, new_path, table

END_ID = 2
#: Pieces of a generation of a worker's memory.
CACHE_WORDS = 200_000
#: Bytes of texts that are encoded at once.
GROUP_BYTES = 1 << 19
BLANK = re.compile(rb"[\x20\x09-\x0D]")

WRITTEN = "shard int, docs long, ids long, name string"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def local_path(url: str) -> str:
    """The mounted path of a shared folder; files that are memory-mapped need one."""
    parts = urlparse(url)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped token files need a mounted shared folder, not {url!r}")
    return parts.path


class WordEncoder:
    """Ids of whole texts, as packed integers, by a tokenizer that drops white space.

    Such a tokenizer never joins across a blank, so a text's ids are its pieces' ids in
    turn, and each distinct piece is encoded once.  A piece is a word between blanks.  If
    the tokenizer's rules are the ones below, words of ASCII and the letters \u00c0 to
    \u00ff alone are put in lower case and cut as those rules cut them, which makes fewer
    distinct pieces and leaves the tokenizer's model alone to run on them; words with
    anything else (other letters, marks, apostrophes, controls, ``<|``) stay whole.

    Many texts are cut at once, their pieces looked up once each.  The memory has two
    generations: when the young one is full it becomes the old one, from which pieces are
    taken back as they come up.  Texts are UTF-8 throughout; only new pieces become strings.
    """

    MARK = "~"
    #: The rules that cut pieces: white space, letters, one digit, any other signs.
    NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    CUTS = {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    }
    BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
    KINDS = bytes(0 if c in b" \t\n\v\f\r" else 1 if chr(c).isalpha() and c < 128 else 2 if c in b"0123456789" else 3 if 32 < c < 127 and c != ord("'") else 4 for c in range(256))
    LOWER = bytes(range(256)).lower()
    #: The characters that stand for bytes in the model's vocabulary (of the first 33 the blank alone comes up).
    BYTES = np.array([{c: 256 + 33 + k for k, c in enumerate([*range(0x7F, 0xA1), 0xAD])}.get(c, c) for c in range(256)], "<u4")

    def __init__(self, path: str, kind: str = "<u4", cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.limit = np.dtype(kind), cache_words
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        mark = self._ids(self.MARK)
        self.mark = mark[0] if len(mark) == 1 and self._ids(f"a {self.MARK} a") == [*self._ids("a"), *mark, *self._ids("a")] else None
        self.model = self._model()

    def _model(self):
        """The tokenizer's model alone, on pieces between blanks; None if its rules are others."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        whole = self.tokenizer
        rules = [x and json.loads(x.__getstate__()) for x in (whole.normalizer, whole.pre_tokenizer)]
        added = [t.content for t in whole.get_added_tokens_decoder().values()]
        model = whole.model
        if rules != [self.NORMALIZER, self.CUTS] or not all("<|" in t for t in added) or whole.truncation or whole.padding:
            return None
        if not isinstance(model, models.BPE) or model.dropout or model.end_of_word_suffix != "</w>":
            return None
        alone = Tokenizer(model)
        alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return alone

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _pack(self, words: list[bytes], ids: np.ndarray, cuts: list[int], gap: int) -> bool:
        """Remembers words[k] = ids from the last cut (and ``gap`` ids on) to cuts[k]."""
        if len(cuts) != len(words):
            return False
        packed, size, start = ids.tobytes(), self.kind.itemsize, 0
        for w, end in zip(words, cuts):
            self.known[w] = packed[start * size : end * size]
            start = end + gap
        return True

    def _learn(self, new: list[bytes]) -> None:
        """Words of letters alone end where an id ends a word, others get a mark of a known
        id between them, and all go to the tokenizer in one call of each kind."""
        missing = [(w, w.decode("utf-8", "surrogatepass")) for w in new]
        letters = [(w, t) for w, t in missing if t.isalpha()]
        if letters:
            ids = np.array(self._ids(" ".join(t for _, t in letters)), dtype=self.kind)
            if self._pack([w for w, _ in letters], ids, (np.flatnonzero(self.ends[ids]) + 1).tolist(), 0):
                missing = [(w, t) for w, t in missing if not t.isalpha()]
        plain = [(w, t) for w, t in missing if self.MARK not in t] if self.mark is not None else []
        if plain:
            ids = np.array(self._ids(f" {self.MARK} ".join(t for _, t in plain)), dtype=self.kind)
            self._pack([w for w, _ in plain], ids, [*np.flatnonzero(ids == self.mark).tolist(), len(ids)], 1)
        for w, t in missing:
            if w not in self.known:
                self.known[w] = np.array(self._ids(t), dtype=self.kind).tobytes()

    def _learn_pieces(self, new: list[bytes]) -> None:
        """Pieces that the rules leave as they are: each ends where an id ends a word."""
        for k in range(0, len(new), 1000):
            some = new[k : k + 1000]
            joined = b" ".join(some)
            text = joined.decode() if joined.isascii() else self.BYTES[np.frombuffer(joined, "u1")].tobytes().decode("utf-32-le")
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
            if not self._pack(some, ids, (np.flatnonzero(self.ends[ids]) + 1).tolist(), 0):
                self._learn(some)

    def _pieces(self, texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
        """The pieces of all texts in turn, which of them are whole words, and the number of
        pieces up to the end of each text."""
        raw = bytearray(b"".join(texts))
        data, kinds = np.frombuffer(raw, "u1"), np.frombuffer(raw.translate(self.KINDS), "u1")
        ends = np.cumsum(np.fromiter(map(len, texts), "i8", len(texts)))
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[0], first[ends] = True, True
        first = first[:-1]
        low = np.frombuffer(raw.translate(self.LOWER), "u1") if self.model else data
        if self.model and not raw.isascii():
            at = np.flatnonzero(data[:-1] == 0xC3)
            second = data[at + 1]
            letter = (second >> 6 == 2) & (second != 0x97) & (second != 0xB7) & ~first[at + 1]
            at, second = at[letter], second[letter]
            kinds[at] = kinds[at + 1] = self.LETTER
            low[at + 1] += np.where(second < 0x9F, 0x20, 0).astype("u1")
        if self.model and b"<|" in raw:
            kinds[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = self.OTHER
        full = kinds != self.BLANK
        new = np.ones(len(raw), dtype=bool)
        new[1:] = kinds[1:] != kinds[:-1]
        new |= first
        starts = (new | (kinds == self.DIGIT)) & full
        odd = np.flatnonzero(kinds == self.OTHER) if self.model else np.flatnonzero(starts)
        whole = np.zeros(len(raw), dtype=bool)
        if len(odd):
            edge = first.copy()
            edge[1:] |= ~full[:-1]
            words = np.flatnonzero(edge & full)
            word = np.zeros(len(words), dtype=bool)
            word[np.searchsorted(words, odd, "right") - 1] = True
            part = np.cumsum(edge & full, dtype="i4") - 1
            whole = full & word[part]
            starts = np.where(whole, edge, starts)
            low = np.where(whole, data, low)
        place = np.flatnonzero(starts)
        offsets = np.append(np.flatnonzero(starts[full]), np.count_nonzero(full)).astype("i4")
        pieces = pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(low[full])])
        return pieces, whole[place], np.searchsorted(place, ends)

    def _remember(self, words: list[bytes], whole: np.ndarray) -> list[bytes]:
        """The ids of distinct pieces; ``whole`` tells which of them are whole words."""
        found = list(map(self.known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        again = {w: self.old[w] for w in (words[k] for k in missing) if w in self.old}
        self.known.update(again)
        new = [k for k in missing if words[k] not in again]
        self._learn_pieces([words[k] for k in new if not whole[k]])
        self._learn([words[k] for k in new if whole[k]])
        for k in missing:
            found[k] = self.known[words[k]]
        return found

    def encode_all(self, texts: list[bytes], end: bytes = b"", last: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn with ``end`` after each of the ``last`` ones (all, if
        not given), and the number of ids up to there."""
        pieces, whole, upto = self._pieces(texts)
        upto = upto if last is None else upto[np.array(last, dtype=bool)]
        coded = pc.dictionary_encode(pieces, memory_pool=pa.system_memory_pool())
        index = coded.indices.to_numpy()
        odd = np.zeros(len(coded.dictionary) + 1, dtype=bool)
        odd[index[whole]] = True
        found = [*self._remember(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), odd), end]
        index = np.insert(index, upto, len(found) - 1)
        sizes = np.fromiter(map(len, found), "i8", len(found)) // self.kind.itemsize
        flat, each = np.frombuffer(b"".join(found), self.kind), sizes[index]
        stops = np.cumsum(each)
        place = np.repeat((np.cumsum(sizes) - sizes)[index] - (stops - each), each)
        place += np.arange(len(place))
        return flat[place], stops[upto + np.arange(len(upto))]

    def encode(self, text: str | bytes) -> bytes:
        return self.encode_all([text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text])[0].tobytes()


def encoder(path: str, kind: str) -> WordEncoder:
    """The worker's own encoder, kept from task to task until another operator's task runs."""
    return kept((path, kind), lambda: WordEncoder(path, kind))


def groups(texts: pa.Array) -> Iterator[tuple[list[bytes], list[bool]]]:
    """Texts in turn, in lists of about ``GROUP_BYTES``, and which elements end a text: one
    longer than that is cut before blanks."""
    some, last, size = [], [], 0
    for text in texts:
        text, at = text.as_py() or b"", 0
        while at is not None:
            cut = BLANK.search(text, at + GROUP_BYTES)
            some.append(text[at : cut.start()] if cut else text[at:])
            last.append(cut is None)
            size += len(some[-1])
            at = cut and cut.start()
            if size >= GROUP_BYTES:
                yield some, last
                some, last, size = [], [], 0
    if some:
        yield some, last


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, partitions: int | None = None) -> list[dict]:
    """Writes ``docs`` (``doc_id, text``) as shards below ``folder`` in ascending order
    of id (null ids first, ties by a hash of the text); gives the manifest, also left
    there as ``manifest.json``.

    Null and empty texts give the end id alone; an empty table gives empty shards.
    """
    root = local_path(folder)
    os.makedirs(root, exist_ok=True)
    kind = "<u2" if max(_vocabulary(tokenizer_path) - 1, end_id) < 1 << 16 else "<u4"

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, mark = f"shard-{part:06d}", f".{uuid.uuid4().hex}"
        words, end = encoder(tokenizer_path, kind), np.array([end_id], dtype=kind).tobytes()
        total, offsets, ids, nulls = 0, [np.zeros(1, dtype="<i8")], [], []
        with open(f"{root}/{name}.ids{mark}", "wb") as out:
            for batch in batches:
                texts = batch.column(1)
                texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
                for some, last in groups(texts):
                    got, ends = words.encode_all(some, end, last)
                    out.write(got)
                    offsets.append(ends + total)
                    total += len(got)
                docs = batch.column(0).to_pylist()
                ids += [doc or 0 for doc in docs]
                nulls += [doc is None for doc in docs]
        with open(f"{root}/{name}.off{mark}", "wb") as out:
            out.write(np.concatenate(offsets).astype("<i8"))
        with open(f"{root}/{name}.doc{mark}", "wb") as out:
            out.write(np.array(ids, dtype="<i8").tobytes() + np.array(nulls, dtype="u1").tobytes())
        for ending in ("ids", "off", "doc"):
            os.replace(f"{root}/{name}.{ending}{mark}", f"{root}/{name}.{ending}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([part], pa.int32()), "docs": [len(ids)], "ids": [total], "name": [name]})

    order = [F.col("doc_id"), F.col("tie")]
    narrow = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    dealt = narrow.repartitionByRange(partitions, *order) if partitions else narrow.repartitionByRange(*order)
    rows = dealt.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(lean(shard, keeps=True), WRITTEN).collect()
    base, manifest = 0, []
    for r in sorted(rows, key=lambda r: r["shard"]):
        manifest.append({"name": r["name"], "docs": r["docs"], "ids": r["ids"], "base": base, "dtype": kind})
        base += r["ids"]
    mark = f"{root}/manifest.json.{uuid.uuid4().hex}"
    with open(mark, "w") as out:
        json.dump({"end_id": end_id, "shards": manifest}, out)
    os.replace(mark, f"{root}/manifest.json")
    return manifest


def read_shards(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files alone, memory-mapped."""
    root = local_path(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                at = f"{root}/{s['name']}"
                off = np.memmap(f"{at}.off", dtype="<i8", mode="r")
                n = len(off) - 1
                if n == 0:
                    continue
                ids = np.memmap(f"{at}.ids", dtype=s["dtype"], mode="r")
                with open(f"{at}.doc", "rb") as f:
                    docs = np.frombuffer(f.read(8 * n), dtype="<i8")
                    nulls = np.frombuffer(f.read(n), dtype="u1").astype(bool)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                for k in range(0, n, 10_000):
                    w = slice(k, k + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[w], mask=nulls[w]), pa.array(off[:-1][w] + s["base"]), pa.array(np.diff(off)[w]), pa.array(crc[w], pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    if not manifest:
        return spark.createDataFrame([], READ)
    rows = spark.createDataFrame([(m["name"], m["base"], m["dtype"]) for m in manifest], "name string, base long, dtype string")
    return rows.repartition(len(manifest)).mapInArrow(lean(read, keeps=True), READ)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_files(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` as token files and returns what the files hold, per document:
    ``doc_id, start, n_tokens, ids_crc32``.

    Null and empty texts give the end id alone; null ids come first; repeated rows are
    written each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    return read_shards(spark, folder, write_shards(docs, tokenizer_path or default_tokenizer(), folder, end_id))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))
