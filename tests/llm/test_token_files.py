import gc
import json
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from leafgrid.llm import token_files as tf
from leafgrid.llm.common import lean


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tf.default_tokenizer())


ODD = ["á ́b", "ΑΣ ΣΑΣ", "<|endoftext|> x<|startoftext|>y", "don't DON'T 12a3 !!??", "a b\x1cc d\x85e", "İstanbul ﬁ Å", "\x00 \x0b\x0c ,", "漢字仮名 \U0001f600‍\U0001f600"]


def test_words_encode_like_whole_texts(tokenizer):
    enc = tf.WordEncoder(tf.default_tokenizer(), "<u2", cache_words=3)
    assert enc.mark is not None
    for t in [*ODD, " ".join(ODD), "", " ", "~ ~~ a~b ~", "one two one", "<|STARTOFTEXT|> A, b.", "X., Y,. z... 'S. I'M. é. A\u0301, \u212a. K.", "A.\u00a0b, c.\u2003D"]:
        assert np.frombuffer(enc.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_plain_words_cost_a_piece_each_and_the_model_alone(tokenizer, monkeypatch):
    enc = tf.WordEncoder(tf.default_tokenizer(), "<u2")
    monkeypatch.setattr(enc, "_ids", None)  # the whole tokenizer, with its rules
    text = "Übung übung!!! ÜBUNG%%% (übung), übung.*** x2y22 élan; \u00d6L"
    assert np.frombuffer(enc.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    pieces = "übung !!! %%% ( ), .*** x 2 y élan ; öl"
    assert sorted(enc.known) == sorted(p.encode() for p in pieces.split())


def test_texts_encoded_at_once(tokenizer, tmp_path, monkeypatch):
    texts = [*ODD, "", "X\u00c9, \u00d7\u00f7 \u00e9\u0301 a\u00a0b", " ".join(ODD), None, "a\r\n1.5 ", "<|", "|>", "'s", "\u00dfs"]
    spec = json.load(open(tf.default_tokenizer()))
    spec["normalizer"]["normalizers"].pop()  # other rules: no lower case
    (tmp_path / "other.json").write_text(json.dumps(spec))
    for path, plain in ((tf.default_tokenizer(), True), (str(tmp_path / "other.json"), False)):
        enc = tf.WordEncoder(path, "<u2", cache_words=3)
        assert (enc.model is not None) == plain
        wanted = [[*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
        for size in (1, 9, 1 << 19):
            monkeypatch.setattr(tf, "GROUP_BYTES", size)
            column = pa.array(texts).cast(pa.binary())
            got, ends = [], []
            for some, last in tf.groups(column):
                ids, upto = enc.encode_all(some, b"\x02\x00", last)
                ends += [len(got) + n for n in upto.tolist()]
                got += ids.tolist()
            assert [got[a:b] for a, b in zip([0, *ends], ends)] == wanted and ends[-1] == len(got)


def test_round_trip(spark, documents, hard_rows, tokenizer, tmp_path):
    rows = hard_rows + [(900 + k, t, "en", "a") for k, t in enumerate(ODD)]
    df = documents(rows)
    folder = f"file://{tmp_path}/out"
    manifest = tf.write_shards(df, tf.default_tokenizer(), folder, partitions=5)
    got = sorted(tf.read_shards(spark, folder, manifest).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    whole = [r[0] for r in got]
    assert whole == sorted(whole, key=lambda d: (d is not None, d or 0))
    at = 0
    expected = {}
    for d, t, _, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        expected.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        expected[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert json.load(open(f"{tmp_path}/out/manifest.json"))["shards"] == manifest
    assert sum(m["ids"] for m in manifest) == at
    flat = np.concatenate([np.fromfile(f"{tmp_path}/out/{m['name']}.ids", m["dtype"]) for m in manifest])
    assert len(flat) == at and flat.max() < 49_408


def test_empty_table(spark, documents):
    assert tf.token_files(documents([])).collect() == []


def test_other_stores_are_refused():
    with pytest.raises(ValueError):
        tf.local_path("hdfs://name/out")


def test_a_worker_frees_its_encoder_for_other_operators():
    path = tf.default_tokenizer()
    held = weakref.ref(tf.encoder(path, "<u2"))
    assert list(lean(iter, keeps=True)(iter([1, 2]))) == [1, 2] and tf.encoder(path, "<u2") is held()
    assert list(lean(iter)(iter([1, 2]))) == [1, 2]
    gc.collect()
    assert held() is None
    assert tf.encoder(path, "<u2").encode("a b") == tf.WordEncoder(path, "<u2").encode("a b")
