"""The pipeline's stages one after the other, on rows with nulls, ties, copies and leaks."""

import random

import numpy as np
import pytest
from leafgrid.llm import mixing, token_files
from leafgrid.llm.common import table

import corpus_pipeline

from .conftest import prose
from .test_decontamination import ITEM

NAMES = ["doc_id", "text", "lang", "source", "n_chars", "odd.name"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `odd.name` string"


def write(spark, folder, docs, items, labels):
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x") for r in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    known = prose(rng, 200).split()
    clean = [(k, " ".join(rng.choices(known, k=rng.randint(60, 160))), "en", "ab"[k % 2]) for k in range(90)]
    junk = [(200 + k, "### ".join(prose(rng, 60, "qwxyz").split()), "en", "a") for k in range(30)]
    copies = [(300 + k, clean[k][1] + " ending", "en", None) for k in range(10)]
    leak = [(400, f"{clean[50][1][:200]} {ITEM} {clean[51][1][:200]}", "en", "b")]
    odd = [(500, None, "en", "a"), (501, "", "en", "a"), (None, clean[60][1], "en", "b"), clean[0]]
    labels = [(d, 1, 0) for d, *_ in clean[::2]] + [(d, 0, 0) for d, *_ in junk[::2]]
    rows = clean + junk + copies + leak + odd
    return write(spark, tmp_path_factory.mktemp("corpus"), rows, [(1, ITEM), (2, None)], labels), clean


def test_each_stage_takes_effect(spark, corpus):
    folder, clean = corpus
    docs, ids = table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == NAMES
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    every = {d for d, *_ in clean}
    assert len(ids["quality"] & every) >= 85 and not ids["quality"] & set(range(200, 230))
    assert ids["near_dedup"] & every == ids["quality"] & every and not ids["near_dedup"] & {300 + k for k in range(10) if k in ids["quality"]}
    assert 400 in ids["near_dedup"] and ids["decontaminate"] == ids["near_dedup"] - {400}
    words = mixing.mix(docs).count()
    assert words == docs.count()


def test_the_run_is_its_stages(spark, corpus):
    folder, _ = corpus
    got = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert len(got) > 80 and [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    encoder = token_files.WordEncoder(token_files.default_tokenizer())
    by = {d: t for d, t, *_ in corpus[1]}
    whole = {d: len(encoder.encode(t)) // 4 + 1 for d, t in by.items()}
    assert sum(r["n_tokens"] == whole.get(r["doc_id"]) for r in got) > 0.8 * len(got)


def test_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_nulls_alone(spark, tmp_path):
    folder = write(spark, tmp_path, [(None, None, None, None)] * 3, [(None, None)], [(None, None, None)])
    assert corpus_pipeline.run(spark, folder).collect() == []
