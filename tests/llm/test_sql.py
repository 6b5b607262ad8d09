"""The SQL of the queries that have one, on rows with nulls, ties, repeats and slots."""

import random

import duckdb
import pandas as pd
import pytest
from leafgrid.llm.queries import ORACLE_SQL, QUERIES

from .test_decontamination import ITEM
from .test_secrets import TEXTS


def cell(v):
    if v is None or v is pd.NA or v != v:
        return ""
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def folder(spark, hard_rows, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = hard_rows + [(d_, t, "en", s) for d_, t, s in TEXTS]
    docs += [(700 + k, ITEM.replace("12", str(k)).replace("5 apples", f"{k * k} kg"), "en", "a") for k in range(4)] + [(710, ITEM.replace("12", "40", 1), "en", None)]
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    items = [(1, ITEM), (2, hard_rows[5][1]), (None, ITEM), (3, None), (4, "what is this"), (5, "in 3 kg of 4 m by 5 s at 6 h")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rng = random.Random(1)
    turns = [(k // 3, rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b\nc", None, "é\U0001f600"])) for k in range(120)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_agrees(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    got, want = QUERIES[name](spark, folder).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and rows(got) == rows(want)
