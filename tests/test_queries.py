"""Every registered table query against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest
from leafgrid.plans import tables
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    return con


def cell(v):
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return str(list(v)) if not hasattr(v, "tolist") else str(v.tolist())
    if pd.isna(v):
        return ""
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.6g}" if isinstance(v, int) else str(v)


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(tables.QUERIES))
def test_query(spark, duck, name):
    got, want = tables.QUERIES[name](spark, SF).toPandas(), duck.execute(tables.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_the_pairs_of_one_page_are_dealt_to_several_tasks(spark, tmp_path):
    line = "id as {0}key, cast(7 as int) {0}nationkey, (id * 37 % 1000) / 10D {0}acctbal"
    for name, mark, n in (("supplier", "s_supp", 2100), ("customer", "c_cust", 4200)):
        own = line.replace("{0}key", f"{mark}key").format(mark[:2])
        spark.range(n).selectExpr(*own.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    tasks = [n for (n,) in tables.cross_grid(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(tasks) == 2100 * 4200 and max(tasks) < 0.75 * sum(tasks)
