import glob
import os

import duckdb
import pytest

from shiftledger.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, name):
    base = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        base.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", ["op3_simhash", "op5_quality", "op7_suffix_dedup", "op8_html", "op9_toxicity", "op10_language"])
def test_one_row_per_input(spark, sf_dir, name):
    table, key = ("pages", "page_id") if name == "op8_html" else ("documents", "doc_id")
    ids = [r[0] for r in QUERIES[name](spark, sf_dir).select(key).collect()]
    there = [r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()]
    assert sorted(ids) == sorted(there)
