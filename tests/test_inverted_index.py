"""Inverted index and back: documents without words or without a text."""

import duckdb

from graphweave.functions import nested as N
from graphweave.plans.catalog import ORACLE, QUERIES

ROWS = [(1, "a b a  c"), (2, None), (3, ""), (4, " \n\t "), (5, "one"), (6, None), (None, "x x")]


def test_roundtrip_with_missing_and_blank_texts(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(ROWS, "doc_id long, text string").write.parquet(path)
    got = [tuple(r) for r in QUERIES["inverted_index_roundtrip"](spark, str(tmp_path)).collect()]
    sql = ORACLE["inverted_index_roundtrip"].replace("FROM documents", f"FROM '{path}/*.parquet'")
    want = duckdb.connect().execute(sql).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(n is None for _, n, _ in got) == 2 and sum(n == 0 for _, n, _ in got) == 2


def test_index_of_no_tokens(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None)], "id long, toks array<string>")
    got = {r.id: r.idx for r in N.with_inverted_index(df, "toks", "idx").collect()}
    assert got == {1: {"a": [1], "b": [0, 2]}, 2: {}, 3: None}
