"""The linking decisions on whole documents (their SQL forms are compared in ``test_queries``)."""

import duckdb

import __spark_entry__ as E
from graphweave.plans import sqltext as S

SF = "/root/testdata/sf0.001"


def test_decisions_read_whole_documents_and_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    passages = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    cascade = {r["paper_id"]: r for r in E.queries()["cascade_label_documents"](spark, SF).collect()}
    assert set(cascade) == {d["doc_id"] for d in docs}
    inside = {d["doc_id"] for d in docs if any(p in (d["text"] or "") for p in passages.values())}
    assert inside and all(cascade[i]["match_type"] == "field_exact" for i in inside)
    assert {r["predicted_technology"] for r in cascade.values()} <= {*passages.values(), ""}
    multi = {r["entity_id"]: r["predicted_technology"] for r in
             E.queries()["multi_signal_labels_documents"](spark, SF).collect()}
    assert set(multi) == set(cascade) and any(multi.values())


def test_long_lcs_in_sql():
    a, b = "abcde fgh" * 30, "xbcd fgy" * 41
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    con = duckdb.connect()
    got = con.execute(f"SELECT {S.lcs_long('a', 'b')}, {S.lcs_long('a', 'e')} FROM (SELECT ? AS a, ? AS b, '' AS e)", [a, b]).fetchall()
    assert got == [(row[-1], 0)]
