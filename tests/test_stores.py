"""Versioned partitions, the enrichment memo, stored embeddings and JSON arrays."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphweave.operators import enrich
from graphweave.sources import embedding_store, readers, sinks
from graphweave.sources.versioned import PartitionStore


def test_a_repeated_year_replaces_itself_and_versions_stay(spark, tmp_path):
    df = lambda rows: spark.createDataFrame(rows, "id long, year int")
    store = PartitionStore(spark, str(tmp_path / "papers"), "year")
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.put(df([(1, 2019), (2, 2020), (3, None)])) == 1
    assert store.put(df([(4, 2021)])) == 2
    assert store.put(df([(5, 2020), (6, 2020)])) == 3
    got = lambda v=None: sorted((r["id"], r["year"]) for r in store.read(v).collect())
    assert got() == [(1, 2019), (3, None), (4, 2021), (5, 2020), (6, 2020)]
    assert got(1) == [(1, 2019), (2, 2020), (3, None)]
    assert store.put(df([(7, None)])) == 4 and (3, None) not in got() and (7, None) in got()
    # data without a manifest, or with an unfinished one, is not seen
    os.makedirs(tmp_path / "papers/manifest/v=9")
    df([(99, 2019)]).write.partitionBy("year").parquet(str(tmp_path / "papers/data/lost"))
    assert store.last_version() == 4 and all(i != 99 for i, _ in got())
    assert {r["value"]: r["rows"] for r in store.manifest().collect()} == {"2019": 1, "2020": 2, "2021": 1, None: 1}


def test_memo_asks_once_per_key_and_again_after_a_failure(spark, tmp_path):
    asked, memo = tmp_path / "asked", str(tmp_path / "memo")
    asked.mkdir()

    def fetch(names):
        for n in names["technology_name"]:
            with open(asked / n.replace(" ", "_"), "a") as f:
                f.write("x")
        if "Broken" in set(names["technology_name"]):
            raise OSError("no service")
        return names.assign(definition="d " + names["technology_name"], synonyms_reply='["s"]', keywords_reply="I don't know")

    def calls():
        return {p.name: len(p.read_text()) for p in asked.iterdir()}
    df = lambda names: spark.createDataFrame([(n, i) for i, n in enumerate(names)], "technology_name string, pos int")
    one = enrich.enrich_memo(df(["Solar cell", "solar CELL", "Ion trap", None]), memo, fetch, retries=1, batch=1)
    rows = {r["technology_name"]: r for r in one.collect()}
    assert len(rows) == 4 and rows["Solar cell"]["definition"] == rows["solar CELL"]["definition"] == "d Solar cell"
    assert rows["Ion trap"]["synonyms"] == ["s"] and rows["Ion trap"]["keywords"] == [] and rows[None]["definition"] == ""
    two = enrich.enrich_memo(df(["Ion trap", "Graph", "Broken", "Solar cell"]), memo, fetch, retries=1, batch=1)
    rows = {r["technology_name"]: r for r in two.collect()}
    assert rows["Graph"]["definition"] == "d Graph" and rows["Broken"]["definition"] == "" and rows["Solar cell"]["pos"] == 3
    assert calls() == {"Solar_cell": 1, "Ion_trap": 1, "Graph": 1, "Broken": 2}
    enrich.enrich_memo(df(["Broken", "Graph"]), memo, fetch, retries=0, batch=1).collect()
    assert calls() == {"Solar_cell": 1, "Ion_trap": 1, "Graph": 1, "Broken": 3}


def test_enrich_with_the_hook(spark):
    techs = spark.createDataFrame([("A", 1), ("B", 2)], "technology_name string, pos int")
    out = enrich.enrich_with(techs, lambda b: b.assign(definition="d", synonyms_reply="[]", keywords_reply='["k"]'))
    assert sorted((r["technology_name"], r["pos"], r["definition"], tuple(r["keywords"])) for r in out.collect()) == [
        ("A", 1, "d", ("k",)), ("B", 2, "d", ("k",))]


def test_embeddings_come_back_as_written(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).astype("float32").tolist()) for i in range(20)] + [(90, [0.0] * 5), (91, None), (92, [1.0, None]), (93, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    path = str(tmp_path / "e")
    embedding_store.write_embeddings(df, path, "id", "v", "m1")
    embedding_store.write_embeddings(df.limit(1), path, "id", "v", "m2")
    held = embedding_store.read_embeddings(spark, path, "m1")
    back = {r["id"]: list(r["embedding"]) for r in embedding_store.vectors(held).collect()}
    assert back == {i: v for i, v in rows if i not in (91, 92)}
    assert {r["id"]: r["norm"] for r in held.collect()}[93] == 5.0 and embedding_store.read_embeddings(spark, path, "m2").count() == 1
    pairs = spark.createDataFrame([(0, 1), (0, 90), (0, 93), (0, 91), (3, 3)], "a long, b long")
    got = {(r["a"], r["b"]): r["score"] for r in embedding_store.cosines(pairs, held, held, "a", "b").collect()}
    x, y = np.array(rows[0][1]), np.array(rows[1][1])
    assert got.keys() == {(0, 1), (0, 90), (3, 3)} and got[0, 90] == 0 and abs(got[3, 3] - 1) < 1e-12
    assert abs(got[0, 1] - x @ y / np.linalg.norm(x) / np.linalg.norm(y)) < 1e-12


@pytest.mark.parametrize("n", [0, 1, 2, 25_000])
def test_json_arrays(spark, tmp_path, n):
    df = spark.range(n).select("id", F.concat(F.lit('a "q"\n'), F.col("id").cast("string")).alias("t"),
                               F.when(F.col("id") % 2 == 0, F.lit("x")).alias("maybe")).repartition(2)
    path = str(tmp_path / "a")
    sinks.write_json_array(df, path)
    records = [r for p in os.listdir(path) if p.startswith("part-")
               and os.path.getsize(os.path.join(path, p)) for r in json.load(open(os.path.join(path, p)))]
    assert sorted(r["id"] for r in records) == list(range(n)) and all("maybe" in r for r in records)
    back = readers.read_json(spark, path, df.schema, lines=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) if n < 100 else back.count() == n
