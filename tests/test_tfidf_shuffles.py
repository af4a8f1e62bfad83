"""TF-IDF against technologies that fit a broadcast: documents are dealt once, pairs not at all."""

import random

import pytest

from graphweave.operators import similarity


def tables(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    d = [(i, " ".join(r.choices(words, k=r.randint(0, 30)))) for i in range(60)] + [(7, "w1 w2 w3"), (70, None)]
    t = [(i, " ".join(r.choices(words, k=r.randint(1, 8)))) for i in range(12)]
    return (spark.createDataFrame(d, "entity_id long, text string"), spark.createDataFrame(t, "tech_id long, text string"))


@pytest.mark.parametrize("threshold", [None, 0.2, 0.35])
def test_broadcast_and_shuffled_technologies_agree(spark, monkeypatch, threshold):
    d, t = tables(spark)

    def rows():
        return {(r["entity_id"], r["tech_id"]): round(r["tfidf"], 9)
                for r in similarity.tfidf_similarity(d, t, threshold=threshold).collect()}
    near = rows()
    monkeypatch.setattr(similarity, "fits_broadcast", lambda *_: False)
    assert near and near == rows()


@pytest.mark.parametrize("threshold", [None, 0.35])
def test_pairs_are_not_shuffled(spark, threshold):
    d, t = tables(spark)
    plan = similarity.tfidf_similarity(d, t, threshold=threshold)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("BroadcastHashJoin")]
    assert "Exchange hashpartitioning" not in above
    # the documents' terms; with a threshold also the few weighted technologies, for their prefixes
    assert plan.count("Exchange hashpartitioning(side") == (1 if threshold is None else 2)


def test_counts_equal_the_ngram_terms(spark, monkeypatch):
    """Terms counted in Arrow batches of a few rows are those of the expression; repeated, empty and missing texts too."""
    from collections import Counter
    monkeypatch.setattr(similarity, "COUNT_ROWS", 3)
    r = random.Random(6)
    words = ["solar", "the", "of", "Éa", "x", "日本語", "a_b", "cell-cell", "grid\n"]
    texts = [" ".join(r.choices(words, k=r.randint(0, 12))) for _ in range(20)] + [None, "", "the", "solar solar solar"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    want = {x["id"]: Counter(x["terms"]) for x in similarity.with_ngram_terms(df, "text").collect()}
    got = {x["id"]: [(y["term"], y["tf"]) for y in x["tf"]] for x in similarity.term_counts(df, "text").collect()}
    assert {k: dict(v) for k, v in got.items()} == want
    assert all(v == sorted(v, key=lambda y: y[0].encode()) for v in got.values())


def test_a_term_travels_as_one_number(spark):
    d, t = tables(spark)
    plan = similarity.tfidf_similarity(d, t)._jdf.queryExecution().executedPlan().toString()
    dealt = plan[plan.index("Exchange hashpartitioning(side"):]
    assert "collect_list(x" in dealt.split("Exchange", 2)[1]


def test_keywords_are_formed_once(spark):
    """No filter on the exploded array's size under the explode; empty and missing arrays give no pair."""
    e = spark.createDataFrame([(1, "a;b;a"), (2, ""), (3, None), (4, "c")], "entity_id long, k string").selectExpr("entity_id", "split(k, ';') AS keywords")
    t = spark.createDataFrame([(7, ["b", "a"]), (8, []), (9, None)], "tech_id long, keywords array<string>")
    out = similarity.keyword_overlap(e, t, "entity_id", "tech_id")
    assert {tuple(r) for r in out.collect()} == {(1, 7)}
    assert "size(" not in out._jdf.queryExecution().optimizedPlan().toString()
