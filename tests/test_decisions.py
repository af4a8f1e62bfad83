"""Golden cases of the composed job and of paths that sizes choose."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from graphweave.functions import fuzzy as fz
from graphweave.operators import cluster, dedupe, linking, similarity
from graphweave.operators import phrases as phrases_
from graphweave.plans import graph_build
from graphweave.sources import readers


def test_name_boost_links_a_pair_of_negative_cosine(spark):
    ents = spark.createDataFrame([("acme", [1.0, 0.0], "Acme Quantum Ltd")], "company_id string, v array<double>, company_name string")
    techs = spark.createDataFrame([(1, [-0.005, 1.0], "Quantum"), (2, [-1.0, 0.0], "Robotics")], "tech_id long, v array<double>, tech_name string")
    named = linking.boost_pairs(ents, "company_id", "company_name", techs, "tech_id", "tech_name")
    emb = similarity.gated_cosine(ents, techs.withColumnRenamed("v", "w"), named, "company_id", "v", "tech_id", "w",
                                  graph_build.COMPANY_GATES["low"]).withColumnRenamed("score", "emb")
    got = {r["tech_id"]: r["emb"] for r in emb.collect()}
    assert set(got) == {1} and got[1] < 0
    tf = spark.createDataFrame([], "company_id string, tech_id long, tfidf double")
    links = linking.link_companies(emb, ents.withColumn("text", F.lit("x")), techs.withColumn("description", F.col("tech_name")),
                                   tf, None, **graph_build.COMPANY_GATES)
    assert [r["technology_name"] for r in links.collect()] == ["Quantum"]


def test_keyword_share_counts_the_name(spark):
    techs = spark.createDataFrame([("Alpha Tech", [], ["k1", "q2"])], "technology_name string, synonyms array<string>, keywords array<string>")
    sets = techs.select("technology_name", graph_build.keyword_set(F.col("technology_name"), F.col("synonyms"), F.col("keywords")).alias("keywords"))
    comps = spark.createDataFrame([("c", ["k1"])], "company_id string, categories array<string>")
    assert linking.category_direct(comps, sets).count() == 0  # 1 of 3 is under 0.40
    assert linking.category_direct(comps, techs.select("technology_name", "keywords")).count() == 1


def test_repeated_ids_are_deduplicated(spark):
    names = "array<struct<display_name:string>>"
    rows = [("W1", "10.1/a", "One"), ("W1", "10.1/a", "One"), ("W2", None, "Two title"), ("W2", None, "Two title"), ("W3", None, "Two titel")]
    clean = spark.createDataFrame(rows, "id string, doi string, title string").withColumns(
        {"publication_date": F.lit("2021-01-01"), "abstract": F.lit(""),
         **{c: F.array().cast(names) for c in ("keywords", "topics", "subfields", "fields")}})
    out = graph_build.normalize_papers(clean.coalesce(1))
    assert sorted(r["id"] for r in out.collect()) == ["W1", "W2"]


def test_null_and_zero_vectors(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id long, v array<double>")
    t = spark.createDataFrame([(7, [1.0, 1.0]), (8, None)], "tid long, w array<double>")
    got = {(r["id"], r["tid"]): round(r["score"], 6) for r in similarity.cosine_scores(e, t, "id", "v", "tid", "w").collect()}
    assert got == {(1, 7): 0.707107, (3, 7): 0.0}


def test_cosine_blocks_equal_one_block(spark):
    rnd = random.Random(1)
    vec = lambda: [rnd.gauss(0, 1) for _ in range(6)]
    e = spark.createDataFrame([(i, vec()) for i in range(50)], "id long, v array<double>")
    t = spark.createDataFrame([(i, vec()) for i in range(30)], "tid long, w array<double>")
    one = {(r[0], r[1]): round(r[2], 9) for r in similarity.cosine_scores(e, t, "id", "v", "tid", "w", 0.1).collect()}
    many = {(r[0], r[1]): round(r[2], 9) for r in similarity.cosine_scores(e, t, "id", "v", "tid", "w", 0.1, block=7).collect()}
    pairs = e.crossJoin(t).select("id", "tid")
    named = {(r[0], r[1]): round(r[2], 9) for r in similarity.cosine_pairs(pairs, e, t, "id", "v", "tid", "w").collect()}
    assert one == many == {k: v for k, v in named.items() if v >= 0.1}


@pytest.mark.parametrize("t", [60, 70, 75, 85, 90])
def test_similar_strings_equal_brute_force(spark, t):
    rnd = random.Random(t)
    words = ["alpha", "beta", "gam", "delta", "om", "s", "zeta"]
    strs = {" ".join(rnd.sample(words, rnd.randint(1, 4))) for _ in range(40)}
    for s in list(strs):
        cut = list(s)
        for _ in range(rnd.randint(0, 4)):
            cut[rnd.randrange(len(cut))] = rnd.choice("abcx ")
        strs.add("".join(cut).strip() or "a")
    strs |= {"a", "b", "ab", "abc", "éa", "ab c"}
    got = {(r["sa"], r["sb"]) for r in dedupe.similar_strings(spark.createDataFrame([(s,) for s in strs] * 2, "s string"), "s", t).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(strs), 2) if 200 * fz.lcs_len(a, b) >= t * (len(a) + len(b))}
    assert got == want


def test_similar_strings_of_lengths_that_need_fewer_grams_than_shorter_ones(spark):
    # the two-grams of the first two meet at the fourth rarest only: 13 letters need four common ones, 14 letters three
    strs = ["om beta", "ombzeta", "omxbeta", *(f"{g}{i}" for i in "pqrsuvwxyz" for g in ("om", "et", "ta", "eta"))]
    got = {(r[0], r[1]) for r in dedupe.similar_strings(spark.createDataFrame([(s,) for s in strs], "s string"), "s", 85).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(strs), 2) if 200 * fz.lcs_len(a, b) >= 85 * (len(a) + len(b))}
    assert ("om beta", "ombzeta") in want and got == want


@pytest.mark.parametrize("rows", [0, 1000])
def test_phrase_and_partial_paths_agree(spark, monkeypatch, rows):
    rnd = random.Random(4)
    words = ["solar", "panel", "battery", "ion", "cell", "graph", "x"]
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))).replace("e", rnd.choice("ee3"))) for i in range(60)]
    phrases = [(100 + i, " ".join(rnd.sample(words, rnd.randint(1, 3)))) for i in range(25)] + [(999, "")]
    e, p = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(phrases, "pid long, p string")
    monkeypatch.setattr(phrases_, "BLOCK_MAX_ROWS", rows)
    monkeypatch.setattr(phrases_, "CELL_BYTES", 500)
    hits = {(r[0], r[1]) for r in linking.phrase_matches(e, "id", "t", p, "pid", "p").distinct().collect()}
    assert hits == {(i, j) for i, t in texts for j, q in phrases if q and q in t}
    part = {(r[0], r[1]) for r in linking.partial_matches(e, "id", "t", p, "pid", "p", 70).collect()}
    assert part == {(i, j) for i, t in texts for j, q in phrases if q and q not in t and fz.partial_ratio(q, t) >= 70}


def _condensed_leaves(points):
    """Leaf clusters of a single-linkage tree with minimum size two, built merge by merge."""
    n = len(points)
    edges = sorted((round(sum((a - b) ** 2 for a, b in zip(points[i], points[j], strict=True)) ** 0.5, 9), i, j)
                   for i, j in itertools.combinations(range(n), 2))
    node = {i: ("point", i, 0.0) for i in range(n)}
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for d, i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            node[a] = ("merge", node[a], node[b], d)
            root[b] = a
    size = lambda t: 1 if t[0] == "point" else size(t[1]) + size(t[2])
    members = lambda t: [t[1]] if t[0] == "point" else members(t[1]) + members(t[2])
    out = []

    def walk(t, top):
        """Follow a cluster down: single points fall out, a real split makes two clusters."""
        if t[0] == "point":
            return
        big = [x for x in (t[1], t[2]) if size(x) >= 2]
        if len(big) == 2:
            walk(t[1], False)
            walk(t[2], False)
        elif not top and (len(big) == 0 or not splits(t)):
            out.append(sorted(members(t)))
        else:
            for x in big:
                walk(x, top)
    def splits(t):
        if t[0] == "point":
            return False
        big = [x for x in (t[1], t[2]) if size(x) >= 2]
        return len(big) == 2 or any(splits(x) for x in big)
    walk(node[find(0)], True)
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_leaf_clusters_equal_a_condensed_tree(spark, seed):
    rnd = random.Random(seed)
    pts = [[rnd.random() for _ in range(3)] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(pts)), "id long, v array<double>")
    got = {}
    for r in cluster.leaf_clusters(df, "id", "v").collect():
        if r["cluster_id"] >= 0:
            got.setdefault(r["cluster_id"], []).append(r["id"])
    assert sorted(sorted(x) for x in got.values()) == _condensed_leaves(pts)


def test_graph_tables_and_definitions_from_csv(spark, tmp_path):
    (tmp_path / "nodes.csv").write_text('paper_id,title\nW1,"a, b"\nW2,\n')
    got = [tuple(r) for r in readers.read_graph_table(spark, str(tmp_path / "nodes.csv"), ["paper_id", "title"]).collect()]
    assert sorted(got) == [("W1", "a, b"), ("W2", "")]
    (tmp_path / "techs.csv").write_text("anything\nQuantum\nRobotics\n")
    (tmp_path / "defs.csv").write_text("technology_name,definition,synonyms,keywords\nQuantum,qubits,\"['qc', 'q']\",[]\n")
    (tmp_path / "papers.csv").write_text("id\n")
    _, techs = readers.load_linking_inputs(spark, str(tmp_path / "papers.csv"), str(tmp_path / "techs.csv"), str(tmp_path / "defs.csv"))
    rows = {r["technology_name"]: r for r in techs.collect()}
    assert rows["Quantum"]["synonyms"] == ["qc", "q"] and rows["Robotics"]["definition"] == ""
    with pytest.raises(FileNotFoundError):
        readers.read_companies(spark, str(tmp_path / "none.json"))


def test_embedding_hook(spark):
    from graphweave.operators import embed
    df = spark.createDataFrame([(1, "solar panel"), (2, "panel solar"), (3, None), (4, "graph")], "id long, t string")
    v = {r["id"]: list(r["embedding"]) for r in embed.embed(df, "id", "t").collect()}
    assert v[1] == v[2] != v[4] and not any(v[3]) and abs(sum(x * x for x in v[1]) - 1) < 1e-6
    own = {r["id"]: list(r["embedding"]) for r in embed.embed(df, "id", "t", lambda ts: __import__("numpy").array(
        [[len(t), 0.0] for t in ts])).collect()}
    assert own[4] == [1.0, 0.0]


@pytest.mark.parametrize("threshold", [0.05, 0.35, 0.7, 0.999])
def test_tfidf_above_a_threshold_equals_all_pairs_filtered(spark, threshold):
    rnd = random.Random(3)
    words = [f"w{min(int(rnd.expovariate(0.15)), 60)}" for _ in range(3000)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    ents = [(f"e{i}", say(rnd.randint(0, 40))) for i in range(60)] + [("null", None), ("none", "a b c")]
    techs = [(i, say(rnd.randint(1, 12))) for i in range(25)] + [(99, ents[0][1]), (98, ents[1][1] + " w1")]
    e, t = spark.createDataFrame(ents, "entity_id string, text string"), spark.createDataFrame(techs, "tech_id long, text string")
    every = {(r[0], r[1]): round(r[2], 9) for r in similarity.tfidf_similarity(e, t, max_features=300).collect()}
    some = {(r[0], r[1]): round(r[2], 9) for r in similarity.tfidf_similarity(e, t, max_features=300, threshold=threshold).collect()}
    assert some == {k: v for k, v in every.items() if v >= threshold} and (some or threshold > 0.9)
