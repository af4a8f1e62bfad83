"""Smoke test of the whole job composed end to end on tiny typed inputs."""

from graphweave import schemas
from graphweave.plans import graph_build


def test_build_end_to_end(spark):
    papers = [
        ("W1", "https://doi.org/10.1/a", "Quantum computing for chemistry", "2021-01-02", 10,
         [("first", ("Ann", None), [("i1", "Inst A", None, None, None, None)])],
         [("k1", "Quantum Computing", 0.9)], [("Physics", 0.8, ("s1", "Sub"), ("f1", "Field"), ("d1", "Dom"))],
         {"quantum": [0], "computing": [1]}),
        ("W2", None, "Deep learning for robots", "2022-03-04", 5, [], [], [], {"robots": [0]}),
        ("W3", None, "Deep learnin for robots", "2022-03-05", 1, [], [], [], None),
    ]
    raw_papers = spark.createDataFrame(papers, schemas.RAW_PAPER)
    comps = [((("acme", "Acme Quantum"), None, "We build quantum computers", None, None,
               [("u", "Berlin", "city")], (1.0,), (2.0,), "2021-01-01", "seed", [], [("quantum-computing",)]),)]
    raw_companies = spark.createDataFrame(comps, schemas.RAW_COMPANY)
    techs = spark.createDataFrame(
        [(1, 1, "Quantum Computing", "computing with qubits", ["qc"], ["qubits"]),
         (2, 2, "Robotics", "machines that act", [], ["robots"])],
        "tech_id long, tech_pos long, technology_name string, definition string, "
        "synonyms array<string>, keywords array<string>")
    emb = lambda rows: spark.createDataFrame(rows, "id string, embedding array<float>")
    paper_emb = emb([("W1", [1.0, 0.0]), ("W2", [0.0, 1.0]), ("W3", [0.0, 1.0])])
    company_emb = emb([("acme", [1.0, 0.1])])
    tech_emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "tech_id long, embedding array<float>")
    out = graph_build.build(raw_papers, raw_companies, techs, paper_emb, company_emb, tech_emb)
    links = {(r.paper_id, r.technology_name) for r in out.paper_links.collect()}
    assert ("W1", "Quantum Computing") in links
    assert ("W2", "Robotics") in links
    # W3 is a fuzzy duplicate of W2 (no DOI) and is dropped before linking
    assert not any(p == "W3" for p, _ in links)
    comp_links = {(r.company_id, r.technology_name) for r in out.company_links.collect()}
    assert ("acme", "Quantum Computing") in comp_links
    assert out.company_paper_links.filter("company_id = 'acme' and paper_id = 'W1'").count() == 1
    assert out.paper_nodes.count() == 3 and out.company_nodes.count() == 1 and out.technology_nodes.count() == 2
