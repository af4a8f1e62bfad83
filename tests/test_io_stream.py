"""Readers, sinks and the streaming cleaner on tiny files."""

import glob
import json
import os
import tempfile

from graphweave.sources import readers, sinks
from graphweave.streaming import paper_stream

PAPER = {"id": "W1", "doi": "https://doi.org/10.1/x", "title": "Deep Model", "publication_date": "2021-01-02",
         "cited_by_count": 5,
         "authorships": [{"author_position": "first", "author": {"display_name": "Ann", "orcid": None},
                          "institutions": [{"id": "i1", "display_name": "A", "lineage": ["x"]}]},
                         {"author_position": "last", "author": {"display_name": "Bob", "orcid": "o"},
                          "institutions": [{"id": "i1", "display_name": "B"}, {"id": "i2", "display_name": "C"}]}],
         "keywords": [{"id": "k", "display_name": "AI", "score": 0.5}],
         "topics": [{"display_name": "T", "score": 0.9, "subfield": {"id": "s1", "display_name": "S"},
                     "field": {"id": "f1", "display_name": "F"}, "domain": None}],
         "abstract_inverted_index": {"deep": [1, 3], "The": [0], "model": [2], "x": [7, 3]}}


def test_jsonl_and_clean(spark):
    d = tempfile.mkdtemp(prefix="gw-io-")
    with open(os.path.join(d, "p.jsonl"), "w") as fh:
        fh.write(json.dumps(PAPER) + "\n\n" + json.dumps({**PAPER, "id": "W2", "abstract_inverted_index": None}) + "\n")
    raw = readers.read_papers(spark, d)
    out = {r.id: r for r in paper_stream.clean_papers(raw).collect()}
    assert out["W1"].abstract == "The deep model x x"
    assert out["W2"].abstract is None
    assert [(i.id, i.display_name) for i in out["W1"].institutions] == [("i1", "B"), ("i2", "C")]
    assert [a.display_name for a in out["W1"].authorships] == ["Ann", "Bob"]
    assert [s.id for s in out["W1"].subfields] == ["s1"] and out["W1"].domains == []


def test_stream_once(spark):
    src = tempfile.mkdtemp(prefix="gw-src-")
    dst = tempfile.mkdtemp(prefix="gw-dst-")
    ck = tempfile.mkdtemp(prefix="gw-ck-")
    with open(os.path.join(src, "a.jsonl"), "w") as fh:
        fh.write(json.dumps(PAPER) + "\n")
    q = paper_stream.start_cleaning_stream(spark, src, dst, ck, trigger_once=True)
    q.awaitTermination(120)
    rows = spark.read.json(dst).collect()
    assert [r.abstract for r in rows] == ["The deep model x x"]


def test_csv_empty_header_and_blank_zero(spark):
    d = tempfile.mkdtemp(prefix="gw-csv-")
    empty = spark.createDataFrame([], "paper_id string, technology_name string")
    sinks.write_csv(empty, os.path.join(d, "e"))
    text = "".join(open(f).read() for f in glob.glob(os.path.join(d, "e", "part-*")))
    assert text.startswith("paper_id,technology_name")
    df = spark.createDataFrame([("c1", 0.0), ("c2", 5.0)], "company_id string, funding double")
    sinks.write_csv(df, os.path.join(d, "f"), blank_zero=["funding"])
    back = readers.read_csv(spark, os.path.join(d, "f"), "company_id string, funding string").collect()
    assert sorted((r.company_id, r.funding) for r in back) == [("c1", None), ("c2", "5.0")]


def test_definitions_file(spark):
    d = tempfile.mkdtemp(prefix="gw-def-")
    p = os.path.join(d, "defs.json")
    with open(p, "w") as fh:
        json.dump([{"Technology Name": "AI", "Definition": "d", "Synonyms": ["a", "b"],
                    "Top Domain Keywords": "I don't know"}], fh, indent=2)
    r = readers.read_technology_definitions(spark, p).collect()[0]
    assert (r.technology_name, r.synonyms, r.keywords) == ("AI", ["a", "b"], [])
