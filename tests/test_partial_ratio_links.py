"""Whole passages against whole documents, on a small fixture."""

import __spark_entry__ as E


def test_passages_inside_documents_are_linked(spark, tmp_path):
    passage = "Quite a long passage, whose words occur nowhere else in these tables. It has two sentences."
    near = passage.replace("nowhere", "noware")
    other = "zzz yyy xxx " * 20
    spark.createDataFrame([(1, f"{other} {passage} {other}"), (2, f"{other} {near} {other}"), (3, other), (4, other)],
                          "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, "zzz yyy")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {tuple(r) for r in E.queries()["partial_ratio_links"](spark, str(tmp_path)).collect()}
    assert got == {(1, passage), (2, passage), (3, "quality"), (3, "toxic")}
