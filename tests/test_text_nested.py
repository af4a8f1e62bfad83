"""Golden micro-cases for text and nested functions (FIXTURES g1-g6, g22, g26)."""

import random

from pyspark.sql import functions as F

from graphweave.functions import nested as N
from graphweave.functions import text as T


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("v")).collect()[0]["v"]


def test_normalize_text_g5(spark):
    assert one(spark, T.normalize_text("s"), [("  A-B.c!\n d  ",)], "s string") == "abc  d"


def test_normalize_text_collapse(spark):
    assert one(spark, T.normalize_text("s", collapse=True), [("a  b\tc",)], "s string") == "a b c"


def test_strip_and_normalize_equal_python(spark):
    rnd = random.Random(3)
    pool = T.WS_CHARS + T.PUNCTUATION + "aZéß日\u200b\u00ad\n\n"
    assert sorted(T.WS_CHARS) == [chr(i) for i in range(0x110000) if chr(i).isspace()]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12))) for _ in range(400)] + ["", "\n", "a\n", " \n.a\n. \n"]
    df = spark.createDataFrame([(s,) for s in texts] + [(None,)], "s string").select("s", T.strip("s"), T.normalize_text("s"))
    for s, stripped, normal in df.collect():
        if s is None:
            assert stripped is None and normal is None
        else:
            bare = s.lower().translate(str.maketrans("", "", T.PUNCTUATION))
            assert (stripped, normal) == (s.strip(), bare.strip().replace("\n", " "))


def test_flatten_names_g4(spark):
    data = [([("B-b",), ("a",), ("A",), (None,)],)]
    v = one(spark, T.flatten_names("c"), data, "c array<struct<display_name:string>>")
    assert v == "a;bb"


def test_flatten_names_null_array(spark):
    assert one(spark, T.flatten_names("c"), [(None,)], "c array<struct<display_name:string>>") == ""


def test_category_and_doi(spark):
    assert one(spark, T.normalize_category("s"), [("  Machine--_Learning_ ",)], "s string") == "machine learning"
    assert one(spark, T.normalize_doi("s"), [(" 10.1/ABC ",)], "s string") == "10.1/abc"
    assert one(spark, T.normalize_doi("s"), [(None,)], "s string") == ""


def test_coerce_date(spark):
    rows = spark.createDataFrame([("2020-03-04",), ("2020-13-01",), ("n/a",), ("2020-03-04 10:00:00",)], "s string") \
        .select(T.coerce_date("s").alias("d")).collect()
    assert [r.d for r in rows] == ["2020-03-04", None, None, "2020-03-04"]


def test_split_set_n14(spark):
    v = one(spark, F.array_sort(T.split_set("s")), [("Deep Learning; AI, ,ai;",)], "s string")
    assert v == ["ai", "deep learning"]


def test_long_tokens(spark):
    assert one(spark, T.long_tokens("s"), [("quantum ai robotics",)], "s string") == ["quantum", "robotics"]


def test_inverted_index_g1_g2(spark):
    df = spark.sql("select map('deep', array(1,3), 'The', array(0), 'model', array(2), 'x', array(7,3)) m "
                   "union all select cast(null as map<string,array<int>>)")
    got = [r.t for r in df.select(N.text_from_inverted_index("m").alias("t")).collect()]
    assert got == ["The deep model x x", None]


def test_institutions_g3(spark):
    schema = ("a array<struct<author_position:string, author:struct<display_name:string,orcid:string>, "
              "institutions:array<struct<id:string,display_name:string,ror:string,country_code:string,type:string,"
              "lineage:array<string>>>>>")
    inst = lambda i, n: (i, n, None, None, None, ["x"])
    data = [([("first", ("p", None), [inst("i1", "A"), inst("i2", "C")]),
              ("last", ("q", None), [inst("i1", "B")])],)]
    v = one(spark, N.paper_institutions("a"), data, schema)
    assert [(x["id"], x["display_name"]) for x in v] == [("i1", "B"), ("i2", "C")]
    assert "lineage" not in v[0].asDict()


def test_first_location_g22(spark):
    schema = "l array<struct<location_type:string,value:string>>"
    assert one(spark, N.first_location("l"), [([("country", "C"), ("region", "R")],)], schema) == "R"
    assert one(spark, N.first_location("l"), [([("country", "C"), ("city", "")],)], schema) == "C"
    assert one(spark, N.first_location("l"), [(None,)], schema) == ""


def test_parse_reply_g26(spark):
    df = spark.createDataFrame([('["a","b"]',), ("oops",), ("I don't know",), (None,)], "s string")
    got = [r.v for r in df.select(N.parse_reply_array("s").alias("v")).collect()]
    assert got == [["a", "b"], [], [], []]


def test_struct_or_text(spark):
    df = spark.createDataFrame([('{"value": "2020-01-02"}',), ("2021-05-06 ",), (None,)], "s string")
    assert [r.v for r in df.select(N.struct_or_text_value("s").alias("v")).collect()] == \
        ["2020-01-02", "2021-05-06", ""]
