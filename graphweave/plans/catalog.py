"""Registered queries on the driver tables and their SQL oracles.

Each query runs one or more operators of the library over the *whole* driver
tables (see ``proxies`` for how the tables stand in for papers, technologies
and companies).  ``ORACLE`` holds, per query, an independent DuckDB SQL
formulation of the same rule; queries that SQL cannot express within reason
(partial-ratio links) have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import text as T
from ..functions.fuzzy import with_token_set_ratio
from ..operators import cluster, dedupe, enrich, graph, harvest, linking, project, similarity
from ..operators.common import scratch_path
from ..sources import embedding_store, readers, sinks
from ..sources.readers import read_list_text
from ..sources.versioned import PartitionStore
from . import graph_build
from . import sqltext as S
from .proxies import part_name_techs, supplier_categories, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


R6 = 6


# --------------------------------------------------------------- bridge join
@register("bridge_join", """
WITH c AS (SELECT DISTINCT o.o_custkey AS company_id, CAST(l.l_partkey AS VARCHAR) AS technology_name
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
     p AS (SELECT DISTINCT l_suppkey AS paper_id, CAST(l_partkey AS VARCHAR) AS technology_name FROM lineitem)
SELECT c.company_id, p.paper_id, min(c.technology_name) AS technology_name
FROM c JOIN p ON c.technology_name = p.technology_name GROUP BY c.company_id, p.paper_id
""")
def bridge_join(spark: SparkSession, sf: str) -> DataFrame:
    """Company <-> paper links through shared technologies (customers and
    suppliers linked through the parts they buy / supply)."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    comp = (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("company_id"), F.col("l_partkey").cast("string").alias("technology_name")))
    pap = li.select(F.col("l_suppkey").alias("paper_id"), F.col("l_partkey").cast("string").alias("technology_name"))
    return linking.company_paper_links(comp, pap)


# ------------------------------------------------------------- top-k per year
@register("topk_per_year", """
SELECT year, rank, o_orderkey, o_totalprice FROM (
  SELECT year(o_orderdate) AS year, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders WHERE o_orderstatus <> 'P') WHERE rank <= 1000
""")
def topk_per_year(spark: SparkSession, sf: str) -> DataFrame:
    """The 1,000 largest orders per year among those with status other than 'P'
    (the "has an abstract" filter of the harvest)."""
    o = table(spark, sf, "orders")
    out = harvest.top_works_per_year(o, F.year("o_orderdate"), "o_totalprice", "o_orderkey",
                                     F.col("o_orderstatus") != "P", k=1000)
    return out.select("year", "rank", "o_orderkey", "o_totalprice")


# ------------------------------------------------------------ company search
@register("company_search", """
SELECT o.o_orderkey, o.o_custkey, strftime(o.o_orderdate, '%Y-%m-%d') AS founded, o.o_totalprice
FROM orders o
WHERE o.o_orderdate >= DATE '1996-01-01' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND o.o_custkey IN (SELECT c.c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                      JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'EUROPE')
ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT 800
""")
def company_search(spark: SparkSession, sf: str) -> DataFrame:
    """Founded on/after a date, in three stages, located in a region, top 800 by value."""
    o = table(spark, sf, "orders")
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    europe = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
              .filter(F.col("r_name") == "EUROPE").select(F.col("c_custkey").alias("o_custkey")))
    located = o.join(europe, "o_custkey", "left_semi")
    top = harvest.company_search(located, F.col("o_orderdate"), "1996-01-01", F.col("o_orderpriority"),
                                 ["1-URGENT", "2-HIGH", "3-MEDIUM"], F.lit(True), F.col("o_totalprice"),
                                 "o_orderkey", limit=800)
    return top.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("founded"),
                      "o_totalprice")


# ------------------------------------------------------- inverted index
@register("inverted_index_roundtrip", f"""
SELECT doc_id, len(toks) AS n_words, md5(array_to_string(toks, ' ')) AS rebuilt_md5
FROM (SELECT doc_id, {S.ws_split('text')} AS toks FROM documents)
""")
def inverted_index_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Text -> inverted index (word -> positions) -> text again, per document
    inside the row (no shuffle)."""
    d = table(spark, sf, "documents").select("doc_id", T.ws_split("text").alias("toks"))
    idx = N.with_inverted_index(d, "toks", "idx")
    rebuilt = N.with_text_from_inverted_index(idx, "idx", "rebuilt")
    return rebuilt.select("doc_id", F.array_size("toks").alias("n_words"), F.md5("rebuilt").alias("rebuilt_md5"))


# ------------------------------------------------------ nested cleaning
_NESTED_SQL = """
WITH li AS (SELECT l.l_orderkey, l.l_linenumber, s.s_name, s.s_nationkey, p.p_type, p.p_size, p.p_brand,
                   row_number() OVER (PARTITION BY l.l_orderkey
                                      ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS pos,
                   p.p_name, p.p_partkey
            FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey),
     au AS (SELECT l_orderkey, string_agg(s_name, '{sep}' ORDER BY pos) AS authors FROM li GROUP BY l_orderkey),
     i1 AS (SELECT l_orderkey, 'I' || s_nationkey AS id, min(pos) AS f, arg_max(s_name, pos) AS nm FROM li GROUP BY ALL),
     i2 AS (SELECT l_orderkey, string_agg({inst}, '{sep}' ORDER BY f) AS institutions FROM i1 GROUP BY l_orderkey),
     s1 AS (SELECT l_orderkey, p_type AS id, min(pos) AS f, arg_max(p_type || ' ' || p_size, pos) AS nm FROM li GROUP BY ALL),
     s2 AS (SELECT l_orderkey, string_agg(id || ':' || nm, '|' ORDER BY f) AS subfields FROM s1 GROUP BY l_orderkey),
     f1 AS (SELECT l_orderkey, p_brand AS id, min(pos) AS f FROM li GROUP BY ALL),
     f2 AS (SELECT l_orderkey, string_agg(id || ':' || id, '|' ORDER BY f) AS fields FROM f1 GROUP BY l_orderkey),
     d1 AS (SELECT l_orderkey, p_type[1] AS id, min(pos) AS f, arg_max(p_type, pos) AS nm FROM li GROUP BY ALL),
     d2 AS (SELECT l_orderkey, string_agg(id || ':' || nm, '|' ORDER BY f) AS domains FROM d1 GROUP BY l_orderkey),
     k2 AS (SELECT l_orderkey, string_agg(p_name, '|' ORDER BY pos) AS topics,
                   string_agg(p_partkey || ':' || p_name, '|' ORDER BY pos) AS keywords FROM li GROUP BY l_orderkey)
"""


def _raw_papers(spark: SparkSession, sf: str) -> DataFrame:
    """Nested paper records built from orders: one author per line item (the
    supplier), one institution per author (the supplier's nation, named after
    the supplier), one topic per line item (the part)."""
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier")
    p = table(spark, sf, "part")
    o = table(spark, sf, "orders")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    x = (li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
         .withColumn("pos", F.row_number().over(w)))
    author = F.struct(F.col("l_linenumber").cast("string").alias("author_position"),
                      F.struct(F.col("s_name").alias("display_name"),
                               F.concat(F.lit("0000-"), F.col("s_suppkey").cast("string")).alias("orcid")).alias("author"),
                      F.array(F.struct(F.concat(F.lit("I"), F.col("s_nationkey").cast("string")).alias("id"),
                                       F.col("s_name").alias("display_name"), F.lit(None).cast("string").alias("ror"),
                                       F.lit("XX").alias("country_code"), F.lit("company").alias("type"),
                                       F.array(F.lit("L")).alias("lineage"))).alias("institutions"))
    topic = F.struct(F.col("p_name").alias("display_name"), F.col("l_quantity").alias("score"),
                     F.struct(F.col("p_type").alias("id"),
                              F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("display_name")).alias("subfield"),
                     F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("display_name")).alias("field"),
                     F.struct(F.substring("p_type", 1, 1).alias("id"), F.col("p_type").alias("display_name")).alias("domain"))
    keyword = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("display_name"),
                       F.col("l_quantity").cast("double").alias("score"), F.lit("x").alias("url"))
    nested = x.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("pos", author.alias("a")))).alias("au"),
        F.sort_array(F.collect_list(F.struct("pos", topic.alias("t")))).alias("tp"),
        F.sort_array(F.collect_list(F.struct("pos", keyword.alias("k")))).alias("kw"))
    return (nested.join(o, nested.l_orderkey == o.o_orderkey)
            .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                    F.transform("au", lambda e: e["a"]).alias("authorships"),
                    F.transform("tp", lambda e: e["t"]).alias("topics"),
                    F.transform("kw", lambda e: e["k"]).alias("keywords")))


def _clean_papers(raw: DataFrame) -> DataFrame:
    # new names first: a select-list alias equal to an input column name can be
    # picked up by later expressions of the same list (lateral alias)
    c = raw.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                   N.slim_authors("authorships").alias("authorships_c"),
                   N.paper_institutions("authorships").alias("institutions"),
                   N.slim_topics("topics").alias("topics_c"), N.slim_keywords("keywords").alias("keywords"),
                   N.topic_level("topics", "subfield").alias("subfields"),
                   N.topic_level("topics", "field").alias("fields"),
                   N.topic_level("topics", "domain").alias("domains"))
    return c.withColumnRenamed("authorships_c", "authorships").withColumnRenamed("topics_c", "topics")


@register("clean_nested", _NESTED_SQL.format(sep="|", inst="id || ':' || nm") + """
SELECT au.l_orderkey AS o_orderkey, authors, institutions, subfields, fields, domains, topics, keywords
FROM au JOIN i2 USING (l_orderkey) JOIN s2 USING (l_orderkey) JOIN f2 USING (l_orderkey)
JOIN d2 USING (l_orderkey) JOIN k2 USING (l_orderkey)
""")
def clean_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Slim authors, institutions unique by id (first position, last value),
    subfields/fields unique by id."""
    c = _clean_papers(_raw_papers(spark, sf))
    j = lambda arr, f: F.array_join(F.transform(arr, f), "|")
    return c.select("o_orderkey",
                    j("authorships", lambda a: a["display_name"]).alias("authors"),
                    j("institutions", lambda i: F.concat(i["id"], F.lit(":"), i["display_name"])).alias("institutions"),
                    j("subfields", lambda i: F.concat(i["id"], F.lit(":"), i["display_name"])).alias("subfields"),
                    j("fields", lambda i: F.concat(i["id"], F.lit(":"), i["display_name"])).alias("fields"),
                    j("domains", lambda i: F.concat(i["id"], F.lit(":"), i["display_name"])).alias("domains"),
                    j("topics", lambda t: t["display_name"]).alias("topics"),
                    j("keywords", lambda k: F.concat(k["id"], F.lit(":"), k["display_name"])).alias("keywords"))


# -------------------------------------------------------------- flatten names
@register("flatten_names", f"""
SELECT conv_id, coalesce(string_agg(DISTINCT n, ';' ORDER BY n) FILTER (WHERE keep), '') AS names_flat
FROM (SELECT conv_id, {S.norm('text')} AS n, text IS NOT NULL AND text <> '' AS keep FROM conversations)
GROUP BY conv_id
""")
def flatten_names(spark: SparkSession, sf: str) -> DataFrame:
    """Array of structs per conversation -> sorted distinct normalized names joined by ';'."""
    c = table(spark, sf, "conversations")
    arr = c.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("text").alias("display_name"))).alias("items"))
    return arr.select("conv_id", T.flatten_names("items").alias("names_flat"))


# -------------------------------------------------------------- normalization
@register("normalize_text", f"""
SELECT doc_id, md5({S.norm('text')}) AS text_norm_md5, length({S.norm('text')}) AS text_norm_len,
       {S.strip("lower(coalesce(' ' || upper(source) || ' ', ''))")} AS doi_norm
FROM documents
""")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    n = T.normalize_text("text")
    return d.select("doc_id", F.md5(n).alias("text_norm_md5"), F.length(n).alias("text_norm_len"),
                    T.normalize_doi(F.concat(F.lit(" "), F.upper("source"), F.lit(" "))).alias("doi_norm"))


@register("normalize_category", f"""
SELECT p_partkey, {S.category("p_type || '--' || replace(p_name, ' ', '_') || '__'")} AS cat_norm FROM part
""")
def normalize_category(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    raw = F.concat(F.col("p_type"), F.lit("--"), F.regexp_replace("p_name", " ", "_"), F.lit("__"))
    return p.select("p_partkey", T.normalize_category(raw).alias("cat_norm"))


# ------------------------------------------------------------- date coercion
_RAW_DATE_SQL = """CASE o_orderpriority
   WHEN '1-URGENT' THEN year(o_orderdate) || '-' || (month(o_orderdate) + 12) || '-' || day(o_orderdate)
   WHEN '2-HIGH' THEN 'n/a'
   WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00'
   ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@register("date_coerce", f"""
SELECT o_orderkey, raw, strftime(TRY_CAST(raw AS TIMESTAMP), '%Y-%m-%d') AS pub_date,
       strftime(TRY_CAST(TRY_CAST(raw AS TIMESTAMP) AS DATE), '%Y-%m-%d') AS date_value
FROM (SELECT o_orderkey, {_RAW_DATE_SQL} AS raw FROM orders)
""")
def date_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """Dates as text, some damaged (month > 12, 'n/a', with a time part)."""
    o = table(spark, sf, "orders")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = (F.when(F.col("o_orderpriority") == "1-URGENT",
                  F.concat_ws("-", F.year("o_orderdate").cast("string"), (F.month("o_orderdate") + 12).cast("string"),
                              F.dayofmonth("o_orderdate").cast("string")))
           .when(F.col("o_orderpriority") == "2-HIGH", F.lit("n/a"))
           .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(d, F.lit(" 12:30:00")))
           .otherwise(d))
    x = o.select("o_orderkey", raw.alias("raw"))
    return x.select("o_orderkey", "raw", T.coerce_date("raw").alias("pub_date"),
                    F.date_format(T.to_date_or_null("raw"), "yyyy-MM-dd").alias("date_value"))


# ------------------------------------------------------------ first location
def _locations(c: DataFrame, n: DataFrame, r: DataFrame) -> DataFrame:
    """Customers with a typed location array (country, region, optional city)."""
    x = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    loc = lambda v, t: F.struct(F.lit(t).alias("location_type"), v.alias("value"), F.lit("u").alias("uuid"))
    region = F.when(F.col("r_name") == "ASIA", F.lit("")).otherwise(F.col("r_name"))
    locs = F.concat(F.array(loc(F.col("n_name"), "country"), loc(region, "region")),
                    F.when(F.col("c_mktsegment") == "BUILDING", F.array(loc(F.col("c_name"), "city")))
                    .otherwise(F.array().cast("array<struct<location_type:string,value:string,uuid:string>>")))
    return x.withColumn("locs", locs)


@register("first_location", """
SELECT c.c_custkey, coalesce(nullif(CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_name END, ''),
                             nullif(CASE WHEN r.r_name = 'ASIA' THEN '' ELSE r.r_name END, ''),
                             nullif(n.n_name, ''), '') AS location
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def first_location(spark: SparkSession, sf: str) -> DataFrame:
    x = _locations(table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region"))
    return x.select("c_custkey", N.first_location("locs").alias("location"))


# ------------------------------------------------- keyword split and overlap
_KW_TEXT_SQL = "p_type || ', ' || replace(p_name, ' ', '; ') || ' ;;' || p_brand"


@register("keyword_split_overlap", f"""
WITH e AS (SELECT p_partkey, unnest(list_distinct(list_filter(
              list_transform(string_split_regex(lower(coalesce({_KW_TEXT_SQL}, '')), '[,;]'), lambda x: {S.strip('x')}),
              lambda x: x <> ''))) AS kw FROM part),
     names AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name),
     t AS (SELECT DISTINCT p_name AS technology_name,
                  unnest([lower(p_name), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS kw FROM names)
SELECT DISTINCT e.p_partkey, t.technology_name FROM e JOIN t ON e.kw = t.kw
""")
def keyword_split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Entity keyword sets split from text vs technology keyword sets (lower
    name and its words); pairs that share a keyword."""
    p = table(spark, sf, "part")
    kw_text = F.concat(F.col("p_type"), F.lit(", "), F.regexp_replace("p_name", " ", "; "), F.lit(" ;;"), F.col("p_brand"))
    ents = p.select("p_partkey", T.split_set(kw_text).alias("keywords"))
    names = p.select("p_name").distinct()
    w = F.split("p_name", " ")
    techs = names.select(F.col("p_name").alias("technology_name"),
                         F.array(F.lower("p_name"), w[0], w[1]).alias("keywords"))
    return similarity.keyword_overlap(ents, techs, "p_partkey", "technology_name")


# -------------------------------------------------------- JSON reply parsing
_REPLY_SQL = """CASE event_type WHEN 'error' THEN 'I don''t know' WHEN 'view' THEN 'oops ' || props
   WHEN 'signup' THEN NULL ELSE '["' || event_type || '", "u' || user_id || '"]' END"""


@register("parse_json_reply", f"""
SELECT event_id, len(arr) AS n_items, array_to_string(arr, '|') AS items, k_value
FROM (SELECT event_id, json_extract_string(props, '$.k') AS k_value,
             CASE WHEN reply IS NULL OR {S.strip('reply')} = 'I don''t know' THEN []::VARCHAR[]
                  WHEN json_valid(reply) THEN coalesce(from_json(reply, '["VARCHAR"]'), []::VARCHAR[])
                  ELSE []::VARCHAR[] END AS arr
      FROM (SELECT event_id, props, {_REPLY_SQL} AS reply FROM events))
""")
def parse_json_reply(spark: SparkSession, sf: str) -> DataFrame:
    """Replies that should be JSON arrays: valid arrays, invalid JSON, the
    "I don't know" sentinel and missing replies."""
    e = table(spark, sf, "events")
    reply = (F.when(F.col("event_type") == "error", F.lit("I don't know"))
             .when(F.col("event_type") == "view", F.concat(F.lit("oops "), F.col("props")))
             .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit('["'), F.col("event_type"), F.lit('", "u'), F.col("user_id").cast("string"),
                                 F.lit('"]'))))
    x = e.select("event_id", F.get_json_object("props", "$.k").alias("k_value"), N.parse_reply_array(reply).alias("arr"))
    return x.select("event_id", F.size("arr").alias("n_items"), F.array_join("arr", "|").alias("items"), "k_value")


# ------------------------------------------------------------- exact dedupe
@register("exact_dedupe", f"""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {S.norm('text')} ORDER BY doc_id) AS rn
                    FROM documents) WHERE rn = 1
""")
def exact_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Documents deduplicated on normalized text, first (smallest id) kept."""
    d = table(spark, sf, "documents")
    return dedupe.keep_first(d, T.normalize_text("text"), "doc_id").select("doc_id")


# -------------------------------------------------------- Indel ratio pairs
_NAMES_SQL = "SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name"


@register("indel_ratio_pairs", f"""
WITH n AS ({_NAMES_SQL}), s AS (SELECT p_name, {S.token_sort('p_name')} AS ts FROM n)
SELECT a.p_name AS name_a, b.p_name AS name_b, round({S.ratio('a.ts', 'b.ts')}, {R6}) AS ratio
FROM s a JOIN s b ON a.p_name < b.p_name
WHERE length(a.ts) > 0 AND length(b.ts) > 0 AND 200 * {S.lcs('a.ts', 'b.ts')} >= 70 * (length(a.ts) + length(b.ts))
""")
def indel_ratio_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of distinct part names with token-sort ratio >= 70."""
    names = table(spark, sf, "part").select("p_name").distinct()
    pairs = dedupe.similar_pairs(names, "p_name", "p_name", 70, sort_tokens=True)
    return pairs.select(F.col("id_a").alias("name_a"), F.col("id_b").alias("name_b"),
                        F.round("ratio", R6).alias("ratio"))


# -------------------------------------------------------------- fuzzy dedupe
@register("fuzzy_dedupe", f"""
WITH RECURSIVE n AS (SELECT p_name, k, row_number() OVER (ORDER BY k) AS rn, {S.token_sort('p_name')} AS ts
                     FROM ({_NAMES_SQL})),
scan(rn, kept) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT n.rn, CASE WHEN len(list_filter(scan.kept, lambda x: length(x) + length(n.ts) > 0 AND
                       200 * {S.lcs('x', 'n.ts')} >= 85 * (length(x) + length(n.ts)))) > 0
                    THEN scan.kept ELSE list_append(scan.kept, n.ts) END
  FROM scan JOIN n ON n.rn = scan.rn + 1)
SELECT n.p_name, n.k AS first_key FROM n
WHERE list_contains((SELECT kept FROM scan ORDER BY rn DESC LIMIT 1), n.ts)
  AND n.rn = (SELECT min(m.rn) FROM n m WHERE m.ts = n.ts)
""")
def fuzzy_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct part names in order of first key, greedy token-sort dedupe at 85."""
    names = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("first_key"))
    kept = dedupe.greedy_fuzzy_dedupe(names, "p_name", "first_key", "p_name", 85)
    return kept.select("p_name", "first_key")


# -------------------------------------------------------------- phrase links
@register("phrase_links", f"""
WITH t AS (SELECT item_id, {S.norm_safe('text')} AS tn FROM benchmark),
     d AS (SELECT doc_id, {S.norm_safe('text')} AS dn FROM documents)
SELECT DISTINCT d.doc_id, t.item_id FROM d JOIN t ON t.tn <> '' AND contains(d.dn, t.tn)
""")
def phrase_links(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose whole normalized text contains a whole normalized passage."""
    d = table(spark, sf, "documents").select("doc_id", T.normalize_text_safe("text").alias("dn"))
    t = table(spark, sf, "benchmark").select("item_id", T.normalize_text_safe("text").alias("tn"))
    return linking.phrase_matches(d, "doc_id", "dn", t, "item_id", "tn").distinct()


@register("partial_ratio_links")
def partial_ratio_links(spark: SparkSession, sf: str) -> DataFrame:
    """Whole passages linked to whole documents by phrase or partial ratio
    (>= 85); documents without any take their labels (quality / toxic flags) as
    fallback technologies."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    pred = F.concat_ws("; ", F.when(F.col("quality") == 1, F.lit("quality")), F.when(F.col("toxic") == 1, F.lit("toxic")))
    papers = (d.join(lab, "doc_id", "left")
              .select(F.col("doc_id").alias("paper_id"), F.col("text").alias("combined"),
                      pred.alias("predicted_technology")))
    techs = table(spark, sf, "benchmark").select(F.col("text").alias("technology_name"))
    return linking.link_papers(papers, techs, threshold=85)


# ------------------------------------------------------------------- TF-IDF
_DOC_BENCH_CORPUS = """SELECT 0 AS side, doc_id AS id, text FROM documents
                UNION ALL SELECT 1 AS side, item_id AS id, text FROM benchmark"""


def tfidf_ctes(corpus_sql: str = _DOC_BENCH_CORPUS) -> str:
    """CTEs ending in ``sim(doc_id, item_id, tfidf)`` for a corpus of (side, id, text)."""
    return f"""
WITH corpus AS ({corpus_sql}),
     nd AS (SELECT count(*) AS n FROM corpus),
     toks AS (SELECT side, id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}\\p{{M}}_]{{2,}}'),
                                          lambda w: NOT list_contains({S.stop_list()}, w)) AS k FROM corpus),
     terms AS (SELECT side, id, unnest(k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS term
               FROM toks),
     tf AS (SELECT side, id, term, count(*) AS tf FROM terms GROUP BY ALL),
     stats AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
     vocab AS (SELECT term, ln((1.0 + nd.n) / (1.0 + df)) + 1 AS idf FROM stats, nd ORDER BY total DESC, term LIMIT 5000),
     w AS (SELECT side, id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
     nr AS (SELECT side, id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY ALL),
     wn AS (SELECT side, id, term, w / nrm AS wn FROM w JOIN nr USING (side, id)),
     sim AS (SELECT e.id AS doc_id, t.id AS item_id, sum(e.wn * t.wn) AS tfidf
             FROM wn e JOIN wn t ON e.term = t.term AND e.side = 0 AND t.side = 1 GROUP BY ALL)
"""


_TFIDF_SQL = tfidf_ctes()


@register("tfidf_cosine", _TFIDF_SQL + f"SELECT doc_id, item_id, round(tfidf, {R6}) AS tfidf FROM sim")
def tfidf_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """Word 1-2-gram TF-IDF cosine, documents x technologies, fitted jointly."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("entity_id"), "text")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("tech_id"), "text")
    s = similarity.tfidf_similarity(d, b)
    return s.select(F.col("entity_id").alias("doc_id"), F.col("tech_id").alias("item_id"),
                    F.round("tfidf", R6).alias("tfidf"))


@register("tfidf_links", _TFIDF_SQL + f"SELECT doc_id, item_id, round(tfidf, {R6}) AS tfidf FROM sim WHERE tfidf >= 0.35")
def tfidf_links(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and technologies whose TF-IDF cosine reaches the gate, by a prefix-filtered term join."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("entity_id"), "text")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("tech_id"), "text")
    s = similarity.tfidf_similarity(d, b, threshold=0.35)
    return s.select(F.col("entity_id").alias("doc_id"), F.col("tech_id").alias("item_id"), F.round("tfidf", R6).alias("tfidf"))


# --------------------------------------------------------- embedding cosine
_CENTROID_SQL = """
cent_raw AS (SELECT label, list(m ORDER BY dim) AS raw FROM (
   SELECT label, dim, avg(x) AS m FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(1, len(embedding) + 1)) AS dim FROM embeddings)
   GROUP BY label, dim) GROUP BY label),
cent AS (SELECT label, list_transform(raw, lambda x: x / sqrt(list_sum(list_transform(raw, lambda y: y * y)))) AS vec
         FROM cent_raw),
emb AS (SELECT e.vec_id, c.label AS tech, list_cosine_similarity(e.embedding::DOUBLE[], c.vec) AS cos
        FROM embeddings e CROSS JOIN cent c)
"""


@register("embedding_cosine", "WITH " + _CENTROID_SQL + f"""
SELECT vec_id, tech AS label, round(cos, {R6}) AS cosine,
       row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, tech) AS rank
FROM emb
""")
def embedding_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every embedding with every unit label centroid, ranked per vector."""
    e = table(spark, sf, "embeddings")
    cents = similarity.label_centroids(e, "label", "embedding")
    s = similarity.cosine_scores(e, cents, "vec_id", "embedding", "label", "vec")
    w = Window.partitionBy("vec_id").orderBy(F.desc("score"), "label")
    return s.select("vec_id", "label", F.round("score", R6).alias("cosine"),
                    F.row_number().over(w).alias("rank"))


# ---------------------------------------------------------- token-set ratio
_TSR_B_SQL = "p_type || ' ' || lower(p_brand) || ' ' || split_part(p_name, ' ', 2)"


@register("token_set_ratio", f"""
SELECT p_partkey, round({S.token_set('a', 'b')}, {R6}) AS token_set
FROM (SELECT p_partkey, p_name AS a, {_TSR_B_SQL} AS b FROM part)
""")
def token_set_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Token-set ratio of the part name with type, brand and the name's noun."""
    p = table(spark, sf, "part")
    x = p.select("p_partkey", F.col("p_name").alias("a"),
                 F.concat_ws(" ", "p_type", F.lower("p_brand"), F.split("p_name", " ")[1]).alias("b"))
    return with_token_set_ratio(x, "a", "b", "token_set").select("p_partkey", F.round("token_set", R6).alias("token_set"))


# ---------------------------------------------------------- category direct
_CAT_SQL = f"""
cats0 AS (SELECT DISTINCT l.l_suppkey AS company_id, unnest(string_split(p.p_name, ' ') || [lower(p.p_type) || '_']) AS c
          FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) l JOIN part p ON l.l_partkey = p.p_partkey),
cats AS (SELECT DISTINCT company_id, {S.category('c')} AS cat FROM cats0),
tn AS (SELECT DISTINCT p_name AS technology_name FROM part),
tname AS (SELECT technology_name, {S.category('technology_name')} AS target FROM tn),
tkw AS (SELECT DISTINCT technology_name, {S.category('lower(k)')} AS target FROM (
          SELECT technology_name, unnest([lower(technology_name), split_part(technology_name, ' ', 1), split_part(technology_name, ' ', 2),
                                          split_part(technology_name, ' ', 1) || 's',
                                          'x' || split_part(technology_name, ' ', 2)]) AS k FROM tn)),
nkw AS (SELECT technology_name, count(*) AS n_kw FROM tkw GROUP BY technology_name),
strs AS (SELECT cat AS s FROM cats UNION SELECT target FROM tname UNION SELECT target FROM tkw),
tss AS (SELECT s, {S.token_sort('s')} AS ts FROM strs),
mt AS (SELECT a.s AS cat, b.s AS target FROM tss a JOIN tss b
       ON a.s = b.s OR (length(a.ts) > 0 AND length(b.ts) > 0 AND
                        200 * {S.lcs('a.ts', 'b.ts')} >= 75 * (length(a.ts) + length(b.ts)))),
ct AS (SELECT DISTINCT cats.company_id, mt.target FROM cats JOIN mt ON cats.cat = mt.cat),
kwhit AS (SELECT ct.company_id, tkw.technology_name, count(*) AS n_hit FROM ct JOIN tkw ON ct.target = tkw.target
          GROUP BY ct.company_id, tkw.technology_name),
direct AS (SELECT DISTINCT company_id, technology_name FROM (
   SELECT ct.company_id, tname.technology_name FROM ct JOIN tname ON ct.target = tname.target
   UNION ALL
   SELECT kwhit.company_id, kwhit.technology_name FROM kwhit JOIN nkw USING (technology_name)
   WHERE kwhit.n_hit / nkw.n_kw >= 0.40))
"""


@register("category_direct", "WITH " + _CAT_SQL + "SELECT company_id, technology_name FROM direct")
def category_direct(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' categories (words and types of supplied parts) matched to part
    names and their keywords, exactly or with token-sort ratio >= 75."""
    comps = supplier_categories(spark, sf)
    techs = part_name_techs(spark, sf)
    return linking.category_direct(comps, techs, 75, 0.40)


# ------------------------------------------------------------ cascade label
# A part as a paper: its name, the name's first word with the brand, the name without vowels, or its type.
_CASCADE_FIELD_SQL = """CASE p_size % 4 WHEN 0 THEN p_name || ' ' || p_brand WHEN 1 THEN p_brand || ' ' || split_part(p_name, ' ', 1)
                        WHEN 2 THEN replace(replace(p_name, 'e', ''), 'o', '') ELSE p_type END"""
_CASCADE_SQL = f"""
WITH t AS (SELECT min(p_partkey) AS tech_id, min(p_partkey) AS tech_pos, p_name AS technology_name,
                  {S.norm('p_name')} AS tech_norm FROM part GROUP BY p_name),
     p0 AS (SELECT p_partkey AS paper_id, {_CASCADE_FIELD_SQL} AS f1 FROM part),
     p AS (SELECT paper_id, [{S.norm_safe('f1')}, ''] AS nf, {S.token_sort(S.norm("concat_ws(' ', f1, '')"))} AS ptext FROM p0),
     s1 AS (SELECT paper_id, arg_min(technology_name, tech_pos) AS technology_name FROM p JOIN t
            ON t.tech_norm <> '' AND len(list_filter(nf, lambda f: contains(f, t.tech_norm))) > 0 GROUP BY paper_id),
     r1 AS (SELECT * FROM p WHERE paper_id NOT IN (SELECT paper_id FROM s1)),
     {_CENTROID_SQL.strip()},
     e2 AS (SELECT r1.paper_id, t.technology_name, emb.cos, t.tech_pos FROM r1 JOIN emb ON emb.vec_id = r1.paper_id
            JOIN t ON t.tech_id = emb.tech),
     s2 AS (SELECT paper_id, technology_name, cos FROM (
              SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY cos DESC, tech_pos) AS rn FROM e2)
            WHERE rn = 1 AND cos >= 0.3),
     r2 AS (SELECT * FROM r1 WHERE paper_id NOT IN (SELECT paper_id FROM s2)),
     tk AS (SELECT *, list_filter({S.ws_split('tech_norm')}, lambda k: length(k) > 4) AS toks FROM t),
     s3 AS (SELECT paper_id, arg_min(technology_name, tech_pos) AS technology_name FROM r2 JOIN tk
            ON len(list_filter(toks, lambda k: len(list_filter(nf, lambda f: contains(f, k))) > 0)) > 0 GROUP BY paper_id),
     r3 AS (SELECT * FROM r2 WHERE paper_id NOT IN (SELECT paper_id FROM s3)),
     t4 AS (SELECT tech_pos, technology_name, {S.token_sort(S.norm('technology_name'))} AS ttext FROM t),
     c4 AS (SELECT r3.paper_id, t4.technology_name, t4.tech_pos,
                   {S.ratio('r3.ptext', 't4.ttext')} AS ratio
            FROM r3 JOIN t4 ON 70 * greatest(length(r3.ptext), length(t4.ttext))
                               <= 130 * least(length(r3.ptext), length(t4.ttext))),
     s4 AS (SELECT paper_id, technology_name, ratio FROM (
              SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY ratio DESC, tech_pos) AS rn FROM c4
              WHERE ratio >= 70) WHERE rn = 1),
     lab AS (SELECT paper_id, technology_name, 'field_exact' AS match_type, 1.0 AS similarity FROM s1
             UNION ALL SELECT paper_id, technology_name, 'embedding', cos FROM s2
             UNION ALL SELECT paper_id, technology_name, 'token_match', 0.6 FROM s3
             UNION ALL SELECT paper_id, technology_name, 'fuzzy_fallback', ratio / 100.0 FROM s4)
SELECT p.paper_id, coalesce(lab.technology_name, '') AS predicted_technology, coalesce(lab.match_type, '') AS match_type,
       round(coalesce(lab.similarity, 0.0), 3) AS similarity
FROM p LEFT JOIN lab USING (paper_id)
"""


@register("cascade_label", _CASCADE_SQL)
def cascade_label(spark: SparkSession, sf: str) -> DataFrame:
    """Single-label cascade of parts (a name field that is whole, cut, damaged or
    without a name, and an empty one) against all part names; the embedding stage
    uses the embedding of the same id against the label centroids (technology = label)."""
    p = table(spark, sf, "part")
    kind = F.col("p_size") % 4
    blank = F.lit("")
    field = (F.when(kind == 0, F.concat_ws(" ", "p_name", "p_brand"))
             .when(kind == 1, F.concat_ws(" ", F.col("p_brand"), F.split("p_name", " ")[0]))
             .when(kind == 2, F.replace(F.replace(F.col("p_name"), F.lit("e"), blank), F.lit("o"), blank))
             .otherwise(F.col("p_type")))
    papers = p.select(F.col("p_partkey").alias("paper_id"), F.array(field, blank).alias("fields"))
    techs = _name_techs(p).select("tech_id", "tech_pos", F.col("tech_name").alias("technology_name"))
    e = table(spark, sf, "embeddings")
    cents = similarity.label_centroids(e, "label", "embedding")
    emb = (similarity.cosine_scores(e, cents, "vec_id", "embedding", "label", "vec")
           .select(F.col("vec_id").alias("paper_id"), F.col("label").cast("long").alias("tech_id"),
                   F.col("score").alias("emb")))
    return linking.cascade_label(papers, techs, emb, 0.3, 70)


# -------------------------------------------------------- multi-signal labels
def _name_techs(p: DataFrame) -> DataFrame:
    """Part names as technologies: id and position are the first key, the
    description adds that part's type and brand, the keywords are its words."""
    first = p.groupBy("p_name").agg(F.min_by(F.struct("p_type", "p_brand"), "p_partkey").alias("x"), F.min("p_partkey").alias("k"))
    return first.select(F.col("k").alias("tech_id"), F.col("k").alias("tech_pos"), F.col("p_name").alias("tech_name"),
                        F.concat_ws(" ", "p_name", "x.p_type", "x.p_brand").alias("description"),
                        F.array_distinct(F.concat(F.split("p_name", " "), F.array(F.lower("x.p_brand")))).alias("keywords"))


_MULTI_CORPUS = """SELECT 0 AS side, p_partkey AS id, concat_ws(' ', p_brand, p_name, p_type) AS text FROM part
                   UNION ALL SELECT 1 AS side, min(p_partkey) AS id,
                   concat_ws(' ', p_name, arg_min(p_type, p_partkey), arg_min(p_brand, p_partkey)) AS text FROM part GROUP BY p_name"""
_MULTI_SQL = f"""
WITH t AS (SELECT min(p_partkey) AS tech_id, min(p_partkey) AS tech_pos, p_name AS tech_name,
                  concat_ws(' ', p_name, arg_min(p_type, p_partkey), arg_min(p_brand, p_partkey)) AS description,
                  list_distinct(string_split(p_name, ' ') || [lower(arg_min(p_brand, p_partkey))]) AS keywords FROM part GROUP BY p_name),
     d AS (SELECT p_partkey AS entity_id, {S.norm("p_name || ', ' || p_brand")} AS title,
                  concat_ws(' ', p_brand, p_name, p_type) AS combined,
                  list_distinct(list_filter(list_transform(string_split_regex(lower(p_brand || ',' || replace(p_name, ' ', ';')), '[,;]'),
                      lambda x: {S.strip('x')}), lambda x: x <> '')) AS kws FROM part),
     {_CENTROID_SQL.strip()[:-1].replace('emb AS (', 'emb0 AS (')}),
     {tfidf_ctes(_MULTI_CORPUS).strip()[5:]},
     kw AS (SELECT DISTINCT d.entity_id, t.tech_id FROM d JOIN t ON len(list_intersect(d.kws, t.keywords)) > 0),
     pr AS (SELECT d.entity_id, t.tech_id, t.tech_pos, t.tech_name, t.description, d.combined,
                   least(1.0, emb0.cos + CASE WHEN d.title <> '' AND contains(lower(d.title), lower(t.tech_name))
                                              THEN 0.3 ELSE 0.0 END) AS embb
            FROM emb0 JOIN d ON d.entity_id = emb0.vec_id JOIN t ON t.tech_id = emb0.tech),
     pg AS (SELECT *, max(CASE WHEN embb >= 0.30 THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id) AS any_strong
            FROM pr WHERE embb >= 0.20),
     weak AS (SELECT pg.entity_id, pg.tech_id, pg.tech_pos, pg.tech_name FROM pg
              LEFT JOIN sim ON sim.doc_id = pg.entity_id AND sim.item_id = pg.tech_id
              LEFT JOIN kw ON kw.entity_id = pg.entity_id AND kw.tech_id = pg.tech_id
              WHERE pg.any_strong = 0 AND
                    (CASE WHEN coalesce(sim.tfidf, 0) >= 0.35 THEN 1 ELSE 0 END
                     + CASE WHEN (SELECT {S.token_set('pg.description', 'pg.combined')}) / 100.0 >= 0.60 THEN 1 ELSE 0 END
                     + CASE WHEN kw.tech_id IS NOT NULL THEN 1 ELSE 0 END) >= 1),
     lab AS (SELECT entity_id, tech_id, tech_pos, tech_name FROM pg WHERE embb >= 0.30
             UNION SELECT * FROM weak),
     agg AS (SELECT entity_id, string_agg(tech_name, '; ' ORDER BY tech_pos) AS predicted_technology
             FROM lab GROUP BY entity_id)
SELECT d.entity_id, coalesce(agg.predicted_technology, '') AS predicted_technology
FROM d LEFT JOIN agg USING (entity_id)
"""


@register("multi_signal_labels", _MULTI_SQL)
def multi_signal_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-label decision on parts with strong=0.30 / weak=0.20 gates: embedding
    of the same id vs label centroids (boosted by the title), TF-IDF, token-set
    and keyword overlap on the whole texts and keyword sets."""
    p = table(spark, sf, "part")
    docs = p.select(F.col("p_partkey").alias("entity_id"), T.normalize_text(F.concat_ws(", ", "p_name", "p_brand")).alias("title"),
                    F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("text"),
                    T.split_set(F.concat(F.col("p_brand"), F.lit(","), F.replace(F.col("p_name"), F.lit(" "), F.lit(";")))).alias("keywords"))
    techs = _name_techs(p)
    e = table(spark, sf, "embeddings")
    cents = similarity.label_centroids(e, "label", "embedding").select(F.col("label").cast("long").alias("tech_id"), "vec")
    boosted = linking.boost_pairs(docs, "entity_id", "title", techs, "tech_id", "tech_name")
    emb = similarity.gated_cosine(e.select(F.col("vec_id").alias("entity_id"), "embedding"), cents, boosted, "entity_id",
                                  "embedding", "tech_id", "vec", 0.20).withColumnRenamed("score", "emb")

    def tf(pairs: DataFrame) -> DataFrame:
        return similarity.tfidf_similarity(docs.select("entity_id", "text"),
                                           techs.select("tech_id", F.col("description").alias("text")), pairs=pairs)
    kw = similarity.keyword_overlap(docs.select("entity_id", "keywords"), techs.select("tech_id", "keywords"), "entity_id", "tech_id")
    ents = docs.select("entity_id", "text", "title")
    return linking.classify_multi(emb, ents, techs, tf, kw, high=0.30, low=0.20, th_tfidf=0.35, th_fuzzy=0.60)


# ------------------------------------------- the same decisions on documents
# The CTEs from the first stage on are those of the part queries; common subsequences have no length bound here.
_CASCADE_DOCS_SQL = f"""
WITH t AS (SELECT item_id AS tech_id, item_id AS tech_pos, text AS technology_name, {S.norm_safe('text')} AS tech_norm
           FROM benchmark),
     p AS (SELECT doc_id AS paper_id, [{S.norm_safe('lang')}, {S.norm_safe('source')}, {S.norm_safe('text')}] AS nf,
                  {S.token_sort(S.norm("concat_ws(' ', coalesce(lang, ''), coalesce(source, ''), coalesce(text, ''))"))}
                  AS ptext FROM documents),
     """ + (_CASCADE_SQL[_CASCADE_SQL.index("s1 AS ("):_CASCADE_SQL.index("c4 AS (")] + f"""
     c3 AS MATERIALIZED (SELECT r3.paper_id, r3.ptext, t4.technology_name, t4.tech_pos, t4.ttext FROM r3 JOIN t4
            ON 70 * greatest(length(r3.ptext), length(t4.ttext)) <= 130 * least(length(r3.ptext), length(t4.ttext))),
     c4 AS MATERIALIZED (SELECT paper_id, technology_name, tech_pos, CASE WHEN length(ptext) + length(ttext) = 0 THEN 100.0
                   ELSE 200.0 * {S.lcs_long('ptext', 'ttext')} / (length(ptext) + length(ttext)) END AS ratio FROM c3),
     """ + _CASCADE_SQL[_CASCADE_SQL.index("s4 AS ("):])


@register("cascade_label_documents", _CASCADE_DOCS_SQL)
def cascade_label_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Single-label cascade of documents (fields: lang, source, whole text) against
    all benchmark passages as names; embedding stage as in ``cascade_label``."""
    papers = table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), F.array("lang", "source", "text").alias("fields"))
    techs = _passage_techs(spark, sf).select("tech_id", "tech_pos", F.col("tech_name").alias("technology_name"))
    e = table(spark, sf, "embeddings")
    cents = similarity.label_centroids(e, "label", "embedding")
    emb = (similarity.cosine_scores(e, cents, "vec_id", "embedding", "label", "vec")
           .select(F.col("vec_id").alias("paper_id"), F.col("label").cast("long").alias("tech_id"),
                   F.col("score").alias("emb")))
    return linking.cascade_label(papers, techs, emb, 0.3, 70)


def _passage_techs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole benchmark passages as names and descriptions; the keywords are all their words longer than four characters."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("tech_id"), F.col("item_id").alias("tech_pos"), F.col("text").alias("tech_name"),
        F.col("text").alias("description"), F.array_distinct(T.long_tokens(T.normalize_text_safe("text"))).alias("keywords"))


# The token-set ratio of the weak pairs in stored steps (the strings must not be formed anew for every character).
# Lengths alone keep most pairs of a passage and a whole document under the gate of 60; the others get their exact score.
_LONG_TOKEN_SET = f"""
     w1 AS MATERIALIZED (SELECT entity_id, tech_id, list_distinct({S.ws_split('description')}) AS ta,
                                list_distinct({S.ws_split('combined')}) AS tb FROM pg WHERE any_strong = 0),
     w2 AS MATERIALIZED (SELECT entity_id, tech_id, ta, tb, array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS sect,
                   array_to_string(list_sort(list_filter(ta, lambda x: NOT list_contains(tb, x))), ' ') AS ab,
                   array_to_string(list_sort(list_filter(tb, lambda x: NOT list_contains(ta, x))), ' ') AS ba FROM w1),
     w3 AS MATERIALIZED (SELECT entity_id, tech_id, ab, ba FROM w2 WHERE 100.0 * (1 - abs(length(ab) - length(ba))
                                / (2 * length(sect) + 2 + length(ab) + length(ba))) >= 60),
     w4 AS MATERIALIZED (SELECT entity_id, tech_id, {S.lcs_long('ab', 'ba')} AS l FROM w3),
     tset AS (SELECT entity_id, tech_id, {S.token_set('x', 'y').replace(S.lcs('ab', 'ba'), 'coalesce(l, 0)').split('FROM (SELECT ta')[0].strip()[len('(SELECT'):]} AS score
              FROM w2 LEFT JOIN w4 USING (entity_id, tech_id)),"""
_MULTI_DOCS_SQL = f"""
WITH t AS (SELECT item_id AS tech_id, item_id AS tech_pos, text AS tech_name, text AS description,
                  list_distinct(list_filter({S.ws_split(S.norm_safe('text'))}, lambda k: length(k) > 4)) AS keywords FROM benchmark),
     d AS (SELECT doc_id AS entity_id, text AS title, text AS combined,
                  list_distinct(list_filter(list_transform(
                      string_split_regex(lower(concat_ws(',', lang, source)), '[,;]') || {S.ws_split(S.norm_safe('text'))},
                      lambda x: {S.strip('x')}), lambda x: x <> '')) AS kws FROM documents),
     {_CENTROID_SQL.strip()[:-1].replace('emb AS (', 'emb0 AS (')}),
     {tfidf_ctes().strip()[5:]},
     """ + (_MULTI_SQL[_MULTI_SQL.index("kw AS ("):]
            .replace("weak AS (", _LONG_TOKEN_SET.strip() + "\n     weak AS (")
            .replace("WHERE pg.any_strong = 0", "LEFT JOIN tset ON tset.entity_id = pg.entity_id AND tset.tech_id = pg.tech_id\n"
                                                "              WHERE pg.any_strong = 0")
            .replace(f"(SELECT {S.token_set('pg.description', 'pg.combined')})", "tset.score"))


@register("multi_signal_labels_documents", _MULTI_DOCS_SQL)
def multi_signal_labels_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-label decision on documents against all benchmark passages, gates as in
    ``multi_signal_labels``: the title boost, TF-IDF and token-set ratio read the whole
    text, the keyword set holds lang, source and every word of the text."""
    d = table(spark, sf, "documents")
    docs = d.select(F.col("doc_id").alias("entity_id"), F.col("text").alias("title"), "text", "lang", "source")
    # normalized words hold neither separators nor white space: only the other fields are split and stripped
    words = F.coalesce(T.ws_split(T.normalize_text_safe("text")), F.array().cast("array<string>"))
    keywords = F.array_distinct(F.concat(T.split_set(F.concat_ws(",", "lang", "source")), words)).alias("keywords")
    techs = _passage_techs(spark, sf)
    e = table(spark, sf, "embeddings")
    cents = similarity.label_centroids(e, "label", "embedding").select(F.col("label").cast("long").alias("tech_id"), "vec")
    boosted = linking.boost_pairs(docs, "entity_id", "title", techs, "tech_id", "tech_name")
    emb = similarity.gated_cosine(e.select(F.col("vec_id").alias("entity_id"), "embedding"), cents, boosted, "entity_id",
                                  "embedding", "tech_id", "vec", 0.20).withColumnRenamed("score", "emb")

    def tf(pairs: DataFrame) -> DataFrame:
        return similarity.tfidf_similarity(docs.select("entity_id", "text"),
                                           techs.select("tech_id", F.col("description").alias("text")), pairs=pairs)

    def kw(pairs: DataFrame) -> DataFrame:
        return similarity.keyword_overlap(
            docs.join(pairs.select("entity_id").distinct(), "entity_id", "left_semi").select("entity_id", keywords),
            techs.join(pairs.select("tech_id").distinct(), "tech_id", "left_semi").select("tech_id", "keywords"),
            "entity_id", "tech_id")
    ents = docs.select("entity_id", "text", "title")
    return linking.classify_multi(emb, ents, techs, tf, kw, high=0.30, low=0.20, th_tfidf=0.35, th_fuzzy=0.60)


# ------------------------------------------------------------ company links
_COMPANY_SQL = "WITH " + _CAT_SQL.strip() + """,
names AS (SELECT s.s_suppkey, CASE WHEN s.s_suppkey % 3 = 0 AND p.p_name IS NOT NULL THEN s.s_name || ' ' || upper(p.p_name)
                                  ELSE s.s_name END AS company_name
          FROM supplier s LEFT JOIN part p ON p.p_partkey = s.s_suppkey),
comps AS (SELECT s.s_suppkey AS company_id, s.company_name,
                 concat_ws(' ', s.company_name, coalesce((SELECT string_agg(c, ' ' ORDER BY c) FROM cats0
                                                    WHERE cats0.company_id = s.s_suppkey), '')) AS text
          FROM names s),
techs AS (SELECT min(p_partkey) AS tech_id, p_name AS tech_name,
                 concat_ws(' ', p_name, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2),
                           split_part(p_name, ' ', 1) || 's', 'x' || split_part(p_name, ' ', 2)) AS description
          FROM part GROUP BY p_name),
emb AS (SELECT c.company_id, t.tech_id, list_cosine_similarity(e.embedding::DOUBLE[], te.embedding::DOUBLE[]) AS cos
        FROM comps c JOIN embeddings e ON e.vec_id = c.company_id
        CROSS JOIN techs t JOIN embeddings te ON te.vec_id = t.tech_id),
""" + tfidf_ctes("""SELECT 0 AS side, company_id AS id, text FROM comps
                    UNION ALL SELECT 1 AS side, tech_id AS id, description AS text FROM techs""").strip()[5:] + """,
pr AS (SELECT emb.company_id, emb.tech_id, t.tech_name, t.description, c.text,
              least(1.0, emb.cos + CASE WHEN c.company_name <> '' AND contains(lower(c.company_name), lower(t.tech_name))
                                        THEN 0.5 ELSE 0.0 END) AS embb
       FROM emb JOIN techs t USING (tech_id) JOIN comps c USING (company_id)),
pg AS (SELECT *, max(CASE WHEN embb >= 0.30 THEN 1 ELSE 0 END) OVER (PARTITION BY company_id) AS any_strong
       FROM pr WHERE embb >= 0.20),
lnk AS (SELECT pg.company_id, pg.tech_name AS technology_name FROM pg
        LEFT JOIN sim ON sim.doc_id = pg.company_id AND sim.item_id = pg.tech_id
        WHERE pg.embb >= 0.30 OR (pg.any_strong = 0 AND
              (CASE WHEN coalesce(sim.tfidf, 0) >= 0.28 THEN 1 ELSE 0 END
               + CASE WHEN (SELECT """ + S.token_set("pg.description", "pg.text") + """) / 100.0 >= 0.45 THEN 1 ELSE 0 END) >= 1))
SELECT DISTINCT company_id, technology_name FROM (SELECT * FROM lnk UNION ALL SELECT * FROM direct)
"""


@register("company_links", _COMPANY_SQL)
def company_links(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier -> part-name technology links: category direct links, plus
    embedding (supplier vector vs technology vector of the same id) with the
    name boost, plus gated weak links with TF-IDF / token-set signals."""
    comps = supplier_categories(spark, sf)
    techs = part_name_techs(spark, sf)
    direct = linking.category_direct(comps, techs, 75, 0.40)
    e = table(spark, sf, "embeddings")
    tvec = techs.join(e, techs.tech_id == e.vec_id).select("tech_id", F.col("embedding").alias("vec"))
    named = linking.boost_pairs(comps, "company_id", "company_name", techs, "tech_id", "technology_name")
    emb = similarity.gated_cosine(
        e.select(F.col("vec_id").alias("company_id"), "embedding").join(comps.select("company_id"), "company_id", "left_semi"),
        tvec, named, "company_id", "embedding", "tech_id", "vec", 0.20).withColumnRenamed("score", "emb")
    ctext = comps.select("company_id", "company_name",
                         F.concat_ws(" ", "company_name", F.array_join("categories", " ")).alias("text"))
    tdesc = techs.select("tech_id", F.col("technology_name").alias("tech_name"),
                         F.array_join("keywords", " ").alias("description"))

    def tf(pairs: DataFrame) -> DataFrame:
        return similarity.tfidf_similarity(ctext.select("company_id", "text"),
                                           tdesc.select("tech_id", F.col("description").alias("text")),
                                           entity_id="company_id", pairs=pairs)
    return linking.link_companies(emb, ctext, tdesc, tf, direct, high=0.30, low=0.20, th_tfidf=0.28, th_fuzzy=0.45)


# ------------------------------------------------------------ leaf clusters
_CLUSTER_SQL = """
WITH RECURSIVE pts AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.id AS a, b.id AS b, round(list_distance(a.v, b.v), 9) AS dist FROM pts a JOIN pts b ON a.id <> b.id),
nn AS (SELECT a AS id, arg_min(b, (dist, b)) AS nn_id, min(dist) AS dist FROM d GROUP BY a),
par AS (SELECT x.id, CASE WHEN y.nn_id = x.id AND x.id < x.nn_id THEN x.id ELSE x.nn_id END AS par
        FROM nn x JOIN nn y ON x.nn_id = y.id),
chase(id, cur, step) AS (SELECT id, par, 0 FROM par
        UNION ALL SELECT chase.id, par.par, chase.step + 1 FROM chase JOIN par ON chase.cur = par.id
        WHERE par.par <> chase.cur),
tree AS (SELECT id, arg_max(cur, step) AS tree FROM chase GROUP BY id),
m AS (SELECT ta.tree, min(d.dist) AS m FROM d JOIN tree ta ON d.a = ta.id JOIN tree tb ON d.b = tb.id
      WHERE ta.tree <> tb.tree GROUP BY ta.tree),
lab AS (SELECT nn.id, tree.tree, (m.m IS NOT NULL AND nn.dist < m.m) AS member
        FROM nn JOIN tree USING (id) LEFT JOIN m USING (tree)),
cid AS (SELECT tree, min(id) AS cluster_id FROM lab WHERE member GROUP BY tree),
labels AS (SELECT lab.id AS vec_id, CASE WHEN member THEN cid.cluster_id ELSE -1 END AS cluster_id
           FROM lab LEFT JOIN cid USING (tree))
"""


@register("leaf_clusters", _CLUSTER_SQL + "SELECT vec_id, cluster_id FROM labels")
def leaf_clusters(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return cluster.leaf_clusters(e, "vec_id", "embedding")


@register("cluster_summary", _CLUSTER_SQL + """
SELECT count(DISTINCT cluster_id) AS n_distinct, count(*) FILTER (WHERE cluster_id = -1) AS n_noise,
       max(cluster_id) AS max_label FROM labels
""")
def cluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.cluster_summary(leaf_clusters(spark, sf))


@register("final_tech_list", _CLUSTER_SQL + """
SELECT DISTINCT technology_name FROM (
  SELECT 'cluster ' || cluster_id AS technology_name FROM labels WHERE cluster_id <> -1
  UNION ALL SELECT 'vector ' || vec_id FROM labels WHERE cluster_id = -1)
""")
def final_tech_list(spark: SparkSession, sf: str) -> DataFrame:
    """Named clusters (one name per cluster) united with the noise points."""
    lab = leaf_clusters(spark, sf)
    named = lab.filter(F.col("cluster_id") != -1).select(
        F.concat(F.lit("cluster "), F.col("cluster_id").cast("string")).alias("technology_name"))
    noise = lab.filter(F.col("cluster_id") == -1).select(
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("technology_name"))
    return named.unionByName(noise).distinct()


# ------------------------------------------------------------------- nodes
@register("nodes_technology", f"""
SELECT trim(p_name) AS tech_name,
       array_to_string(list_filter([trim(p_name), trim(arg_min(p_type, p_partkey)), trim(arg_min(p_brand, p_partkey)),
                                    CASE WHEN min(p_partkey) % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE '' END],
                                   lambda x: x <> ''), ' ') AS description
FROM part GROUP BY p_name
""")
def nodes_technology(spark: SparkSession, sf: str) -> DataFrame:
    """Technology nodes: name, definition (type), synonym (brand, in blanks) and
    keywords (the first word or a blank) of every part name."""
    p = table(spark, sf, "part")
    first = p.groupBy("p_name").agg(F.min_by(F.struct("p_type", "p_brand"), "p_partkey").alias("x"), F.min("p_partkey").alias("k"))
    word = F.when(F.col("k") % 2 == 0, F.split("p_name", " ")[0]).otherwise(F.lit("  "))
    defs = first.select(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("technology_name"),
                        F.col("x.p_type").alias("definition"),
                        F.array(F.concat(F.lit(" "), F.col("x.p_brand"), F.lit(" "))).alias("synonyms"), F.array(word).alias("keywords"))
    return graph.technology_nodes(defs).select("description", "tech_name")


@register("nodes_paper", _NESTED_SQL.format(sep="; ", inst="nm") + """
SELECT 'W' || o.o_orderkey AS paper_id,
       CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE 'https://doi.org/10.1/' || o.o_orderkey END AS link,
       trim(o.o_orderpriority) AS title, au.authors, strftime(o.o_orderdate, '%Y-%m-%d') AS pub_date,
       i2.institutions AS institution
FROM au JOIN i2 USING (l_orderkey) JOIN orders o ON o.o_orderkey = au.l_orderkey
""")
def nodes_paper(spark: SparkSession, sf: str) -> DataFrame:
    """Paper nodes from clean (not deduplicated) nested papers."""
    return _paper_nodes(spark, sf)


def _paper_nodes(spark: SparkSession, sf: str) -> DataFrame:
    c = _clean_papers(_raw_papers(spark, sf))
    papers = c.select(F.concat(F.lit("W"), F.col("o_orderkey").cast("string")).alias("id"),
                      F.when(F.col("o_orderstatus") != "P",
                             F.concat(F.lit("https://doi.org/10.1/"), F.col("o_orderkey").cast("string"))).alias("doi"),
                      F.col("o_orderpriority").alias("title"),
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"),
                      "authorships", "institutions")
    return graph.paper_nodes(papers)


_COMPANY_NODES_FROM = """
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@register("nodes_company", """
SELECT 'c-' || c.c_custkey AS company_id, trim(c.c_name) AS company_name,
       CASE WHEN c.c_acctbal < 0 THEN strftime(DATE '2020-01-01' + c.c_nationkey, '%Y-%m-%d')
            ELSE '2021-06-' || lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') END AS founding_date,
       coalesce(nullif(CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_name END, ''),
                nullif(CASE WHEN r.r_name = 'ASIA' THEN '' ELSE r.r_name END, ''), nullif(n.n_name, ''), '') AS location,
       CASE WHEN c.c_mktsegment = 'MACHINERY' OR c.c_acctbal = 0 THEN NULL ELSE c.c_acctbal END AS funding_total_usd,
       lower(c.c_mktsegment) AS funding_stage
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def nodes_company(spark: SparkSession, sf: str) -> DataFrame:
    """Company nodes from nested company records (customers): founded_on is a
    JSON ``{"value": ...}`` text for some and a plain date for others, funding
    0 (machinery) becomes blank."""
    return graph.company_nodes(_raw_companies(spark, sf))


def _raw_companies(spark: SparkSession, sf: str) -> DataFrame:
    x = _locations(table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region"))
    founded = F.when(F.col("c_acctbal") < 0,
                     F.concat(F.lit('{"value": "'),
                              F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd"),
                              F.lit('"}'))) \
        .otherwise(F.concat(F.lit("2021-06-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")))
    props = F.struct(
        F.struct(F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("permalink"),
                 F.col("c_name").alias("value")).alias("identifier"),
        founded.alias("founded_on"), F.col("locs").alias("location_identifiers"),
        F.struct(F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(0.0)).otherwise(F.col("c_acctbal"))
                 .alias("value_usd")).alias("funding_total"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("funding_stage"))
    return x.select(props.alias("properties"))


@register("edge_load", """
SELECT DISTINCT l.l_orderkey AS paper_id, l.l_partkey AS tech_id FROM lineitem l
WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  AND l.l_partkey IN (SELECT p_partkey FROM part)
""")
def edge_load(spark: SparkSession, sf: str) -> DataFrame:
    """Edges (order -> part, repeated per line) loaded against paper nodes
    (finished orders only) and technology nodes: dangling edges vanish,
    repeats merge into one edge."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_partkey").alias("tech_id"))
    papers = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    parts = table(spark, sf, "part")
    return graph.load_edges(li, papers, parts, "paper_id", "tech_id", "o_orderkey", "p_partkey")


# ------------------------------------------------------ normalization jobs
def _greedy_sql(rows: str, threshold: int) -> str:
    """CTEs ``kept(ts, pos)``: the sequential scan over ``rows`` (pos, name), one string once."""
    return f"""
n0 AS ({rows}),
n1 AS (SELECT {S.token_sort('name')} AS ts, min(pos) AS pos FROM n0 GROUP BY 1),
n AS (SELECT ts, pos, row_number() OVER (ORDER BY pos) AS rn FROM n1 WHERE ts <> ''),
scan(rn, kept) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT n.rn, CASE WHEN len(list_filter(scan.kept, lambda x: 200 * {S.lcs('x', 'n.ts')}
                                         >= {threshold} * (length(x) + length(n.ts)))) > 0
                    THEN scan.kept ELSE list_append(scan.kept, n.ts) END
  FROM scan JOIN n ON n.rn = scan.rn + 1),
kept AS (SELECT n.ts, n.pos FROM n WHERE list_contains((SELECT kept FROM scan ORDER BY rn DESC LIMIT 1), n.ts))
"""


@register("normalize_papers", f"""
WITH RECURSIVE p AS (SELECT p_partkey AS pos, 'W' || (p_partkey // 2) AS id, {S.norm("coalesce(' ' || upper(p_name) || '!', '')")} AS title_norm,
            CASE WHEN p_size % 2 = 0 THEN {S.strip("lower(' HTTPS://doi.org/' || p_brand || '/' || p_size || ' ')")} ELSE '' END AS doi_norm
            FROM part),
d AS (SELECT doi_norm, min(pos) AS pos FROM p WHERE doi_norm <> '' GROUP BY doi_norm),
{_greedy_sql("SELECT pos, title_norm AS name FROM p WHERE doi_norm = ''", 85)}
SELECT p.id, p.title_norm, p.doi_norm FROM p WHERE p.pos IN (SELECT pos FROM d) OR p.pos IN (SELECT pos FROM kept)
""")
def normalize_papers(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as papers in key order (two rows share each id): even sizes have a
    DOI and are deduplicated on it, the others fuzzily on the title."""
    p = table(spark, sf, "part")
    names = F.array().cast("array<struct<display_name:string>>")
    clean = p.select(
        F.col("p_partkey").alias("pos"), F.concat(F.lit("W"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("id"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" HTTPS://doi.org/"), F.col("p_brand"), F.lit("/"),
                                                  F.col("p_size").cast("string"), F.lit(" "))).alias("doi"),
        F.concat(F.lit(" "), F.upper("p_name"), F.lit("!")).alias("title"), F.lit("2021-01-01").alias("publication_date"),
        F.lit("").alias("abstract"), *[names.alias(c) for c in ("keywords", "topics", "subfields", "fields")])
    return graph_build.normalize_papers(clean, position="pos").select("id", "title_norm", "doi_norm")


@register("normalize_technologies", f"""
WITH RECURSIVE {_greedy_sql("SELECT p_partkey AS pos, " + S.norm("p_name || CASE WHEN p_partkey % 7 = 0 THEN 's' ELSE '' END")
                            + " AS name FROM part", 90)}
SELECT p_partkey AS first_key, p_name || CASE WHEN p_partkey % 7 = 0 THEN 's' ELSE '' END AS technology_name
FROM part WHERE p_partkey IN (SELECT pos FROM kept)
""")
def normalize_technologies(spark: SparkSession, sf: str) -> DataFrame:
    """Part names, every seventh in the plural, exact then fuzzy (90) dedupe in key order."""
    return graph_build.normalize_technologies(_tech_rows(spark, sf), "first_key").select("first_key", "technology_name")


def _tech_rows(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    plural = F.when(F.col("p_partkey") % 7 == 0, F.lit("s")).otherwise(F.lit(""))
    return p.select(F.col("p_partkey").alias("first_key"), F.concat("p_name", plural).alias("technology_name"))


@register("cleaning_counts", f"""
WITH RECURSIVE {_greedy_sql("SELECT p_partkey AS pos, " + S.norm("p_name || CASE WHEN p_partkey % 7 = 0 THEN 's' ELSE '' END")
                            + " AS name FROM part", 90)}
SELECT (SELECT count(*) FROM part) AS rows_before, (SELECT count(*) FROM kept) AS rows_after
""")
def cleaning_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Technology rows before and after the cleaning step."""
    t = _tech_rows(spark, sf)
    return graph_build.cleaning_counts(t, graph_build.normalize_technologies(t, "first_key"))


# ------------------------------------------------------------ enrichment
@register("enriched_technologies", """
WITH t AS (SELECT p_name AS technology_name, min(p_partkey) AS k FROM part GROUP BY p_name),
r AS (SELECT t.technology_name, p.p_type AS definition, p.p_brand AS brand, k FROM t JOIN part p ON p.p_partkey = t.k WHERE k % 3 <> 0)
SELECT t.technology_name, t.k AS tech_pos, coalesce(r.definition, '') AS definition,
       CASE WHEN r.k % 3 = 1 THEN r.brand || '|' || t.technology_name ELSE '' END AS synonyms,
       CASE WHEN r.k IS NOT NULL THEN r.brand ELSE '' END AS keywords
FROM t LEFT JOIN r USING (technology_name)
""")
def enriched_technologies(spark: SparkSession, sf: str) -> DataFrame:
    """Technologies left-joined with stored replies; a third has none, another
    third answers "I don't know" for the synonyms."""
    p = table(spark, sf, "part")
    t = p.groupBy(F.col("p_name").alias("technology_name")).agg(F.min("p_partkey").alias("tech_pos"))
    js = lambda *c: F.concat(F.lit('["'), F.concat_ws('", "', *c), F.lit('"]'))
    replies = (t.join(p, F.col("tech_pos") == F.col("p_partkey")).where("tech_pos % 3 <> 0")
               .select("technology_name", F.col("p_type").alias("definition"),
                       F.when(F.col("tech_pos") % 3 == 1, js("p_brand", "technology_name"))
                       .otherwise(F.lit("I don't know")).alias("synonyms_reply"), js("p_brand").alias("keywords_reply")))
    out = enrich.enrich(t, replies)
    return out.select("technology_name", "tech_pos", "definition", F.array_join("synonyms", "|").alias("synonyms"),
                      F.array_join("keywords", "|").alias("keywords"))


# ------------------------------------------------- graph-load forms
@register("typed_nodes_paper", _NESTED_SQL.format(sep="; ", inst="nm") + """
SELECT 'W' || o.o_orderkey AS paper_id, len(string_split(au.authors, ';')) AS n_authors,
       array_to_string(list_transform(string_split(au.authors, ';'), lambda x: trim(x)), '|') AS authors,
       strftime(o.o_orderdate, '%Y-%m-%d') AS pub_date,
       array_to_string(list_transform(string_split(i2.institutions, ';'), lambda x: trim(x)), '|') AS institutions
FROM au JOIN i2 USING (l_orderkey) JOIN orders o ON o.o_orderkey = au.l_orderkey
""")
def typed_nodes_paper(spark: SparkSession, sf: str) -> DataFrame:
    """Paper nodes in graph-load form: arrays from ';'-joined text, a typed date."""
    n = graph.typed_paper_nodes(_paper_nodes(spark, sf))
    return n.select("paper_id", F.size("authors").alias("n_authors"), F.array_join("authors", "|").alias("authors"),
                    F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"),
                    F.array_join("institutions", "|").alias("institutions"))


@register("wide_company_labels", "WITH " + _CAT_SQL + """
SELECT s.s_suppkey AS company_id,
       coalesce((SELECT string_agg(technology_name, '; ' ORDER BY technology_name) FROM direct d
                 WHERE d.company_id = s.s_suppkey), '') AS predicted_technology FROM supplier s
""")
def wide_company_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier with its direct technologies in one alphabetical string."""
    comps = supplier_categories(spark, sf)
    links = linking.category_direct(comps, part_name_techs(spark, sf), 75, 0.40)
    return graph.wide_company_labels(comps.select("company_id"), links)


@register("label_rows", """
SELECT p_partkey AS paper_id, unnest(list_filter([p_brand, trim(p_type), CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END],
                                                 lambda x: x <> '')) AS technology_name FROM part
""")
def label_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A ';'-joined label string per part as one row per label, blanks dropped."""
    p = table(spark, sf, "part")
    labels = F.concat_ws("; ", "p_brand", F.concat(F.lit(" "), F.col("p_type")),
                         F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.lit(" ")), F.lit(""))
    return graph.links_from_labels(p.select("p_partkey", labels.alias("labels")), "p_partkey", "labels", "paper_id")


@register("company_summary", """
SELECT 'c-' || c.c_custkey AS company_id, c.c_name || ' | ' || n.n_name || ' | ' ||
       CASE WHEN c.c_acctbal < 0 THEN strftime(DATE '2020-01-01' + c.c_nationkey, '%Y-%m-%d')
            ELSE '2021-06-' || lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') END || ' | ' ||
       CAST(CAST(CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 0 ELSE c.c_acctbal END AS DECIMAL(18,2)) AS VARCHAR) AS summary
""" + _COMPANY_NODES_FROM)
def company_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Name | country | founding date | funding of every company."""
    return graph.company_summary(_raw_companies(spark, sf))


# ----------------------------------------------------------- projections and texts
@register("paper_projection", """
SELECT p_partkey AS id, p_name AS title, '' AS abstract, p_brand || ' ' || p_type AS definition_text,
       'a|' || p_brand AS list_items FROM part
""")
def paper_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted columns that exist are kept, a missing one is added, a list
    literal becomes an array."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), "p_brand", "p_type",
                                        F.col("p_size").alias("unused"))
    lst = F.concat(F.lit("['a', '"), F.col("p_brand"), F.lit("']"))
    x = p.withColumn("list_items", F.array_join(read_list_text(lst), "|"))
    x = x.withColumn("definition_text", F.concat_ws(" ", "p_brand", "p_type"))
    x = project.ensure_column(x, "abstract")
    return project.select_present(x, ["id", "doi", "title", "abstract", "definition_text", "list_items"])


# --------------------------------------------------------- clusters
@register("cluster_members", _CLUSTER_SQL + """
SELECT l.cluster_id, string_agg('v' || l.vec_id, '|' ORDER BY l.vec_id) AS members
FROM labels l WHERE l.cluster_id <> -1 GROUP BY l.cluster_id
""")
def cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """Member names of every cluster, in id order."""
    lab = leaf_clusters(spark, sf)
    names = table(spark, sf, "embeddings").select("vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"))
    return cluster.members_per_cluster(lab, names, "vec_id", "name").select(
        "cluster_id", F.array_join("members", "|").alias("members"))


@register("singleton_clusters", _CLUSTER_SQL + """
SELECT vec_id, CASE WHEN cluster_id <> -1 THEN cluster_id
       ELSE (SELECT max(cluster_id) FROM labels) + row_number() OVER (PARTITION BY cluster_id ORDER BY vec_id) END AS cluster_id
FROM labels
""")
def singleton_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Noise points numbered after the largest cluster, in id order."""
    return cluster.leaf_clusters(table(spark, sf, "embeddings"), "vec_id", "embedding", noise="singleton")


# --------------------------------------------------- partial ratio on whole names
_SHORT_TEXT_SQL = """CASE p_size % 3 WHEN 0 THEN 'x' || replace(p_name, 'e', '') WHEN 1 THEN lower(p_brand) || ' ' || p_name
                     ELSE p_type || ' ' || p_brand END"""


@register("partial_ratio_names", f"""
WITH p AS (SELECT p_partkey AS paper_id, {S.norm(_SHORT_TEXT_SQL)} AS txt, p_brand, p_type FROM part),
t AS (SELECT DISTINCT p_name AS technology_name, {S.norm('p_name')} AS ph FROM part),
pr AS (SELECT x.txt, t.technology_name, t.ph, CASE WHEN length(t.ph) <= length(x.txt) THEN t.ph ELSE x.txt END AS needle,
              CASE WHEN length(t.ph) <= length(x.txt) THEN x.txt ELSE t.ph END AS hay
       FROM (SELECT DISTINCT txt FROM p) x CROSS JOIN t WHERE t.ph <> '' AND x.txt <> ''),
w AS (SELECT DISTINCT needle, unnest(list_transform(range(1, length(hay) - length(needle) + 2), lambda i: substr(hay, i::INT, length(needle)::INT))
             || list_transform(range(1, length(needle)), lambda k: left(hay, k::INT))
             || list_transform(range(1, length(needle)), lambda k: right(hay, k::INT))) AS win, txt, technology_name FROM pr),
sc AS (SELECT needle, win, {S.ratio('needle', 'win')} AS r FROM (SELECT DISTINCT needle, win FROM w)),
hit AS (SELECT DISTINCT w.txt, w.technology_name FROM w JOIN sc USING (needle, win) WHERE sc.r >= 85
        UNION SELECT txt, technology_name FROM pr WHERE contains(txt, ph)),
lk AS (SELECT DISTINCT p.paper_id, hit.technology_name FROM p JOIN hit USING (txt))
SELECT * FROM lk
UNION SELECT paper_id, unnest([p_brand, p_type]) FROM p WHERE paper_id NOT IN (SELECT paper_id FROM lk)
""")
def partial_ratio_names(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with a damaged name, a whole name or no name against all part names:
    phrase or partial ratio >= 85, else the brand and type labels."""
    p = table(spark, sf, "part")
    third = F.col("p_size") % 3
    txt = (F.when(third == 0, F.concat(F.lit("x"), F.replace(F.col("p_name"), F.lit("e"), F.lit(""))))
           .when(third == 1, F.concat_ws(" ", F.lower("p_brand"), "p_name")).otherwise(F.concat_ws(" ", "p_type", "p_brand")))
    papers = p.select(F.col("p_partkey").alias("paper_id"), txt.alias("combined"),
                      F.concat_ws("; ", "p_brand", "p_type").alias("predicted_technology"))
    return linking.link_papers(papers, p.select(F.col("p_name").alias("technology_name")).distinct(), threshold=85)


# ------------------------------------------------------ sinks read again
@register("csv_roundtrip", """
SELECT 'P' || p_partkey AS part_id, p_name || ', "' || p_brand || '"' || chr(10) || p_type AS title, p_brand || '; ' || p_type AS labels,
       CASE WHEN p_size % 10 = 0 THEN '' ELSE p_size::VARCHAR END AS size_text FROM part
""")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes with quotes, commas, newlines, an array and blank zeros, written as
    CSV with chosen columns and read again as text."""
    p = table(spark, sf, "part")
    nodes = p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("part_id"),
                     F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type").alias("title"),
                     F.array("p_brand", "p_type").alias("labels"),
                     F.when(F.col("p_size") % 10 == 0, F.lit(0)).otherwise(F.col("p_size")).alias("size_text"), "p_retailprice")
    path = scratch_path(spark)
    columns = ["part_id", "title", "labels", "size_text"]
    sinks.write_csv(nodes, path, columns=columns, blank_zero=["size_text"])
    return readers.read_graph_table(spark, path, columns)


@register("jsonl_roundtrip", """
SELECT 'c-' || c.c_custkey AS company_id, c.c_name AS company_name, n.n_name AS country,
       CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 0.0 ELSE c.c_acctbal END AS funding
""" + _COMPANY_NODES_FROM)
def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Nested company records written as JSON Lines and read with a declared schema."""
    raw = _raw_companies(spark, sf)
    path = scratch_path(spark)
    sinks.write_jsonl(raw, path)
    back = readers.read_jsonl(spark, path, raw.schema)
    q = "properties"
    country = F.filter(f"{q}.location_identifiers", lambda x: x["location_type"] == "country")[0]["value"]
    return back.select(F.col(f"{q}.identifier.permalink").alias("company_id"), F.col(f"{q}.identifier.value").alias("company_name"),
                       country.alias("country"), F.col(f"{q}.funding_total.value_usd").alias("funding"))


@register("company_csv", """
SELECT c.c_name AS name, 'c-' || c.c_custkey AS permalink, '' AS description
""" + _COMPANY_NODES_FROM)
def company_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The three-column company table; companies have no description here."""
    raw = _raw_companies(spark, sf).select(F.col("properties").withField("description", F.lit(None).cast("string")).alias("properties"))
    return sinks.company_csv(raw).toDF("name", "permalink", "description")


@register("combined_texts", """
SELECT p_partkey, concat_ws(' ', p_name, CASE WHEN p_size % 2 = 0 THEN p_brand END, p_type) AS skipping,
       concat_ws(' ', p_name, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END, p_type) AS keeping,
       p_name || '. ' || CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS described FROM part
""")
def combined_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Joined texts with a missing column skipped, kept as a blank, and as "name. definition"."""
    p = table(spark, sf, "part").withColumn("b", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")))
    return p.select("p_partkey", T.join_skip_nulls("p_name", "b", "p_type").alias("skipping"),
                    T.join_nulls_as_empty("p_name", "b", "p_type").alias("keeping"),
                    T.name_dot_definition("p_name", "b").alias("described"))


@register("category_permalinks", """
SELECT s.s_suppkey AS company_id, coalesce((SELECT string_agg(p_type, '|' ORDER BY l_orderkey, l_linenumber, l_partkey) FROM lineitem l
       JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_suppkey = s.s_suppkey AND p_size % 2 = 0), '') AS categories FROM supplier s
""")
def category_permalinks(spark: SparkSession, sf: str) -> DataFrame:
    """Permalinks of a company's categories in order, blank and missing ones dropped."""
    link = F.when(F.col("p_size") % 2 == 0, F.col("p_type")).when(F.col("p_size") % 3 == 0, F.lit(""))
    items = (table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
             .groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sort_array(F.collect_list(F.struct(
                 "l_orderkey", "l_linenumber", "l_partkey", link.alias("permalink")))).alias("c")))
    out = table(spark, sf, "supplier").select("s_suppkey").join(items, "s_suppkey", "left")
    return out.select(F.col("s_suppkey").alias("company_id"), F.array_join(N.category_permalinks("c"), "|").alias("categories"))


# ------------------------------------------------------------- stored tables
@register("accumulated_years", """
SELECT o_orderkey AS paper_id, o_custkey AS author_id, year(o_orderdate)::INTEGER AS year FROM orders
WHERE year(o_orderdate) < (SELECT max(year(o_orderdate)) FROM orders) OR o_orderkey % 2 = 0
""")
def accumulated_years(spark: SparkSession, sf: str) -> DataFrame:
    """Papers added in three runs of several years each; a fourth run brings the last year again with
    half of its rows, which replaces it.  Read by the last committed manifest."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("paper_id"), F.col("o_custkey").alias("author_id"),
                                          F.year("o_orderdate").alias("year"))
    store = PartitionStore(spark, scratch_path(spark), "year")
    for k in range(3):
        store.put(o.where(F.col("year") % 3 == k))
    last = o.agg(F.max("year")).first()[0]
    store.put(o.where((F.col("year") == last) & (F.col("paper_id") % 2 == 0)))
    return store.read()


@register("enriched_memo", """
SELECT c_custkey AS tech_id, c_name AS technology_name, 'about ' || c_name AS definition, lower(c_name) AS synonyms, '' AS keywords
FROM customer
""")
def enriched_memo(spark: SparkSession, sf: str) -> DataFrame:
    """Technologies enriched through the hook with a memo: a first run for half of the names, a second one for all."""
    def fetch(names):
        n = names["technology_name"]
        return names.assign(definition="about " + n, synonyms_reply='["' + n.str.lower() + '"]', keywords_reply="I don't know")
    techs = table(spark, sf, "customer").select(F.col("c_custkey").alias("tech_id"), F.col("c_name").alias("technology_name"))
    memo = scratch_path(spark)
    enrich.enrich_memo(techs.where("tech_id % 2 = 0"), memo, fetch)
    out = enrich.enrich_memo(techs, memo, fetch)
    return out.select("tech_id", "technology_name", "definition", F.array_join("synonyms", "|").alias("synonyms"),
                      F.array_join("keywords", "|").alias("keywords"))


@register("stored_embeddings", """
SELECT a.vec_id AS vec_id, b.vec_id AS next_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def stored_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings written as binary vectors, read again, and each scored against the next one."""
    e = table(spark, sf, "embeddings")
    path = scratch_path(spark)
    embedding_store.write_embeddings(e, path, "vec_id", "embedding", "given")
    held = embedding_store.read_embeddings(spark, path, "given")
    pairs = held.select(F.col("id").alias("vec_id"), (F.col("id") + 1).alias("next_id"))
    return embedding_store.cosines(pairs, held, held, "vec_id", "next_id").withColumn("score", F.round("score", 6))


@register("json_array_records", ORACLE["jsonl_roundtrip"])
def json_array_records(spark: SparkSession, sf: str) -> DataFrame:
    """Nested company records written as JSON arrays and read with a declared schema."""
    raw = _raw_companies(spark, sf)
    path = scratch_path(spark)
    sinks.write_json_array(raw, path)
    back = readers.read_json(spark, path, raw.schema, lines=False)
    q = "properties"
    country = F.filter(f"{q}.location_identifiers", lambda x: x["location_type"] == "country")[0]["value"]
    return back.select(F.col(f"{q}.identifier.permalink").alias("company_id"), F.col(f"{q}.identifier.value").alias("company_name"),
                       country.alias("country"), F.col(f"{q}.funding_total.value_usd").alias("funding"))


@register("company_snapshot", """
SELECT c.c_name AS company_name, lower(c.c_mktsegment) AS description
""" + _COMPANY_NODES_FROM)
def company_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The stored company snapshot and its projection to name and description."""
    raw = _raw_companies(spark, sf)
    path = scratch_path(spark)
    sinks.write_json_array(raw.select(F.col("properties").withField(
        "short_description", F.trim("properties.funding_stage")).alias("properties")), path)
    return project.rename_company_columns(readers.read_companies(spark, path))


@register("linking_inputs", """
SELECT 'paper' AS kind, 'P' || p_partkey AS name, p_name || ', "' || p_brand || '"' AS detail FROM part
UNION ALL
SELECT 'technology', c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'about ' || c_name END || '/' || lower(c_name)
       || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '|' || lower(c_mktsegment) END FROM customer
""")
def linking_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """The joint loader on written inputs: papers as CSV, technologies as a one-column CSV, definitions as JSON records (a
    third of the names has none, another third no synonyms); each technology with its keyword set."""
    base = scratch_path(spark)
    p = table(spark, sf, "part")
    blank = [c.split()[0] for c in readers.schemas.NORMALIZED_PAPER.replace("\n", " ").split(",")]
    values = {"id": F.concat(F.lit("P"), F.col("p_partkey").cast("string")),
              "title": F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))}
    sinks.write_csv(p.select(*[values.get(c, F.lit("x")).alias(c) for c in blank]), f"{base}/papers")
    c = table(spark, sf, "customer")
    sinks.write_csv(c.select(F.col("c_name").alias("anything")), f"{base}/techs")
    js = lambda *x: F.concat(F.lit('["'), F.concat_ws('", "', *x), F.lit('"]'))
    sinks.write_json_array(c.where("c_custkey % 3 <> 0").select(
        F.col("c_name").alias("Technology Name"), F.concat(F.lit("about "), "c_name").alias("Definition"),
        F.when(F.col("c_custkey") % 3 == 1, js("c_mktsegment", "c_name")).otherwise(F.lit("I don't know")).alias("Synonyms"),
        js("c_mktsegment").alias("Top Domain Keywords")), f"{base}/definitions")
    papers, techs = readers.load_linking_inputs(spark, f"{base}/papers", f"{base}/techs", f"{base}/definitions")
    none = F.array().cast("array<string>")
    words = graph_build.keyword_set(F.col("technology_name"), F.coalesce("synonyms", none), F.coalesce("keywords", none))
    return papers.select(F.lit("paper").alias("kind"), F.col("id").alias("name"), F.col("title").alias("detail")).unionByName(
        techs.select(F.lit("technology").alias("kind"), F.col("technology_name").alias("name"),
                     F.concat_ws("/", "definition", F.array_join(words, "|")).alias("detail")))
