"""Registered queries of the training-data operators and their SQL forms.

Every query applies its operator to the whole of its table and derives the
columns that its contract names from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.llm import (
    conversation_repair, importance, license_scan, line_dedup, near_dedup, packing, quality, secret_scan,
    sentencepiece_codec, sharding, token_counts, topk, url_filter,
)
from graphweave.llm.common import materialise, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that five or more documents share go, except from the largest doc_id."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE["op3_line_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT rid, doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, (s.key IS NOT NULL AND k.doc_id <> s.keeper) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""


N_SHARDS = 24


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near-equal bytes through 4,096 virtual slots: the first version of the map is stored,
    edited for balance, and the stored second one used."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slotted = materialise(sharding.with_slots(docs))
    sums = sharding.slot_sums(slotted)
    slot_map = sharding.rebalanced(spark, scratch_path(spark), sums, N_SHARDS)
    return sharding.assign(slotted, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "v_slot", F.col("version").alias("map_version"))


@_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (5-word shingles, Jaccard 0.85)."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


BYTE_BPE = "byte_bpe_50k.json"


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2,048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), _tokenizer(BYTE_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@_query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by overlapping chunks."""
    out = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), _tokenizer(BYTE_BPE))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"),
                      "n_chunks", "n_widened")


PIECE_MODEL = "piece_bpe_32k.model"


@_query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document (with an end id), their cover of the text, and the text decoded again."""
    out = sentencepiece_codec.encode_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"), _tokenizer(PIECE_MODEL),
        outputs=("ids", "ends", "decoded"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"),
                      F.element_at("ends", -1).cast("long").alias("covered_bytes"))


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and adaptive rules per language and source on every document."""
    out = quality.verdicts(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "max_symbols", "max_dup_lines", "max_length", "min_length", "max_bangs", "max_stutter")


ORACLE["op5_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
e AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT rid, words, unnest(range(1, len(words) - 6)) AS p FROM e WHERE len(words) >= 8),
k AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, list_slice(words, p, p + 7)) AS c FROM p),
g AS (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nx FROM k WHERE c >= 2),
r AS (SELECT rid, sum(least(8, coalesce(nx - p, 8)))::BIGINT AS n FROM g GROUP BY rid),
m AS (SELECT e.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
             length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_bangs,
             len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1]))::BIGINT AS n_stutter, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM e LEFT JOIN r ON e.rid = r.rid),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
             1000 * n_symbols // greatest(n_words, 1) AS v_symbols,
             1000 * n_dup_lines // greatest(n_lines, 1) AS v_dup_lines,
             100 * word_chars // greatest(n_words, 1) AS v_length,
             1000 * n_bangs // greatest(n_words, 1) AS v_bangs,
             1000 * n_stutter // greatest(n_words, 1) AS v_stutter FROM m),
u AS (SELECT lang, source, 'symbols' AS rule, v_symbols AS v FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'dup_lines', v_dup_lines FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'length', v_length FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'bangs', v_bangs FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'stutter', v_stutter FROM b WHERE NOT base_failed),
s AS (SELECT lang, source, rule, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END
             AS bucket FROM u),
x AS (SELECT 'g' AS lvl, lang, source, rule, bucket FROM s UNION ALL SELECT 'l', lang, NULL, rule, bucket FROM s
      UNION ALL SELECT 'a', NULL, NULL, rule, bucket FROM s),
c AS (SELECT lvl, lang, source, rule, bucket, count(*) AS c FROM x GROUP BY ALL),
w AS (SELECT *, sum(c) OVER (PARTITION BY lvl, lang, source, rule) AS n,
             sum(c) OVER (PARTITION BY lvl, lang, source, rule ORDER BY bucket) AS cum FROM c),
q AS (SELECT lvl, lang, source, rule, max(n) AS n, min(bucket) FILTER (100 * cum >= 25 * n) AS q1,
             min(bucket) FILTER (100 * cum >= 50 * n) AS q2, min(bucket) FILTER (100 * cum >= 75 * n) AS q3
      FROM w GROUP BY lvl, lang, source, rule),
h AS (SELECT *, 4 * greatest(q3 - q1, CASE rule WHEN 'dup_lines' THEN 100 WHEN 'length' THEN 50
                             WHEN 'stutter' THEN 25 ELSE 20 END) AS sp FROM q),
f AS (SELECT lvl, lang, source, rule, n, (q2 + sp)::BIGINT AS hi, greatest(q2 - sp, 0)::BIGINT AS lo FROM h),
md AS (SELECT rule, quantile_disc(hi, 0.5)::BIGINT AS median FROM f WHERE lvl = 'g' GROUP BY rule),
j AS (SELECT g.lang, g.source, g.rule,
             least((g.n * g.hi + 200 * least((l.n * l.hi + 200 * a.hi) // (l.n + 200), 2 * median)) // (g.n + 200), 2 * median)::BIGINT AS hi,
             ((g.n * g.lo + 200 * ((l.n * l.lo + 200 * a.lo) // (l.n + 200))) // (g.n + 200))::BIGINT AS lo
      FROM f g JOIN f l ON g.lvl = 'g' AND l.lvl = 'l' AND g.lang IS NOT DISTINCT FROM l.lang AND g.rule = l.rule
      JOIN f a ON a.lvl = 'a' AND a.rule = g.rule JOIN md ON md.rule = g.rule),
t AS (SELECT lang, source, max(hi) FILTER (rule = 'symbols') AS max_symbols,
             max(hi) FILTER (rule = 'dup_lines') AS max_dup_lines, max(hi) FILTER (rule = 'length') AS max_length,
             max(lo) FILTER (rule = 'length') AS min_length, max(hi) FILTER (rule = 'bangs') AS max_bangs,
             max(hi) FILTER (rule = 'stutter') AS max_stutter FROM j GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND coalesce(v_symbols <= max_symbols AND v_dup_lines <= max_dup_lines
        AND v_length <= max_length AND v_length >= min_length
        AND v_bangs <= max_bangs AND v_stutter <= max_stutter, false)) AS kept,
       max_symbols, max_dup_lines, max_length, min_length, max_bangs, max_stutter
FROM b LEFT JOIN t ON b.lang IS NOT DISTINCT FROM t.lang AND b.source IS NOT DISTINCT FROM t.source
"""


@_query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others."""
    return topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, 20)


ORACLE["op6_topk"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@_query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and texts in all documents: lines, paragraphs and whole texts with their best template."""
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _license_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(a)}, {quote(b)}, {quote(c)})" for a, b, c in license_scan.TEMPLATES)
    gap = license_scan.GAP.replace("'", "''")
    norm = (f"regexp_replace(translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{gap}', ' ', 'g')")
    return f"""
WITH RECURSIVE tpl(template, spdx, body) AS (VALUES {rows}),
tw AS (SELECT template, spdx, list_filter(string_split(replace({norm % 'body'}, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM tpl),
tg AS (SELECT template, spdx, len(w) - 1 AS n_template, unnest(list_zip(w[:-2], w[2:])) AS g FROM tw),
tn AS (SELECT *, row_number() OVER (PARTITION BY template, g) AS rep FROM tg),
tk AS (SELECT template, spdx, n_template, g, count(*) AS k, 120 * n_template // 80 AS longest,
              ceil(80 * (ceil(80 * n_template / 120) + n_template) / 200) AS least FROM tg GROUP BY ALL),
d AS (SELECT row_number() OVER () AS tid, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
l0 AS (SELECT tid, string_split({norm % 'text'}, chr(10)) AS lines FROM d),
l AS (SELECT tid, trim(unnest(lines)) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM l0),
b AS (SELECT *, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY tid ORDER BY pos) AS grp FROM l),
p AS (SELECT tid, grp, min(pos) AS f, max(pos) AS t, string_agg(line, ' ' ORDER BY pos) AS body
      FROM b WHERE line <> '' GROUP BY ALL),
u AS (SELECT tid, 'line' AS kind, pos AS f, pos AS t, line AS body FROM l
      UNION ALL SELECT tid, 'paragraph', f, t, body FROM p WHERE t > f
      UNION ALL SELECT tid, 'text', min(f), max(t), string_agg(body, ' ' ORDER BY f) FROM p
                GROUP BY tid HAVING count(*) > 1),
uw AS (SELECT * EXCLUDE (body), list_filter(string_split(body, ' '), lambda x: x <> '') AS w FROM u),
uf AS (SELECT *, len(w) - 1 AS n_unit FROM uw WHERE len(w) > 1 AND EXISTS (
       SELECT 1 FROM (SELECT DISTINCT n_template FROM tg) z
       WHERE 120 * least(n_template, len(w) - 1) >= 80 * greatest(n_template, len(w) - 1))),
ug AS (SELECT tid, kind, f, t, n_unit, unnest(list_zip(w[:-2], w[2:])) AS g FROM uf),
un AS (SELECT *, row_number() OVER (PARTITION BY tid, kind, f, t, g) AS rep FROM ug),
m AS (SELECT tid, kind, f, t, n_unit, template, spdx, n_template, count(*) AS shared
      FROM un JOIN tn USING (g, rep) GROUP BY ALL),
r AS (SELECT *, 2.0::DOUBLE * shared / (n_unit + n_template) AS dice, row_number() OVER (PARTITION BY tid, kind, f, t
             ORDER BY 2.0::DOUBLE * shared / (n_unit + n_template) DESC, template) AS rn
      FROM m WHERE 200 * shared >= 80 * (n_unit + n_template)),
w1 AS (SELECT tid, pos AS line, list_filter(string_split(line, ' '), lambda x: x <> '') AS ws FROM l WHERE line <> ''),
w2 AS (SELECT tid, line, len(ws) - 1 AS n_line, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w1),
w3 AS (SELECT tid, line AS la, n_line, lead(line) OVER o AS lb, w, lead(w) OVER o AS v, row_number() OVER o AS pos
       FROM w2 WINDOW o AS (PARTITION BY tid ORDER BY line, i)),
h0 AS (SELECT w3.tid, la, lb, n_line, pos, tk.*, row_number() OVER (PARTITION BY tid, template, tk.g ORDER BY pos) AS occ
       FROM w3 JOIN tk ON tk.g = (w3.w, w3.v) WHERE w3.v IS NOT NULL),
h1 AS (SELECT x.*, y.pos AS before FROM (SELECT * FROM h0 QUALIFY count(*) OVER (PARTITION BY tid, template) >= least) x
       LEFT JOIN h0 y ON x.tid = y.tid AND x.template = y.template AND x.g = y.g AND y.occ = x.occ - x.k),
e AS (SELECT s.tid, s.template, s.spdx, s.n_template, s.n_line, s.pos AS s, z.pos AS e, s.la AS f, z.lb AS t, z.pos - s.pos + 1 AS n_unit,
             row_number() OVER (PARTITION BY s.tid, s.template, s.pos ORDER BY z.pos) AS shared
      FROM h1 s JOIN h1 z ON s.tid = z.tid AND s.template = z.template AND z.pos >= s.pos AND z.pos < s.pos + s.longest
                         AND (z.before IS NULL OR z.before < s.pos)),
c AS (SELECT *, 2.0::DOUBLE * shared / (n_unit + n_template) AS dice FROM e
      WHERE 200 * shared >= 80 * (n_unit + n_template) AND NOT (f = t AND n_line <= n_template AND 120 * n_line >= 80 * n_template)
      QUALIFY row_number() OVER (PARTITION BY tid, template, s ORDER BY 2.0::DOUBLE * shared / (n_unit + n_template) DESC, n_unit DESC) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY dice DESC, n_unit DESC, template, s) AS rk FROM c),
pick AS (SELECT DISTINCT tid, 0::BIGINT AS rk, [] :: STRUCT(a BIGINT, b BIGINT)[] AS kept, false AS taken FROM o
         UNION ALL
         SELECT q.tid, q.rk, CASE WHEN q.free THEN list_append(q.kept, {{'a': q.s, 'b': q.e}}) ELSE q.kept END, q.free FROM (
             SELECT o.tid, o.rk, o.s, o.e, kept, len(list_filter(kept, lambda x: x.a <= o.e AND x.b >= o.s)) = 0 AS free
             FROM pick JOIN o ON o.tid = pick.tid AND o.rk = pick.rk + 1) q),
win AS (SELECT o.* FROM o JOIN pick USING (tid, rk) WHERE taken AND NOT EXISTS (
            SELECT 1 FROM r WHERE rn = 1 AND r.tid = o.tid AND r.f <= o.f AND r.t >= o.t)),
res AS (SELECT tid, kind, f, t, spdx, template, shared, n_unit, n_template, dice FROM r WHERE rn = 1
        UNION ALL SELECT tid, 'window', f, t, spdx, template, shared, n_unit, n_template, dice FROM win)
SELECT doc_id, kind, f::INTEGER AS first_line, t::INTEGER AS last_line, spdx, template, shared, n_unit, n_template, dice
FROM res JOIN d USING (tid)
"""


ORACLE["op1_license_scan"] = _license_sql()


@_query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret candidates of all documents and the forest's verdict on each."""
    out = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("id").cast("long").alias("doc_id"), "start", "end", "rule",
                      F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


@_query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by importance towards the distribution of the benchmark texts."""
    return importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark").select("text"))


# crc32 of the UTF-8 bytes of a word, from the eight-step rule for a byte
_CRC_SQL = """
crc_table AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN (c & 1) = 1
              THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i))"""


def _crc_of(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode({text})) + 1),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


ORACLE["op11_importance_resampling"] = r"""
WITH """ + _CRC_SQL.strip() + r""",
d0 AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
d1 AS (SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d0),
b1 AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT rid, unnest(words) AS w FROM d1),
bw AS (SELECT unnest(words) AS w FROM b1),
v AS (SELECT w, """ + _crc_of("w") + r""" % 10000 AS bucket
      FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc_table),
db AS (SELECT rid, bucket FROM dw JOIN v USING (w)),
s AS (SELECT bucket, count(*) AS s FROM db GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN v USING (w) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM db) AS s_all, (SELECT count(*) FROM bw) AS t_all),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), n),
w AS (SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS total FROM db JOIN g USING (bucket) GROUP BY rid),
x AS (SELECT rid, doc_id, coalesce(n_features, 0)::BIGINT AS n_features,
             coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
      FROM d1 LEFT JOIN w USING (rid)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM x),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, rid) AS rn, count(*) OVER () AS n
      FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rn <= 10 * n // 100 THEN rn END AS rank FROM y LEFT JOIN r USING (rid)
"""


# The rules of the query, as (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


ORACLE["op12_url_filters"] = """
WITH rules(r_host, r_path, r_verdict) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + """),
p AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
u AS (SELECT rid, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT rid, r_host || r_path AS rule, r_verdict, row_number() OVER (PARTITION BY rid ORDER BY length(r_host || r_path) DESC) AS rn
      FROM u JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.rid = m.rid AND rn = 1
"""


@_query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


ORACLE["op13_conversation_repair"] = r"""
WITH RECURSIVE """ + _CRC_SQL.strip() + r""",
c0 AS (SELECT conv_id, turn, coalesce('v' || conv_id::VARCHAR, 'n') AS ck, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
c1 AS (SELECT c0.*, """ + _crc_of("k") + r""" % 20 AS d FROM c0, crc_table),
c2 AS (SELECT ck, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
              CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
              unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM c1 WHERE d <> 0),
c3 AS (SELECT ck, turn, role, text, substr(role, 1, 1) AS x, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
              row_number() OVER (PARTITION BY ck ORDER BY turn NULLS FIRST, role, text) AS i FROM c2),
c4 AS (SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 AS again,
              lead(x) OVER (PARTITION BY ck ORDER BY i) AS y FROM c3),
c AS (SELECT *, NOT blank AND again AS dup, NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM c4),
facts AS (SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank)::BIGINT AS blank,
                 count(*) FILTER (dup)::BIGINT AS duplicate, count(*) FILTER (cut)::BIGINT AS truncated,
                 count(*) FILTER (y IS NOT NULL AND x || y NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, max(i) AS n FROM c GROUP BY ck),
nx(q, role, q2) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
ins AS (SELECT q, 0 AS cost, '' AS letters, [] :: VARCHAR[] AS lines, q AS q2 FROM nx
        UNION ALL SELECT q, 3, 'I', [role || ':'], q2 FROM nx
        UNION ALL SELECT a.q, 6, 'II', [a.role || ':', b.role || ':'], b.q2 FROM nx a JOIN nx b ON a.q2 = b.q),
walk AS (
  SELECT ck, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, [] :: VARCHAR[] AS lines FROM facts
  UNION ALL
  SELECT ck, i, q, best.cost, best.audit, best.lines FROM (
    SELECT ck, i, q, min({'cost': cost, 'audit': audit, 'lines': lines}) AS best FROM (
      SELECT w.ck, c.i, e.q2 AS q, w.cost + n.cost + e.cost AS cost, w.audit || n.letters || e.letter AS audit,
             list_concat(list_concat(w.lines, n.lines), e.lines) AS lines
      FROM walk w JOIN c ON c.ck = w.ck AND c.i = w.i + 1 JOIN ins n ON n.q = w.q JOIN nx ON nx.q = n.q2,
      LATERAL (SELECT 'D' AS letter, 4 AS cost, [] :: VARCHAR[] AS lines, nx.q AS q2
               UNION ALL SELECT 'R', 3 + 3 * c.cut::INT, [nx.role || ':' || c.text], nx.q2 WHERE NOT c.blank AND NOT c.dup
               UNION ALL SELECT 'K', 3 * c.cut::INT, [c.role || ':' || c.text],
                                CASE c.x WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
                         WHERE NOT c.blank AND NOT c.dup AND (c.x = substr(nx.role, 1, 1) OR (c.x = 's' AND nx.q = 0))) e)
    GROUP BY ck, i, q)),
fin AS (SELECT ck, min({'cost': w.cost + n.cost, 'audit': w.audit || n.letters, 'lines': list_concat(w.lines, n.lines)}) AS best
        FROM walk w JOIN facts f USING (ck) JOIN ins n ON n.q = w.q WHERE w.i = f.n AND n.q2 IN (0, 3) GROUP BY ck)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(fin.best.cost, 0)::BIGINT AS cost,
       coalesce(fin.best.audit, '') AS audit, sha256(coalesce(array_to_string(fin.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, ck FROM c0) o LEFT JOIN facts USING (ck) LEFT JOIN fin USING (ck)
"""
