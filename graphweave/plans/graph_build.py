"""The whole linking job as one composition of DataFrame functions.

Inputs are the typed source tables (raw papers, raw companies, technology
list, technology definitions, embeddings); outputs are node and edge tables.
Technologies are normalized and enriched before they are used.  Iterative and
reused steps are stored in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.nested import category_permalinks
from ..operators import dedupe, enrich, graph, linking, similarity
from ..operators.common import stored
from ..streaming.paper_stream import clean_papers


# Gates of the two decisions; everything that depends on them is derived.
PAPER_GATES = {"high": 0.61, "low": 0.35, "th_tfidf": 0.35, "th_fuzzy": 0.60, "title_factor": 0.3}
COMPANY_GATES = {"high": 0.49, "low": 0.35, "th_tfidf": 0.28, "th_fuzzy": 0.45, "name_boost": 0.50}


@dataclass
class GraphTables:
    technology_nodes: DataFrame
    paper_nodes: DataFrame
    company_nodes: DataFrame
    paper_links: DataFrame
    company_links: DataFrame
    company_paper_links: DataFrame


def normalize_papers(clean: DataFrame, fuzzy_threshold: int = 85, position: str | None = None) -> DataFrame:
    """Flattened, normalized papers: exact dedupe on DOI, greedy fuzzy dedupe
    on titles among the papers without DOI.  The first row in reading order wins:
    ``position`` names a column that holds it, else the order of the input is numbered.
    """
    if position is None:
        clean, position = dedupe.with_position(clean), "row_pos"
    p = clean.select(
        position, "id", "doi", "title", T.coerce_date("publication_date").alias("publication_date"),
        F.coalesce("abstract", F.lit("")).alias("abstract"),
        T.flatten_names("keywords").alias("keywords_flat"), T.flatten_names("topics").alias("topics_flat"),
        T.flatten_names("subfields").alias("subfields_flat"), T.flatten_names("fields").alias("fields_flat"),
        T.normalize_text(F.coalesce("title", F.lit(""))).alias("title_norm"), T.normalize_doi("doi").alias("doi_norm"))
    p = p.filter((F.col("title_norm") != "") | (F.col("doi_norm") != ""))
    with_doi = dedupe.keep_first(p.filter(F.col("doi_norm") != ""), F.col("doi_norm"), position)
    no_doi = p.filter(F.col("doi_norm") == "")
    kept = dedupe.greedy_fuzzy_dedupe(no_doi, "id", position, "title_norm", fuzzy_threshold)
    return with_doi.unionByName(kept).drop(position)


def normalize_technologies(techs: DataFrame, order_col: str, fuzzy_threshold: int = 90) -> DataFrame:
    """Technologies without empty names, deduplicated on the normalized name, exactly and then fuzzily."""
    t = techs.withColumn("tech_norm", T.normalize_text("technology_name")).where("tech_norm <> ''")
    exact = dedupe.keep_first(t, F.col("tech_norm"), order_col)
    return dedupe.greedy_fuzzy_dedupe(exact, order_col, order_col, "tech_norm", fuzzy_threshold).drop("tech_norm")


def cleaning_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_before, rows_after) of a cleaning step."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return (before.select(one.alias("b"), none.alias("a")).unionByName(after.select(none.alias("b"), one.alias("a")))
            .agg(F.coalesce(F.sum("b"), none).alias("rows_before"), F.coalesce(F.sum("a"), none).alias("rows_after")))


def keyword_set(name, synonyms, keywords):
    """Distinct lower-cased {name} + synonyms + keywords: the set every keyword share divides by."""
    return F.array_distinct(F.transform(F.concat(F.array(name), synonyms, keywords), F.lower))


def build(raw_papers: DataFrame, raw_companies: DataFrame, techs: DataFrame,
          paper_emb: DataFrame, company_emb: DataFrame, tech_emb: DataFrame,
          definitions: DataFrame | None = None) -> GraphTables:
    """techs: tech_id, tech_pos, technology_name and, unless ``definitions`` (technology_name,
    definition, synonyms, keywords) is given, definition, synonyms, keywords.
    *_emb: (id, embedding) with ids paper id / company id / tech_id."""
    techs = normalize_technologies(techs, "tech_pos")
    if definitions is not None:
        techs = enrich.enrich(techs, definitions)
    techs = stored(techs)
    clean = clean_papers(raw_papers)
    papers = normalize_papers(clean)
    papers = papers.withColumn("combined", T.join_skip_nulls(
        "title", "abstract", "title_norm", "keywords_flat", "topics_flat", "subfields_flat", "fields_flat"))
    tdesc = techs.select("tech_id", "tech_pos", F.col("technology_name").alias("tech_name"),
                         F.array_join(F.filter(F.concat(F.array("technology_name", "definition"), "synonyms", "keywords"),
                                               lambda x: x != ""), " ").alias("description"),
                         keyword_set(F.col("technology_name"), F.col("synonyms"), F.col("keywords")).alias("keywords"))
    names = tdesc.select("tech_id", "tech_name")
    papers = stored(papers)
    ents = papers.select(F.col("id").alias("entity_id"), F.col("combined").alias("text"), F.col("title_norm").alias("title"))
    boosted = linking.boost_pairs(ents, "entity_id", "title", names, "tech_id", "tech_name")
    pe = similarity.gated_cosine(paper_emb.withColumnRenamed("id", "entity_id"), tech_emb, boosted, "entity_id",
                                 "embedding", "tech_id", "embedding", PAPER_GATES["low"]).withColumnRenamed("score", "emb")

    def tf(pairs: DataFrame) -> DataFrame:
        return similarity.tfidf_similarity(ents.select("entity_id", "text"),
                                           tdesc.select("tech_id", F.col("description").alias("text")), pairs=pairs)
    kw = similarity.keyword_overlap(papers.select(F.col("id").alias("entity_id"), T.split_set("keywords_flat").alias("keywords")),
                                    tdesc.select("tech_id", "keywords"), "entity_id", "tech_id")
    labels = linking.classify_multi(pe, ents, tdesc, tf, kw, **PAPER_GATES)
    classified = papers.join(labels.withColumnRenamed("entity_id", "id"), "id", "left")
    paper_links = linking.link_papers(
        classified.select(F.col("id").alias("paper_id"),
                          T.join_nulls_as_empty("keywords_flat", "topics_flat", "subfields_flat", "fields_flat",
                                                "title", "abstract").alias("combined"), "predicted_technology"),
        techs.select("technology_name"))
    comps = raw_companies.select(F.col("properties.identifier.permalink").alias("company_id"),
                                 F.col("properties.identifier.value").alias("company_name"),
                                 F.col("properties.description").alias("description"),
                                 category_permalinks("properties.categories").alias("categories"))
    comps = comps.withColumn("text", F.concat_ws(" ", F.coalesce("company_name", F.lit("")),
                                                 F.coalesce("description", F.lit("")), F.array_join("categories", " ")))
    direct = linking.category_direct(comps, tdesc.select(F.col("tech_name").alias("technology_name"), "keywords"))
    named = linking.boost_pairs(comps, "company_id", "company_name", names, "tech_id", "tech_name")
    ce = similarity.gated_cosine(company_emb.withColumnRenamed("id", "company_id"), tech_emb, named, "company_id",
                                 "embedding", "tech_id", "embedding", COMPANY_GATES["low"]).withColumnRenamed("score", "emb")

    def ctf(pairs: DataFrame) -> DataFrame:
        return similarity.tfidf_similarity(comps.select("company_id", "text"),
                                           tdesc.select("tech_id", F.col("description").alias("text")),
                                           entity_id="company_id", pairs=pairs)
    company_links = linking.link_companies(ce, comps, tdesc, ctf, direct, **COMPANY_GATES)
    bridge = linking.company_paper_links(company_links, paper_links)
    tech_nodes = graph.technology_nodes(techs)
    paper_nodes = graph.paper_nodes(clean)
    company_nodes = graph.company_nodes(raw_companies)
    return GraphTables(tech_nodes, paper_nodes, company_nodes, paper_links, company_links, bridge)
