"""Graph node and edge tables (for bulk import into a graph store)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nested import first_location, first_of_type, struct_or_text_value
from ..functions.text import blank_trim, join_display_names, split_or_empty, strip, to_date_or_null
from .dedupe import merge_edges


def technology_nodes(defs: DataFrame) -> DataFrame:
    """(tech_name, description): name, definition, synonyms and keywords, each
    stripped, blanks dropped, joined by one blank."""
    name = blank_trim("technology_name")
    parts = F.concat(F.array(name, blank_trim("definition")),
                     F.transform(F.coalesce(F.col("synonyms"), F.array().cast("array<string>")), blank_trim),
                     F.transform(F.coalesce(F.col("keywords"), F.array().cast("array<string>")), blank_trim))
    kept = F.filter(parts, lambda x: x != "")
    desc = F.when(name == "", F.array_join(F.concat(F.array(F.lit("")), kept), " ")).otherwise(F.array_join(kept, " "))
    return defs.select(name.alias("tech_name"), desc.alias("description"))


def paper_nodes(papers: DataFrame) -> DataFrame:
    """(paper_id, link, title, authors, pub_date, institution) from clean papers."""
    return papers.select(blank_trim("id").alias("paper_id"), blank_trim("doi").alias("link"),
                         blank_trim("title").alias("title"), join_display_names("authorships").alias("authors"),
                         blank_trim("publication_date").alias("pub_date"),
                         join_display_names("institutions").alias("institution"))


def company_nodes(companies: DataFrame) -> DataFrame:
    """(company_id, company_name, founding_date, location, funding_total_usd, funding_stage)."""
    p = "properties"
    fund = F.col(f"{p}.funding_total.value_usd")
    return companies.select(
        blank_trim(f"{p}.identifier.permalink").alias("company_id"),
        blank_trim(f"{p}.identifier.value").alias("company_name"),
        struct_or_text_value(f"{p}.founded_on").alias("founding_date"),
        first_location(f"{p}.location_identifiers").alias("location"),
        F.when(fund != 0, fund).alias("funding_total_usd"),
        blank_trim(f"{p}.funding_stage").alias("funding_stage"))


def typed_paper_nodes(nodes: DataFrame) -> DataFrame:
    """Graph-load form: arrays from ';'-joined text, pub_date as DATE."""
    return nodes.select("paper_id", "link", "title", split_or_empty("authors").alias("authors"),
                        to_date_or_null("pub_date").alias("pub_date"),
                        split_or_empty("institution").alias("institutions"))


def load_edges(edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame, src: str, dst: str,
               src_key: str, dst_key: str, existing: DataFrame | None = None) -> DataFrame:
    """Edges whose both ends exist (unmatched edges vanish), one per pair, none
    already present: two semi-joins + an idempotent merge."""
    e = (edges.join(src_nodes.select(F.col(src_key).alias(src)).distinct(), src, "left_semi")
         .join(dst_nodes.select(F.col(dst_key).alias(dst)).distinct(), dst, "left_semi"))
    return merge_edges(e, existing, src, dst)


def links_from_labels(df: DataFrame, id_col: str, labels_col: str, out_id: str) -> DataFrame:
    """Long link table from a ';'-joined label column (stripped, blanks dropped)."""
    return df.select(F.col(id_col).alias(out_id),
                     F.explode(F.filter(F.transform(F.split(F.coalesce(F.col(labels_col), F.lit("")), ";"), strip),
                                        lambda x: x != "")).alias("technology_name"))


def wide_company_labels(companies: DataFrame, links: DataFrame, id_col: str = "company_id") -> DataFrame:
    """Every company with its linked technologies as one string, in alphabetical
    order joined by '; '; '' for a company without a link."""
    names = links.groupBy(id_col).agg(F.array_join(F.sort_array(F.collect_set("technology_name")), "; ").alias("__l"))
    return (companies.join(names, id_col, "left")
            .select(*companies.columns, F.coalesce("__l", F.lit("")).alias("predicted_technology")))


def company_summary(companies: DataFrame) -> DataFrame:
    """One line per nested company record: name | country | founding date | funding."""
    p = "properties"
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    country = first_of_type(F.col(f"{p}.location_identifiers"), "country")
    return companies.select(
        F.col(f"{p}.identifier.permalink").alias("company_id"),
        F.concat_ws(" | ", blank(F.col(f"{p}.identifier.value")), blank(country),
                    struct_or_text_value(f"{p}.founded_on"),
                    blank(F.col(f"{p}.funding_total.value_usd").cast("decimal(18,2)"))).alias("summary"))
