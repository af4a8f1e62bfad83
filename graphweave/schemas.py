"""Declared schemas of the source records (declared once; never inferred).

JSON inference would turn the abstract's inverted index into one struct field
per word, so the map type is declared explicitly.
"""

from __future__ import annotations

RAW_PAPER = """
id STRING, doi STRING, title STRING, publication_date STRING, cited_by_count BIGINT,
authorships ARRAY<STRUCT<author_position: STRING,
    author: STRUCT<display_name: STRING, orcid: STRING>,
    institutions: ARRAY<STRUCT<id: STRING, display_name: STRING, ror: STRING, country_code: STRING,
                               type: STRING, lineage: ARRAY<STRING>>>>>,
keywords ARRAY<STRUCT<id: STRING, display_name: STRING, score: DOUBLE>>,
topics ARRAY<STRUCT<display_name: STRING, score: DOUBLE,
    subfield: STRUCT<id: STRING, display_name: STRING>,
    field: STRUCT<id: STRING, display_name: STRING>,
    domain: STRUCT<id: STRING, display_name: STRING>>>,
abstract_inverted_index MAP<STRING, ARRAY<INT>>
"""

RAW_COMPANY = """
properties STRUCT<
  identifier: STRUCT<permalink: STRING, value: STRING>, short_description: STRING, description: STRING,
  website: STRING, company_type: STRING,
  location_identifiers: ARRAY<STRUCT<uuid: STRING, value: STRING, location_type: STRING>>,
  funding_total: STRUCT<value_usd: DOUBLE>, equity_funding_total: STRUCT<value_usd: DOUBLE>,
  founded_on: STRING, funding_stage: STRING,
  category_groups: ARRAY<STRUCT<permalink: STRING>>, categories: ARRAY<STRUCT<permalink: STRING>>>
"""

TECH_DEFINITIONS_FILE = """
`Technology Name` STRING, Definition STRING, Synonyms STRING, `Top Domain Keywords` STRING
"""

NORMALIZED_PAPER = """
id STRING, doi STRING, doi_norm STRING, title STRING, title_norm STRING, publication_date STRING, abstract STRING,
keywords_flat STRING, topics_flat STRING, subfields_flat STRING, fields_flat STRING
"""

LINKS_PAPER = "paper_id STRING, technology_name STRING"
LINKS_COMPANY = "company_id STRING, technology_name STRING"
