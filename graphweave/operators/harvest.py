"""Source-side selection re-expressed on tables: top works per year, top
companies by funding, and the company search predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int, require: Column | None = None,
                  rank_col: str = "rank") -> DataFrame:
    """At most ``k`` rows per ``group`` by ``order`` (a feature limit: a top-k
    report), rows failing ``require`` dropped first.  ``row_number() <= k`` over
    a window lets Spark insert a partial WindowGroupLimit before the shuffle,
    so each map task forwards at most ``k`` rows per group even for a group
    holding a third of all rows."""
    if require is not None:
        df = df.filter(require)
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_works_per_year(works: DataFrame, year: Column, citations: str, id_col: str,
                       has_abstract: Column, k: int = 1000) -> DataFrame:
    """Top-``k`` most cited works per year among those with an abstract; ties by id."""
    return top_per_group(works.withColumn("year", year), "year",
                         [F.desc(citations), F.asc(id_col)], k, require=has_abstract)


def company_search(companies: DataFrame, founded: Column, founded_from: str, stage: Column,
                   stages: list[str], location_hit: Column, funding: Column, id_col: str,
                   limit: int = 800) -> DataFrame:
    """Companies founded on/after a date, in one of the funding stages and at a
    location, top ``limit`` by equity funding (ties by id).  The predicates are
    plain filters (pushed to the scan where the source allows) and the order +
    limit plans as a single TakeOrderedAndProject."""
    return (companies.filter((founded >= F.lit(founded_from).cast("date")) & stage.isin(stages) & location_hit)
            .orderBy(funding.desc(), F.col(id_col).asc()).limit(limit))
