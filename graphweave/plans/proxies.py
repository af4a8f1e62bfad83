"""Inputs of the linking jobs derived from the driver tables.

The driver tables stand in for the real inputs: ``documents`` and ``part`` for
papers, part names and ``benchmark`` passages for technologies, ``embeddings`` for encoded entities, ``supplier``/``part`` for
companies and their categories, ``orders``/``lineitem`` for nested paper
records and ``customer``/``nation``/``region`` for nested company records.
Every proxy is computed by Spark from the whole tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; see ``balanced``."""
    return balanced(spark.read.parquet(f"{sf_dir}/{name}.parquet"), f"{sf_dir}/{name}.parquet")


def balanced(df: DataFrame, path: str | None = None, min_bytes: int = 1 << 20) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A large input already arrives in many splits and is returned unchanged
    (no extra shuffle).  A file that is one indivisible row group would keep
    all per-row work of the following stages in a single task; it is
    round-robin repartitioned to the default parallelism.  Tiny files stay as
    they are.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    if path is not None:
        try:
            if os.path.getsize(path) < min_bytes:
                return df
        except OSError:
            pass
    return df.repartition(par)


def part_name_techs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct part names as technologies, in order of their first part key.

    keywords: the name itself, adjective, noun, adjective + 's', 'x' + noun.
    """
    p = table(spark, sf_dir, "part")
    names = p.groupBy("p_name").agg(F.min("p_partkey").alias("tech_pos"))
    w = F.split(F.col("p_name"), " ")
    return names.select(F.col("tech_pos").alias("tech_id"), "tech_pos", F.col("p_name").alias("technology_name"),
                        F.array(F.lower("p_name"), w[0], w[1], F.concat(w[0], F.lit("s")), F.concat(F.lit("x"), w[1])).alias("keywords"))


def supplier_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """company_id (supplier), company_name, categories: the words of the names
    of the parts it supplies plus their type with a trailing '_'.

    Every third supplier's name also holds the (upper-cased) name of the part
    with its key, so the name boost of the company links has cases to fire on.
    """
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    words = (li.join(p, li.l_partkey == p.p_partkey)
             .select(F.col("l_suppkey").alias("company_id"),
                     F.explode(F.concat(F.split("p_name", " "), F.array(F.concat(F.lower("p_type"), F.lit("_")))))
                     .alias("cat"))
             .distinct())
    cats = words.groupBy("company_id").agg(F.sort_array(F.collect_list("cat")).alias("categories"))
    named = s.join(p.select(F.col("p_partkey").alias("s_suppkey"), "p_name"), "s_suppkey", "left")
    name = F.when((F.col("s_suppkey") % 3 == 0) & F.col("p_name").isNotNull(),
                  F.concat_ws(" ", "s_name", F.upper("p_name"))).otherwise(F.col("s_name"))
    return (named.join(cats, F.col("s_suppkey") == cats.company_id, "left")
            .select(F.col("s_suppkey").alias("company_id"), name.alias("company_name"),
                    F.coalesce("categories", F.array().cast("array<string>")).alias("categories")))
