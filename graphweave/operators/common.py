"""Small shared helpers for operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# A side is broadcast only when its rows and bytes are at most these (checked).
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20
# Spark's setting by which a query's shuffle files are removed when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (as JSON).

    Looks at ``limit(max_rows + 1)`` only, so a huge side stops early instead of
    being counted in full.
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when the size check passes, else ``df`` unchanged
    (Spark then plans a shuffle join)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def seq(lo, hi):
    """``sequence(lo, hi)`` that is empty when ``lo > hi`` (Spark's would count down)."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def scratch_path(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder, removed when the
    application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/gw-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, keep_shuffles: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Cuts the lineage (a lost executor costs no more than its running tasks) and
    gives the optimizer the true size of the intermediate table.  With
    ``keep_shuffles=False`` the shuffle files of the write go when it ends, else
    when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    was = spark.conf.get(DROP_SHUFFLES, None)
    if not keep_shuffles:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if not keep_shuffles:
            spark.conf.unset(DROP_SHUFFLES) if was is None else spark.conf.set(DROP_SHUFFLES, was)
    return spark.read.schema(df.schema).parquet(path)
