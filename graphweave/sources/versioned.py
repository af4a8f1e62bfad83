"""Tables kept as committed versions of partitions.

Every ``put`` writes its rows under a folder of its own and then commits a manifest that says, for each partition value, which
folder holds it.  Readers follow the last manifest, so a put that fails or is run twice leaves no half-written and
no doubled rows: the partitions it brings replace the earlier ones, the others stay where they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, value string, folder string, rows long"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


class PartitionStore:
    """Rows of one schema under ``path``, partitioned by the values of ``column`` (say, years)."""

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column

    def last_version(self) -> int:
        """The last committed version, 0 before the first one (a manifest counts once its writer has finished)."""
        done = [n for n in _names(self.spark, f"{self.path}/manifest") if n.startswith("v=") and
                "_SUCCESS" in _names(self.spark, f"{self.path}/manifest/{n}")]
        return max([0, *(int(n[2:]) for n in done)])

    def manifest(self, version: int | None = None) -> DataFrame:
        """(version, value, folder, rows): one row per partition value."""
        v = self.last_version() if version is None else version
        if v == 0:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={v}")

    def put(self, rows: DataFrame) -> int:
        """Replace the partitions that ``rows`` has values of; returns the new version.

        Each value's rows go to as many files as there are write tasks with such rows; nothing moves.
        """
        version = self.last_version()
        folder = uuid.uuid4().hex
        data = f"{self.path}/data/{folder}"
        rows.withColumn("_part", F.col(self.column).cast("string")).write.partitionBy("_part").parquet(data)
        mine = (self.spark.read.parquet(data).groupBy(F.col("_part").cast("string").alias("value"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(version + 1).cast("long").alias("version"), "value", F.lit(folder).alias("folder"), "rows"))
        same = F.col("o_value").eqNullSafe(F.col("value"))
        old = self.manifest(version).withColumn("version", F.lit(version + 1).cast("long")) if version else self.manifest(0)
        kept = old.join(mine.select(F.col("value").alias("o_value")), same, "left_anti")
        kept.unionByName(mine).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifest/v={version + 1}")
        return version + 1

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (the last one by default).

        Only the folders that the version names are listed; a filter on the column prunes them.
        """
        held = self.manifest(version)
        folders = [r["folder"] for r in held.select("folder").distinct().collect()]      # one per put still in use
        if not folders:
            raise FileNotFoundError(f"nothing committed under {self.path}")
        out = None
        for f in folders:
            wanted = [r["value"] for r in held.where(F.col("folder") == f).collect()]
            part = F.col("_part").cast("string")
            some = part.isin([v for v in wanted if v is not None])
            rows = self.spark.read.option("mergeSchema", False).parquet(f"{self.path}/data/{f}")
            rows = rows.where((some | part.isNull()) if None in wanted else some).drop("_part")
            out = rows if out is None else out.unionByName(rows)
        return out
