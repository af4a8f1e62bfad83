"""SparkSession helpers.

The library never creates its own cluster settings on a real cluster; it only
fills in values that are unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on; applied only where unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "graphweave", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (the UI stays off)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the library's defaults on an existing session where they are unset."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
    single machine) gets a private folder when the setting is missing; on a
    cluster a missing setting is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative jobs")
        path = tempfile.mkdtemp(prefix="gw-ckpt-", dir=os.environ.get("GW_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
