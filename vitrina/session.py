"""Session settings and the shared working folder.

Nothing here creates a session: callers own it.  ``configure`` only fills in
SQL options that the caller left at their defaults.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime options that keep the plans below safe on skewed keys.
SQL_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the aggregate above then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Groups that arrive sorted are added up as they pass, without a table of all groups in memory.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set ``SQL_OPTIONS`` where the session still has Spark's default."""
    given = spark.sparkContext.getConf()
    for key, value in SQL_OPTIONS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see, as named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only for a ``local`` master that
    names no folder; on a cluster the setting is required.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="vitrina-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one run below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/vitrina/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "etapa") -> DataFrame:
    """The frame as a table written to the shared folder.

    Cuts the lineage, survives the loss of executors, and gives the plans above
    it real sizes and pruned columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
