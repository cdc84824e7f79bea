"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Timestamps are epoch seconds read in UTC.  With the co-partitioning switch a table already
# hashed on link_id can join on (link_id, cell) without another shuffle of the large side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "roadcast", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a session on a local master gets a folder of its own when none is set.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="roadcast-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from its files.

    Computed once, safe against lost executors, and the planner learns the real size.
    """
    path = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_count(df: DataFrame, **flags: str) -> tuple[DataFrame, dict[str, int]]:
    """:func:`cut_lineage`, and for each flag how many rows had its condition; counted while writing."""
    seen = Observation()
    counts = [F.count_if(F.expr(condition)).alias(name) for name, condition in flags.items()]
    return cut_lineage(df.observe(seen, *counts)), seen.get
