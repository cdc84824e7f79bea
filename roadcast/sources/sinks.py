"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 10_000_000


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), max_records: int | None = None, mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_by_day(df: DataFrame, path: str, ts: str = "snapshot_ts", max_records: int = CHUNK_ROWS) -> None:
    """Feature rows in day folders, so that time ranges prune files.

    Rebalancing on the day gathers each day into few files and splits large days, so no day ends up in one task.
    """
    day = F.date_format(F.timestamp_seconds(F.col(ts)), "yyyy-MM-dd")
    rows = df.withColumn("day", day).hint("rebalance", "day")
    write_table(rows, path, ["day"], max_records)


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "link_id", order: Sequence[str] = ("snapshot_ts",), buckets: int = 200) -> DataFrame:
    """``df`` as a table in buckets of ``key``, each sorted by ``order``, at ``path``; returns the table.

    Windows and joins on ``key`` then need no shuffle of it.  Rows go to their bucket before they are written, so each bucket is one file; a
    bucket has about (rows / ``buckets``) rows unless one key has more.
    """
    rows = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path).option("compression", "snappy")
    writer.bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)
    return df.sparkSession.table(table)
