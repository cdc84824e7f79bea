"""What several operators share: reading, written steps with clean-up, word splitting, positions over all rows."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from roadcast.session import shared_folder

WORD = re.compile(r"\w+")
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when the execution that wrote them ends


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores; null has none."""
    return WORD.findall(text.lower()) if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Steps:
    """Intermediate tables below the cluster's shared folder.

    ``write`` computes a frame once and goes on from its files, so lost executors cost one task and not the whole
    lineage; its shuffle files go when it is written.  ``drop`` removes tables that no later step reads; what the returned frame reads has to stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._held: list[DataFrame] = []
        self._n = 0

    def path(self) -> str:
        self._n += 1
        return f"{self.folder}/{self._n}"

    def write(self, df: DataFrame) -> DataFrame:
        path = self.path()
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(SHUFFLE_CLEANUP) if before is None else self.spark.conf.set(SHUFFLE_CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        self._held.append(back)
        return back

    def write_and_sum(self, df: DataFrame, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
        """:meth:`write`, and totals taken while writing (0 for an empty frame)."""
        seen = Observation()
        back = self.write(df.observe(seen, *[F.sum(c).alias(name) for name, c in sums.items()]))
        return back, {name: seen.get[name] or 0 for name in sums}

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self._paths.pop(id(df), None)
            if path is None:
                continue
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def positions(df: DataFrame, order: list[str], steps: Steps, name: str = "_pos") -> DataFrame:
    """Number all rows 0, 1, .. by ``order``, without putting them into one task.

    Range partitions are written with their row numbers; only one count per partition meets in one place.
    """
    tie = "_tie"
    ranged = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*order, tie)
        .withColumn("_part", F.spark_partition_id())
    )
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order, tie))
    written = steps.write(ranged.withColumn("_local", local).drop(tie))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return written.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_local") - 1).drop("_part", "_local", "_before")
