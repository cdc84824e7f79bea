"""Table reads with declared schemas, and the numeric clean-up of raw readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.functions.columns import utc_seconds


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Speed readings; ``path`` may be a folder or a glob of chunks."""
    return spark.read.schema(schemas.READINGS).parquet(path)


def read_roads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROADS).parquet(path)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INCIDENTS).parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INCIDENT_SNAPSHOTS).parquet(path)


def read_database(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, driver: str
) -> DataFrame:
    """A database table in ``parts`` key ranges read side by side.  Needs the JDBC driver jar on the class path."""
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }
    return spark.read.format("jdbc").options(**options).load()


def read_landed(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Readings exported as CSV, all columns as text."""
    return spark.read.schema(schemas.RAW_READINGS).option("header", header).csv(path)


def normalise_readings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): integers and epoch seconds from text.

    A row is rejected when its time cannot be read; numbers that cannot be read become NULL.
    """
    cols = [F.col(c).try_cast(t).alias(c) for c, t in (("id", "bigint"), ("link_id", "bigint"), ("speed_band", "int"), ("min_speed", "int"), ("max_speed", "int"))]
    parsed = raw.select(*cols, utc_seconds("snapshot_time").alias("snapshot_ts"), "snapshot_time")
    good = parsed.filter(F.col("snapshot_ts").isNotNull()).drop("snapshot_time")
    return good, raw.filter(utc_seconds("snapshot_time").isNull())


def road_columns(roads: DataFrame) -> DataFrame:
    """The seven road columns of the export, with the category as a whole number."""
    return roads.select(
        "link_id", "road_name", F.col("road_category").try_cast("int").alias("road_category"), "start_lat", "start_lon", "end_lat", "end_lon"
    )
