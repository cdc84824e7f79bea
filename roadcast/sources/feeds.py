"""Landed JSON of the live feeds.  Rows that cannot be read are skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast import schemas


def read_incident_feed(spark: SparkSession, path: str, n: int | None = 30) -> DataFrame:
    """First ``n`` incidents of feed files, all with ``n`` None: each file a bare list, or an object with the list under ``value``.

    Files follow each other by path, incidents as they stand in the file; a file is read by one task, which numbers its entries.
    """
    fields = schemas.FEED_INCIDENT
    names = [c.split()[0] for c in fields.split(", ")]
    both = f"{fields}, value ARRAY<STRUCT<{fields}>>"
    rows = spark.read.schema(both).option("multiLine", True).json(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_entry"))
    listed = rows.select("_file", "_entry", F.posexplode(F.coalesce("value", F.array(F.struct(*names)))).alias("_pos", "_row"))
    if n is not None:
        listed = listed.orderBy("_file", "_entry", "_pos").limit(n)
    return listed.select("_row.*")


def parse_incidents(payloads: DataFrame, col: str = "body") -> DataFrame:
    """Incident rows from feed documents held as text, one document per row."""
    fields = f"STRUCT<{schemas.FEED_INCIDENT}>"
    text = F.col(col)
    listed = F.when(
        F.ltrim(text).startswith("["), F.from_json(text, F.lit(f"ARRAY<{fields}>"))
    ).otherwise(F.from_json(text, F.lit(f"STRUCT<value: ARRAY<{fields}>>"))["value"])
    return payloads.select(*[c for c in payloads.columns if c != col], F.inline(listed))


def speed_rows(pages: DataFrame) -> DataFrame:
    """(link_id, speed_band, fetched_at) of all pages; entries without whole numbers are skipped."""
    rows = pages.select("fetched_at", F.explode("value").alias("_v"))
    rows = rows.select(
        F.col("_v.LinkID").try_cast("bigint").alias("link_id"),
        F.col("_v.SpeedBand").try_cast("int").alias("speed_band"),
        "fetched_at",
    )
    return rows.filter(F.col("link_id").isNotNull() & F.col("speed_band").isNotNull())


def read_speed_pages(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Readings from pages landed as JSON files; a page without ``fetched_at`` takes the time of its file."""
    reader = (spark.readStream if streaming else spark.read).schema(schemas.SPEED_PAGE).option("multiLine", True)
    pages = reader.json(folder).withColumn(
        "fetched_at", F.coalesce("fetched_at", F.unix_seconds(F.col("_metadata.file_modification_time")))
    )
    return speed_rows(pages)


def flatten_stations(feed: DataFrame) -> DataFrame:
    """(station_id, lat, lon) of stations with a non-zero position; ``feed`` has the response under ``data``."""
    rows = feed.select(F.explode("data.stations").alias("_s")).select(
        F.col("_s.id").alias("station_id"),
        F.col("_s.location.latitude").try_cast("double").alias("lat"),
        F.col("_s.location.longitude").try_cast("double").alias("lon"),
    )
    return rows.filter((F.col("lat") != 0) & (F.col("lon") != 0))


def flatten_geocode(answers: DataFrame, n: int = 8) -> DataFrame:
    """First ``n`` places with coordinates of each geocoder answer (``query``, ``body`` as text).

    The label is the address, else the search value.
    """
    parsed = F.from_json("body", F.lit(f"STRUCT<{schemas.GEOCODE}>"))["results"]
    lat_text = lambda r: F.nullif(r["LATITUDE"], F.lit(""))
    lon_text = lambda r: F.nullif(r["LONGITUDE"], F.lit(""))
    placed = F.filter(parsed, lambda r: lat_text(r).isNotNull() & lon_text(r).isNotNull())
    rows = answers.select("query", F.posexplode(F.slice(placed, 1, n)).alias("pos", "_r"))
    return rows.select(
        "query",
        F.col("pos").cast("bigint").alias("pos"),
        F.coalesce(F.nullif(F.col("_r.ADDRESS"), F.lit("")), F.col("_r.SEARCHVAL")).alias("label"),
        F.col("_r.POSTAL").alias("postal"),
        F.col("_r.LATITUDE").try_cast("double").alias("lat"),
        F.col("_r.LONGITUDE").try_cast("double").alias("lon"),
    )
