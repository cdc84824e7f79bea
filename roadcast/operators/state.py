"""Latest readings per link, and what is served from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadcast.operators.spatial import nearest_in_box

KEEP = 4
NOT_AVAILABLE = "N/A"  # fixed value


def last_n(readings: DataFrame, n: int = KEEP) -> DataFrame:
    """(link_id, bands): the last ``n`` bands of each link, newest first; readings without a band say nothing, in streams too.

    The rank limit is applied before the shuffle as well, so at most ``n`` rows per link and task are moved.
    """
    newest = Window.partitionBy("link_id").orderBy(F.desc("snapshot_ts"), F.desc("id"))
    rows = readings.select("link_id", "snapshot_ts", "id", "speed_band").filter("speed_band IS NOT NULL")
    top = rows.withColumn("_r", F.row_number().over(newest))
    top = top.filter(F.col("_r") <= n)
    listed = top.groupBy("link_id").agg(F.sort_array(F.collect_list(F.struct("_r", "speed_band"))).alias("_rows"))
    return listed.select("link_id", F.col("_rows.speed_band").alias("bands"))


def state_to_lags(state: DataFrame) -> DataFrame:
    """Bands as lag columns; a lag that is not there yet takes the current band."""
    band = lambda k: F.coalesce(F.get("bands", F.lit(k)), F.get("bands", F.lit(0)))
    return state.select(
        "link_id",
        band(0).alias("sb"),
        band(1).alias("sb_tm5"),
        band(2).alias("sb_tm10"),
        band(3).alias("sb_tm15"),
    )


def enrich_incidents(feed: DataFrame, roads: DataFrame, lags: DataFrame, scores: DataFrame) -> DataFrame:
    """Feed rows with the link they lie on, its current band and its predicted band.

    Unmatched rows read "N/A" twice; a matched link without readings reads "N/A" and a NULL prediction.
    """
    points = feed.withColumnsRenamed({"Latitude": "lat", "Longitude": "lon"})
    matched = nearest_in_box(points, roads).withColumnRenamed("matched_link_id", "link_id")
    now = lags.select("link_id", F.col("sb").cast("string").alias("_sb"))
    soon = scores.select("link_id", F.col("prediction_tp15").cast("string").alias("_pred"))
    out = matched.join(now, "link_id", "left").join(soon, "link_id", "left")
    unmatched = F.col("link_id").isNull()
    return out.select(
        *[c for c in points.columns],
        F.col("link_id").alias("matched_link_id"),
        "matched_road_name",
        F.coalesce("_sb", F.lit(NOT_AVAILABLE)).alias("current_speed_band"),
        F.when(unmatched, F.lit(NOT_AVAILABLE)).otherwise(F.col("_pred")).alias("predicted_speed_band_tp15"),
    )
