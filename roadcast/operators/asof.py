"""Rain at the time of each reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadcast.operators.cover import cover_table, interval_pieces, look_up
from roadcast.skew import spread_join

FOREVER_S = 1 << 36  # two thousand years: how long a station's last value holds


def asof_rain(df: DataFrame, mapping: DataFrame, rain: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Latest rain value at or before each reading, from the station nearest to its link.

    A value holds until the second before the station's next one.  These intervals are looked up like incidents (:mod:`roadcast.operators.cover`): a value that holds for years
    becomes a few dozen aligned spans, rain is aggregated once, and readings are neither sorted nor grouped.  Readings of one station meet its
    rain by (station, 2,048 seconds), so a station with a large share of them is spread over its time.

    Of values at the same second the largest holds.  A NULL value holds like any other.  Links without a station, and readings before its first value, get NULL.
    """
    values = rain.groupBy("station_id", "ts").agg(F.max("rain_mm").alias("rain_mm"))
    # one row per station and second at most is left to order here
    following = F.lead("ts").over(Window.partitionBy("station_id").orderBy("ts"))
    values = values.select("station_id", F.col("ts").alias("start_ts"), F.coalesce(following - 1, F.col("ts") + FOREVER_S).alias("end_ts"), "rain_mm")
    pieces = interval_pieces(values, ["station_id"], {"_mm": (F.col("rain_mm"), "max")})
    cover = cover_table(pieces, ["station_id"], ["_mm"])
    stations = mapping.select("link_id", F.col("nearest_station_id").alias("station_id"))
    rows = spread_join(df, stations, ["link_id"], "link_id", hot)
    out = look_up(rows, cover, ["station_id"], {"_mm": "max"}).withColumn("rain_mm", F.col("_mm"))
    return out.select(*df.columns, "rain_mm", (F.col("rain_mm") > 0).cast("int").alias("is_raining"))
