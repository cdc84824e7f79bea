"""Feature rows: positional lags and leads per link, band checks, road columns, derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.functions.columns import BIN_SCALE, PEAK_HOURS, WEEKEND_DAYS, dow_of, hour_of, midpoint, space_bin
from roadcast.skew import FIND, MAX_GROUP_ROWS, Hot, neighbour_window, spread_join

STEP_MIN = 5


def lag_name(step: int) -> str:
    return f"sb_tm{step * STEP_MIN}"


def lead_name(step: int) -> str:
    return f"y_tp{step * STEP_MIN}"


def time_range(df: DataFrame, start: int | None, end: int | None, ts: str = "snapshot_ts") -> DataFrame:
    """Both ends included.  Comes before the windows, so that it reaches the scan."""
    if start is not None:
        df = df.filter(F.col(ts) >= start)
    return df if end is None else df.filter(F.col(ts) <= end)


def valid_bands(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    keep: Column = F.lit(True)
    for name in cols:
        keep = keep & F.col(name).between(1, 8)
    return df.filter(keep)


def drop_null_steps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def add_time_parts(df: DataFrame, ts: str = "snapshot_ts", shift_s: int = 0, names=("hour", "dow")) -> DataFrame:
    return df.withColumns({names[0]: hour_of(ts, shift_s), names[1]: dow_of(ts, shift_s)})


def build_features(
    readings: DataFrame,
    lags: Sequence[int] = (1, 2, 3),
    leads: Sequence[int] = (3,),
    start: int | None = None,
    end: int | None = None,
    tz_shift_s: int = 0,
    time_names: tuple[str, str] | None = ("hour", "dow"),
    valid: Sequence[str] = (),
    max_rows: int = MAX_GROUP_ROWS,
    hot: Hot = FIND,
) -> DataFrame:
    """One row per reading with the bands of earlier and later readings of the same link.

    Steps count readings, not minutes.  ``valid`` names the columns that must hold a band 1..8; the check comes
    after the window, so an invalid reading still takes its place in the series.  All columns share one window, hence one shuffle.
    """
    rows = time_range(readings, start, end).select(
        "link_id", "snapshot_ts", F.col("speed_band").alias("sb"), F.col("id").alias("_id")
    )

    def add(frame, w):
        steps = {lag_name(k): F.lag("sb", k).over(w) for k in lags}
        steps.update({lead_name(k): F.lead("sb", k).over(w) for k in leads})
        return frame.withColumns(steps)

    rows = neighbour_window(
        rows, ["link_id"], ["snapshot_ts", "_id"], add, max(lags, default=0), max(leads, default=0), max_rows, hot
    )
    rows = valid_bands(rows, valid)
    parts: list[str] = []
    if time_names:
        rows = add_time_parts(rows, shift_s=tz_shift_s, names=time_names)
        parts = list(time_names)
    return rows.select(
        "link_id", "snapshot_ts", "sb", *map(lag_name, lags), *parts, *map(lead_name, leads)
    )


def feature_bands(lags: Sequence[int], leads: Sequence[int]) -> list[str]:
    return ["sb", *map(lag_name, lags), *map(lead_name, leads)]


def road_mid(roads: DataFrame) -> DataFrame:
    return roads.withColumns(
        {"mid_lat": midpoint("start_lat", "end_lat"), "mid_lon": midpoint("start_lon", "end_lon")}
    )


def with_road(
    df: DataFrame,
    roads: DataFrame,
    how: str = "inner",
    position: str = "mid",
    bin_scale: int = BIN_SCALE,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add road columns: midpoint and cells (``position="mid"``), the end points (``"ends"``), or ``"both"``.

    The rows are already hashed on link_id by the window, so the join adds no shuffle of them; whether roads are small
    enough to broadcast is left to the optimiser, which knows their size.  ``hot`` are the links with too many readings for
    one task, from :func:`roadcast.skew.hot_keys`.
    """
    ends = ["start_lat", "start_lon", "end_lat", "end_lon"]
    mid = ["mid_lat", "mid_lon", space_bin("mid_lat", bin_scale).alias("lat_bin"), space_bin("mid_lon", bin_scale).alias("lon_bin")]
    wanted = {"ends": ends, "mid": mid, "both": [*mid, *ends]}[position]
    side = road_mid(roads).select("link_id", "road_category", *wanted)
    return spread_join(df, side, ["link_id"], "link_id", hot, how)


def add_momentum(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "delta_0_5": F.col("sb") - F.col("sb_tm5"),
            "delta_5_10": F.col("sb_tm5") - F.col("sb_tm10"),
            "delta_10_15": F.col("sb_tm10") - F.col("sb_tm15"),
        }
    )
    return df.withColumn("acceleration", F.col("delta_0_5") - F.col("delta_5_10"))


def add_link_proxy(df: DataFrame) -> DataFrame:
    """Link length in degrees."""
    dlat, dlon = F.col("start_lat") - F.col("end_lat"), F.col("start_lon") - F.col("end_lon")
    return df.withColumn("link_dist_proxy", F.sqrt(dlat * dlat + dlon * dlon))


def add_calendar_flags(df: DataFrame, hour: str = "hour_sg", dow: str = "dow_sg") -> DataFrame:
    return df.withColumns(
        {
            "is_weekend": F.col(dow).isin(*WEEKEND_DAYS).cast("int"),
            "is_peak": F.col(hour).isin(*PEAK_HOURS).cast("int"),
        }
    )


def add_targets(df: DataFrame, y: str = "y_tp15") -> DataFrame:
    """``label`` = band - 1 for the band model, ``change`` = 1 where the band moves."""
    return df.withColumns(
        {"label": (F.col(y) - 1).cast("int"), "change": (F.col(y) != F.col("sb")).cast("int")}
    )


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [name for name in wanted if name not in have]
