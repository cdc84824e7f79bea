"""Matching route coordinates to road links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.functions.columns import bearing_deg, bearing_diff, flat_m, midpoint
from roadcast.operators.features import road_mid
from roadcast.operators.spatial import in_box_pairs
from roadcast.session import cut_lineage
from roadcast.skew import FIND, MAX_GROUP_ROWS, Hot, hot_keys, neighbour_window, run_numbers

# Matching limits, fixed values.
MIN_SEGMENT_M = 5.0
BOX_DEG = 0.0005
MAX_DIST_M = 35.0
MAX_BEARING_DEG = 35.0
BEARING_WEIGHT = 0.7

_ENDS = ["lat1", "lon1", "lat2", "lon2"]


def segments(
    points: DataFrame, min_len_m: float = MIN_SEGMENT_M, max_rows: int = MAX_GROUP_ROWS, hot: Hot = FIND
) -> DataFrame:
    """Consecutive point pairs of each route, without those shorter than ``min_len_m``."""

    def add(df, w):
        return df.withColumns({"lat2": F.lead("lat").over(w), "lon2": F.lead("lon").over(w)})

    rows = points.select("route_id", "seq", "lat", "lon")
    pairs = neighbour_window(rows, ["route_id"], ["seq"], add, 0, 1, max_rows, hot)
    pairs = pairs.filter(F.col("lat2").isNotNull()).withColumnsRenamed({"lat": "lat1", "lon": "lon1"})
    length = flat_m(*_ENDS)
    return pairs.withColumn("segment_len_m", length).filter(F.col("segment_len_m") >= min_len_m)


def match_segments(
    segs: DataFrame, roads: DataFrame, max_dist_m: float = MAX_DIST_M, max_bearing: float = MAX_BEARING_DEG
) -> DataFrame:
    """Best link of each segment, NULL without one: least distance + 0.7 x undirected bearing difference.

    Many routes use the same stretch, so each different segment is matched once.  Equal scores go to the lowest link id.
    """
    return _matched(segs, roads, max_dist_m, max_bearing).drop(*_ENDS)


def _matched(segs: DataFrame, roads: DataFrame, max_dist_m: float = MAX_DIST_M, max_bearing: float = MAX_BEARING_DEG) -> DataFrame:
    """:func:`match_segments` with the ends of each segment."""
    mids = road_mid(roads)
    mids = mids.groupBy("start_lat", "start_lon", "end_lat", "end_lon", "mid_lat", "mid_lon").agg(
        F.min("link_id").alias("link_id")
    )
    mids = mids.select(
        "link_id", "mid_lat", "mid_lon", bearing_deg("start_lat", "start_lon", "end_lat", "end_lon").alias("_road_bearing")
    )
    distinct = segs.select(*_ENDS).distinct().withColumns(
        {
            "lat": midpoint("lat1", "lat2"),
            "lon": midpoint("lon1", "lon2"),
            "_bearing": bearing_deg(*_ENDS),
        }
    )
    pairs = in_box_pairs(distinct, mids, BOX_DEG).withColumns(
        {
            "_dist": flat_m("lat", "lon", "mid_lat", "mid_lon"),
            "_diff": bearing_diff("_bearing", "_road_bearing", undirected=True),
        }
    )
    pairs = pairs.filter((F.col("_dist") <= max_dist_m) & (F.col("_diff") <= max_bearing))
    score = F.round(F.col("_dist") + BEARING_WEIGHT * F.col("_diff"), 6)
    best = pairs.groupBy(*_ENDS).agg(
        F.min_by(F.struct("link_id", "_dist", "_diff"), F.struct(score.alias("s"), "link_id")).alias("_best")
    )
    # one row per matched stretch, dealt evenly by its ends: segments need no sort by four doubles to meet it
    out = segs.join(best.hint("shuffle_hash"), _ENDS, "left")
    return out.select(
        "route_id",
        "seq",
        "segment_len_m",
        F.col("_best.link_id").alias("link_id"),
        F.col("_best._dist").alias("dist_m"),
        F.col("_best._diff").alias("bearing_diff_deg"),
        *_ENDS,
    )


def merge_runs(matches: DataFrame, max_rows: int = MAX_GROUP_ROWS, hot: Hot = FIND, ties: Sequence[str] = ()) -> DataFrame:
    """Consecutive matches of one link in a route as one row; unmatched segments do not break a run.

    ``ties`` are columns that order segments of equal ``seq``.
    """
    hits = matches.filter(F.col("link_id").isNotNull())

    def starts(w):
        before = F.lag("link_id").over(w)
        return before.isNull() | (before != F.col("link_id"))

    runs = run_numbers(hits, ["route_id"], ["seq", *ties], starts, "run_no", max_rows, hot)
    return runs.groupBy("route_id", "run_no", "link_id").agg(
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n_segments"),
        F.sum(F.bround("segment_len_m", 2)).alias("segment_len_m"),
    )


def route_summary(matches: DataFrame) -> DataFrame:
    """Total and covered length of each route, and their ratio (0 without length)."""
    length = F.col("segment_len_m")
    covered = F.sum(F.when(F.col("link_id").isNotNull(), length).otherwise(0.0))
    sums = matches.groupBy("route_id").agg(F.sum(length).alias("_total"), covered.alias("_covered"))
    ratio = F.when(F.col("_total") > 0, F.col("_covered") / F.col("_total")).otherwise(0.0)
    return sums.select(
        "route_id",
        F.bround("_total", 1).alias("total_route_len_m"),
        F.bround("_covered", 1).alias("covered_len_m"),
        F.bround(ratio, 3).alias("coverage_ratio"),
    )


def match_routes(points: DataFrame, roads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segment matches, merged runs) of every route; totals come from :func:`route_summary` on the first.

    A route has fewer segments than points, so its size is looked at once.
    """
    hot = hot_keys(points, ["route_id"])
    matches = _matched(cut_lineage(segments(points, hot=hot)), roads)  # read for the different stretches and for the segments
    return matches.drop(*_ENDS), merge_runs(matches, hot=hot, ties=_ENDS)


def enrich_matches(matches: DataFrame, roads: DataFrame, state: DataFrame, scores: DataFrame) -> DataFrame:
    """Road name, category, current and predicted band of each matched link."""
    named = matches.join(roads.select("link_id", "road_name", "road_category"), "link_id", "left")
    named = named.join(state.select("link_id", F.col("sb").alias("current_band")), "link_id", "left")
    return named.join(scores.select("link_id", F.col("prediction_tp15").alias("pred_band")), "link_id", "left")
