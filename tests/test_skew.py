"""Keys above the row limit take the block plans; results must not change."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadcast.operators.features import build_features
from roadcast.operators.routes import match_segments, merge_runs, segments
from roadcast.operators.sessions import gap_sessions
from roadcast.skew import hot_keys


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(3)
    data = []
    for n in range(900):
        link = None if n % 50 == 0 else (1 if rng.random() < 0.5 else rng.randrange(2, 30))
        # few different times: many ties, one of them holding a large part of the link
        ts = 7000 if rng.random() < 0.3 else rng.randrange(0, 40) * 300
        data.append((n, link, rng.randrange(1, 10), ts))
    return spark.createDataFrame(data, "id BIGINT, link_id BIGINT, speed_band INT, snapshot_ts BIGINT")


def test_hot_keys(readings):
    assert hot_keys(readings, ["link_id"], 10_000) is None
    assert [r[0] for r in hot_keys(readings, ["link_id"], 200).collect()] == [1]


@pytest.mark.parametrize("limit", [10, 100])
def test_features_by_blocks(readings, limit):
    plain = build_features(readings, (1, 2, 3, 6), (1, 3, 6))
    assert rows(build_features(readings, (1, 2, 3, 6), (1, 3, 6), max_rows=limit)) == rows(plain)


def test_features_match_python(readings):
    by_link = {}
    for r in readings.collect():
        by_link.setdefault(r.link_id, []).append((r.snapshot_ts, r.id, r.speed_band))
    want = []
    for link, series in by_link.items():
        series.sort()
        bands = [b for _, _, b in series]
        for n, (ts, _, band) in enumerate(series):
            at = lambda k: bands[k] if 0 <= k < len(bands) else None
            want.append((link, ts, band, at(n - 1), at(n - 2), at(n + 3)))
    got = build_features(readings, (1, 2), (3,), time_names=None, max_rows=50)
    assert rows(got) == sorted(want, key=repr)


def test_sessions_by_blocks(readings):
    plain = gap_sessions(readings, ["link_id"], "snapshot_ts", "id", 10)
    assert rows(gap_sessions(readings, ["link_id"], "snapshot_ts", "id", 10, max_rows=25)) == rows(plain)


def test_identical_rows_are_split(spark):
    same = spark.range(400).select(F.lit(1).alias("k"), F.lit(5).alias("ts"), F.lit(0).alias("id"))
    got = gap_sessions(same, ["k"], "ts", "id", 1, max_rows=50)
    assert got.count() == 400 and rows(got, "session_no") == [(1,)] * 400


def test_routes_by_blocks(spark):
    points = spark.range(300).select(
        F.lit(9).alias("route_id"), F.col("id").alias("seq"), (F.col("id") * 0.0003).alias("lat"), F.lit(103.0).alias("lon")
    )
    assert rows(segments(points, max_rows=20)) == rows(segments(points))
    matches = segments(points).withColumn("link_id", F.when(F.col("seq") % 7 != 0, F.floor(F.col("seq") / 5)))
    assert rows(merge_runs(matches, max_rows=20), "run_no", "link_id", "first_seq", "n_segments") == rows(
        merge_runs(matches), "run_no", "link_id", "first_seq", "n_segments"
    )


def test_joins_of_hot_links(spark, readings):
    from roadcast.operators import incidents as inc
    from roadcast.operators.asof import asof_rain
    from roadcast.operators.features import with_road

    roads = spark.range(25).selectExpr("id AS link_id", "1 AS road_category", "1.0D AS start_lat", "2.0D AS end_lat", "3.0D AS start_lon", "id * 0.1D AS end_lon")
    incidents = spark.range(200).selectExpr(
        "id AS incident_id", "id % 6 AS nearest_link_id", "IF(id % 3 = 0, 'Accident', NULL) AS type", "id * 50 AS start_ts", "id * 50 + id * 7 AS end_ts", "id * 1.0D AS duration_min"
    )
    mapping = spark.range(20).selectExpr("id AS link_id", "CAST(id % 2 AS STRING) AS nearest_station_id")
    rain = spark.range(50).selectExpr("CAST(id % 3 AS STRING) AS station_id", "id * 200 AS ts", "id * 1.0D AS rain_mm")
    rows_in = readings.select("link_id", "snapshot_ts", "speed_band")
    hot = hot_keys(readings, ["link_id"], 60)
    for job in (
        lambda h: with_road(rows_in, roads, hot=h),
        lambda h: with_road(rows_in, roads, how="left", hot=h),
        lambda h: inc.flag_incidents(rows_in, incidents, h),
        lambda h: inc.covering_max(rows_in, incidents, {"d": "duration_min"}, h),
        lambda h: inc.incident_rollup(rows_in, incidents, h),
        lambda h: asof_rain(rows_in, mapping, rain, hot=h),
    ):
        assert rows(job(hot)) == rows(job(None))


def test_hot_keys_are_found_in_full_buckets_only(spark, monkeypatch):
    data = [(k, n) for k in [None, *range(40)] for n in range(9 if k in (None, 7) else 4)]
    df = spark.createDataFrame(data, "k BIGINT, n BIGINT")
    for buckets in (1, 5, 4096):
        monkeypatch.setattr("roadcast.skew.BUCKETS", buckets)
        assert rows(hot_keys(df, ["k"], 5), "k", "_n", "_parts") == [(7, 9, 2), (None, 9, 2)]
        assert hot_keys(df, ["k"], 9) is None


def test_segments_meet_their_matches_without_a_sort(spark):
    segs = spark.createDataFrame([(1, 0, 1.3, 103.8, 1.3005, 103.8, 55.0)], "route_id BIGINT, seq BIGINT, lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE, segment_len_m DOUBLE")
    roads = spark.createDataFrame([(5, 1.3, 103.8, 1.3005, 103.8)], "link_id BIGINT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE")
    plan = match_segments(segs, roads.withColumns({"road_category": F.lit(1), "road_name": F.lit("a")}))
    assert "ShuffledHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
    assert rows(plan, "route_id", "link_id") == [(1, 5)]


@pytest.mark.parametrize("limit", [2, 100])
def test_segments_of_equal_place_are_ordered_by_their_ends(spark, limit):
    data = [(1, s, link, lat, 10.0) for lat, link in ((0.3, 6), (0.1, 5), (0.4, 6), (0.2, 5)) for s in (None, 4)]
    for given in (data, data[::-1]):
        found = spark.createDataFrame(given, "route_id BIGINT, seq BIGINT, link_id BIGINT, lat1 DOUBLE, segment_len_m DOUBLE")
        runs = merge_runs(found, limit, ties=["lat1"])
        assert rows(runs, "run_no", "link_id", "first_seq", "n_segments") == [(1, 5, None, 2), (2, 6, None, 2), (3, 5, 4, 2), (4, 6, 4, 2)]
