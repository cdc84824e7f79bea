import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sessions import metres

from roadcast.operators import routes as rt
from roadcast.operators.spatial import cell_join, distance_summary, in_box_pairs, nearest_in_box, nearest_join
from roadcast.session import cut_lineage
from roadcast.operators.asof import asof_rain

ROAD = "link_id BIGINT, road_name STRING, road_category INT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE"


@pytest.mark.parametrize("box", [(1.2, 1.5, 103.6, 104.0), (-60, 75, -170, 170)])
def test_nearest_equals_all_pairs(spark, box):
    rng = random.Random(5)
    spot = lambda: (rng.uniform(box[0], box[1]), rng.uniform(box[2], box[3]))
    targets = [(n, *spot()) for n in range(120)]
    targets += [(200 + n, *targets[n][1:]) for n in range(10)] + [(900, None, 1.0)]
    points = [(n, *spot()) for n in range(80)] + [(100, 80.0, 10.0), (101, -75.0, -120.0), (102, None, None), (103, *targets[3][1:])]
    got = nearest_join(
        spark.createDataFrame(points, "p BIGINT, lat DOUBLE, lon DOUBLE"),
        spark.createDataFrame(targets, "t BIGINT, lat DOUBLE, lon DOUBLE"), "t", "t", "m",
    ).collect()
    assert len(got) == len(points)
    for r in got:
        if r.lat is None:
            assert r.t is None
            continue
        want = min((round(metres(r.lat, r.lon, t[1], t[2]), 3), t[0]) for t in targets if t[1] is not None)
        assert r.t == want[1] and abs(r.m - want[0]) < 0.01


def haversine(lat, lon, lats, lons):
    h = np.sin(np.radians(lats - lat) / 2) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(lats)) * np.sin(np.radians(lons - lon) / 2) ** 2
    return 2 * 6371000.0 * np.arctan2(np.sqrt(h), np.sqrt(1 - h))


@pytest.mark.parametrize("apart", [0.0, 0.5, 120.0])
def test_many_targets_and_points_in_one_cell(spark, apart):
    """100,000 of each within 0.004 degrees; the points in the same cell, half a degree away, and on the other side of the globe."""
    spots = spark.range(100_000).select("id", (F.rand(3) * 0.004 + 1.3).alias("lat"), (F.rand(4) * 0.004 + 103.8).alias("lon"))
    asked = spark.range(100_000).select("id", (F.rand(5) * 0.004 + 1.3 - apart / 4).alias("lat"), (F.rand(6) * 0.004 + 103.8 - apart).alias("lon"))
    spots, asked = cut_lineage(spots), cut_lineage(asked)
    got = nearest_join(asked, spots, "id", "t", "m").toPandas()
    assert len(got) == 100_000 and got.t.notna().all()
    known = spots.toPandas().sort_values("id")
    for r in got.sample(150, random_state=1).itertuples():
        d = haversine(r.lat, r.lon, known.lat.to_numpy(), known.lon.to_numpy())
        assert abs(d.min() - r.m) < 0.002 and abs(d[r.t] - d.min()) < 0.002


def test_nearest_without_targets_or_points(spark):
    points = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, float("nan"), 2.0)], "p BIGINT, lat DOUBLE, lon DOUBLE")
    assert rows(nearest_join(points, points.filter("FALSE"), "p", "t", "m"), "p", "t", "m") == [(1, None, None), (2, None, None), (3, None, None)]
    assert rows(nearest_join(points, points.filter("p = 1"), "p", "t", "m"), "p", "t") == [(1, 1), (2, None), (3, None)]
    assert nearest_join(points.filter("FALSE"), points, "p", "t", "m").collect() == []


@pytest.mark.parametrize("cell_rows", [2000, 50])
def test_hot_cells_are_split_without_losing_a_pair(spark, cell_rows):
    left = spark.range(900).select(F.col("id").alias("a"), F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 9).alias("c"), F.lit(1).alias("x"))
    right = spark.range(400).select(F.col("id").alias("b"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 12).alias("c"))
    got = cell_join(left, right, ["c"], cell_rows)
    assert got.columns == ["c", "a", "x", "b"]
    assert rows(got, "a", "b", "c") == rows(left.join(right, "c"), "a", "b", "c")


def test_points_in_one_cell_spread_over_tasks(spark):
    """All points of a box join in one cell: the rows of a task are bounded, the pairs are all pairs."""
    points = spark.range(3000).select("id", (F.lit(1.3) + F.col("id") * 1e-8).alias("lat"), F.lit(103.8).alias("lon"))
    mids = spark.range(700).select("id", (F.lit(1.3) + F.col("id") * 1e-8).alias("mid_lat"), F.lit(103.8).alias("mid_lon"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = in_box_pairs(points.withColumnRenamed("id", "p"), mids, 0.001)
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
        hot = cell_join(points.withColumn("c", F.lit(1)), mids.withColumn("c", F.lit(1)).withColumnRenamed("id", "m"), ["c"], 200)
        tasks = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == sum(tasks) == 3000 * 700
    assert len(tasks) > 10 and max(tasks) < sum(tasks) / 4


def test_distance_summary(spark):
    rng = random.Random(1)
    values = [round(rng.expovariate(1 / 300), 4) for _ in range(700)] + [250.0] * 300
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "dist_to_road_m DOUBLE")
    r = distance_summary(df).first()
    want = np.quantile(values, [0.5, 0.9, 0.99])
    assert np.allclose([r.p50, r.p90, r.p99], want, atol=1e-9)
    assert (r.n, r.over_200m, r.over_500m) == (1000, sum(v > 200 for v in values), sum(v > 500 for v in values))


def test_box_match(spark):
    roads = spark.createDataFrame(
        [(5, None, 1, 1.3, 103.8, 1.3, 103.8), (3, "B", 1, 1.3, 103.8, 1.3, 103.8), (7, "C", 1, 1.3009, 103.8, 1.3009, 103.8), (9, None, 2, 1.4, 103.9, 1.4, 103.9)], ROAD
    )
    points = spark.createDataFrame([(1, 1.3001, 103.8), (2, 1.4, 103.9), (3, 1.5, 103.8), (4, 1.3018, 103.8)], "p BIGINT, lat DOUBLE, lon DOUBLE")
    got = rows(nearest_in_box(points, roads), "p", "matched_link_id", "matched_road_name")
    assert got == [(1, 3, "B"), (2, 9, "LTA Road"), (3, None, "Ummapped Road"), (4, 7, "C")]


def test_route_matching(spark):
    step = 0.0004  # about 44 m
    roads = spark.createDataFrame(
        [
            (1, "A", 1, 1.3, 103.8, 1.3, 103.8 + step),
            (4, "A2", 1, 1.3, 103.8, 1.3, 103.8 + step),  # same score: the lower id wins
            (2, "B", 1, 1.3, 103.8 + 2 * step, 1.3, 103.8 + step),  # drawn the other way
            (3, "C", 1, 1.3 - step / 2, 103.8 + step / 2, 1.3 + step / 2, 103.8 + step / 2),  # across
        ],
        ROAD,
    )
    line = [(1.3, 103.8), (1.3, 103.8 + step / 2), (1.3, 103.8 + step), (1.3, 103.8 + step + 1e-6), (1.3, 103.8 + 2 * step), (1.5, 103.9), (1.3, 103.8 + 2 * step), (1.3, 103.8 + step)]
    points = spark.createDataFrame([(1, n, *p) for n, p in enumerate(line)] + [(2, 0, 1.0, 1.0)], "route_id BIGINT, seq BIGINT, lat DOUBLE, lon DOUBLE")
    segs = rt.segments(points)
    assert [r.seq for r in segs.orderBy("seq").collect()] == [0, 1, 3, 4, 5, 6]
    matches = rt.match_segments(segs, roads)
    assert rows(matches, "seq", "link_id") == [(0, 1), (1, 1), (3, 2), (4, None), (5, None), (6, 2)]
    assert rows(rt.merge_runs(matches), "run_no", "link_id", "n_segments") == [(1, 1, 2), (2, 2, 2)]
    total = rt.route_summary(matches).first()
    assert 0 < total.covered_len_m <= total.total_route_len_m and 0 < total.coverage_ratio < 1


def test_rain_as_of(spark):
    rng = random.Random(2)
    rain = [(s, rng.randrange(0, 60) * 600, float(rng.randrange(0, 5))) for s in ("a", "b") for _ in range(25)]
    read = [(n % 3, rng.randrange(0, 70) * 600) for n in range(200)]
    got = asof_rain(
        spark.createDataFrame(read, "link_id BIGINT, snapshot_ts BIGINT"),
        spark.createDataFrame([(0, "a"), (1, "b")], "link_id BIGINT, nearest_station_id STRING"),
        spark.createDataFrame(rain, "station_id STRING, ts BIGINT, rain_mm DOUBLE"),
    )
    want = []
    for link, ts in read:
        seen = [(t, mm) for s, t, mm in rain if s == {0: "a", 1: "b"}.get(link) and t <= ts]
        mm = max(seen)[1] if seen else None
        want.append((link, ts, mm, None if mm is None else int(mm > 0)))
    assert rows(got) == sorted(want, key=repr)
