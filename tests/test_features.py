from conftest import rows

from roadcast.operators import features as ft
from roadcast.operators import incidents as inc
from roadcast.operators.sampling import fraction_split_ts, hash_sample, keep_or_sample, last_split_ts, split_last

READ = "id BIGINT, link_id BIGINT, speed_band INT, snapshot_ts BIGINT"
INC = "incident_id BIGINT, nearest_link_id BIGINT, type STRING, start_ts BIGINT, end_ts BIGINT, duration_min DOUBLE, lat DOUBLE, lon DOUBLE"


def test_invalid_band_keeps_its_place(spark):
    data = [(n, 1, b, 300 * n) for n, b in enumerate([1, 2, 9, 4, 5, 6, 7])] + [(50, 2, 3, 0)]
    df = spark.createDataFrame(data, READ)
    got = ft.build_features(df, (1,), (1,), time_names=None, valid=["sb", "sb_tm5", "y_tp5"])
    assert rows(got) == [(1, 1200, 5, 4, 6), (1, 1500, 6, 5, 7)]


def test_short_links_and_time_range(spark):
    df = spark.createDataFrame([(n, 1, n + 1, 300 * n) for n in range(5)], READ)
    got = ft.build_features(df, (1,), (), start=300, end=900, time_names=None)
    assert rows(got) == [(1, 300, 2, None), (1, 600, 3, 2), (1, 900, 4, 3)]


def test_time_parts(spark):
    df = spark.createDataFrame([(1770040500,)], "snapshot_ts BIGINT")
    assert rows(ft.add_time_parts(df, shift_s=28800), "hour", "dow") == [(21, 1)]


def test_incident_edges(spark):
    read = spark.createDataFrame([(1, t) for t in (99, 100, 500, 2000, 2001)] + [(2, 100), (None, 100)], "link_id BIGINT, snapshot_ts BIGINT")
    incidents = spark.createDataFrame(
        [
            (1, 1, "Accident", 100, 2000, 31.0, 1.0, 1.0),
            (2, 1, None, 500, 500, 99.0, 1.0, 1.0),
            (3, 1, "Roadwork", 400, 600, 3.0, 1.0, 1.0),
            (4, None, "Roadwork", 0, 9000, 3.0, 1.0, 1.0),
            (5, 1, "Roadwork", 900, 800, 3.0, 1.0, 1.0),
        ],
        INC,
    )
    flags = rows(inc.flag_incidents(read, incidents))
    assert flags == sorted([(1, 99, 0), (1, 100, 1), (1, 500, 1), (1, 2000, 1), (1, 2001, 0), (2, 100, 0), (None, 100, 0)], key=repr)
    top = inc.covering_max(read, incidents, {"t": "type", "d": "duration_min"}).filter("snapshot_ts = 500")
    assert rows(top, "t", "d") == [("Roadwork", 99.0)]
    rolled = rows(inc.incident_rollup(read, incidents).filter("snapshot_ts = 500"))
    assert rolled == [(1, 500, 1, 2, 0.0, 1, 1, 0)]


def test_equal_readings_merge_and_add_up(spark):
    read = spark.createDataFrame([(1, 100), (1, 100)], "link_id BIGINT, snapshot_ts BIGINT")
    incidents = spark.createDataFrame([(1, 1, "Accident", 0, 200, 1.0, 1.0, 1.0), (2, 1, None, 60, 200, 1.0, 1.0, 1.0)], INC)
    assert rows(inc.incident_rollup(read, incidents)) == [(1, 100, 1, 2, 40 / 60.0, 1, 0, 0)]


def test_nearby_radius(spark):
    roads = spark.createDataFrame([(1, 1.3, 103.8, 1.3, 103.8), (2, 1.4, 103.8, 1.4, 103.8)], "link_id BIGINT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE")
    read = spark.createDataFrame([(1, 100), (2, 100), (1, 9999)], "link_id BIGINT, snapshot_ts BIGINT")
    near, far = 1.3 + 199 / 111194.9, 1.3 + 201 / 111194.9
    incidents = spark.createDataFrame([(1, 1, "Accident", 40, 200, 1.0, near, 103.8), (2, 1, "Roadwork", 0, 200, 1.0, far, 103.8)], INC)
    nearby = inc.nearby_incidents(read, roads.withColumn("x", roads.link_id), incidents)
    assert rows(nearby) == [(1, 100, 1, 1, 0, 0, 1.0)]
    filled = rows(inc.with_nearby(read, nearby).filter("link_id = 2"))
    assert filled == [(2, 100, 0, 0, 0, 0, -1.0)]


def test_type_codes(spark):
    df = inc.fill_incident_nulls(spark.createDataFrame([("Roadwork",), (None,), ("Accident",)], "incident_type STRING"))
    assert rows(inc.encode_types(df, [df])) == [("Accident", 1, 0), ("None", 0, 1), ("Roadwork", 1, 2)]


def test_splits_and_samples(spark):
    df = spark.createDataFrame([(n % 7, n * 1000, n % 2) for n in range(500)], "link_id BIGINT, snapshot_ts BIGINT, f INT")
    assert last_split_ts(df) == 499000 - 172800 and fraction_split_ts(df) == int(0.8 * 499000)
    train, test = split_last(df)
    assert train.count() + test.count() == 500 and test.agg({"snapshot_ts": "min"}).first()[0] >= 499000 - 172800
    want = sum((link * 2654435761 + ts) % 100 < 10 for link, ts, _ in df.collect())
    assert hash_sample(df).count() == want
    kept = keep_or_sample(df, "f")
    assert kept.filter("f = 1").count() == 250
    empty = df.filter("link_id < 0")
    assert [side.count() for side in split_last(empty)] == [0, 0]


def test_missing_columns(spark):
    assert ft.missing_columns(spark.range(1), ["id", "rain_mm"]) == ["rain_mm"]
