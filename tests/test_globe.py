"""Places anywhere on the globe, sessions in any time zone, repeated keys."""

import pytest

from roadcast.functions.columns import utc_seconds
from roadcast.operators.alerts import update_by_key
from roadcast.operators.sessions import iso_to_epoch, with_iso_times
from roadcast.operators.spatial import close_pairs
from roadcast.operators.state import last_n
from roadcast.sources.tables import normalise_readings


@pytest.mark.parametrize("lat", [0.0, 45.0, -70.0, 82.0, 89.9, 89.9995])
def test_close_pairs_at_any_latitude(spark, lat):
    from math import cos, radians

    step = 180.0 / 111195.0 / cos(radians(lat))
    at = [(n, lat, -180.0 + (n * 7.2) % 360.0) for n in range(50)]
    points = spark.createDataFrame(at, "p long, lat double, lon double")
    moved = [(n, a, (o + step + 180.0) % 360.0 - 180.0) for n, a, o in at]
    mids = spark.createDataFrame(moved, "m long, mid_lat double, mid_lon double")
    got = {(r.p, r.m) for r in close_pairs(points, mids, 200.0).collect()}
    from roadcast.functions.columns import haversine_m

    every = points.crossJoin(mids).filter(haversine_m("lat", "lon", "mid_lat", "mid_lon") <= 200.0)
    assert got == {(r.p, r.m) for r in every.collect()} >= {(n, n) for n in range(50)}


def test_close_pairs_over_the_date_line_and_once(spark):
    points = spark.createDataFrame([(1, 10.0, 179.9995), (2, 89.99999, 10.0)], "p long, lat double, lon double")
    mids = spark.createDataFrame([(1, 10.0, -179.9995), (2, 89.99999, -170.0)], "m long, mid_lat double, mid_lon double")
    assert sorted((r.p, r.m) for r in close_pairs(points, mids, 200.0).collect()) == [(1, 1), (2, 2)]


def test_times_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
        df = with_iso_times(spark.createDataFrame([(0, 1700000000)], "start_ts long, end_ts long"))
        row = df.withColumn("back", iso_to_epoch("end_time_utc")).first()
        assert (row.start_time_utc, row.end_time_utc, row.back) == ("1970-01-01T00:00:00+00:00", "2023-11-14T22:13:20+00:00", 1700000000)
        texts = ["1970-01-01 00:00:10", "1970-01-01T08:00:10+08:00", "1970-01-01T00:00:10Z", "1970-01-02", "1970-01-01 08:00:10.5 +08:00", "never", None]
        seen = spark.createDataFrame([(t,) for t in texts], "t string").select(utc_seconds("t").alias("s")).collect()
        assert [r.s for r in seen] == [10, 10, 10, 86400, 10, None, None]
        raw = spark.createDataFrame([("1", "2", "3", "0", "9", texts[0]), ("1", "2", "3", "0", "9", "never")], "id string, link_id string, speed_band string, min_speed string, max_speed string, snapshot_time string")
        good, rejects = normalise_readings(raw)
        assert [r.snapshot_ts for r in good.collect()] == [10] and rejects.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_values_of_a_repeated_key_stay_together(spark):
    base = spark.createDataFrame([("s", 0.0, 0.0), ("t", 5.0, 5.0)], "id string, lat double, lon double")
    new = spark.createDataFrame([("s", 2.0, 103.0, 1), ("s", 1.0, 104.0, 2), ("x", 1.0, 1.0, 3)], "id string, lat double, lon double, no long")
    rows, count = update_by_key(base, new, "id", ["lat", "lon"], "no")
    assert sorted(map(tuple, rows.collect())) == [("s", 1.0, 104.0), ("t", 5.0, 5.0)] and count.first()[0] == 2
    assert sorted(map(tuple, update_by_key(base, new, "id", ["lat", "lon"])[0].collect()))[0] == ("s", 2.0, 103.0)


def test_readings_without_a_band_are_not_kept(spark):
    rows = spark.createDataFrame([(1, 1, 10, 3), (2, 1, 20, None)], "id long, link_id long, snapshot_ts long, speed_band int")
    assert last_n(rows).first().bands == [3]
