from conftest import rows
from pyspark.sql import functions as F

from roadcast.functions.columns import clock, in_daily_window
from roadcast.operators import alerts as al
from roadcast.operators import evaluate as ev
from roadcast.operators.state import enrich_incidents, last_n, state_to_lags


def test_daily_window(spark):
    cases = [("07:30", "09:00", "07:30", True), ("07:30", "09:00", "09:01", False), ("22:00", "06:00", "23:10", True), ("22:00", "06:00", "06:00", True), ("22:00", "06:00", "12:00", False), (None, None, "08:00", True)]
    df = spark.createDataFrame(cases, "a STRING, b STRING, n STRING, want BOOLEAN")
    assert df.filter(in_daily_window("a", "b", "n") != F.col("want")).count() == 0
    assert rows(spark.createDataFrame([(1770040500,)], "t BIGINT").select(clock("t"))) == [("21:55",)]


def test_route_alerts(spark):
    routes = spark.createDataFrame(
        [(1, 10, True, "07:30", "09:00"), (2, 10, True, "22:00", "06:00"), (3, 11, False, None, None), (4, 12, True, None, None), (5, 13, True, None, None)],
        "id BIGINT, user_id BIGINT, alert_enabled BOOLEAN, alert_start_time STRING, alert_end_time STRING",
    )
    links = spark.createDataFrame([(1, 0, 100), (1, 1, 101), (2, 0, 100), (3, 0, 100), (4, 0, 999)], "route_id BIGINT, pos BIGINT, link_id BIGINT")
    latest = spark.createDataFrame([(100, 3), (101, 4)], "link_id BIGINT, sb INT")
    assert rows(al.route_alerts(routes, links, latest, "08:00")) == [(1, 10, 2, 1, [100], False)]
    assert rows(al.route_alerts(routes, links, latest, "08:00", threshold=0)) == [(1, 10, 2, 1, [100], False), (4, 12, 1, 0, [], False)]
    assert rows(al.route_alerts(routes, links, latest, "23:00")) == [(2, 10, 1, 1, [100], False)]


def test_cooldown(spark):
    new = spark.createDataFrame([(1,), (2,), (3,)], "route_id BIGINT")
    sent = spark.createDataFrame([(1, 10_000 - 3600), (2, 10_000 - 3599), (2, 9_999)], "route_id BIGINT, created_ts BIGINT")
    assert rows(al.apply_cooldown(new, sent, 10_000)) == [(1,), (3,)]


def test_change_log(spark):
    log = [
        (1, 1, "insert", "a", "x"), (1, 2, "update", None, "y"), (1, 3, "update", "b", None),
        (2, 4, "update", "lost", "lost"), (2, 5, "insert", None, None), (2, 6, "delete", "z", "z"),
        (3, 7, "insert", "old", "old"), (3, 8, "delete", None, None), (3, 9, "insert", None, "new"),
        (4, 10, "delete", None, None), (4, 11, "update", "q", "q"),
    ]
    df = spark.createDataFrame(log, "k BIGINT, no BIGINT, op STRING, a STRING, b STRING")
    assert rows(al.current_rows(df, ["k"], "no", ["a", "b"])) == [(1, 1, "b", "y"), (3, 9, None, "new")]


def test_newest_first(spark):
    df = spark.createDataFrame([(1, 5, 100, False), (2, 5, 300, True), (3, 5, 200, False), (4, 6, 1, False)], "id BIGINT, user_id BIGINT, created_ts BIGINT, is_dismissed BOOLEAN")
    assert [r.id for r in al.newest_first(df, 5).collect()] == [2, 3, 1]
    assert [r.id for r in al.open_alerts(df, 5).collect()] == [3, 1]


def test_update_by_key(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k STRING, v DOUBLE")
    new = spark.createDataFrame([("a", 9.0), ("b", 8.0), ("z", 7.0)], "k STRING, v DOUBLE")
    updated, count = al.update_by_key(base, new, "k", ["v"])
    assert rows(updated) == [("a", 9.0), ("b", 8.0), ("c", 3.0)] and count.first()[0] == 2


def test_state_and_incidents(spark):
    read = spark.createDataFrame([(n, 1, n, 100 * n) for n in range(1, 7)] + [(9, 2, 5, 100)], "id BIGINT, link_id BIGINT, speed_band INT, snapshot_ts BIGINT")
    lags = state_to_lags(last_n(read))
    assert rows(lags) == [(1, 6, 5, 4, 3), (2, 5, 5, 5, 5)]
    roads = spark.createDataFrame([(1, "R", 1, 1.0, 103.0, 1.0, 103.0), (3, None, 1, 2.0, 103.0, 2.0, 103.0)], "link_id BIGINT, road_name STRING, road_category INT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE")
    feed = spark.createDataFrame([("Accident", 1.0, 103.0), ("Accident", 2.0, 103.0), ("Accident", 9.0, 103.0)], "Type STRING, Latitude DOUBLE, Longitude DOUBLE")
    scores = spark.createDataFrame([(1, 7)], "link_id BIGINT, prediction_tp15 INT")
    got = rows(enrich_incidents(feed, roads, lags, scores), "lat", "matched_link_id", "matched_road_name", "current_speed_band", "predicted_speed_band_tp15")
    assert got == [(1.0, 1, "R", "6", "7"), (2.0, 3, "LTA Road", "N/A", None), (9.0, None, "Ummapped Road", "N/A", "N/A")]


def test_scores(spark):
    df = spark.createDataFrame([(3, 3, 3), (4, 6, 3), (5, 5, 5), (1, 2, 1)], "sb INT, y_tp15 INT, prediction INT")
    r = ev.class_metrics(df).first()
    assert (r.n, r.acc, r.base_acc, r.change_rows, r.change_acc) == (4, 0.5, 0.5, 2, 0.0)
    assert (r.mae, r.within1, r.base_mae) == (1.0, 0.75, 0.75)
    still = ev.class_metrics(df.filter("sb = y_tp15")).first()
    assert still.change_rows == 0 and still.change_acc is None
    two = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.1), (0, 0.0)], "change INT, prob DOUBLE")
    sweep = {round(x.threshold, 2): (x.precision, x.recall, x.f1) for x in ev.threshold_sweep(two, "change", "prob").collect()}
    assert sweep[0.3] == (0.5, 0.5, 0.5) and sweep[0.5] == (0.0, 0.0, 0.0) and len(sweep) == 7
    none = ev.binary_metrics(two, "change", F.lit(0)).first()
    assert (none.accuracy, none.precision, none.recall, none.f1) == (0.5, 0.0, 0.0, 0.0)
    assert ev.change_summary(two, "change", (F.col("prob") >= 0.25).cast("int")).first() == (0.5, 2, 0.5)
