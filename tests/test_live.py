from conftest import rows

from roadcast.operators import models as md
from roadcast.operators.features import add_targets
from roadcast.operators.state import last_n, state_to_lags
from roadcast.streaming import live

READ = "id BIGINT, link_id BIGINT, speed_band INT, snapshot_ts BIGINT"
ROAD = "link_id BIGINT, road_name STRING, road_category INT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE"


def land(spark, folder, data, name):
    spark.createDataFrame(data, READ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(READ).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_late_and_repeated_files(spark, tmp_path):
    late = [(n, n % 3, 1 + n % 8, 300 * n) for n in range(20)]
    early = [(100 + n, n % 3, 1 + n % 5, 10 * n) for n in range(20)]
    for name, data in (("a", late), ("b", early), ("c", late)):
        land(spark, tmp_path / "in", data, name)
    live.start_state(stream(spark, tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    got = live.current_state(spark, str(tmp_path / "state"))
    want = last_n(spark.createDataFrame(late + early, READ))
    assert rows(state_to_lags(got)) == rows(state_to_lags(want))
    # later files go on from the stored state
    land(spark, tmp_path / "in", [(500, 0, 8, 99_999)], "d")
    live.start_state(stream(spark, tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    assert got.sparkSession is spark
    again = state_to_lags(live.current_state(spark, str(tmp_path / "state")))
    assert again.filter("link_id = 0").first().sb == 8 and again.count() == 3


def test_one_alert_per_route_and_hour(spark, tmp_path):
    for n in range(3):
        land(spark, tmp_path / "in", [(n, 1, 2, 300 * n)], f"f{n}")
    routes = spark.createDataFrame([(7, 70, True, "00:00", "23:59")], "id BIGINT, user_id BIGINT, alert_enabled BOOLEAN, alert_start_time STRING, alert_end_time STRING")
    links = spark.createDataFrame([(7, 0, 1)], "route_id BIGINT, pos BIGINT, link_id BIGINT")
    clock = iter([10_000, 10_060, 20_000])
    live.start_alerts(
        stream(spark, tmp_path / "in"), routes, links, lambda: (next(clock), "08:00"),
        str(tmp_path / "state"), str(tmp_path / "alerts"), str(tmp_path / "cp"),
    ).awaitTermination()
    assert rows(live.read_alerts(spark, str(tmp_path / "alerts")), "route_id", "n_jammed", "created_ts") == [(7, 1, 10_000), (7, 1, 20_000)]


def test_stream_sessions(spark, tmp_path):
    schema = "type STRING, link_id BIGINT, snapshot_ts BIGINT"
    data = [("A", 1, 0), ("A", 1, 600), ("A", 1, 1501), ("A", 2, 0), ("A", 1, 50_000)]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = live.stream_sessions(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = out.writeStream.format("memory").queryName("sessions").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("sessions")) == [("A", 1, 0, 600, 2), ("A", 1, 1501, 1501, 1), ("A", 1, 50_000, 50_000, 1), ("A", 2, 0, 0, 1)]


def band_rows(n):
    """Bands that follow from the lags, with a quarter of the rows changed by what the hour says."""
    data = [(1 + i % 8, 1 + (i // 3) % 8, 1 + i % 7, 1 + i % 5, i % 4, i % 7, i % 24, 1.3 + i % 9 / 100, 103.8, 1 + (i + (i % 24 > 17)) % 8) for i in range(n)]
    return data, md.BAND_FEATURES["roads"] + ["y_tp15"]


def test_models(spark, tmp_path):
    frame = add_targets(spark.createDataFrame(*band_rows(600)))
    features = md.BAND_FEATURES["roads"]
    model = md.fit_band_model(frame, features, rounds=4, depth=3)
    scored = md.predict_band(model, frame)
    assert {r[0] for r in scored.select("prediction").distinct().collect()} <= set(range(1, 9))
    md.save_model(spark, model, str(tmp_path / "m"))
    again = md.load_model(spark, str(tmp_path / "m"))
    assert rows(md.predict_band(again, frame), "prediction") == rows(scored, "prediction")
    top = md.importance(spark, model, 5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance
    lags = spark.createDataFrame([(1, 3, 3, 3, 3), (2, 4, 4, 4, 4), (3, 5, 5, 5, 5)], "link_id BIGINT, sb INT, sb_tm5 INT, sb_tm10 INT, sb_tm15 INT")
    roads = spark.createDataFrame([(1, "R", 1, 1.3, 103.8, 1.3, 103.8), (2, "R", None, 1.3, 103.8, 1.3, 103.8)], ROAD)
    scores = dict(rows(md.score_links(again, lags, roads, 1770040500)))
    assert scores[1] in range(1, 9) and scores[2] is None and scores[3] is None
    for n in range(2):
        land(spark, tmp_path / "in", [(n, 1, 3, 300 * n), (10 + n, 2, 3, 300 * n)], f"f{n}")
    live.start_scoring(stream(spark, tmp_path / "in"), str(tmp_path / "m"), roads, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.filter("link_id = 1 AND prediction_tp15 BETWEEN 1 AND 8").count() == 2
