import json

from conftest import rows
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.sources import feeds, sinks, tables

ITEM = {"Type": "Roadwork", "Latitude": 1.3, "Longitude": 103.8, "Message": "m"}


def test_incident_files(spark, tmp_path):
    (tmp_path / "bare.json").write_text(json.dumps([ITEM] * 40))
    (tmp_path / "wrapped.json").write_text(json.dumps({"value": [ITEM] * 3}))
    assert feeds.read_incident_feed(spark, str(tmp_path / "bare.json")).count() == 30
    wrapped = feeds.read_incident_feed(spark, str(tmp_path / "wrapped.json"))
    assert wrapped.columns == list(ITEM) and rows(wrapped) == [tuple(ITEM.values())] * 3


def test_speed_pages(spark, tmp_path):
    page = {"value": [{"LinkID": "1", "SpeedBand": "3"}, {"LinkID": "x", "SpeedBand": "3"}, {"LinkID": "2", "SpeedBand": None}]}
    (tmp_path / "a.json").write_text(json.dumps({"fetched_at": 100, **page}))
    (tmp_path / "b.json").write_text(json.dumps(page))
    got = feeds.read_speed_pages(spark, str(tmp_path)).collect()
    assert [(r.link_id, r.speed_band) for r in got] == [(1, 3)] * 2
    assert min(r.fetched_at for r in got) == 100 and max(r.fetched_at for r in got) > 1_600_000_000


def test_stations(spark, tmp_path):
    stations = [("S1", 1.3, 103.8), ("S2", 0, 103.8), ("S3", None, 1.0)]
    body = {"data": {"stations": [{"id": i, "location": {"latitude": a, "longitude": b}} for i, a, b in stations] + [{"id": "S4"}]}}
    (tmp_path / "s.json").write_text(json.dumps(body))
    df = spark.read.schema(schemas.STATION_FEED).option("multiLine", True).json(str(tmp_path / "s.json"))
    assert rows(feeds.flatten_stations(df)) == [("S1", 1.3, 103.8)]


def test_geocode(spark):
    hit = lambda n, **k: {"SEARCHVAL": f"s{n}", "ADDRESS": f"a{n}", "POSTAL": "1", "LATITUDE": "1.3", "LONGITUDE": "103.8", **k}
    body = {"results": [hit(0, LATITUDE=""), hit(1, ADDRESS=""), hit(2, LONGITUDE=None)] + [hit(n) for n in range(3, 14)]}
    df = spark.createDataFrame([("q", json.dumps(body)), ("none", '{"results": []}')], "query STRING, body STRING")
    got = feeds.flatten_geocode(df).orderBy("pos").collect()
    assert [r.label for r in got] == ["s1", *[f"a{n}" for n in range(3, 10)]]


def test_normalise(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "id,link_id,speed_band,min_speed,max_speed,snapshot_time\n1,10,3,0,9,2026-02-02 13:55:00\n2,x,3,0,9,2026-02-02T13:55:00+00:00\n3,10,3,0,9,oops\n"
    )
    good, bad = tables.normalise_readings(tables.read_landed(spark, str(tmp_path / "r.csv")))
    assert rows(good, "id", "link_id", "snapshot_ts") == [(1, 10, 1770040500), (2, None, 1770040500)]
    assert rows(bad, "id") == [("3",)]


def test_day_folders_prune(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("link_id"), (F.col("id") * 600).alias("snapshot_ts"))
    out = str(tmp_path / "features")
    sinks.write_by_day(df, out, max_records=50)
    back = spark.read.parquet(out)
    assert back.count() == 1000 and back.select("day").distinct().count() == 7
    plan = back.filter("day = '1970-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    from roadcast.operators.features import build_features

    path = str(tmp_path / "readings")
    spark.range(100).selectExpr("id", "id % 5 AS link_id", "CAST(1 + id % 8 AS INT) AS speed_band", "0 AS min_speed", "9 AS max_speed", "id * 300 AS snapshot_ts").write.parquet(path)
    df = build_features(tables.read_readings(spark, path), start=300, end=9000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(snapshot_ts,300)" in plan and "max_speed" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_feed_files_in_order(spark, tmp_path):
    """The first entries are those of the first file, in its order, whatever partitions the files fall into."""
    for n in range(3):
        items = [{**ITEM, "Message": f"{n}-{k}"} for k in range(25)]
        (tmp_path / f"f{n}.json").write_text(json.dumps(items if n % 2 else {"value": items}))
    got = [r.Message for r in feeds.read_incident_feed(spark, str(tmp_path), n=40).collect()]
    assert got == [f"0-{k}" for k in range(25)] + [f"1-{k}" for k in range(15)]
    assert feeds.read_incident_feed(spark, str(tmp_path), n=None).count() == 75


def test_buckets_need_no_shuffle(spark, tmp_path):
    from roadcast.operators.features import build_features

    rows = spark.range(2000).selectExpr("id", "id % 37 AS link_id", "CAST(1 + id % 8 AS INT) AS speed_band", "id * 300 AS snapshot_ts")
    table = sinks.write_bucketed(rows, "bucketed_readings", str(tmp_path / "b"), order=("snapshot_ts", "id"), buckets=8)
    roads = sinks.write_bucketed(spark.range(37).selectExpr("id AS link_id", "id AS road"), "bucketed_roads", str(tmp_path / "r"), order=(), buckets=8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = build_features(table, hot=None).join(roads, "link_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert rows_equal(build_features(table, hot=None), build_features(rows, hot=None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("bucketed_readings", "bucketed_roads"):
            spark.sql(f"DROP TABLE {name}")


def rows_equal(a, b):
    return rows(a) == rows(b)


def test_bounds_come_from_footers(spark, tmp_path):
    from roadcast.operators.sampling import file_bounds

    spark.range(1000).selectExpr("id * 3 AS snapshot_ts").write.parquet(str(tmp_path / "t"))
    found = file_bounds(spark, str(tmp_path / "t"))
    assert "PushedAggregation: [COUNT(*), MIN(snapshot_ts), MAX(snapshot_ts)]" in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(found.first()) == (1000, 0, 2997)


def test_sides_from_one_read(spark):
    from roadcast.operators.sampling import split_last, with_side_fraction, with_side_last

    df = spark.range(11).selectExpr("id", "id * 86400 AS snapshot_ts").unionByName(spark.sql("SELECT 99L AS id, CAST(NULL AS BIGINT) AS snapshot_ts"))
    train, test = split_last(df)
    got = with_side_last(df)
    assert rows(got.filter("side = 'train'"), "id") == rows(train, "id") and rows(got.filter("side = 'test'"), "id") == rows(test, "id")
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert rows(with_side_fraction(df).groupBy("side").count()) == [("test", 3), ("train", 8)]
    empty = df.filter("FALSE")
    assert with_side_last(empty).collect() == [] and split_last(empty)[0].collect() == []
