import random

from conftest import rows
from pyspark.sql import functions as F

from roadcast.operators import incidents as inc

INC = "incident_id BIGINT, type STRING, start_ts BIGINT, end_ts BIGINT, lat DOUBLE, lon DOUBLE"
ROADS = "link_id BIGINT, start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE"


def test_links_get_only_pieces_that_hold_a_moment(spark):
    """A spot with incidents all day, and links near it that are looked up at a few moments."""
    spans = [(n, "Accident", 60 * n, 60 * n + 5000, 1.3, 103.8) for n in range(1000)]
    roads = spark.createDataFrame([(n, 1.3, 103.8, 1.3, 103.8) for n in range(20)], ROADS)
    moments = spark.createDataFrame([(n, 7000 + 3000 * k) for n in range(20) for k in range(3)], "link_id BIGINT, snapshot_ts BIGINT")
    cover = inc.nearby_cover(roads, spark.createDataFrame(spans, INC), moments)
    assert cover.agg(F.sum(F.size("_pieces"))).first()[0] <= 20 * 3 * 2


def test_nearby_equals_plain_rows(spark):
    rng = random.Random(7)
    at = lambda: (1.3 + rng.randrange(8) / 1000, 103.8 + rng.randrange(8) / 1000)
    kinds = ["Accident", "Roadwork", "Vehicle breakdown", "Heavy Traffic", None]
    spans = []
    for n in range(300):
        s = rng.randrange(-5000, 400_000)
        spans.append((n, rng.choice(kinds), s, rng.choice([s, s + rng.randrange(60), s + rng.randrange(9000), s + rng.randrange(300_000), s + 5_000_000, s - 1, None]), *at()))
    spans += spans[:40] + [(900, "Accident", 0, 9 * 10**9, 1.5, 103.8), (901, "Accident", 0, 100, None, 103.8)]
    # links may come twice, in two places, and without an id or a position
    roads = [(n, *(p := at()), *p) for n in range(12)] + [(3, *(p := at()), *p), (None, 1.3, 103.8, 1.3, 103.8), (5, None, 103.8, 1.3, 103.8), (20, 1.5, 103.8, 1.5, 103.8)]
    roads += roads[:2]
    times = [rng.randrange(-9000, 410_000) for _ in range(40)] + [8 * 10**9, None]
    read = [(link, t) for link in [*range(12), 20, 99, None] for t in rng.sample(times, 30)]
    read += read[:50]
    frames = spark.createDataFrame(roads, ROADS), spark.createDataFrame(spans, INC)
    readings = spark.createDataFrame(read, "link_id BIGINT, snapshot_ts BIGINT")
    got = rows(inc.nearby_incidents(readings, *frames))
    spark.createDataFrame(read, "link_id BIGINT, snapshot_ts BIGINT").createOrReplaceTempView("t_read")
    frames[0].selectExpr("link_id", "(start_lat + end_lat) / 2 AS lat", "(start_lon + end_lon) / 2 AS lon").createOrReplaceTempView("t_mids")
    frames[1].createOrReplaceTempView("t_inc")
    want = spark.sql("""SELECT s.link_id, s.snapshot_ts, 1, max(int(coalesce(type = 'Accident', false))), max(int(coalesce(type = 'Roadwork', false))),
     max(int(coalesce(type = 'Vehicle breakdown', false))), (s.snapshot_ts - max(start_ts)) / 60D
     FROM t_read s JOIN t_mids r ON r.link_id = s.link_id JOIN t_inc i ON s.snapshot_ts BETWEEN i.start_ts AND i.end_ts
      AND 2 * 6371000 * asin(sqrt(pow(sin(radians(i.lat - r.lat) / 2), 2) + cos(radians(i.lat)) * cos(radians(r.lat)) * pow(sin(radians(i.lon - r.lon) / 2), 2))) <= 200
     GROUP BY s.link_id, s.snapshot_ts""")
    assert len(got) > 100 and got == rows(want)
    added = inc.add_nearby(readings, *frames)
    assert added.count() == len(read)
    hit = added.filter("incident_nearby = 1").distinct()
    assert rows(hit.select("link_id", "snapshot_ts", "incident_nearby", *inc._NEARBY_FLAGS, "mins_since_nearby_start")) == got
