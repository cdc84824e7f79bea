import random

from conftest import rows
from pyspark.sql import functions as F
from math import atan2, cos, radians, sin, sqrt

from roadcast.operators import sessions
from roadcast.operators.sessions import assign_incidents, fold_incidents, iso_to_epoch, with_iso_times

SNAP = "row_id BIGINT, type STRING, lat DOUBLE, lon DOUBLE, message STRING, snapshot_ts BIGINT"


def metres(a, b, c, d):
    h = sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2
    return 12742000.0 * atan2(sqrt(h), sqrt(1 - h))


def one_by_one(data, gap_s, radius):
    """All rows in one list, in time order: what the split work must equal."""
    incidents, owner = [], {}
    for row_id, kind, lat, lon, _, ts in sorted(data, key=lambda r: (r[5], r[0])):
        best = None
        for i in incidents:
            if i["type"] == kind and ts - i["seen"] <= gap_s and lat is not None and i["lat"] is not None:
                m = metres(lat, lon, i["lat"], i["lon"])
                if m <= radius and (best is None or m < best[0]):
                    best = (m, i)
        if best is None:
            incidents.append({"type": kind, "lat": lat, "lon": lon, "seen": ts, "id": row_id})
            owner[row_id] = row_id
        else:
            best[1]["seen"] = ts
            owner[row_id] = best[1]["id"]
    return owner


def test_fold_equals_the_sequential_walk(spark):
    rng = random.Random(11)
    data = []
    for n in range(1500):
        spot = rng.randrange(6)
        data.append((
            n, rng.choice(["Accident", "Roadwork", None]), 1.3 + spot * 0.004 + rng.randrange(6) * 0.0006,
            103.8 + rng.randrange(5) * 0.0007, None if n % 5 else f"m{n}", rng.randrange(0, 400) * 60,
        ))
    data += [(2000 + n, "Accident", None, None, None, 600) for n in range(2)]
    snaps = spark.createDataFrame(data, SNAP)
    owner = one_by_one(data, 900, 200.0)
    for limit in (250_000, 120):
        assert {r.row_id: r.first_row for r in assign_incidents(snaps, max_rows=limit).collect()} == owner
    folded = fold_incidents(snaps).collect()
    by_id = {r[0]: r for r in data}
    assert {r.incident_id for r in folded} == set(owner.values())
    for r in folded:
        times = [by_id[k][5] for k, v in owner.items() if v == r.incident_id]
        assert (r.start_ts, r.end_ts, r.duration_min) == (min(times), max(times), (max(times) - min(times)) / 60.0)
        assert (r.lat, r.lon, r.message) == (by_id[r.incident_id][2], by_id[r.incident_id][3], by_id[r.incident_id][4])


def spread(rng, n, lat, lon, kind, first, width=0.02):
    """Rows that drift over tile edges: a chain of reports that reaches from one end to the other."""
    return [
        (first + k, kind, lat + rng.random() * width, ((lon + rng.random() * width / max(0.02, cos(radians(lat))) + 180) % 360) - 180, None, rng.randrange(0, 40_000))
        for k in range(n)
    ]


def test_chained_reports_over_many_tiles(spark, monkeypatch):
    """One type without a gap anywhere, so that all rows hang together; tiles of five radii, several tasks."""
    monkeypatch.setattr(sessions, "TILE_RADII", 5)
    rng = random.Random(5)
    data = spread(rng, 900, 1.3, 103.8, "Heavy Traffic", 0) + [(5000 + n, "Heavy Traffic", 1.31, 103.81, "m", 40 * n) for n in range(300)]
    snaps = spark.createDataFrame(data, SNAP)
    got = {r.row_id: r.first_row for r in assign_incidents(snaps, max_rows=100).collect()}
    assert got == one_by_one(data, 900, 200.0)


def test_far_north_date_line_and_poles(spark, monkeypatch):
    rng = random.Random(8)
    data = spread(rng, 250, 82.0, 25.0, "A", 0) + spread(rng, 250, -17.0, 179.99, "A", 1000) + spread(rng, 120, 89.97, 0.0, "B", 2000) + spread(rng, 120, -89.985, 100.0, "B", 3000, 0.01)
    for radii in (40, 4):
        monkeypatch.setattr(sessions, "TILE_RADII", radii)
        got = {r.row_id: r.first_row for r in assign_incidents(spark.createDataFrame(data, SNAP)).collect()}
        assert got == one_by_one(data, 900, 200.0)


def test_fifty_incidents_at_82_degrees(spark):
    east = lambda n, m: 20.0 + n * 0.2 + m / (111194.926645 * cos(radians(82.0)))
    data = [(2 * n + k, "A", 82.0, east(n, 150.0 * k), None, 60 * k) for n in range(50) for k in (0, 1)]
    assert fold_incidents(spark.createDataFrame(data, SNAP)).count() == 50


def test_copies_of_a_row_and_empty_table(spark):
    data = [(1, "A", 1.3, 103.8, "x", 0), (2, "A", 1.3, 103.8, "y", 0), (3, None, None, 1.0, None, None), (4, "A", float("nan"), 1.0, None, 5)]
    snaps = spark.createDataFrame(data, SNAP)
    assert {r.row_id: r.first_row for r in assign_incidents(snaps).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert fold_incidents(snaps.filter("FALSE")).collect() == []


def test_gap_and_distance_limits(spark):
    north = lambda m: 1.3 + m / 111194.926645
    data = [
        (1, "A", 1.3, 103.8, "x", 0), (2, "A", 1.3, 103.8, None, 900), (3, "A", 1.3, 103.8, None, 1801),
        (4, "B", 1.3, 103.8, None, 0), (5, "B", north(199.9), 103.8, None, 60), (6, "B", north(200.1), 103.8, None, 120),
        (7, "B", north(-199.0), 103.8, None, 960),
    ]
    got = {r.row_id: r.first_row for r in assign_incidents(spark.createDataFrame(data, SNAP)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 4}


def test_iso_round_trip(spark):
    df = spark.createDataFrame([(0, 1770040500)], "start_ts BIGINT, end_ts BIGINT")
    out = with_iso_times(df).withColumn("back", iso_to_epoch("end_time_utc"))
    assert rows(out, "start_time_utc", "back") == [("1970-01-01T00:00:00+00:00", 1770040500)]


def test_tiles_of_a_row_are_computed_once(spark):
    """A cosine for the width of the reach, and one in the condition and one in the result for each of three bands; nine tiles share them."""
    rows = spark.createDataFrame([(False, "a", 17, 1500, 0, 1, 100, 1.3, 103.8)], f"{', '.join(f'{c} {t}' for c, t in zip(sessions._REGION, ('BOOLEAN', 'STRING', 'BIGINT', 'BIGINT', 'BIGINT')))}, row_id BIGINT, snapshot_ts BIGINT, lat DOUBLE, lon DOUBLE")
    spans = rows.select(*sessions._REGION, F.col("snapshot_ts").alias("_from"), F.col("snapshot_ts").alias("_till"))
    plan = sessions._spread(rows, spans, "lat", "lon", 200.0, 4, 3600)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("COS(") <= 7
