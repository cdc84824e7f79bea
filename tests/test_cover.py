import random

import pytest
from pyspark.sql import functions as F

from roadcast.operators.asof import asof_rain
from roadcast.operators.cover import STEP, cover_table, interval_pieces, look_up

KINDS = "link BIGINT, start_ts BIGINT, end_ts BIGINT, kind STRING, weight BIGINT"
FOLDS = {"n": "sum", "weight": "max", "kind": "max"}
NAMES = list(FOLDS)
YEAR = 31_557_600


def pieces_of(df):
    columns = {"n": F.lit(1).cast("bigint"), "weight": F.col("weight"), "kind": F.col("kind")}
    return interval_pieces(df, ["link"], {name: (columns[name], fold) for name, fold in FOLDS.items()})


def intervals(rng):
    out = []
    for n in range(400):
        start = rng.choice([rng.randrange(-9000, 9000), rng.randrange(0, 50 * YEAR), 2048 * rng.randrange(-3, 9), (1 << 33) - rng.randrange(5000)])
        length = rng.choice([0, 1, 5, 2047, 2048, rng.randrange(4096), rng.randrange(90_000), rng.randrange(10 * YEAR), -3])
        out.append((n % 4 or None, start, start + length, rng.choice(["a", "b", None]), n))
    return [*out, (1, 100, 100 + 50 * YEAR, "long", 7), (2, -5 * 10**9, 4 * 10**10, "age", 3), (3, None, 5, "x", 1), (3, 5, None, "x", 1)]


def test_lookup_against_trying_all(spark):
    rng = random.Random(2)
    data = intervals(rng)
    edges = [t + d for _, s, e, _, _ in data for t in (s, e) if t is not None for d in (-1, 0, 1)]
    asked = [(n, rng.choice([None, 1, 2, 3, 4]), t) for n, t in enumerate([*rng.sample(edges, 500), *(rng.randrange(0, 60 * YEAR) for _ in range(300))])]
    rows = spark.createDataFrame(asked, "id BIGINT, link BIGINT, snapshot_ts BIGINT")
    cover = cover_table(pieces_of(spark.createDataFrame(data, KINDS)), ["link"], NAMES)
    got = {r.id: (r._covered, r.n, r.weight, r.kind) for r in look_up(rows, cover, ["link"], FOLDS).collect()}
    for n, link, t in asked:
        hits = [d for d in data if link is not None and d[0] == link and d[1] is not None and d[2] is not None and d[1] <= t <= d[2]]
        most = lambda k: max((d[k] for d in hits if d[k] is not None), default=None)  # noqa: E731, B023
        assert got[n] == (bool(hits), len(hits), most(4), most(3)), (link, t)


def test_pieces_of_one_interval_are_few_and_do_not_overlap(spark):
    spans = [(100, 100 + 50 * YEAR), (0, 2047), (1, 2046), (2040, 2050), (5, 5), (-7, 123_456_789), (0, (1 << 33) - 1), (-1, 1 << 35)]
    data = [(n, s, e, None, 1) for n, (s, e) in enumerate(spans)]
    pieces = interval_pieces(spark.createDataFrame(data, KINDS), ["link"], {}).collect()
    for n, (s, e) in enumerate(spans):
        own = sorted((p.s, p.e, p.tier, p.cell) for p in pieces if p.link == n)
        assert own[0][0] == s and own[-1][1] == e and all(a[1] + 1 == b[0] for a, b in zip(own, own[1:]))
        assert len(own) <= 2 + 2 * 32
        assert all(lo >> STEP * (t + 1) == hi >> STEP * (t + 1) == c for lo, hi, t, c in own)


def test_lists_stay_bounded(spark):
    """100,000 different intervals in one hour of one link, and a million seconds of day-long ones."""
    many = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("link"), F.pmod(F.col("id") * 7919, F.lit(3600)).alias("start_ts"),
        F.pmod(F.col("id") * 104_729, F.lit(3600)).alias("_n"), F.lit("a").alias("kind"), F.col("id").alias("weight"),
    )
    many = many.withColumn("end_ts", F.greatest("start_ts", "_n")).drop("_n")
    days = spark.range(50_000).select(
        F.lit(1).cast("bigint").alias("link"), (F.col("id") * 20).alias("start_ts"), (F.col("id") * 20 + 86_400).alias("end_ts"), F.lit("b").alias("kind"), F.col("id").alias("weight")
    )
    both = many.unionByName(days)
    cover = cover_table(pieces_of(both), ["link"], NAMES)
    assert cover.agg(F.max(F.size("_pieces"))).first()[0] <= 2 * 2048 + 4094
    rows = spark.createDataFrame([(n, 1, t) for n, t in enumerate([0, 17, 1800, 3599, 500_000])], "id BIGINT, link BIGINT, snapshot_ts BIGINT")
    got = {r.id: r.n for r in look_up(rows, cover, ["link"], FOLDS).collect()}
    want = rows.join(both, (F.col("snapshot_ts") >= F.col("start_ts")) & (F.col("snapshot_ts") <= F.col("end_ts"))).groupBy("id").count().collect()
    assert got == {r["id"]: r["count"] for r in want}


@pytest.mark.parametrize("gap", [60, 40 * YEAR])
def test_rain_holds_until_the_next_value(spark, gap):
    rain = spark.createDataFrame([("S1", 1000, 0.0), ("S1", 1000, 2.5), ("S1", 1000 + gap, None), ("S1", 1000 + 2 * gap, 0.0), ("S2", 5, 1.0)], "station_id STRING, ts BIGINT, rain_mm DOUBLE")
    mapping = spark.createDataFrame([(1, "S1"), (2, "S2"), (3, None)], "link_id BIGINT, nearest_station_id STRING")
    asked = [(1, 999), (1, 1000), (1, 1000 + gap - 1), (1, 1000 + gap), (1, 1000 + 2 * gap), (1, 1000 + 900 * YEAR), (2, 4), (2, 5 + 100 * YEAR), (3, 1000), (4, 1000)]
    rows = spark.createDataFrame(asked, "link_id BIGINT, snapshot_ts BIGINT")
    got = {(r.link_id, r.snapshot_ts): (r.rain_mm, r.is_raining) for r in asof_rain(rows, mapping, rain).collect()}
    want = [(None, None), (2.5, 1), (2.5, 1), (None, None), (0.0, 0), (0.0, 0), (None, None), (1.0, 1), (None, None), (None, None)]
    assert got == dict(zip(asked, want))


def test_no_intervals(spark):
    rows = spark.createDataFrame([(1, 1, 5)], "id BIGINT, link BIGINT, snapshot_ts BIGINT")
    cover = cover_table(pieces_of(spark.createDataFrame([], KINDS)), ["link"], NAMES)
    assert [tuple(r) for r in look_up(rows, cover, ["link"], FOLDS).collect()] == [(1, 1, 5, False, 0, None, None)]


def test_cutting_is_not_interpreted(spark):
    """Pieces come from plain columns: no list with a function of its own is built for each interval."""
    data = spark.createDataFrame(intervals(random.Random(3)), KINDS)
    plan = pieces_of(data)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan.lower() and "transform(" not in plan
