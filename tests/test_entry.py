"""A choice of registered queries against their DuckDB twins at the smallest scale; check.py runs them all."""

import pytest

import __spark_entry__ as entry_points
from check import connect, rows_by_name

SF = "/root/testdata/sf0.001"
NAMES = [
    "features_roads_tp15", "clean_noroads_tp30", "features_incident_types", "features_master_v3", "nearby_incidents", "asof_rain",
    "binary_metrics", "incident_nearest_link", "match_routes", "alert_cooldown", "current_places",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_equal(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    cur = duck.execute(entry_points.oracle_sql()[name])
    want = rows_by_name([c[0] for c in cur.description], cur.fetchall())
    assert rows_by_name(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_twin_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
