"""Road-traffic views over the driver's tables.

One text per view for both engines: ``{name}`` stands for a table or another view, ``[EP]`` for the epoch
seconds of ``ts``, ``[DIV]`` for whole division, ``[STRIDES]`` for one row per step width of the road graph.  Every view reads its tables whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_STRIDES = ", ".join(str(n * 10**p) for p in range(4) for n in range(1, 6))
SPARK_TOKENS = {
    "[EP]": "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)",
    "[DIV]": "div",
    "[STRIDES]": f"explode(array({_STRIDES}))",
}
DUCK_TOKENS = {"[EP]": "(epoch_us(ts)//1000000)", "[DIV]": "//", "[STRIDES]": f"unnest([{_STRIDES}])"}

# The events span 30 days from here; all time-range filters use these bounds.
START_TS = 1704067200
END_TS = START_TS + 30 * 86400
NOW_TS = START_TS + 29 * 86400 + 8 * 3600

VIEWS = {
    "speedbands": """
SELECT event_id AS id, link_id, CAST(1 + (event_id + v) % 9 AS INT) AS speed_band,
 CAST(10 * ((event_id + v) % 9) AS INT) AS min_speed, CAST(10 * ((event_id + v) % 9) + 9 AS INT) AS max_speed, snapshot_ts
FROM (SELECT link_id, snapshot_ts, max(event_id) AS event_id, max(v) AS v
      FROM (SELECT user_id AS link_id, ([EP] [DIV] 300) * 300 AS snapshot_ts, event_id,
                   CAST(floor(value) AS BIGINT) AS v FROM {events}) e
      GROUP BY link_id, snapshot_ts) g""",
    "road_links": """
SELECT c_custkey AS link_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('Road ', CAST(c_nationkey AS STRING)) END AS road_name,
 CAST(1 + c_nationkey % 8 AS INT) AS road_category,
 CAST(1.25 AS DOUBLE) + (c_custkey * 37 % 1500) / CAST(10000 AS DOUBLE) AS start_lat,
 CAST(103.70 AS DOUBLE) + (c_custkey * 53 % 2000) / CAST(10000 AS DOUBLE) AS start_lon,
 CAST(1.25 AS DOUBLE) + (c_custkey * 37 % 1500 + 5) / CAST(10000 AS DOUBLE) AS end_lat,
 CAST(103.70 AS DOUBLE) + (c_custkey * 53 % 2000 + c_custkey % 7) / CAST(10000 AS DOUBLE) AS end_lon
FROM {customer}""",
    "incident_snapshots": """
SELECT event_id AS row_id, CASE event_type WHEN 'error' THEN 'Accident' WHEN 'signup' THEN 'Roadwork' WHEN 'click' THEN 'Vehicle breakdown' WHEN 'view' THEN 'Heavy Traffic' ELSE 'Obstacle' END AS type,
 CAST(1.25 AS DOUBLE) + ((user_id % 12) * 100 + (event_id % 5) * 8) / CAST(10000 AS DOUBLE) AS lat,
 CAST(103.70 AS DOUBLE) + ((user_id % 12) * 100) / CAST(10000 AS DOUBLE) AS lon,
 CASE WHEN event_id % 10 = 0 THEN NULL ELSE concat('incident ', CAST(event_id AS STRING)) END AS message, [EP] AS snapshot_ts
FROM {events}""",
    "incidents": """
SELECT o_orderkey AS incident_id, o_custkey AS nearest_link_id,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Accident' WHEN o_orderpriority = '2-HIGH' THEN 'Vehicle breakdown'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'Heavy Traffic' ELSE 'Roadwork' END AS type,
 1704067200 + (o_orderkey * 7919 % 8640) * 300 AS start_ts,
 1704067200 + (o_orderkey * 7919 % 8640) * 300 + 1800 * (1 + o_orderkey % 24) AS end_ts,
 CAST(30 * (1 + o_orderkey % 24) AS DOUBLE) AS duration_min,
 CAST(1.25 AS DOUBLE) + (o_orderkey * 31 % 1500) / CAST(10000 AS DOUBLE) AS lat,
 CAST(103.70 AS DOUBLE) + (o_orderkey * 47 % 2000) / CAST(10000 AS DOUBLE) AS lon
FROM {orders}""",
    "stations": """
SELECT concat('S', CAST(s_suppkey AS STRING)) AS station_id,
 CAST(1.25 AS DOUBLE) + (s_suppkey * 149 % 1500) / CAST(10000 AS DOUBLE) AS lat,
 CAST(103.70 AS DOUBLE) + (s_suppkey * 211 % 2000) / CAST(10000 AS DOUBLE) AS lon
FROM {supplier}""",
    "rain": """
SELECT station_id, ts, max(mm) AS rain_mm
FROM (SELECT concat('S', CAST(user_id AS STRING)) AS station_id, ([EP] [DIV] 3600) * 3600 AS ts,
             CASE WHEN value > 60 THEN floor(value) / CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS mm FROM {events}) x
GROUP BY station_id, ts""",
    "route_links": """
SELECT l_orderkey AS route_id, CAST(l_linenumber AS BIGINT) AS pos, max(l_suppkey) AS link_id
FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "route_points": """
SELECT l.route_id, l.pos * 3 AS seq, r.start_lat AS lat, r.start_lon AS lon
FROM {route_links} l JOIN {road_links} r ON r.link_id = l.link_id
UNION ALL
SELECT l.route_id, l.pos * 3 + 1 AS seq, (r.start_lat + r.end_lat) / CAST(2 AS DOUBLE) AS lat, (r.start_lon + r.end_lon) / CAST(2 AS DOUBLE) AS lon
FROM {route_links} l JOIN {road_links} r ON r.link_id = l.link_id
UNION ALL
SELECT l.route_id, l.pos * 3 + 2 AS seq, r.end_lat AS lat, r.end_lon AS lon
FROM {route_links} l JOIN {road_links} r ON r.link_id = l.link_id""",
    "habit_routes": """
SELECT o_orderkey AS id, o_custkey AS user_id, concat('Route ', CAST(o_orderkey AS STRING)) AS route_name, o_orderkey % 4 <> 0 AS alert_enabled,
 CASE WHEN o_orderkey % 5 = 0 THEN '22:00' WHEN o_orderkey % 7 = 0 THEN NULL ELSE '07:30' END AS alert_start_time,
 CASE WHEN o_orderkey % 5 = 0 THEN '06:00' WHEN o_orderkey % 7 = 0 THEN NULL ELSE '09:00' END AS alert_end_time,
 1704067200 + o_orderkey * 613 % 2592000 AS created_ts
FROM {orders}""",
    "traffic_alerts": """
SELECT event_id AS id, event_id AS route_id, user_id, 1706601600 - (event_id * 37 % 7201) AS created_ts, event_id % 3 = 0 AS is_dismissed
FROM {events}""",
    "place_changes": """
SELECT user_id, event_id % 20 AS place_id, event_id AS change_no,
 CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS op,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('label ', CAST(event_id AS STRING)) END AS label
FROM {events}""",
    "road_edges": """
SELECT s.c_custkey AS src, b.c_custkey AS dst, CAST(60 + 100 * s.k + (s.c_custkey * 37 + s.k) % 50 AS DOUBLE) AS length
FROM (SELECT c_custkey, [STRIDES] AS k FROM {customer}) s
JOIN {customer} b ON b.c_custkey = s.c_custkey + s.k""",
    "trips": """
SELECT s_suppkey AS od_id, s_suppkey AS src, s_suppkey * 14 + 9 AS dst FROM {supplier}""",
}

_NAME = re.compile(r"\{(\w+)\}")


def _fill(text: str, tokens: dict[str, str]) -> str:
    for token, value in tokens.items():
        text = text.replace(token, value)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view, or the driver's table, called ``name``."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    return run_sql(spark, sf_dir, VIEWS[name])


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    inputs = {name: view(spark, sf_dir, name) for name in sorted(set(_NAME.findall(text)))}
    return spark.sql(_fill(text, SPARK_TOKENS), **inputs)


def duck_sql(body: str) -> str:
    """``body`` with the views it names put in front as common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in order:
                need(VIEWS[name])
                order.append(name)

    need(body)
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in order]
    text = _fill(body, DUCK_TOKENS).strip()
    if ctes:
        head = ",\n".join(ctes)
        if text.upper().startswith("WITH RECURSIVE "):
            text = f"WITH RECURSIVE {head},\n{text[15:]}"
        else:
            text = f"WITH {head}\n{text}"
    return _NAME.sub(r"\1", _fill(text, DUCK_TOKENS))
