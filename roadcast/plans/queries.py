"""Registered queries: name -> (Spark job, DuckDB text or None)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.functions.columns import (
    SINGAPORE_SHIFT_S,
    bearing_deg,
    bearing_diff,
    clock,
    flat_m,
    haversine_m,
    in_daily_window,
)
from roadcast.operators import alerts as al
from roadcast.operators import evaluate as ev
from roadcast.operators import features as ft
from roadcast.operators import incidents as inc
from roadcast.operators import routes as rt
from roadcast.operators import sampling as sm
from roadcast.operators import sessions as ss
from roadcast.operators import spatial as sp
from roadcast.operators import state as st
from roadcast.operators.asof import asof_rain
from roadcast.operators.routing import alternative_paths, path_lengths, shortest_paths
from roadcast.plans.fixtures import END_TS, NOW_TS, START_TS, run_sql, view
from roadcast.plans.registry import QUERIES, register
from roadcast.skew import FIND, hot_keys
from roadcast.sources import feeds, tables

HORIZONS = {5: 1, 10: 2, 15: 3, 30: 6}
NOW_HHMM = "08:00"


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- feature tables -------------------------------------------------------------------------------------------------


def _sql_features(lags, leads, shift: int = 0, names=("hour", "dow"), valid=()) -> str:
    lag_cols = [f"LAG(speed_band, {k}) OVER w AS {ft.lag_name(k)}" for k in lags]
    lead_cols = [f"LEAD(speed_band, {k}) OVER w AS {ft.lead_name(k)}" for k in leads]
    parts, at = [], f"make_timestamp((snapshot_ts + {shift}) * 1000000)"
    if names:
        parts = [f"extract('hour' FROM {at}) AS {names[0]}", f"extract('dow' FROM {at}) AS {names[1]}"]
    inner = ", ".join(["link_id", "snapshot_ts", "speed_band AS sb", *lag_cols, *parts, *lead_cols])
    where = " AND ".join(f"{c} BETWEEN 1 AND 8" for c in valid) or "TRUE"
    return (
        f"SELECT * FROM (SELECT {inner} FROM {{speedbands}} WHERE snapshot_ts BETWEEN {START_TS} AND {END_TS} "
        f"WINDOW w AS (PARTITION BY link_id ORDER BY snapshot_ts, id)) f WHERE {where}"
    )


_MID = (
    "r.road_category, (r.start_lat + r.end_lat) / CAST(2 AS DOUBLE) AS mid_lat, (r.start_lon + r.end_lon) / CAST(2 AS DOUBLE) AS mid_lon, "
    "floor((r.start_lat + r.end_lat) / CAST(2 AS DOUBLE) * 200) AS lat_bin, floor((r.start_lon + r.end_lon) / CAST(2 AS DOUBLE) * 200) AS lon_bin"
)
_ENDS = "r.road_category, r.start_lat, r.start_lon, r.end_lat, r.end_lon"


def _sql_with_road(features: str, cols: str = _MID) -> str:
    return f"SELECT f.*, {cols} FROM ({features}) f JOIN {{road_links}} r ON f.link_id = r.link_id"


def _hot_links(spark, d):
    """Links with too many readings for one task; counted once per query and handed to its steps."""
    return hot_keys(view(spark, d, "speedbands"), ["link_id"])


def _features(spark, d, lags=(1, 2, 3), leads=(3,), shift=0, names=("hour", "dow"), valid=(), hot=FIND):
    return ft.build_features(view(spark, d, "speedbands"), lags, leads, START_TS, END_TS, shift, names, valid, hot=hot)


LAGS = (1, 2, 3)
SG = ("hour_sg", "dow_sg")


def _register_horizon(minutes: int, step: int) -> None:
    bands = ft.feature_bands(LAGS, (step,))
    clean = ["sb_tm5", "sb_tm10", "sb_tm15", ft.lead_name(step)]
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in clean)

    def noroads(spark, d):
        return _features(spark, d, leads=(step,))

    sql = _sql_features(LAGS, (step,))
    register(f"features_noroads_tp{minutes}", noroads, sql)
    register(
        f"clean_noroads_tp{minutes}",
        lambda spark, d: ft.drop_null_steps(noroads(spark, d), clean),
        f"SELECT * FROM ({sql}) c WHERE {not_null}",
    )
    local = minutes == 15
    shift, names = (SINGAPORE_SHIFT_S, SG) if local else (0, ("hour", "dow"))

    def roads(spark, d):
        hot = _hot_links(spark, d)
        rows = _features(spark, d, leads=(step,), shift=shift, names=names, valid=bands, hot=hot)
        return ft.with_road(rows, view(spark, d, "road_links"), position="mid" if local else "ends", hot=hot)

    road_sql = _sql_with_road(_sql_features(LAGS, (step,), shift, names, bands), _MID if local else _ENDS)
    register(f"features_roads_tp{minutes}", roads, road_sql)
    register(
        f"clean_roads_tp{minutes}",
        lambda spark, d: ft.drop_null_steps(roads(spark, d), clean),
        f"SELECT * FROM ({road_sql}) c WHERE {not_null}",
    )


for _minutes, _step in HORIZONS.items():
    _register_horizon(_minutes, _step)

register(
    "time_range_week",
    lambda spark, d: ft.build_features(view(spark, d, "speedbands"), LAGS, (3,), START_TS + 86400, START_TS + 8 * 86400),
    _sql_features(LAGS, (3,)).replace(f"BETWEEN {START_TS} AND {END_TS}", f"BETWEEN {START_TS + 86400} AND {START_TS + 8 * 86400}"),
)

# --- incident features ----------------------------------------------------------------------------------------------

_BANDS15 = ft.feature_bands(LAGS, (3,))
_PLAIN15 = _sql_features(LAGS, (3,), names=(), valid=_BANDS15)
_COVERS = "i.nearest_link_id = f.link_id AND f.snapshot_ts >= i.start_ts AND f.snapshot_ts <= i.end_ts"


def _plain15(spark, d, hot):
    rows = _features(spark, d, names=None, valid=_BANDS15, hot=hot)
    return ft.with_road(rows, view(spark, d, "road_links"), hot=hot)


def _flagged(spark, d):
    hot = _hot_links(spark, d)
    return inc.flag_incidents(_plain15(spark, d, hot), view(spark, d, "incidents"), hot)


register(
    "features_incidents",
    _flagged,
    f"SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM {{incidents}} i WHERE {_COVERS}) THEN 1 ELSE 0 END AS has_incident FROM ({_sql_with_road(_PLAIN15)}) f",
)


def _incident_types(spark, d):
    cols = {"incident_type": "type", "incident_duration": "duration_min"}
    hot = _hot_links(spark, d)
    return inc.covering_max(_plain15(spark, d, hot), view(spark, d, "incidents"), cols, hot)


_TYPES_SQL = (
    f"SELECT f.*, (SELECT MAX(i.type) FROM {{incidents}} i WHERE {_COVERS}) AS incident_type, "
    f"(SELECT MAX(i.duration_min) FROM {{incidents}} i WHERE {_COVERS}) AS incident_duration FROM ({_sql_with_road(_PLAIN15)}) f"
)
register("features_incident_types", _incident_types, _TYPES_SQL)


def _sql_rollup(features: str, lags, leads) -> str:
    names = ["link_id", "snapshot_ts", "sb", *map(ft.lag_name, lags), *SG, *map(ft.lead_name, leads)]
    names += ["road_category", "mid_lat", "mid_lon", "lat_bin", "lon_bin"]
    cols = ", ".join(f"b.{name}" for name in names)
    return f"""
SELECT {cols}, CASE WHEN count(i.type) > 0 THEN 1 ELSE 0 END AS incident_on_link, count(i.type) AS incident_count_on_link,
 (b.snapshot_ts - max(i.start_ts)) / CAST(60 AS DOUBLE) AS mins_since_inc_start,
 max(CASE WHEN i.type = 'Accident' THEN 1 ELSE 0 END) AS has_accident,
 max(CASE WHEN i.type = 'Roadwork' THEN 1 ELSE 0 END) AS has_roadwork,
 max(CASE WHEN i.type = 'Vehicle breakdown' THEN 1 ELSE 0 END) AS has_breakdown
FROM ({features}) b LEFT JOIN {{incidents}} i ON i.nearest_link_id = b.link_id AND b.snapshot_ts BETWEEN i.start_ts AND i.end_ts
GROUP BY {cols}"""


_MASTER_LAGS = _MASTER_LEADS = (1, 2, 3, 4, 5, 6)
_MASTER_VALID = ["sb", "sb_tm5", "sb_tm10", "sb_tm15", "y_tp15", "sb_tm30", "y_tp30"]


def _rollup(spark, d, lags, leads, valid, hot=FIND, position="mid"):
    hot = _hot_links(spark, d) if hot is FIND else hot
    rows = _features(spark, d, lags, leads, SINGAPORE_SHIFT_S, SG, valid, hot)
    rows = ft.with_road(rows, view(spark, d, "road_links"), position=position, hot=hot)
    return inc.incident_rollup(rows, view(spark, d, "incidents"), hot)


def _master(spark, d, hot=FIND, position="mid"):
    return _rollup(spark, d, _MASTER_LAGS, _MASTER_LEADS, _MASTER_VALID, hot, position)


_MASTER_SQL = _sql_rollup(
    _sql_with_road(_sql_features(_MASTER_LAGS, _MASTER_LEADS, SINGAPORE_SHIFT_S, SG, _MASTER_VALID)), _MASTER_LAGS, _MASTER_LEADS
)
register(
    "features_nearby_v2",
    lambda spark, d: _rollup(spark, d, LAGS, (3,), _BANDS15),
    _sql_rollup(_sql_with_road(_sql_features(LAGS, (3,), SINGAPORE_SHIFT_S, SG, _BANDS15)), LAGS, (3,)),
)
register("features_master_v3", lambda spark, d: _master(spark, d), _MASTER_SQL)
register(
    "distinct_intervals",
    lambda spark, d: inc.distinct_intervals(view(spark, d, "incidents")),
    "SELECT nearest_link_id AS link_id, start_ts, end_ts FROM {incidents} WHERE nearest_link_id IS NOT NULL GROUP BY 1, 2, 3",
)


def _encoded(spark, d):
    rows = inc.fill_incident_nulls(_incident_types(spark, d))
    both = sm.with_side_last(rows)
    out = inc.encode_types(both, [both])
    return out.select("link_id", "snapshot_ts", "side", "incident_type", "has_incident", "inc_type_code")


register(
    "encode_types",
    _encoded,
    f"""SELECT link_id, snapshot_ts, CASE WHEN snapshot_ts < (SELECT max(snapshot_ts) - 172800 FROM ({_TYPES_SQL}) a) THEN 'train' ELSE 'test' END AS side,
 coalesce(incident_type, 'None') AS incident_type, CASE WHEN coalesce(incident_type, 'None') <> 'None' THEN 1 ELSE 0 END AS has_incident,
 dense_rank() OVER (ORDER BY coalesce(incident_type, 'None')) - 1 AS inc_type_code FROM ({_TYPES_SQL}) t""",
)

# --- incidents near a link, rain, change features ---------------------------------------------------------------------


def _sql_haversine(lat1, lon1, lat2, lon2) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371000.0::DOUBLE * atan2(sqrt{a}, sqrt(1 - {a})))"


_NEARBY_SQL = f"""
SELECT s.link_id, s.snapshot_ts, 1 AS incident_nearby,
 max(CASE WHEN p.type = 'Accident' THEN 1 ELSE 0 END) AS nearby_accident,
 max(CASE WHEN p.type = 'Roadwork' THEN 1 ELSE 0 END) AS nearby_roadwork,
 max(CASE WHEN p.type = 'Vehicle breakdown' THEN 1 ELSE 0 END) AS nearby_breakdown,
 (s.snapshot_ts - max(p.start_ts)) / CAST(60 AS DOUBLE) AS mins_since_nearby_start
FROM (SELECT DISTINCT link_id, snapshot_ts FROM {{speedbands}}) s
JOIN (SELECT r.link_id, i.type, i.start_ts, i.end_ts
      FROM (SELECT link_id, (start_lat + end_lat) / CAST(2 AS DOUBLE) AS mlat, (start_lon + end_lon) / CAST(2 AS DOUBLE) AS mlon FROM {{road_links}}) r
      JOIN {{incidents}} i ON i.lat BETWEEN r.mlat - 0.01 AND r.mlat + 0.01 AND {_sql_haversine("i.lat", "i.lon", "r.mlat", "r.mlon")} <= 200) p
 ON p.link_id = s.link_id AND s.snapshot_ts BETWEEN p.start_ts AND p.end_ts
GROUP BY s.link_id, s.snapshot_ts"""


def _nearby(spark, d):
    return inc.nearby_incidents(view(spark, d, "speedbands"), view(spark, d, "road_links"), view(spark, d, "incidents"))


register("nearby_incidents", _nearby, _NEARBY_SQL)

_LINK_STATION_SQL = f"""
SELECT link_id, arg_min(station_id, {{k}}) AS nearest_station_id FROM (
 SELECT r.link_id, s.station_id, round({_sql_haversine("r.mlat", "r.mlon", "s.lat", "s.lon")}, 3) AS d
 FROM (SELECT link_id, (start_lat + end_lat) / CAST(2 AS DOUBLE) AS mlat, (start_lon + end_lon) / CAST(2 AS DOUBLE) AS mlon FROM {{road_links}}) r, {{stations}} s) x
GROUP BY link_id""".replace("{k}", "(d, station_id)")


def _link_stations(spark, d):
    return sp.link_stations(view(spark, d, "road_links"), view(spark, d, "stations"))


register("link_nearest_station", _link_stations, _LINK_STATION_SQL)
register(
    "link_station_check",
    lambda spark, d: sm.hash_pick(
        view(spark, d, "road_links").select("link_id", "road_name").join(_link_stations(spark, d), "link_id"), "link_id", 5
    ),
    f"SELECT r.link_id, r.road_name, m.nearest_station_id FROM {{road_links}} r JOIN ({_LINK_STATION_SQL}) m ON m.link_id = r.link_id ORDER BY (r.link_id * 7919) % 1009, r.link_id LIMIT 5",
)


def _rain(spark, d, rows, hot):
    return asof_rain(rows, _link_stations(spark, d), view(spark, d, "rain"), hot=hot)


def _sql_rain(rows: str) -> str:
    return f"""
SELECT t.*, x.rain_mm, CASE WHEN x.rain_mm > 0 THEN 1 WHEN x.rain_mm IS NOT NULL THEN 0 END AS is_raining FROM ({rows}) t
LEFT JOIN ({_LINK_STATION_SQL}) m ON m.link_id = t.link_id
ASOF LEFT JOIN {{rain}} x ON x.station_id = m.nearest_station_id AND t.snapshot_ts >= x.ts"""


register(
    "asof_rain",
    lambda spark, d: _rain(spark, d, view(spark, d, "speedbands"), _hot_links(spark, d)),
    _sql_rain("SELECT * FROM {speedbands}"),
)


def _change(spark, d):
    hot = _hot_links(spark, d)
    rows = _rain(spark, d, _master(spark, d, hot, "both"), hot)
    rows = inc.add_nearby(rows, view(spark, d, "road_links"), view(spark, d, "incidents"), hot=hot, moments=view(spark, d, "speedbands"))
    return ft.add_targets(ft.add_calendar_flags(ft.add_link_proxy(ft.add_momentum(rows))))


_CHANGE_SQL = f"""
SELECT f.*, r.start_lat, r.end_lat, r.start_lon, r.end_lon,
 coalesce(n.incident_nearby, 0) AS incident_nearby, coalesce(n.nearby_accident, 0) AS nearby_accident,
 coalesce(n.nearby_roadwork, 0) AS nearby_roadwork, coalesce(n.nearby_breakdown, 0) AS nearby_breakdown,
 coalesce(n.mins_since_nearby_start, -1) AS mins_since_nearby_start,
 sb - sb_tm5 AS delta_0_5, sb_tm5 - sb_tm10 AS delta_5_10, sb_tm10 - sb_tm15 AS delta_10_15, (sb - sb_tm5) - (sb_tm5 - sb_tm10) AS acceleration,
 sqrt((r.start_lat - r.end_lat) * (r.start_lat - r.end_lat) + (r.start_lon - r.end_lon) * (r.start_lon - r.end_lon)) AS link_dist_proxy,
 CASE WHEN dow_sg IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN hour_sg IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_peak,
 y_tp15 - 1 AS label, CASE WHEN y_tp15 <> sb THEN 1 ELSE 0 END AS change
FROM ({_sql_rain(_MASTER_SQL)}) f LEFT JOIN {{road_links}} r ON r.link_id = f.link_id
LEFT JOIN ({_NEARBY_SQL}) n ON n.link_id = f.link_id AND n.snapshot_ts = f.snapshot_ts"""
register("change_features", lambda spark, d: rounded(_change(spark, d), "link_dist_proxy", digits=9), _CHANGE_SQL.replace("sqrt((r.start", "round(sqrt((r.start").replace(")) AS link_dist", ")), 9) AS link_dist"))

# --- profiles, splits, samples ------------------------------------------------------------------------------------------

register(
    "profile_readings",
    lambda spark, d: sm.profile(view(spark, d, "speedbands")),
    "SELECT count(*) AS n, min(snapshot_ts) AS min_ts, max(snapshot_ts) AS max_ts, count(DISTINCT link_id) AS n_keys FROM {speedbands}",
)


_TP15_SQL = _sql_features(LAGS, (3,))


def _tp15(spark, d):
    return _features(spark, d)


register(
    "split_last",
    lambda spark, d: sm.with_side_last(_tp15(spark, d)),
    f"SELECT *, CASE WHEN snapshot_ts < max(snapshot_ts) OVER () - 172800 THEN 'train' ELSE 'test' END AS side FROM ({_TP15_SQL}) t",
)
register(
    "split_fraction",
    lambda spark, d: sm.with_side_fraction(_tp15(spark, d)),
    f"""SELECT *, CASE WHEN snapshot_ts < min(snapshot_ts) OVER () + CAST(trunc(CAST(0.8 AS DOUBLE) * (max(snapshot_ts) OVER () - min(snapshot_ts) OVER ())) AS BIGINT)
 THEN 'train' ELSE 'test' END AS side FROM ({_TP15_SQL}) t""",
)
_SLOT_SQL = "((link_id * 2654435761 + snapshot_ts) % 100)"
register(
    "hash_sample",
    lambda spark, d: sm.hash_sample(sm.split_last(_tp15(spark, d))[0]),
    f"SELECT * FROM ({_TP15_SQL}) t WHERE snapshot_ts < (SELECT max(snapshot_ts) - 172800 FROM ({_TP15_SQL}) a) AND {_SLOT_SQL} < 10",
)
register(
    "keep_or_sample",
    lambda spark, d: sm.keep_or_sample(inc.with_nearby(_tp15(spark, d), _nearby(spark, d)), "incident_nearby"),
    f"""SELECT * FROM (SELECT t.*, coalesce(n.incident_nearby, 0) AS incident_nearby, coalesce(n.nearby_accident, 0) AS nearby_accident,
 coalesce(n.nearby_roadwork, 0) AS nearby_roadwork, coalesce(n.nearby_breakdown, 0) AS nearby_breakdown,
 coalesce(n.mins_since_nearby_start, -1) AS mins_since_nearby_start
 FROM ({_TP15_SQL}) t LEFT JOIN ({_NEARBY_SQL}) n ON n.link_id = t.link_id AND n.snapshot_ts = t.snapshot_ts) k WHERE incident_nearby = 1 OR {_SLOT_SQL} < 10""",
)
register(
    "first_readings",
    lambda spark, d: sm.head_by(view(spark, d, "speedbands"), ["id"], 5),
    "SELECT * FROM {speedbands} ORDER BY id LIMIT 5",
)

# --- scores -----------------------------------------------------------------------------------------------------------
# A lag stands in for the prediction, so that the scores can be checked without a model.

_METRICS = ["acc", "mae", "within1", "base_acc", "base_mae", "base_within1", "change_acc", "base_change_acc"]


def _sql_class_metrics(rows: str, pred: str, group: str = "") -> str:
    head, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"""SELECT {head}count(*) AS n, round(avg(CAST({pred} = y_tp15 AS INT)), 6) AS acc, round(avg(abs({pred} - y_tp15)), 6) AS mae,
 round(avg(CAST(abs({pred} - y_tp15) <= 1 AS INT)), 6) AS within1, round(avg(CAST(sb = y_tp15 AS INT)), 6) AS base_acc,
 round(avg(abs(sb - y_tp15)), 6) AS base_mae, round(avg(CAST(abs(sb - y_tp15) <= 1 AS INT)), 6) AS base_within1,
 count(*) FILTER (sb <> y_tp15) AS change_rows, round(avg(CAST({pred} = y_tp15 AS INT)) FILTER (sb <> y_tp15), 6) AS change_acc,
 round(avg(CAST(sb = y_tp15 AS INT)) FILTER (sb <> y_tp15), 6) AS base_change_acc FROM ({rows}) t{tail}"""


_ROADS15_SQL = _sql_with_road(_sql_features(LAGS, (3,), SINGAPORE_SHIFT_S, SG, _BANDS15))


def _roads15(spark, d):
    return QUERIES["features_roads_tp15"](spark, d)


register(
    "class_metrics",
    lambda spark, d: rounded(ev.class_metrics(_roads15(spark, d), pred="sb_tm5"), *_METRICS),
    _sql_class_metrics(_ROADS15_SQL, "sb_tm5"),
)
register(
    "class_metrics_by_category",
    lambda spark, d: rounded(ev.class_metrics(_roads15(spark, d), pred="sb_tm5", group=["road_category"]), *_METRICS),
    _sql_class_metrics(_ROADS15_SQL, "sb_tm5", "road_category"),
)
register(
    "persistence_baseline",
    lambda spark, d: rounded(ev.class_metrics(sm.split_last(_roads15(spark, d))[1], pred="sb"), *_METRICS),
    _sql_class_metrics(f"SELECT * FROM ({_ROADS15_SQL}) a WHERE snapshot_ts >= (SELECT max(snapshot_ts) - 172800 FROM ({_ROADS15_SQL}) b)", "sb"),
)
register(
    "incident_metrics",
    lambda spark, d: rounded(
        ev.subset_accuracy(QUERIES["features_incidents"](spark, d), "has_incident", pred="sb_tm5"), "acc", "base_acc"
    ),
    f"""SELECT count(*) AS n, round(avg(CAST(sb_tm5 = y_tp15 AS INT)), 6) AS acc, round(avg(CAST(sb = y_tp15 AS INT)), 6) AS base_acc
 FROM ({_sql_with_road(_PLAIN15)}) f WHERE EXISTS (SELECT 1 FROM {{incidents}} i WHERE {_COVERS})""",
)


def _nearby_rows(spark, d):
    rows = inc.with_nearby(_roads15(spark, d), _nearby(spark, d))
    return ft.add_targets(rows).withColumn("prob", sm.sample_slot() / F.lit(100.0))


_NEARBY_ROWS_SQL = f"""SELECT t.*, coalesce(n.incident_nearby, 0) AS incident_nearby, CASE WHEN t.y_tp15 <> t.sb THEN 1 ELSE 0 END AS change,
 ((t.link_id * 2654435761 + t.snapshot_ts) % 100) / CAST(100 AS DOUBLE) AS prob
 FROM ({_ROADS15_SQL}) t LEFT JOIN ({_NEARBY_SQL}) n ON n.link_id = t.link_id AND n.snapshot_ts = t.snapshot_ts"""
_BINARY = ["accuracy", "precision", "recall", "f1"]


def _sql_binary(rows: str, pred: str, group: str = "") -> str:
    head, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"""SELECT {head}n, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
 round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
 FROM (SELECT {head}count(*) AS n, count(*) FILTER (change = 1 AND {pred}) AS tp, count(*) FILTER (change = 0 AND {pred}) AS fp,
 count(*) FILTER (change = 1 AND NOT {pred}) AS fn, count(*) FILTER (change = 0 AND NOT {pred}) AS tn FROM ({rows}) t{tail}) c"""


register(
    "binary_metrics",
    lambda spark, d: rounded(
        ev.binary_metrics(_nearby_rows(spark, d), "change", (F.col("prob") >= 0.25).cast("int"), ["incident_nearby"]), *_BINARY
    ),
    _sql_binary(_NEARBY_ROWS_SQL, "prob >= 0.25", "incident_nearby"),
)
register(
    "no_change_baseline",
    lambda spark, d: rounded(ev.binary_metrics(_nearby_rows(spark, d), "change", F.lit(0), ["incident_nearby"]), *_BINARY),
    _sql_binary(_NEARBY_ROWS_SQL, "FALSE", "incident_nearby"),
)
register(
    "momentum_baseline",
    lambda spark, d: rounded(
        ev.binary_metrics(ft.add_targets(_roads15(spark, d)), "change", (F.col("sb") != F.col("sb_tm5")).cast("int")), *_BINARY
    ),
    _sql_binary(f"SELECT *, CASE WHEN y_tp15 <> sb THEN 1 ELSE 0 END AS change FROM ({_ROADS15_SQL}) q", "sb <> sb_tm5"),
)
register(
    "threshold_sweep",
    lambda spark, d: rounded(ev.threshold_sweep(_nearby_rows(spark, d), "change", "prob"), "precision", "recall", "f1"),
    f"""SELECT threshold, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
 round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
 FROM (SELECT threshold, count(*) FILTER (change = 1 AND prob >= threshold) AS tp, count(*) FILTER (change = 0 AND prob >= threshold) AS fp,
 count(*) FILTER (change = 1 AND prob < threshold) AS fn
 FROM ({_NEARBY_ROWS_SQL}) t, (SELECT CAST(unnest([0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]) AS DOUBLE) AS threshold) h GROUP BY threshold) c""",
)
register(
    "change_summary",
    lambda spark, d: rounded(
        ev.change_summary(_nearby_rows(spark, d), "change", (F.col("prob") >= 0.25).cast("int")), "change_rate", "hit_rate"
    ),
    f"""SELECT round(avg(change), 6) AS change_rate, count(*) FILTER (change = 1) AS change_rows,
 round(avg(CAST(prob >= 0.25 AS INT)) FILTER (change = 1), 6) AS hit_rate FROM ({_NEARBY_ROWS_SQL}) t""",
)
register(
    "nearby_rate",
    lambda spark, d: rounded(ev.flag_rate(sm.with_side_fraction(_nearby_rows(spark, d)), "incident_nearby", ["side"]), "rate"),
    f"""SELECT side, round(avg(incident_nearby), 6) AS rate, count(*) FILTER (incident_nearby = 1) AS rows FROM (
 SELECT *, CASE WHEN snapshot_ts < min(snapshot_ts) OVER () + CAST(trunc(CAST(0.8 AS DOUBLE) * (max(snapshot_ts) OVER () - min(snapshot_ts) OVER ())) AS BIGINT)
 THEN 'train' ELSE 'test' END AS side FROM ({_NEARBY_ROWS_SQL}) t) s GROUP BY side""",
)

# --- geometry, nearest links ----------------------------------------------------------------------------------------------

_FLAT_SQL = "sqrt(pow((lon2 - lon1) * 111320.0::DOUBLE * cos(radians((lat1 + lat2) / 2)), 2) + pow((lat2 - lat1) * 110540.0::DOUBLE, 2))"
_BEARING_SQL = "((degrees(atan2((lon2 - lon1) * cos(radians((lat1 + lat2) / 2)), lat2 - lat1)) + 360) % 360)"


def _geometry(spark, d):
    rows = view(spark, d, "road_links").select("link_id", "road_category", *[F.col(a).alias(b) for a, b in zip(("start_lat", "start_lon", "end_lat", "end_lon"), rt._ENDS)])
    rows = rows.withColumn("_b", bearing_deg(*rt._ENDS))
    other = F.col("road_category") * 40.0
    return rows.select(
        "link_id",
        F.round(haversine_m(*rt._ENDS), 3).alias("haversine_m"),
        F.round(flat_m(*rt._ENDS), 3).alias("flat_m"),
        F.round("_b", 3).alias("bearing"),
        F.round(bearing_diff("_b", other), 3).alias("diff"),
        F.round(bearing_diff("_b", other, undirected=True), 3).alias("diff_undirected"),
    )


register(
    "road_geometry",
    _geometry,
    f"""SELECT link_id, round({_sql_haversine("lat1", "lon1", "lat2", "lon2")}, 3) AS haversine_m, round({_FLAT_SQL}, 3) AS flat_m, round(b, 3) AS bearing,
 round(least(abs(b - o) % 360, 360 - abs(b - o) % 360), 3) AS diff,
 round(least(abs(b - o) % 360, 360 - abs(b - o) % 360, abs(b - (o + 180) % 360) % 360, 360 - abs(b - (o + 180) % 360) % 360), 3) AS diff_undirected
 FROM (SELECT *, {_BEARING_SQL} AS b, road_category * 40.0::DOUBLE AS o FROM (SELECT link_id, road_category, start_lat AS lat1, start_lon AS lon1, end_lat AS lat2, end_lon AS lon2 FROM {{road_links}}) q) g""",
)
_MIDS_SQL = "(SELECT link_id, road_name, (start_lat + end_lat) / CAST(2 AS DOUBLE) AS mlat, (start_lon + end_lon) / CAST(2 AS DOUBLE) AS mlon FROM {road_links})"


def _mapped(spark, d):
    found = view(spark, d, "incidents").drop("nearest_link_id")
    return sp.incident_links(found, view(spark, d, "road_links"))


_MAPPED_SQL = f"""
SELECT i.* EXCLUDE (nearest_link_id), b.nearest_link_id, b.dist_to_road_m FROM {{incidents}} i JOIN (
 SELECT lat, lon, arg_min(link_id, (round(dist, 3), link_id)) AS nearest_link_id, round(min(dist), 3) AS dist_to_road_m FROM (
  SELECT p.lat, p.lon, r.link_id, {_sql_haversine("p.lat", "p.lon", "r.mlat", "r.mlon")} AS dist
  FROM (SELECT DISTINCT lat, lon FROM {{incidents}}) p, {_MIDS_SQL} r) c GROUP BY lat, lon) b ON b.lat = i.lat AND b.lon = i.lon"""
register("incident_nearest_link", lambda spark, d: rounded(_mapped(spark, d), "dist_to_road_m", digits=3), _MAPPED_SQL)
register(
    "distance_summary",
    lambda spark, d: rounded(
        sp.distance_summary(rounded(_mapped(spark, d), "dist_to_road_m", digits=3)), "mean", "std", "p50", "p90", "p99", digits=4
    ),
    f"""SELECT count(dist_to_road_m) AS n, round(avg(dist_to_road_m), 4) AS mean, round(stddev_samp(dist_to_road_m), 4) AS std, min(dist_to_road_m) AS min,
 max(dist_to_road_m) AS max, count(*) FILTER (dist_to_road_m > 200) AS over_200m, count(*) FILTER (dist_to_road_m > 500) AS over_500m,
 round(quantile_cont(dist_to_road_m, 0.5), 4) AS p50, round(quantile_cont(dist_to_road_m, 0.9), 4) AS p90,
 round(quantile_cont(dist_to_road_m, 0.99), 4) AS p99 FROM ({_MAPPED_SQL}) m""",
)
_FLAT_MID = _FLAT_SQL.replace("lat1", "p.lat").replace("lon1", "p.lon").replace("lat2", "r.mlat").replace("lon2", "r.mlon")
_IN_BOX_SQL = f"""
SELECT i.incident_id, i.lat, i.lon, b.link_id AS matched_link_id,
 CASE WHEN b.link_id IS NULL THEN 'Ummapped Road' ELSE coalesce(b.road_name, 'LTA Road') END AS matched_road_name
FROM {{incidents}} i LEFT JOIN (
 SELECT p.lat, p.lon, arg_min(r.link_id, (round({_FLAT_MID}, 3), r.link_id)) AS link_id, arg_min(struct_pack(n := r.road_name), (round({_FLAT_MID}, 3), r.link_id)).n AS road_name
 FROM (SELECT DISTINCT lat, lon FROM {{incidents}}) p JOIN {_MIDS_SQL} r
  ON r.mlat BETWEEN p.lat - 0.001::DOUBLE AND p.lat + 0.001::DOUBLE AND r.mlon BETWEEN p.lon - 0.001::DOUBLE AND p.lon + 0.001::DOUBLE GROUP BY p.lat, p.lon) b
 ON b.lat = i.lat AND b.lon = i.lon"""
register(
    "nearest_in_box",
    lambda spark, d: sp.nearest_in_box(view(spark, d, "incidents").select("incident_id", "lat", "lon"), view(spark, d, "road_links")),
    _IN_BOX_SQL,
)

# --- incident snapshots --------------------------------------------------------------------------------------------------

GAP_MIN = 240  # the stand-in snapshots are sparse


def _cells(df):
    return df.withColumns({"cell_i": F.floor(F.col("lat") * 200), "cell_j": F.floor(F.col("lon") * 200)})


_GAP_SQL = """SELECT row_id, type, cell_i, cell_j, CAST(sum(s) OVER (PARTITION BY type, cell_i, cell_j ORDER BY snapshot_ts, row_id) AS BIGINT) AS session_no FROM (
 SELECT *, CASE WHEN snapshot_ts - lag(snapshot_ts) OVER (PARTITION BY type, cell_i, cell_j ORDER BY snapshot_ts, row_id) <= {gap} THEN 0 ELSE 1 END AS s
 FROM (SELECT *, CAST(floor(lat * 200) AS BIGINT) AS cell_i, CAST(floor(lon * 200) AS BIGINT) AS cell_j FROM {{incident_snapshots}}) a) b"""
register(
    "gap_sessions",
    lambda spark, d: ss.gap_sessions(
        _cells(view(spark, d, "incident_snapshots")), ["type", "cell_i", "cell_j"], "snapshot_ts", "row_id", GAP_MIN
    ).select("row_id", "type", "cell_i", "cell_j", "session_no"),
    _GAP_SQL.format(gap=GAP_MIN * 60),
)


def _fold_sql(gap_min: int) -> str:
    """One row of each type per step, with the list of its ongoing incidents."""
    metres = _sql_haversine("s.lat", "s.lon", "x.lat", "x.lon")
    return f"""
WITH RECURSIVE seq AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY snapshot_ts, row_id) AS n FROM {{incident_snapshots}}),
walk(type, n, row_id, first_row, ongoing) AS (
 SELECT DISTINCT type, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::STRUCT(id BIGINT, lat DOUBLE, lon DOUBLE, seen BIGINT)[] FROM seq
 UNION ALL SELECT type, n, row_id, coalesce(near.id, row_id), CASE WHEN near IS NULL THEN list_append(alive, struct_pack(id := row_id, lat := lat, lon := lon, seen := snapshot_ts))
   ELSE list_transform(alive, lambda x: struct_pack(id := x.id, lat := x.lat, lon := x.lon, seen := CASE WHEN x.id = near.id THEN snapshot_ts ELSE x.seen END)) END
 FROM (SELECT *, list_min(list_filter(list_transform(alive, lambda x, i: struct_pack(m := {metres.replace("s.lat", "lat").replace("s.lon", "lon")}, i := i, id := x.id)), lambda y: y.m <= 200)) AS near
  FROM (SELECT s.*, list_filter(w.ongoing, lambda x: s.snapshot_ts - x.seen <= {gap_min * 60}) AS alive FROM walk w JOIN seq s ON s.type IS NOT DISTINCT FROM w.type AND s.n = w.n + 1) a) b)
SELECT w.first_row AS incident_id, any_value(s.type) AS type, arg_min(s.lat, (s.snapshot_ts, s.row_id)) AS lat, arg_min(s.lon, (s.snapshot_ts, s.row_id)) AS lon, min(s.snapshot_ts) AS start_ts,
 max(s.snapshot_ts) AS end_ts, (max(s.snapshot_ts) - min(s.snapshot_ts)) / CAST(60 AS DOUBLE) AS duration_min, arg_min(struct_pack(m := s.message), (s.snapshot_ts, s.row_id)).m AS message
FROM walk w JOIN seq s ON s.row_id = w.row_id GROUP BY w.first_row"""


register("fold_incidents", lambda spark, d: ss.fold_incidents(view(spark, d, "incident_snapshots"), GAP_MIN), _fold_sql(GAP_MIN))
register("fold_incidents_quarter_hour", lambda spark, d: ss.fold_incidents(view(spark, d, "incident_snapshots")), _fold_sql(ss.MAX_GAP_MIN))
register(
    "gap_sessions_quarter_hour",
    lambda spark, d: ss.gap_sessions(_cells(view(spark, d, "incident_snapshots")), ["type", "cell_i", "cell_j"], "snapshot_ts", "row_id").select(
        "row_id", "type", "cell_i", "cell_j", "session_no"
    ),
    _GAP_SQL.format(gap=ss.MAX_GAP_MIN * 60),
)
register(
    "incident_iso_times",
    lambda spark, d: ss.with_iso_times(view(spark, d, "incidents")).select(
        "incident_id", "start_time_utc", "end_time_utc",
        ss.iso_to_epoch("start_time_utc").alias("start_ts"), ss.iso_to_epoch("end_time_utc").alias("end_ts"),
    ),
    """SELECT incident_id, strftime(make_timestamp(start_ts * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS start_time_utc,
 strftime(make_timestamp(end_ts * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS end_time_utc, start_ts, end_ts FROM {incidents}""",
)
register(
    "incident_types_count",
    lambda spark, d: ss.value_counts(view(spark, d, "incidents"), "type"),
    "SELECT type, count(*) AS n FROM {incidents} GROUP BY type ORDER BY n DESC, type",
)
register(
    "incidents_in_order",
    lambda spark, d: view(spark, d, "incidents").orderBy("start_ts", "incident_id"),
    "SELECT * FROM {incidents} ORDER BY start_ts, incident_id",
)
register(
    "first_incidents",
    lambda spark, d: sm.head_by(
        sp.nearest_in_box(view(spark, d, "incidents").select("incident_id", "lat", "lon"), view(spark, d, "road_links")), ["incident_id"], 30
    ),
    f"SELECT * FROM ({_IN_BOX_SQL}) b ORDER BY incident_id LIMIT 30",
)

# --- live state, incidents, alerts -----------------------------------------------------------------------------------------


def _lags(spark, d):
    return st.state_to_lags(st.last_n(view(spark, d, "speedbands")))


def _sql_last_n(readings: str) -> str:
    return f"""
SELECT link_id, max(b) FILTER (r = 1) AS sb, coalesce(max(b) FILTER (r = 2), max(b) FILTER (r = 1)) AS sb_tm5,
 coalesce(max(b) FILTER (r = 3), max(b) FILTER (r = 1)) AS sb_tm10, coalesce(max(b) FILTER (r = 4), max(b) FILTER (r = 1)) AS sb_tm15
FROM (SELECT link_id, speed_band AS b, row_number() OVER (PARTITION BY link_id ORDER BY snapshot_ts DESC, id DESC) AS r FROM {readings}) t
WHERE r <= 4 GROUP BY link_id"""


_LAGS_SQL = _sql_last_n("{speedbands}")
register("last_n", _lags, _LAGS_SQL)


def _stand_in_scores(lags):
    return lags.select("link_id", F.col("sb_tm5").alias("prediction_tp15"))


def _enriched(spark, d):
    feed = view(spark, d, "incidents").select("incident_id", F.col("type").alias("Type"), F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"))
    lags = _lags(spark, d)
    return st.enrich_incidents(feed, view(spark, d, "road_links"), lags, _stand_in_scores(lags))


register(
    "enrich_incidents",
    _enriched,
    f"""SELECT x.incident_id, i.type AS Type, x.lat, x.lon, x.matched_link_id, x.matched_road_name, coalesce(CAST(s.sb AS STRING), 'N/A') AS current_speed_band,
 CASE WHEN x.matched_link_id IS NULL THEN 'N/A' ELSE CAST(s.sb_tm5 AS STRING) END AS predicted_speed_band_tp15
 FROM ({_IN_BOX_SQL}) x JOIN {{incidents}} i ON i.incident_id = x.incident_id LEFT JOIN ({_LAGS_SQL}) s ON s.link_id = x.matched_link_id""",
)


def listed(df: DataFrame) -> DataFrame:
    """Link lists as text, which both engines write alike."""
    return df.withColumn("affected_link_ids", F.array_join("affected_link_ids", ","))


def _alerts(spark, d):
    return listed(al.route_alerts(view(spark, d, "habit_routes"), view(spark, d, "route_links"), _lags(spark, d), NOW_HHMM))


_WINDOW_SQL = (
    "CASE WHEN coalesce(alert_start_time, '07:30') <= coalesce(alert_end_time, '09:00') THEN coalesce(alert_start_time, '07:30') <= {n} AND {n} <= coalesce(alert_end_time, '09:00') "
    "ELSE {n} >= coalesce(alert_start_time, '07:30') OR {n} <= coalesce(alert_end_time, '09:00') END"
)
_JAMMED_SQL = f"""
SELECT l.route_id, h.user_id, l.pos, l.link_id, coalesce(s.sb, 9) < 4 AS jammed FROM {{route_links}} l
JOIN (SELECT * FROM {{habit_routes}} WHERE alert_enabled AND {_WINDOW_SQL.replace("{n}", "'08:00'")}) h ON h.id = l.route_id
LEFT JOIN ({_LAGS_SQL}) s ON s.link_id = l.link_id"""
_ALERTS_SQL = f"""
SELECT route_id, user_id, count(*) AS n_links, count(*) FILTER (jammed) AS n_jammed, coalesce(string_agg(CAST(link_id AS VARCHAR), ',' ORDER BY pos) FILTER (jammed), '') AS affected_link_ids,
 FALSE AS is_dismissed FROM ({_JAMMED_SQL}) j
GROUP BY route_id, user_id HAVING count(*) FILTER (jammed) >= 1"""
register(
    "jammed_links",
    lambda spark, d: al.jammed_links(view(spark, d, "habit_routes"), view(spark, d, "route_links"), _lags(spark, d), NOW_HHMM),
    _JAMMED_SQL,
)
register("route_alerts", _alerts, _ALERTS_SQL)
register(
    "alert_cooldown",
    lambda spark, d: al.apply_cooldown(_alerts(spark, d), view(spark, d, "traffic_alerts"), NOW_TS),
    f"SELECT * FROM ({_ALERTS_SQL}) a WHERE NOT EXISTS (SELECT 1 FROM {{traffic_alerts}} t WHERE t.route_id = a.route_id AND t.created_ts > {NOW_TS} - 3600)",
)
register(
    "daily_window",
    lambda spark, d: view(spark, d, "habit_routes").select(
        "id", clock("created_ts").alias("hhmm"), in_daily_window("alert_start_time", "alert_end_time", clock("created_ts")).alias("in_window")
    ),
    f"""SELECT id, hhmm, {_WINDOW_SQL.replace("{n}", "hhmm")} AS in_window FROM (
 SELECT *, strftime(make_timestamp((created_ts + 28800) * 1000000), '%H:%M') AS hhmm FROM {{habit_routes}}) h""",
)
register(
    "user_latest",
    lambda spark, d: al.open_alerts(view(spark, d, "traffic_alerts")),
    "SELECT * FROM {traffic_alerts} WHERE NOT is_dismissed ORDER BY user_id, created_ts DESC, id DESC",
)
register(
    "current_places",
    lambda spark, d: al.current_rows(view(spark, d, "place_changes"), ["user_id", "place_id"], "change_no", ["label"]),
    """SELECT r.user_id, r.place_id, r.change_no AS inserted_at,
 (SELECT arg_max(u.label, u.change_no) FROM {place_changes} u WHERE u.user_id = r.user_id AND u.place_id = r.place_id AND u.change_no >= r.change_no
   AND u.op <> 'delete' AND u.label IS NOT NULL) AS label
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id, place_id ORDER BY change_no DESC) AS n FROM {place_changes} WHERE op IN ('insert', 'delete')) r
 WHERE r.n = 1 AND r.op = 'insert'""",
)

# --- routes ------------------------------------------------------------------------------------------------------------

_SEGMENTS_SQL = f"""
SELECT route_id, seq, lat1, lon1, lat2, lon2, {_FLAT_SQL} AS len FROM (
 SELECT route_id, seq, lat AS lat1, lon AS lon1, lead(lat) OVER (PARTITION BY route_id ORDER BY seq) AS lat2, lead(lon) OVER (PARTITION BY route_id ORDER BY seq) AS lon2
 FROM {{route_points}}) p WHERE lat2 IS NOT NULL AND {_FLAT_SQL} >= 5"""
register(
    "route_segments",
    lambda spark, d: rounded(rt.segments(view(spark, d, "route_points")), "segment_len_m", digits=3),
    f"SELECT route_id, seq, lat1, lon1, lat2, lon2, round(len, 3) AS segment_len_m FROM ({_SEGMENTS_SQL}) s",
)


def _matches(spark, d):
    return rt.match_routes(view(spark, d, "route_points"), view(spark, d, "road_links"))[0]


def _runs(spark, d):
    return rt.match_routes(view(spark, d, "route_points"), view(spark, d, "road_links"))[1]


_DISTINCT_SQL = f"SELECT DISTINCT lat1, lon1, lat2, lon2 FROM ({_SEGMENTS_SQL}) s"
_MATCH_SQL = f"""
SELECT s.route_id, s.seq, s.len AS segment_len_m, b.m.link_id AS link_id, b.m.dist AS dist_m, b.m.diff AS bearing_diff_deg
FROM ({_SEGMENTS_SQL}) s LEFT JOIN (
 SELECT lat1, lon1, lat2, lon2, arg_min(struct_pack(link_id := link_id, dist := dist, diff := diff), (round(dist + 0.7::DOUBLE * diff, 6), link_id)) AS m FROM (
  SELECT d.lat1, d.lon1, d.lat2, d.lon2, r.link_id, {_FLAT_MID.replace("p.lat", "d.lat").replace("p.lon", "d.lon")} AS dist,
   least(abs(d.b - r.b) % 360, 360 - abs(d.b - r.b) % 360, abs(d.b - (r.b + 180) % 360) % 360, 360 - abs(d.b - (r.b + 180) % 360) % 360) AS diff
  FROM (SELECT *, (lat1 + lat2) / CAST(2 AS DOUBLE) AS lat, (lon1 + lon2) / CAST(2 AS DOUBLE) AS lon, {_BEARING_SQL} AS b FROM ({_DISTINCT_SQL}) q) d
  JOIN (SELECT link_id, (lat1 + lat2) / CAST(2 AS DOUBLE) AS mlat, (lon1 + lon2) / CAST(2 AS DOUBLE) AS mlon, {_BEARING_SQL} AS b
        FROM (SELECT link_id, start_lat AS lat1, start_lon AS lon1, end_lat AS lat2, end_lon AS lon2 FROM {{road_links}}) g) r
   ON r.mlat BETWEEN d.lat - 0.0005::DOUBLE AND d.lat + 0.0005::DOUBLE AND r.mlon BETWEEN d.lon - 0.0005::DOUBLE AND d.lon + 0.0005::DOUBLE) c
 WHERE dist <= 35 AND diff <= 35 GROUP BY lat1, lon1, lat2, lon2) b
 ON b.lat1 = s.lat1 AND b.lon1 = s.lon1 AND b.lat2 = s.lat2 AND b.lon2 = s.lon2"""
register(
    "match_segments",
    lambda spark, d: rounded(_matches(spark, d), "segment_len_m", "dist_m", "bearing_diff_deg", digits=2),
    f"SELECT route_id, seq, round(segment_len_m, 2) AS segment_len_m, link_id, round(dist_m, 2) AS dist_m, round(bearing_diff_deg, 2) AS bearing_diff_deg FROM ({_MATCH_SQL}) m",
)
_RUNS_SQL = f"""
SELECT route_id, run_no, link_id, min(seq) AS first_seq, count(*) AS n_segments, round(sum(round_even(segment_len_m, 2)), 2) AS segment_len_m FROM (
 SELECT *, CAST(sum(s) OVER (PARTITION BY route_id ORDER BY seq) AS BIGINT) AS run_no FROM (
  SELECT *, CASE WHEN lag(link_id) OVER (PARTITION BY route_id ORDER BY seq) = link_id THEN 0 ELSE 1 END AS s FROM ({_MATCH_SQL}) m WHERE link_id IS NOT NULL) a) b
GROUP BY route_id, run_no, link_id"""
register("match_routes", lambda spark, d: rounded(_runs(spark, d), "segment_len_m", digits=2), _RUNS_SQL)
register(
    "route_summary",
    lambda spark, d: rt.route_summary(_matches(spark, d)),
    f"""SELECT route_id, round_even(t, 1) AS total_route_len_m, round_even(c, 1) AS covered_len_m, round_even(CASE WHEN t > 0 THEN c / t ELSE 0 END, 3) AS coverage_ratio
 FROM (SELECT route_id, sum(segment_len_m) AS t, sum(CASE WHEN link_id IS NOT NULL THEN segment_len_m ELSE 0 END) AS c FROM ({_MATCH_SQL}) m GROUP BY route_id) x""",
)


def _enriched_matches(spark, d):
    lags = _lags(spark, d)
    rows = _runs(spark, d).select("route_id", "run_no", "link_id")
    return rt.enrich_matches(rows, view(spark, d, "road_links"), lags, _stand_in_scores(lags))


register(
    "enrich_matches",
    _enriched_matches,
    f"""SELECT m.link_id, m.route_id, m.run_no, r.road_name, r.road_category, s.sb AS current_band, s.sb_tm5 AS pred_band FROM ({_RUNS_SQL}) m
 LEFT JOIN {{road_links}} r ON r.link_id = m.link_id LEFT JOIN ({_LAGS_SQL}) s ON s.link_id = m.link_id""",
)
register("alternative_paths", lambda spark, d: alternative_paths(view(spark, d, "trips"), view(spark, d, "road_edges")))



def _shortest_lengths(spark, d):
    edges = view(spark, d, "road_edges")
    return path_lengths(shortest_paths(view(spark, d, "trips"), edges), edges).select("od_id", "length")


register(
    "shortest_lengths",
    _shortest_lengths,
    """WITH RECURSIVE reached(od_id, node, dist) USING KEY (od_id, node) AS (
 SELECT od_id, src AS node, CAST(0 AS DOUBLE) AS dist FROM {trips}
 UNION
 (SELECT n.od_id, n.node, n.dist FROM (
   SELECT r.od_id, e.dst AS node, min(r.dist + e.length) AS dist FROM reached r JOIN {road_edges} e ON e.src = r.node GROUP BY r.od_id, e.dst) n
  LEFT JOIN recurring.reached p ON p.od_id = n.od_id AND p.node = n.node WHERE p.dist IS NULL OR n.dist < p.dist))
SELECT t.od_id, r.dist AS length FROM {trips} t JOIN reached r ON r.od_id = t.od_id AND r.node = t.dst""",
)

# --- landed feeds ---------------------------------------------------------------------------------------------------------


def _normalised(spark, d):
    raw = run_sql(
        spark,
        d,
        """SELECT CAST(event_id AS STRING) AS id, CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END AS link_id, CAST(1 + event_id % 9 AS STRING) AS speed_band,
 '10' AS min_speed, '19' AS max_speed, CASE WHEN event_id % 29 = 0 THEN 'not a time' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS snapshot_time FROM {events}""",
    )
    return tables.normalise_readings(raw)[0]


register(
    "normalise_readings",
    _normalised,
    """SELECT event_id AS id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS link_id, CAST(1 + event_id % 9 AS INT) AS speed_band, 10 AS min_speed, 19 AS max_speed,
 [EP] AS snapshot_ts FROM {events} WHERE event_id % 29 <> 0""",
)
register(
    "road_columns",
    lambda spark, d: tables.road_columns(view(spark, d, "road_links")),
    "SELECT link_id, road_name, road_category, start_lat, start_lon, end_lat, end_lon FROM {road_links}",
)


def _incident_feed(spark, d):
    rows = view(spark, d, "incidents").withColumnsRenamed({"type": "Type", "lat": "Latitude", "lon": "Longitude"})
    item = F.to_json(F.struct("Type", "Latitude", "Longitude", F.concat(F.lit("order "), "incident_id").alias("Message")))
    body = F.when(F.col("incident_id") % 2 == 0, F.concat(F.lit("["), item, F.lit("]"))).otherwise(F.concat(F.lit('{"value":['), item, F.lit("]}")))
    return feeds.parse_incidents(rows.select("incident_id", body.alias("body")))


register(
    "incident_feed",
    _incident_feed,
    "SELECT incident_id, type AS Type, lat AS Latitude, lon AS Longitude, concat('order ', CAST(incident_id AS STRING)) AS Message FROM {incidents}",
)


def _speed_feed(spark, d):
    pages = run_sql(
        spark,
        d,
        """SELECT [EP] AS fetched_at, array(named_struct('LinkID', CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END, 'SpeedBand', CAST(1 + event_id % 8 AS STRING)),
 named_struct('LinkID', CAST(user_id AS STRING), 'SpeedBand', CASE WHEN event_id % 7 = 0 THEN NULL ELSE '9' END)) AS value FROM {events}""",
    )
    return feeds.speed_rows(pages)


register(
    "speed_feed",
    _speed_feed,
    """SELECT user_id AS link_id, CAST(1 + event_id % 8 AS INT) AS speed_band, [EP] AS fetched_at FROM {events} WHERE event_id % 13 <> 0
 UNION ALL SELECT user_id AS link_id, 9 AS speed_band, [EP] AS fetched_at FROM {events} WHERE event_id % 7 <> 0""",
)


def _station_feed(spark, d):
    text = F.concat(
        F.lit('{"data":{"stations":[{"id":"'), "station_id", F.lit('","location":{"latitude":'),
        F.when(F.substring("station_id", -1, 1) == "7", F.lit("0")).otherwise(F.col("lat").cast("string")),
        F.lit(',"longitude":'), F.col("lon").cast("string"), F.lit("}}]}}"),
    )
    rows = view(spark, d, "stations").select(text.alias("body"))
    from roadcast import schemas

    parsed = rows.select(F.from_json("body", F.lit(f"STRUCT<{schemas.STATION_FEED}>")).alias("_r")).select("_r.data")
    return feeds.flatten_stations(parsed)


_STATION_FEED_SQL = "SELECT station_id, lat, lon FROM {stations} WHERE right(station_id, 1) <> '7'"
register("station_feed", _station_feed, _STATION_FEED_SQL)


def _station_update(spark, d):
    base = view(spark, d, "stations").select("station_id", F.lit(None).cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    return al.update_by_key(base, _station_feed(spark, d), "station_id", ["lat", "lon"])


register(
    "update_stations",
    lambda spark, d: _station_update(spark, d)[0],
    "SELECT station_id, CASE WHEN right(station_id, 1) <> '7' THEN lat END AS lat, CASE WHEN right(station_id, 1) <> '7' THEN lon ELSE 0 END AS lon FROM {stations}",
)
register(
    "update_stations_count",
    lambda spark, d: _station_update(spark, d)[1],
    "SELECT count(*) AS n_updated FROM {stations} WHERE right(station_id, 1) <> '7'",
)


def _geocode(spark, d):
    rows = run_sql(
        spark,
        d,
        """SELECT p_partkey AS query, to_json(named_struct('results', transform(sequence(1, CAST(p_size AS INT)), i -> named_struct('SEARCHVAL', concat('part ', i),
 'ADDRESS', CASE WHEN i % 3 = 0 THEN '' ELSE concat(p_name, ' ', i) END, 'POSTAL', '0', 'LATITUDE', CASE WHEN i % 4 = 0 THEN '' ELSE '1.25' END, 'LONGITUDE', '103.75')))) AS body FROM {part}""",
    )
    return feeds.flatten_geocode(rows)


register(
    "geocode_places",
    _geocode,
    """SELECT query, pos, CASE WHEN i % 3 = 0 THEN concat('part ', CAST(i AS STRING)) ELSE concat(p_name, ' ', CAST(i AS STRING)) END AS label, '0' AS postal,
 CAST(1.25 AS DOUBLE) AS lat, CAST(103.75 AS DOUBLE) AS lon FROM (
 SELECT *, row_number() OVER (PARTITION BY query ORDER BY i) - 1 AS pos FROM (
  SELECT p_partkey AS query, p_name, unnest(range(1, p_size + 1)) AS i FROM {part}) a WHERE i % 4 <> 0) b WHERE pos < 8""",
)

def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    return QUERIES["features_master_v3"](spark, sf_dir)
