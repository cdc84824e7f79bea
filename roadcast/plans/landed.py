"""Registered queries over files and streams that are derived from the driver's tables: landed, read back, served."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import functions as F

from roadcast.operators import alerts as al
from roadcast.operators import evaluate as ev
from roadcast.operators import features as ft
from roadcast.operators import models as md
from roadcast.operators import sampling as sm
from roadcast.operators import state as st
from roadcast.plans import queries as q
from roadcast.plans.fixtures import NOW_TS, run_sql, view
from roadcast.plans.registry import QUERIES, register
from roadcast.session import cut_lineage, shared_folder
from roadcast.sources import feeds, sinks, tables
from roadcast.streaming import live


def _fresh_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- readings, features -------------------------------------------------------------------------------------------------


def _chunks(spark, d):
    folder = _fresh_folder(spark, "readings")
    rows = view(spark, d, "speedbands").withColumn("chunk", F.pmod("id", F.lit(3)))
    sinks.write_table(rows, folder, ["chunk"], max_records=sinks.CHUNK_ROWS)
    return tables.read_readings(spark, f"{folder}/chunk=*")


register("read_readings", _chunks, "SELECT * FROM {speedbands}")

_RAW = """SELECT CAST(event_id AS STRING) AS id, CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END AS link_id, CAST(1 + event_id % 9 AS STRING) AS speed_band,
 '10' AS min_speed, '19' AS max_speed, CASE WHEN event_id % 29 = 0 THEN concat('not a time ', CAST(event_id AS STRING)) ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS snapshot_time FROM {events}"""


def _landed(spark, d):
    """Readings exported as CSV and read again: (good, rejects)."""
    folder = _fresh_folder(spark, "landed")
    run_sql(spark, d, _RAW).write.option("header", True).csv(folder)
    return tables.normalise_readings(tables.read_landed(spark, folder))


register(
    "landed_readings",
    lambda spark, d: _landed(spark, d)[0],
    """SELECT event_id AS id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS link_id, CAST(1 + event_id % 9 AS INT) AS speed_band, 10 AS min_speed, 19 AS max_speed,
 [EP] AS snapshot_ts FROM {events} WHERE event_id % 29 <> 0""",
)
register(
    "rejected_readings",
    lambda spark, d: _landed(spark, d)[1],
    """SELECT CAST(event_id AS STRING) AS id, CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END AS link_id, CAST(1 + event_id % 9 AS STRING) AS speed_band,
 '10' AS min_speed, '19' AS max_speed, concat('not a time ', CAST(event_id AS STRING)) AS snapshot_time FROM {events} WHERE event_id % 29 = 0""",
)


def _by_day(spark, d):
    folder = _fresh_folder(spark, "features")
    sinks.write_by_day(QUERIES["features_roads_tp15"](spark, d), folder)
    back = spark.read.parquet(folder)
    return back.filter(F.col("day") >= F.lit("2024-01-03").cast("date")).withColumn("day", F.col("day").cast("string"))


_ROADS15 = q._ROADS15_SQL
register(
    "features_by_day",
    _by_day,
    f"SELECT *, strftime(make_timestamp(snapshot_ts * 1000000), '%Y-%m-%d') AS day FROM ({_ROADS15}) f WHERE snapshot_ts >= 1704240000",
)


def _file_profile(spark, d):
    folder = _fresh_folder(spark, "profile")
    sinks.write_table(QUERIES["features_roads_tp15"](spark, d), folder)
    return sm.file_bounds(spark, folder)


register("file_profile", _file_profile, f"SELECT count(*) AS n, min(snapshot_ts) AS min_ts, max(snapshot_ts) AS max_ts FROM ({_ROADS15}) f")


def _bucketed(spark, d):
    name = f"readings_{uuid.uuid4().hex}"
    rows = sinks.write_bucketed(view(spark, d, "speedbands"), name, _fresh_folder(spark, name), order=("snapshot_ts", "id"), buckets=16)
    return ft.build_features(rows, q.LAGS, (3,), q.START_TS, q.END_TS)


register("features_from_buckets", _bucketed, q._sql_features(q.LAGS, (3,)))

# --- feeds --------------------------------------------------------------------------------------------------------------

_PER_DOCUMENT = 4000


def _feed_files(spark, d, only=None):
    """Documents of a few thousand incidents each, every other one a bare list."""
    folder = _fresh_folder(spark, "feed")
    rows = view(spark, d, "incidents").withColumnsRenamed({"type": "Type", "lat": "Latitude", "lon": "Longitude"})
    rows = rows.withColumns({"doc": F.floor(F.col("incident_id") / _PER_DOCUMENT), "Message": F.concat(F.lit("order "), "incident_id")})
    rows = rows if only is None else rows.filter(F.col("doc") == only)
    items = F.sort_array(F.collect_list(F.struct("incident_id", "Type", "Latitude", "Longitude", "Message")))
    bare = F.to_json(F.transform(items, lambda r: F.struct(r["Type"].alias("Type"), r["Latitude"].alias("Latitude"), r["Longitude"].alias("Longitude"), r["Message"].alias("Message"))))
    docs = rows.groupBy("doc").agg(bare.alias("body"))
    docs = docs.select("doc", F.when(F.col("doc") % 2 == 0, F.col("body")).otherwise(F.concat(F.lit('{"value":'), "body", F.lit("}"))).alias("body"))
    docs.write.partitionBy("doc").text(folder)
    return f"{folder}/*"


_FEED_SQL = "SELECT type AS Type, lat AS Latitude, lon AS Longitude, concat('order ', CAST(incident_id AS STRING)) AS Message FROM {incidents}"
register("incident_feed_files", lambda spark, d: feeds.read_incident_feed(spark, _feed_files(spark, d), n=None), _FEED_SQL)
register(
    "first_feed_incidents",
    lambda spark, d: feeds.read_incident_feed(spark, _feed_files(spark, d, only=1)),
    f"{_FEED_SQL} WHERE incident_id // {_PER_DOCUMENT} = 1 ORDER BY incident_id LIMIT 30",
)


def _page_files(spark, d):
    """Pages of 500 entries, one file each, some entries unreadable."""
    folder = _fresh_folder(spark, "pages")
    rows = run_sql(
        spark,
        d,
        """SELECT event_id [DIV] 500 AS page, [EP] AS at, event_id, CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END AS LinkID,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1 + event_id % 8 AS STRING) END AS SpeedBand FROM {events}""",
    )
    value = F.transform(F.sort_array(F.collect_list(F.struct("event_id", "LinkID", "SpeedBand"))), lambda r: F.struct(r["LinkID"].alias("LinkID"), r["SpeedBand"].alias("SpeedBand")))
    pages = rows.groupBy("page").agg(F.to_json(F.struct(F.max("at").alias("fetched_at"), value.alias("value"))).alias("body"))
    pages.write.partitionBy("page").text(folder)
    return feeds.read_speed_pages(spark, f"{folder}/*")


register(
    "speed_page_files",
    _page_files,
    """SELECT user_id AS link_id, CAST(1 + event_id % 8 AS INT) AS speed_band, max([EP]) OVER (PARTITION BY event_id // 500) AS fetched_at FROM {events}
 QUALIFY event_id % 13 <> 0 AND event_id % 7 <> 0""",
)

# --- user tables ----------------------------------------------------------------------------------------------------------

register(
    "user_routes",
    lambda spark, d: al.newest_first(view(spark, d, "habit_routes")),
    "SELECT * FROM {habit_routes} ORDER BY user_id, created_ts DESC, id DESC",
)
_PLACES_SQL = """SELECT r.user_id, r.place_id, r.change_no AS inserted_at,
 (SELECT arg_max(u.label, u.change_no) FROM {place_changes} u WHERE u.user_id = r.user_id AND u.place_id = r.place_id AND u.change_no >= r.change_no
   AND u.op <> 'delete' AND u.label IS NOT NULL) AS label
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id, place_id ORDER BY change_no DESC) AS n FROM {place_changes} WHERE op IN ('insert', 'delete')) r
 WHERE r.n = 1 AND r.op = 'insert'"""
register(
    "user_places",
    lambda spark, d: al.newest_first(QUERIES["current_places"](spark, d), by="inserted_at", tie="place_id"),
    f"SELECT * FROM ({_PLACES_SQL}) p ORDER BY user_id, inserted_at DESC, place_id DESC",
)


def _update_twice(spark, d):
    """Each station reported twice; the later report counts, though its values are the smaller ones."""
    base = view(spark, d, "stations").select("station_id", F.lit(None).cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    late = view(spark, d, "stations").withColumn("seq", F.lit(2))
    early = late.select("station_id", (F.col("lat") + 1).alias("lat"), (F.col("lon") + 1).alias("lon"), F.lit(1).alias("seq"))
    return al.update_by_key(base, late.unionByName(early), "station_id", ["lat", "lon"], order="seq")[0]


register("update_stations_last", _update_twice, "SELECT station_id, lat, lon FROM {stations}")

# --- models ---------------------------------------------------------------------------------------------------------------
# Scores of fitted models have no SQL; what does is which rows they have and what must hold for each.


def _band_rows(spark, d):
    """(train, test) rows of the band model; training reads its rows many times."""
    train, test = sm.split_last(ft.add_targets(QUERIES["features_roads_tp15"](spark, d)))
    return sm.hash_sample(train), test


@lru_cache(1)
def _band_model(spark, d):
    """Several queries ask what one fitted model says."""
    return md.fit_band_model(_band_rows(spark, d)[0], md.BAND_FEATURES["roads"], rounds=MODEL_ROUNDS)


def _change_rows(spark, d):
    train, test = sm.split_fraction(QUERIES["change_features"](spark, d))
    return sm.keep_or_sample(train, "incident_nearby"), test


register(
    "row_weights",
    lambda spark, d: md.row_weights(q._nearby_rows(spark, d), 5.0).select("link_id", "snapshot_ts", "incident_nearby", "w"),
    f"SELECT link_id, snapshot_ts, incident_nearby, CASE WHEN incident_nearby = 1 THEN CAST(5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS w FROM ({q._NEARBY_ROWS_SQL}) n",
)
MODEL_ROUNDS = 5


def _served(spark, d, scores):
    """Per link: whether it has a score, and whether that is a band."""
    band = F.col("prediction_tp15")
    return scores.select("link_id", band.isNotNull().alias("scored"), F.coalesce(band.between(1, 8), F.lit(True)).alias("in_range"))


def _scores(spark, d):
    return md.score_links(_band_model(spark, d), q._lags(spark, d), view(spark, d, "road_links"), NOW_TS)


register(
    "band_model_scores",
    lambda spark, d: _served(spark, d, _scores(spark, d)),
    f"SELECT s.link_id, r.link_id IS NOT NULL AS scored, TRUE AS in_range FROM ({q._LAGS_SQL}) s LEFT JOIN {{road_links}} r ON r.link_id = s.link_id",
)


def _saved(spark, d):
    """Scores of the model as fitted and as loaded again, side by side."""
    folder = _fresh_folder(spark, "model")
    model = _band_model(spark, d)
    md.save_model(spark, model, folder)
    lags, roads = cut_lineage(q._lags(spark, d)), view(spark, d, "road_links")
    one = md.score_links(model, lags, roads, NOW_TS)
    two = md.score_links(md.load_model(spark, folder), lags, roads, NOW_TS).withColumnRenamed("prediction_tp15", "_again")
    return one.join(two, "link_id").select("link_id", F.col("prediction_tp15").eqNullSafe(F.col("_again")).alias("same"))


register("saved_model_scores", _saved, f"SELECT link_id, TRUE AS same FROM ({q._LAGS_SQL}) s")


def _model_metrics(spark, d):
    """Scores of a fitted model against persistence on the last two days; the model's own figures as ranges."""
    train, test = _band_rows(spark, d)
    model = md.fit_band_model(train, md.BAND_FEATURES["roads"], rounds=MODEL_ROUNDS)
    row = q.rounded(ev.class_metrics(md.predict_band(model, test, "_pred"), pred="_pred"), *q._METRICS)
    share = lambda c: F.coalesce(F.col(c).between(0, 1), F.lit(True)).alias(f"{c}_ok")
    return row.select("n", "base_acc", "base_mae", "base_within1", "change_rows", "base_change_acc", share("acc"), share("within1"), share("change_acc"))


register(
    "model_metrics",
    _model_metrics,
    f"""SELECT n, base_acc, base_mae, base_within1, change_rows, base_change_acc, TRUE AS acc_ok, TRUE AS within1_ok, TRUE AS change_acc_ok FROM ({
        q._sql_class_metrics(f"SELECT * FROM ({_ROADS15}) a WHERE snapshot_ts >= (SELECT max(snapshot_ts) - 172800 FROM ({_ROADS15}) b)", "sb")}) m""",
)


def _importance(spark, d):
    found = md.importance(spark, _band_model(spark, d))
    return found.select("feature", (F.col("importance") >= 0).alias("ok"))


register("feature_importance", _importance, "SELECT feature, TRUE AS ok FROM (VALUES " + ", ".join(f"('{name}')" for name in md.BAND_FEATURES["roads"]) + ") v(feature)")


def _change_scores(spark, d):
    train, test = _change_rows(spark, d)
    model = md.fit_change_model(md.row_weights(train, 2.0), rounds=MODEL_ROUNDS)
    out = md.predict_change(model, test)
    right = F.col("prob").between(0, 1) & ((F.col("prob") >= md.CHANGE_CUT) == (F.col("pred") == 1))
    return out.select("link_id", "snapshot_ts", "change", right.alias("ok"))


register(
    "change_model_scores",
    _change_scores,
    f"""SELECT link_id, snapshot_ts, CAST(change AS INT) AS change, TRUE AS ok FROM ({q._CHANGE_SQL}) c
 WHERE snapshot_ts >= (SELECT min(snapshot_ts) + CAST(trunc(CAST(0.8 AS DOUBLE) * (max(snapshot_ts) - min(snapshot_ts))) AS BIGINT) FROM ({q._MASTER_SQL}) m)""",
)

# --- streams --------------------------------------------------------------------------------------------------------------
# The events land as three files, so that each stream runs three batches.

_PARTS = 3
_STREAMED = "id BIGINT, link_id BIGINT, speed_band INT, snapshot_ts BIGINT, type STRING"
_READINGS_SQL = "SELECT event_id AS id, user_id AS link_id, CAST(1 + (event_id * 7 + user_id) % 8 AS INT) AS speed_band, [EP] AS snapshot_ts, event_type AS type FROM {events}"


def _event_files(spark, d):
    folder = _fresh_folder(spark, "stream")
    rows = cut_lineage(run_sql(spark, d, _READINGS_SQL.replace("CAST(1 + (event_id * 7 + user_id) % 8 AS INT)", "CAST(1 + pmod(event_id * 7 + user_id, 8) AS INT)")))
    for n in range(_PARTS):
        rows.filter(F.pmod("id", F.lit(_PARTS)) == n).coalesce(1).write.parquet(f"{folder}/in/part={n}")
    stream = spark.readStream.schema(_STREAMED).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    return stream, folder


def _upto(n: int) -> str:
    return q._sql_last_n(f"({_READINGS_SQL} WHERE event_id % {_PARTS} <= {n}) e")


def _stream_last_n(spark, d):
    stream, folder = _event_files(spark, d)
    live.start_state(stream, f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return st.state_to_lags(live.current_state(spark, f"{folder}/state"))


register("stream_last_n", _stream_last_n, _upto(_PARTS))


def _stream_alerts(spark, d):
    stream, folder = _event_files(spark, d)
    clock = iter([NOW_TS, NOW_TS + 60, NOW_TS + 4000])
    live.start_alerts(
        stream, view(spark, d, "habit_routes"), view(spark, d, "route_links"), lambda: (next(clock), q.NOW_HHMM),
        f"{folder}/state", f"{folder}/alerts", f"{folder}/checkpoint",
    ).awaitTermination()
    return q.listed(live.read_alerts(spark, f"{folder}/alerts").drop("batch"))


def _alerts_sql(n: int, at: int) -> str:
    return f"SELECT *, CAST({at} AS BIGINT) AS created_ts FROM ({q._ALERTS_SQL.replace(q._LAGS_SQL, _upto(n))}) a{n}"


register(
    "stream_alerts",
    _stream_alerts,
    f"""{_alerts_sql(0, NOW_TS)} UNION ALL SELECT * FROM ({_alerts_sql(1, NOW_TS + 60)}) x WHERE route_id NOT IN (SELECT route_id FROM ({_alerts_sql(0, NOW_TS)}) y)
 UNION ALL {_alerts_sql(2, NOW_TS + 4000)}""",
)


def _stream_scores(spark, d):
    stream, folder = _event_files(spark, d)
    md.save_model(spark, _band_model(spark, d), f"{folder}/model")
    live.start_scoring(stream, f"{folder}/model", view(spark, d, "road_links"), f"{folder}/scores", f"{folder}/checkpoint").awaitTermination()
    scores = spark.read.schema("link_id BIGINT, prediction_tp15 INT, scored_ts BIGINT, batch INT").parquet(f"{folder}/scores")
    return scores.select(
        "batch", "link_id", "scored_ts", F.col("prediction_tp15").isNotNull().alias("scored"), F.coalesce(F.col("prediction_tp15").between(1, 8), F.lit(True)).alias("in_range")
    )


register(
    "stream_scores",
    _stream_scores,
    " UNION ALL ".join(
        f"""SELECT {n} AS batch, e.link_id, (SELECT max(snapshot_ts) FROM ({_READINGS_SQL} WHERE event_id % {_PARTS} <= {n}) u WHERE u.link_id IN (SELECT user_id FROM {{events}} WHERE event_id % {_PARTS} = {n})) AS scored_ts,
 r.link_id IS NOT NULL AS scored, TRUE AS in_range FROM (SELECT DISTINCT user_id AS link_id FROM {{events}} WHERE event_id % {_PARTS} = {n}) e LEFT JOIN {{road_links}} r ON r.link_id = e.link_id"""
        for n in range(_PARTS)
    ),
)


def _stream_sessions(spark, d):
    """Sessions of the whole stream in one batch: nothing is late."""
    _, folder = _event_files(spark, d)
    stream = spark.readStream.schema(_STREAMED).parquet(f"{folder}/in/part=*")
    live.start_sessions(stream, f"{folder}/sessions", f"{folder}/checkpoint").awaitTermination()
    return live.current_sessions(spark, f"{folder}/sessions", {"type": "STRING", "link_id": "BIGINT"})


register(
    "stream_sessions",
    _stream_sessions,
    f"""SELECT type, link_id, min(snapshot_ts) AS start_ts, max(snapshot_ts) AS end_ts, count(*) AS n FROM (
 SELECT *, sum(s) OVER (PARTITION BY type, link_id ORDER BY snapshot_ts, id) AS k FROM (
  SELECT *, CASE WHEN snapshot_ts - lag(snapshot_ts) OVER (PARTITION BY type, link_id ORDER BY snapshot_ts, id) < 900 THEN 0 ELSE 1 END AS s FROM ({_READINGS_SQL}) e) a) b
GROUP BY type, link_id, k""",
)
