"""Live state, scores, alerts and sessions on Structured Streaming.

Every start function takes a fresh folder for its checkpoint and writes one sub-folder per micro-batch with
overwrite, so a batch that is run again replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadcast.functions.columns import SINGAPORE_SHIFT_S
from roadcast.operators.alerts import apply_cooldown, route_alerts
from roadcast.operators.models import load_model, score_links
from roadcast.operators.state import KEEP, state_to_lags

_LIVE = "link_id BIGINT, newest_ts BIGINT, bands ARRAY<INT>"
_STATE = "times ARRAY<BIGINT>, ids ARRAY<BIGINT>, bands ARRAY<INT>"
_ALERTS = "route_id BIGINT, user_id BIGINT, n_links BIGINT, n_jammed BIGINT, affected_link_ids ARRAY<BIGINT>, is_dismissed BOOLEAN, created_ts BIGINT"


def _newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Merge new readings into the newest ones of the link; late and repeated readings fall into place."""
    held = set(zip(*state.get)) if state.exists else set()
    for batch in batches:
        held.update(zip(batch["snapshot_ts"].tolist(), batch["id"].tolist(), batch["speed_band"].tolist()))
        held = set(sorted(held, reverse=True)[:KEEP])
    rows = sorted(held, reverse=True)
    times, ids, bands = (list(part) for part in zip(*rows))
    state.update((times, ids, bands))
    yield pd.DataFrame({"link_id": [key[0]], "newest_ts": [times[0]], "bands": [bands]})


def stream_last_n(readings: DataFrame) -> DataFrame:
    """Stream of (link_id, newest_ts, bands) for each link with new readings (id, link_id, speed_band, snapshot_ts)."""
    rows = readings.select("link_id", "snapshot_ts", "id", "speed_band").filter("speed_band IS NOT NULL")
    return rows.groupBy("link_id").applyInPandasWithState(
        _newest, _LIVE, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str, every: str | None = None) -> StreamingQuery:
    """Run a batch ``every`` so often ("5 minutes"), or without it over what is there now."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _latest(df: DataFrame) -> DataFrame:
    """Newest state row per link, by a partial aggregate."""
    best = df.groupBy("link_id").agg(F.max_by(F.struct("newest_ts", "bands"), F.struct("newest_ts", "_v")).alias("_b"))
    return best.select("link_id", "_b.newest_ts", "_b.bands")


def _next_version(spark, updates: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """Write version ``batch_id`` of the state table: the version before it with the updates of this batch."""
    rows = updates.withColumn("_v", F.lit(1))
    if batch_id > 0:
        before = spark.read.schema(_LIVE).parquet(f"{folder}/version={batch_id - 1}")
        rows = rows.unionByName(before.withColumn("_v", F.lit(0)))
    target = f"{folder}/version={batch_id}"
    _latest(rows).write.mode("overwrite").parquet(target)
    return spark.read.schema(_LIVE).parquet(target)


def start_state(readings: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the state table of all links; the highest version is the current one."""

    def each(batch: DataFrame, batch_id: int) -> None:
        _next_version(batch.sparkSession, batch, folder, batch_id)

    return _start(stream_last_n(readings), each, checkpoint, "update", every)


def current_state(spark, folder: str) -> DataFrame:
    versions = spark.read.schema(f"{_LIVE}, version INT").parquet(folder)
    last = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == last).drop("version")


def start_scoring(
    readings: DataFrame, model_path: str, roads: DataFrame, out: str, checkpoint: str, shift_s: int = SINGAPORE_SHIFT_S, every: str | None = None
) -> StreamingQuery:
    """Predicted band of every link touched by a micro-batch, at the time of its newest reading."""
    model = load_model(readings.sparkSession, model_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max("newest_ts")).first()[0]
        if newest is None:
            return
        scores = score_links(model, state_to_lags(batch), roads, newest, shift_s)
        scores.withColumn("scored_ts", F.lit(newest)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(stream_last_n(readings), each, checkpoint, "update", every)


def start_alerts(
    readings: DataFrame,
    routes: DataFrame,
    route_links: DataFrame,
    now: Callable[[], tuple[int, str]],
    state_folder: str,
    alert_folder: str,
    checkpoint: str,
    jam_below: int = 4,
    threshold: int = 1,
    every: str | None = None,
) -> StreamingQuery:
    """Route alerts per micro-batch, at most one per route and hour.  ``now`` gives epoch seconds and "HH:MM"."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lags = state_to_lags(_next_version(spark, batch, state_folder, batch_id))
        now_ts, hhmm = now()
        fresh = route_alerts(routes, route_links, lags, hhmm, jam_below, threshold)
        fresh = fresh.withColumn("created_ts", F.lit(now_ts).cast("bigint"))
        if batch_id > 0:
            sent = spark.read.schema(f"{_ALERTS}, batch INT").parquet(alert_folder).filter(F.col("batch") < batch_id)
            fresh = apply_cooldown(fresh, sent, now_ts)
        fresh.write.mode("overwrite").parquet(f"{alert_folder}/batch={batch_id}")

    return _start(stream_last_n(readings), each, checkpoint, "update", every)


def read_alerts(spark, folder: str) -> DataFrame:
    return spark.read.schema(f"{_ALERTS}, batch INT").parquet(folder)


def stream_sessions(snapshots: DataFrame, keys=("type", "link_id"), gap: str = "15 minutes", late: str = "15 minutes") -> DataFrame:
    """Gap sessions of a snapshot stream per key.  Looser than the incident fold: it looks at no distances."""
    timed = snapshots.withColumn("event_time", F.timestamp_seconds("snapshot_ts")).withWatermark("event_time", late)
    windows = timed.groupBy(F.session_window("event_time", gap).alias("_w"), *keys).agg(
        F.min("snapshot_ts").alias("start_ts"), F.max("snapshot_ts").alias("end_ts"), F.count(F.lit(1)).alias("n")
    )
    return windows.select(*keys, "start_ts", "end_ts", "n")


def start_sessions(snapshots: DataFrame, folder: str, checkpoint: str, keys=("type", "link_id"), every: str | None = None) -> StreamingQuery:
    """Keep the table of all sessions; the highest version is the current one."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/version={batch_id}")

    return _start(stream_sessions(snapshots, keys), each, checkpoint, "complete", every)


def current_sessions(spark, folder: str, keys: dict[str, str]) -> DataFrame:
    fields = ", ".join(f"{name} {kind}" for name, kind in keys.items())
    versions = spark.read.schema(f"{fields}, start_ts BIGINT, end_ts BIGINT, n BIGINT, version INT").parquet(folder)
    last = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == last).drop("version")
