"""Route alerts and the user tables around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.functions.columns import in_daily_window

JAM_BELOW = 4  # bands 1 to 3 are jammed
NO_READING = 9  # what a link without readings counts as
COOLDOWN_S = 3600


def active_routes(routes: DataFrame, now_hhmm: str) -> DataFrame:
    """Routes with alerts on whose daily window holds now."""
    return routes.filter("alert_enabled").filter(
        in_daily_window("alert_start_time", "alert_end_time", F.lit(now_hhmm))
    )


def jammed_links(routes: DataFrame, route_links: DataFrame, latest: DataFrame, now_hhmm: str, jam_below: int = JAM_BELOW) -> DataFrame:
    """One row per (active route, link position) with ``jammed``; ``latest`` has link_id and its current band sb."""
    active = active_routes(routes, now_hhmm).select(F.col("id").alias("route_id"), "user_id")
    band = F.coalesce(F.col("sb"), F.lit(NO_READING))
    rows = route_links.join(active, "route_id").join(latest.select("link_id", "sb"), "link_id", "left")
    return rows.select("route_id", "user_id", "pos", "link_id", (band < jam_below).alias("jammed"))


def route_alerts(
    routes: DataFrame,
    route_links: DataFrame,
    latest: DataFrame,
    now_hhmm: str,
    jam_below: int = JAM_BELOW,
    threshold: int = 1,
) -> DataFrame:
    """Active routes with at least ``threshold`` jammed links, as rows of the alert table.  Routes without links never alert.

    ``affected_link_ids`` lists the jammed links in route order; a list is no longer than the route it came from, which the route table holds in one row.
    A new alert is not dismissed.
    """
    rows = jammed_links(routes, route_links, latest, now_hhmm, jam_below)
    hit = F.collect_list(F.when(F.col("jammed"), F.struct("pos", "link_id")))
    counts = rows.groupBy("route_id", "user_id").agg(
        F.count(F.lit(1)).alias("n_links"), F.count_if("jammed").alias("n_jammed"), F.sort_array(hit)["link_id"].alias("affected_link_ids"), F.lit(False).alias("is_dismissed")
    )
    return counts.filter(F.col("n_jammed") >= threshold)


def apply_cooldown(new: DataFrame, alerts: DataFrame, now_ts: int, cooldown_s: int = COOLDOWN_S) -> DataFrame:
    """Drop routes alerted less than ``cooldown_s`` ago."""
    recent = alerts.filter(F.col("created_ts") > now_ts - cooldown_s).select("route_id").distinct()
    return new.join(recent, "route_id", "left_anti")


def newest_first(df: DataFrame, user: int | None = None, by: str = "created_ts", tie: str = "id") -> DataFrame:
    """Rows of a user, or of all users one after the other, newest first."""
    rows = df if user is None else df.filter(F.col("user_id") == user)
    return rows.orderBy("user_id", F.desc(by), F.desc(tie))


def open_alerts(alerts: DataFrame, user: int | None = None) -> DataFrame:
    return newest_first(alerts.filter(~F.col("is_dismissed")), user)


def current_rows(changes: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], op: str = "op") -> DataFrame:
    """Fold a change log (insert, update, delete) into the rows that exist now.

    An insert starts a row afresh, an update replaces the columns it gives (not NULL), a delete ends the row, and a change
    to a row that does not exist does nothing.  All of it is one aggregation with partial results; no history is ordered.
    """
    no, kind = F.col(order), F.col(op)
    resets = kind.isin("insert", "delete")
    aggs = [
        F.max(F.when(resets, no)).alias("_reset"),
        F.max_by(kind, F.when(resets, no)).alias("_kind"),
    ]
    for name in cols:
        given = F.when((kind != "delete") & F.col(name).isNotNull(), no)
        aggs += [F.max(given).alias(f"_at_{name}"), F.max_by(F.col(name), given).alias(f"_val_{name}")]
    now = changes.groupBy(*keys).agg(*aggs).filter(F.col("_kind") == "insert")
    return now.select(
        *keys,
        F.col("_reset").alias("inserted_at"),
        *[F.when(F.col(f"_at_{n}") >= F.col("_reset"), F.col(f"_val_{n}")).alias(n) for n in cols],
    )


def update_by_key(base: DataFrame, new: DataFrame, key: str, cols: Sequence[str], order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(base with the new values where given, one row with the number of updates that met a row).

    Of several new rows for a key the last by ``order`` counts, without it the largest by ``cols``; its values stay together.
    """
    given = F.struct(*cols)
    best = F.max(given) if order is None else F.max_by(given, F.struct(order, given))
    fresh = new.groupBy(key).agg(best.alias("_b"), F.count(F.lit(1)).alias("_hit"))
    fresh = fresh.select(key, *[F.col(f"_b.{c}").alias(f"_new_{c}") for c in cols], "_hit")
    both = base.join(fresh, key, "left")
    updated = both.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in cols}).select(*base.columns)
    return updated, both.agg(F.coalesce(F.sum("_hit"), F.lit(0)).alias("n_updated"))
