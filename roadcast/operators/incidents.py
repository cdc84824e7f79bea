"""Incident features on readings: flags, covering maxima, roll-ups, incidents near a link.

``hot`` are the links with too many readings for one task, from :func:`roadcast.skew.hot_keys`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.functions.columns import haversine_m
from roadcast.operators.cover import cover_table, interval_pieces, look_up, pieces_met
from roadcast.operators.features import road_mid
from roadcast.operators.spatial import close_pairs
from roadcast.session import cut_lineage
from roadcast.skew import spread_join

# Incident type names, fixed values of the feed.
ACCIDENT, ROADWORK, BREAKDOWN = "Accident", "Roadwork", "Vehicle breakdown"


def _is(kind: str) -> Column:
    return F.coalesce((F.col("type") == kind).cast("int"), F.lit(0))


def on_link(incidents: DataFrame) -> DataFrame:
    """Incidents that were mapped to a link, keyed by ``link_id``."""
    return incidents.filter(F.col("nearest_link_id").isNotNull()).withColumn("link_id", F.col("nearest_link_id"))


def distinct_intervals(incidents: DataFrame) -> DataFrame:
    return on_link(incidents).select("link_id", "start_ts", "end_ts").dropDuplicates()


def _add_cover(
    df: DataFrame, incidents: DataFrame, values: Mapping[str, tuple[Column, str]], hot: DataFrame | None
) -> DataFrame:
    pieces = interval_pieces(incidents, ["link_id"], values)
    folds = {name: fold for name, (_, fold) in values.items()}
    return look_up(df, cover_table(pieces, ["link_id"], list(values)), ["link_id"], folds, hot=hot)


def flag_incidents(df: DataFrame, incidents: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``has_incident`` = 1 where an incident of the link covers the reading."""
    out = _add_cover(df, distinct_intervals(incidents), {}, hot)
    return out.withColumn("has_incident", F.col("_covered").cast("int")).drop("_covered")


def covering_max(
    df: DataFrame, incidents: DataFrame, cols: Mapping[str, str], hot: DataFrame | None = None
) -> DataFrame:
    """For each output name the largest value of an incident column; the maxima are independent of one another."""
    values = {name: (F.col(source), "max") for name, source in cols.items()}
    return _add_cover(df, on_link(incidents), values, hot).drop("_covered")


def incident_rollup(df: DataFrame, incidents: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Count, age and type flags of the incidents that cover each reading.

    Only typed incidents are counted, while one without a type still sets the age.  Equal
    rows become one row with the counts added up.
    """
    values = {
        "_typed": (F.col("type").isNotNull().cast("bigint"), "sum"),
        "_latest": (F.col("start_ts"), "max"),
        "has_accident": (_is(ACCIDENT), "max"),
        "has_roadwork": (_is(ROADWORK), "max"),
        "has_breakdown": (_is(BREAKDOWN), "max"),
    }
    flags = ["has_accident", "has_roadwork", "has_breakdown"]
    rows = _add_cover(df, on_link(incidents), values, hot)
    merged = rows.groupBy(*df.columns).agg(
        F.sum("_typed").alias("incident_count_on_link"),
        F.max("_latest").alias("_latest"),
        *[F.coalesce(F.max(flag), F.lit(0)).alias(flag) for flag in flags],
    )
    return merged.select(
        *df.columns,
        (F.col("incident_count_on_link") > 0).cast("int").alias("incident_on_link"),
        "incident_count_on_link",
        ((F.col("snapshot_ts") - F.col("_latest")) / F.lit(60.0)).alias("mins_since_inc_start"),
        *flags,
    )


NEARBY_COLUMNS = ["incident_nearby", "nearby_accident", "nearby_roadwork", "nearby_breakdown", "mins_since_nearby_start"]


_NEARBY_FLAGS = {"nearby_accident": ACCIDENT, "nearby_roadwork": ROADWORK, "nearby_breakdown": BREAKDOWN}
_NEARBY_FOLDS = {"_latest": "max", **dict.fromkeys(_NEARBY_FLAGS, "max")}


def nearby_cover(roads: DataFrame, incidents: DataFrame, moments: DataFrame, radius_m: float = 200.0) -> DataFrame:
    """Cover table by link of the incidents within ``radius_m`` of the link's midpoint, for the ``moments`` (link_id, snapshot_ts) to be looked up.

    Intervals are merged per incident position first; positions are then paired with links, so copies of an
    incident or many incidents at one spot do not multiply the pairs.  A link gets those pieces only that hold one of its moments.
    """
    values = {"_latest": (F.col("start_ts"), "max"), **{name: (_is(kind), "max") for name, kind in _NEARBY_FLAGS.items()}}
    at_spot = interval_pieces(incidents.filter("lat IS NOT NULL AND lon IS NOT NULL"), ["lat", "lon"], values)
    at_spot = cut_lineage(at_spot)
    mids = road_mid(roads).select("link_id", "mid_lat", "mid_lon")
    pairs = close_pairs(at_spot.select("lat", "lon").distinct(), mids, radius_m, haversine_m).select("lat", "lon", "link_id")
    return cover_table(pieces_met(at_spot, ["lat", "lon"], pairs, moments, "link_id", _NEARBY_FOLDS), ["link_id"], list(values))


def _age(latest: Column) -> Column:
    return (F.col("snapshot_ts") - latest) / F.lit(60.0)


def nearby_incidents(readings: DataFrame, roads: DataFrame, incidents: DataFrame, radius_m: float = 200.0) -> DataFrame:
    """One row per (link, snapshot) with an active incident within ``radius_m`` of the link midpoint."""
    snapshots = cut_lineage(readings.select("link_id", "snapshot_ts").distinct())
    cover = nearby_cover(roads, incidents, snapshots, radius_m)
    snapshots = snapshots.join(cover.select("link_id").distinct(), "link_id", "left_semi")
    hit = look_up(snapshots, cover, ["link_id"], _NEARBY_FOLDS).filter("_covered")
    age = _age(F.col("_latest")).alias("mins_since_nearby_start")
    return hit.select("link_id", "snapshot_ts", F.lit(1).alias("incident_nearby"), *_NEARBY_FLAGS, age)


def add_nearby(
    df: DataFrame, roads: DataFrame, incidents: DataFrame, radius_m: float = 200.0, hot: DataFrame | None = None, moments: DataFrame | None = None
) -> DataFrame:
    """The columns of :func:`with_nearby`, looked up on the rows themselves.

    ``moments`` has the (link_id, snapshot_ts) of all rows, and may have more; by default they are taken from ``df``, which is then computed for them too.
    """
    cover = nearby_cover(roads, incidents, df if moments is None else moments, radius_m)
    hit = look_up(df, cover, ["link_id"], _NEARBY_FOLDS, hot=hot)
    flags = [F.coalesce(name, F.lit(0)).alias(name) for name in _NEARBY_FLAGS]
    age = F.coalesce(_age(F.col("_latest")), F.lit(-1.0)).alias("mins_since_nearby_start")
    return hit.select(*df.columns, F.col("_covered").cast("int").alias("incident_nearby"), *flags, age)


def with_nearby(df: DataFrame, nearby: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Left join of the nearby table; rows without an entry get 0, and -1 for the age."""
    out = spread_join(df, nearby, ["link_id", "snapshot_ts"], "link_id", hot)
    return out.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(-1.0 if name.startswith("mins") else 0))
            for name in NEARBY_COLUMNS
        }
    )


def fill_incident_nulls(df: DataFrame, col: str = "incident_type") -> DataFrame:
    filled = df.withColumn(col, F.coalesce(F.col(col), F.lit("None")))
    return filled.withColumn("has_incident", (F.col(col) != "None").cast("int"))


def encode_types(df: DataFrame, frames: Sequence[DataFrame], col: str = "incident_type", out: str = "inc_type_code") -> DataFrame:
    """Code of each type by alphabetical place among the types seen in all ``frames``.

    Distinct types are range-partitioned by name and written with their place in their part; only one count per part meets in one
    task.  A NULL type has no code.
    """
    seen = frames[0].select(col)
    for other in frames[1:]:
        seen = seen.unionByName(other.select(col))
    types = seen.filter(F.col(col).isNotNull()).distinct().repartitionByRange(col).withColumn("_part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("_part").orderBy(col))
    types = cut_lineage(types.withColumn("_local", local))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = types.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    codes = types.join(parts, "_part").select(col, (F.col("_before") + F.col("_local") - 1).cast("bigint").alias(out))
    return df.join(codes, col, "left")
