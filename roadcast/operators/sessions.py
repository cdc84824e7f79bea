"""Repeated incident snapshots: gap sessions and the fold into one row per incident."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import atan2, cos, radians, sin, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.functions.columns import EARTH_RADIUS_M, utc_seconds
from roadcast.session import cut_lineage
from roadcast.skew import FIND, MAX_GROUP_ROWS, Hot, run_numbers

MAX_GAP_MIN = 15  # fixed value
RADIUS_M = 200.0  # fixed value


def gap_sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    row_id: str,
    max_gap_min: float = MAX_GAP_MIN,
    out: str = "session_no",
    max_rows: int = MAX_GROUP_ROWS,
    hot: Hot = FIND,
) -> DataFrame:
    """Number the sessions of each key: a new one starts after a gap longer than ``max_gap_min``."""

    def starts(w):
        gap = F.col(ts) - F.lag(ts, 1).over(w)
        return gap.isNull() | (gap > F.lit(max_gap_min * 60))

    return run_numbers(df, keys, [ts, row_id], starts, out, max_rows, hot)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


# --- the fold -----------------------------------------------------------------------------------------------------------

TILE_RADII = 40  # a tile is that many radii high and at least as wide
BLOCK_ROWS = 250_000  # a tile with more rows is cut at whole hours
HALO_RADII, HALO_GAPS = 4, 4  # rows around a region that its first walk decides too, to know what goes on at its edges
LEAST_RING = 16  # a ring of fewer tiles is one tile: near a pole the radius spans too many degrees

_REGION = ["_none", "_type", "_tb", "_tc", "_blk"]
_WALKED = (
    "_none BOOLEAN, _type STRING, _tb BIGINT, _tc BIGINT, _blk BIGINT, row_id BIGINT, snapshot_ts BIGINT, first_row BIGINT, first_ts BIGINT, first_lat DOUBLE, first_lon DOUBLE"
)


def _metres(lat1, lon1, lat2, lon2) -> float:
    a = sin(radians(lat2 - lat1) / 2) ** 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * atan2(sqrt(a), sqrt(max(0.0, 1 - a)))


def _tile_degrees(radius_m: float) -> float:
    return TILE_RADII * _reach(radius_m)


def _reach(radius_m: float) -> float:
    """Degrees of latitude that the radius spans, with some to spare."""
    return radius_m * 1.02 / 110000.0


def _tile(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Band of latitude and cell on it; the cells of a band are at least ``size`` wide at its farthest latitude and go around the globe."""
    band = _band(lat, size)
    return band, _cell(lon, _cells(band, size))


def _band(lat: Column, size: float) -> Column:
    return F.floor(lat / F.lit(size)).cast("bigint")


def _cells(band: Column, size: float) -> Column:
    far = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * size, F.lit(90.0))
    fit = F.floor(F.lit(360.0 / size) * F.cos(F.radians(far)))
    return F.when(fit < LEAST_RING, F.lit(1)).otherwise(fit).cast("bigint")


def _cell(lon: Column, n: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) * n / 360.0).cast("bigint"), n)


class _Open:
    """Ongoing incidents by cells as wide as the radius: id -> [lat, lon, first time, last seen, cell]."""

    def __init__(self, max_gap_s: float, radius_m: float):
        self.gap, self.radius, self.step = max_gap_s, radius_m, _reach(radius_m)
        self.known: dict[int, list] = {}
        self.cells: dict[tuple[int, int], list[int]] = {}

    def _column(self, i: int, lon: float) -> tuple[int, int]:
        """Place of ``lon`` among the cells of row ``i``, and how many there are; wide enough for the row and those beside it."""
        far = min(90.0, (max(abs(i), abs(i + 1)) + 1) * self.step)
        n = int(360.0 / self.step * cos(radians(far)))
        n = 1 if n < LEAST_RING else n
        return int((lon + 180.0) * n // 360.0) % n, n

    def add(self, key: int, lat: float, lon: float, since: int, seen: int) -> None:
        i = int(lat // self.step)
        cell = (i, self._column(i, lon)[0])
        self.known[key] = [lat, lon, since, seen, cell]
        self.cells.setdefault(cell, []).append(key)

    def saw(self, key: int, lat: float, lon: float, since: int, seen: int) -> None:
        if key in self.known:
            self.known[key][3] = seen
        else:
            self.add(key, lat, lon, since, seen)

    def nearest(self, lat: float, lon: float, now: int) -> int | None:
        best = None
        row = int(lat // self.step)
        for i in (row - 1, row, row + 1):
            j, n = self._column(i, lon)
            for k in {(j - 1) % n, j, (j + 1) % n}:
                held = self.cells.get((i, k))
                for key in tuple(held or ()):
                    incident = self.known[key]
                    if now - incident[3] > self.gap:
                        held.remove(key)
                        del self.known[key]
                        continue
                    m = _metres(lat, lon, incident[0], incident[1])
                    if m <= self.radius and (best is None or (m, incident[2], key) < best):
                        best = (m, incident[2], key)
        return None if best is None else best[2]


def _walk(max_gap_s: float, radius_m: float):
    """Decide the rows of a region in time order; rows that other regions have decided (``told``) only keep their incident open.

    Rows that are neither told nor the region's own are decided for the sake of the others and not returned.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        region, ongoing = None, _Open(max_gap_s, radius_m)
        for batch in batches:
            first = []
            for row in batch.itertuples(index=False):
                if (here := row[:5]) != region:
                    region, ongoing = here, _Open(max_gap_s, radius_m)
                if row.told:
                    ongoing.saw(row.first_row, row.first_lat, row.first_lon, row.first_ts, row.snapshot_ts)
                    continue
                key = ongoing.nearest(row.lat, row.lon, row.snapshot_ts)
                if key is None:
                    key = row.row_id
                    ongoing.add(key, row.lat, row.lon, row.snapshot_ts, row.snapshot_ts)
                incident = ongoing.known[key]
                incident[3] = row.snapshot_ts
                if row.own:
                    first.append((key, incident[2], incident[0], incident[1]))
            out = batch.loc[batch["own"], [*_REGION, "row_id", "snapshot_ts"]].reset_index(drop=True)
            yield out.join(pd.DataFrame(first, columns=["first_row", "first_ts", "first_lat", "first_lon"]))

    return run


def _regions(rows: DataFrame, block_rows: int) -> DataFrame:
    """Add ``_blk``: 0, or the part of a tile with more than ``block_rows`` rows; parts are cut at whole hours."""
    tile = _REGION[:-1]
    counts = rows.groupBy(*tile).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block_rows)
    if counts.isEmpty():
        return rows.withColumn("_blk", F.lit(0).cast("bigint"))
    hour = F.floor(F.col("snapshot_ts") / 3600).cast("bigint")
    hours = rows.join(counts.drop("_n"), tile, "left_semi").groupBy(*tile, hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*tile).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hours.select(*tile, "_hour", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / block_rows).cast("bigint").alias("_blk"))
    placed = rows.withColumn("_hour", hour).join(blocks, [*tile, "_hour"], "left")
    return placed.drop("_hour").withColumn("_blk", F.coalesce("_blk", F.lit(0).cast("bigint")))


def _spread(rows: DataFrame, spans: DataFrame, lat: str, lon: str, radius_m: float, radii: float, gap_s: float) -> DataFrame:
    """Copies of ``rows`` for every other region that is within ``radii`` radii of (lat, lon) and whose rows come at most the gap after.

    A row reaches three bands at most, each with a number of cells of its own; bands and numbers are columns, so that each is computed once per row.
    """
    size, reach = _tile_degrees(radius_m), _reach(radius_m) * radii
    at, across = F.col(lat), F.col(lon)
    wide = F.lit(reach) / F.greatest(F.cos(F.radians(F.least(F.abs(at) + reach, F.lit(90.0)))), F.lit(1e-3))
    steps = (-1, 0, 1)
    heights = {a: F.greatest(F.least(at + a * reach, F.lit(90.0)), F.lit(-90.0)) for a in steps}
    own = {"_tb": "_ob", "_tc": "_oc", "_blk": "_oblk"}
    sent = rows.withColumnsRenamed(own).withColumns({"_wide": wide} | {f"_b{a}": _band(heights[a], size) for a in steps})
    sent = sent.withColumns({f"_n{a}": _cells(F.col(f"_b{a}"), size) for a in steps})
    sent = sent.withColumns({f"_c{a}{b}": _cell(across + F.col("_wide") * b, F.col(f"_n{a}")) for a in steps for b in steps})
    tiles = [F.struct(F.col(f"_b{a}").alias("_tb"), F.col(f"_c{a}{b}").alias("_tc")) for a in steps for b in steps]
    kept = [own.get(c, c) for c in rows.columns]
    sent = sent.select(*kept, F.inline(F.array_distinct(F.array(*tiles)))).join(spans, _REGION[:-1])
    elsewhere = (F.col("_tb") != F.col("_ob")) | (F.col("_tc") != F.col("_oc")) | (F.col("_blk") != F.col("_oblk"))
    sent = sent.filter(elsewhere & (F.col("snapshot_ts") <= F.col("_till")) & (F.col("snapshot_ts") >= F.col("_from") - F.lit(gap_s)))
    return sent.select(*rows.columns)


def assign_incidents(
    snapshots: DataFrame,
    max_gap_min: float = MAX_GAP_MIN,
    radius_m: float = RADIUS_M,
    max_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Snapshot rows with ``first_row``, the row id that opened the incident they belong to.

    A row joins the nearest incident of its type that was seen at most ``max_gap_min`` ago and opened within
    ``radius_m``, else it opens one.  Equal distances go to the incident that opened first.  Rows follow each other by time and row id.

    The globe is cut into tiles, and tiles with more than ``max_rows`` rows of a type at whole hours.  Each such region is walked in time order on its own, together with
    the rows around it.  Then it is told what others have decided about incidents within its reach, and walked again if that has changed.  A row depends on earlier
    rows only, so the rounds end, and where nothing changes any more every row is decided as if all had been walked in one list.
    Regions that touch no other are walked once; only the ongoing incidents of a region are in memory.

    Rows without a position (NULL or NaN) open an incident each.  A NULL type is a type.  Every row comes back, also repeated ones.
    """
    gap_s = max_gap_min * 60
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon")
    band, cell = _tile(F.col("lat"), F.col("lon"), _tile_degrees(radius_m))
    kind = {"_none": F.isnull("type"), "_type": F.coalesce("type", F.lit("")), "_tb": band, "_tc": cell}
    rows = snapshots.filter(placed).withColumns(kind).select(*_REGION[:-1], "row_id", "snapshot_ts", "lat", "lon")
    rows = cut_lineage(_regions(cut_lineage(rows), max_rows))
    spans = cut_lineage(rows.groupBy(*_REGION).agg(F.min("snapshot_ts").alias("_from"), F.max("snapshot_ts").alias("_till")))

    known = {"first_row": "bigint", "first_ts": "bigint", "first_lat": "double", "first_lon": "double"}

    def walked(own: DataFrame, others: DataFrame) -> DataFrame:
        mixed = own.withColumns({c: F.lit(0).cast(t) for c, t in known.items()} | {"own": F.lit(True), "told": F.lit(False)}).unionByName(others)
        mixed = mixed.select(*_REGION, "row_id", "snapshot_ts", "lat", "lon", "own", "told", *known)
        return mixed.repartition(*_REGION).sortWithinPartitions(*_REGION, "snapshot_ts", "row_id").mapInPandas(_walk(gap_s, radius_m), _WALKED)

    halo = _spread(rows, spans, "lat", "lon", radius_m, HALO_RADII, gap_s * HALO_GAPS)
    halo = halo.withColumns({c: F.lit(0).cast(t) for c, t in known.items()} | {"own": F.lit(False), "told": F.lit(False)})
    decided, told_before = cut_lineage(walked(rows, halo)), None
    while True:
        told = cut_lineage(_spread(decided, spans, "first_lat", "first_lon", radius_m, 1, gap_s))
        digest = F.sum(F.pmod(F.xxhash64("row_id", "first_row"), F.lit(1 << 40))).alias("_sum")
        now = told.groupBy(*_REGION).agg(F.count(F.lit(1)).alias("_n"), digest)
        if told_before is None:
            changed = now.select(*_REGION)
        else:
            changed = now.exceptAll(told_before).select(*_REGION).unionByName(told_before.exceptAll(now).select(*_REGION)).distinct()
        changed = cut_lineage(changed)
        if changed.isEmpty():
            break
        nowhere = {"own": F.lit(False), "told": F.lit(True), "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")}
        again = walked(rows.join(changed, _REGION, "left_semi"), told.join(changed, _REGION, "left_semi").withColumns(nowhere))
        decided = cut_lineage(again.unionByName(decided.join(changed, _REGION, "left_anti")))
        told_before = now
    named = snapshots.select("row_id", "type", "lat", "lon", "message", "snapshot_ts")
    # A row without a position is never within the radius of anything.
    return named.join(decided.select("row_id", "first_row"), "row_id", "left").withColumn("first_row", F.coalesce("first_row", "row_id"))


def fold_incidents(
    snapshots: DataFrame,
    max_gap_min: float = MAX_GAP_MIN,
    radius_m: float = RADIUS_M,
    max_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per incident: place and message of its first row, start, end, duration.

    ``incident_id`` is the row id of the opening row, which is unique and does not depend on how the work was split.
    """
    rows = assign_incidents(snapshots, max_gap_min, radius_m, max_rows)
    first = F.struct("snapshot_ts", "row_id")
    folded = rows.groupBy(F.col("first_row").alias("incident_id")).agg(
        F.min_by(F.struct("type", "lat", "lon", "message"), first).alias("_first"),
        F.min("snapshot_ts").alias("start_ts"),
        F.max("snapshot_ts").alias("end_ts"),
    )
    return folded.select(
        "incident_id",
        "_first.type",
        "_first.lat",
        "_first.lon",
        "start_ts",
        "end_ts",
        ((F.col("end_ts") - F.col("start_ts")) / F.lit(60.0)).alias("duration_min"),
        "_first.message",
    )


def with_iso_times(incidents: DataFrame) -> DataFrame:
    """ISO strings in UTC, as written to the cleaned table."""
    wall = lambda c: F.expr(f"CAST(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {c}) AS STRING)")
    iso = lambda c: F.concat(F.replace(wall(c), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    return incidents.withColumns({"start_time_utc": iso("start_ts"), "end_time_utc": iso("end_ts")})


def iso_to_epoch(col: str):
    """Epoch seconds of an ISO string, in UTC when it names no zone; NULL when it cannot be read."""
    return utc_seconds(col)
