"""Nearest-neighbour and within-distance joins on grids of cells."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.functions.columns import EARTH_RADIUS_M, flat_m, haversine_m
from roadcast.operators.features import road_mid
from roadcast.session import cut_lineage

FINEST = 30  # halvings of the globe along each axis: cells of four centimetres
SPLIT_BITS = 3  # a cell is split eight times along each axis
LEAF_POSITIONS = 32
CELL_ROWS = 2_000  # rows of one side of a cell that meet the other side in one task
SLACK_M = 0.01
LEAST_RING = 16  # a ring of fewer cells is not cut: there the radius spans too many degrees for the slack of the cells

UNMAPPED_NAME = "Ummapped Road"  # fixed value, spelled as served
UNNAMED_ROAD = "LTA Road"  # fixed value


def _grid(lat, lon, size_lat: float, size_lon: float) -> dict[str, Column]:
    return {
        "_ci": F.floor(F.col(lat) / F.lit(size_lat)).cast("bigint"),
        "_cj": F.floor(F.col(lon) / F.lit(size_lon)).cast("bigint"),
    }


def _around(df: DataFrame) -> DataFrame:
    """Copy rows to their cell and the eight cells around it."""
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    return (
        df.withColumn("_d", F.explode(steps))
        .withColumns({"_ci": F.col("_ci") + F.col("_d.a"), "_cj": F.col("_cj") + F.col("_d.b")})
        .drop("_d")
    )


def cell_join(left: DataFrame, right: DataFrame, keys: Sequence[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Join of rows in the same cell, where cells with many rows are split.

    A histogram of both sides, counted before they meet, gives each cell with more than ``cell_rows`` rows on a side its number of parts on either side.  A row
    goes to one part of its own side and is copied to all parts of the other one, so each pair of rows meets once, and no
    task has more than ``cell_rows`` rows of each side of one cell to put together.
    """
    n_left = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    n_right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
    load = n_left.join(n_right, list(keys)).filter((F.col("_nl") > cell_rows) | (F.col("_nr") > cell_rows))
    parts = lambda n: F.ceil(F.col(n) / F.lit(cell_rows)).cast("int")
    load = cut_lineage(load.select(*keys, parts("_nl").alias("_pl"), parts("_nr").alias("_pr")))
    if load.isEmpty():
        return left.join(right, list(keys))

    def dealt(df: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        placed = df.join(load, list(keys), "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_pl", "_pr")})
        placed = placed.withColumn(own_part, F.pmod(F.xxhash64(*df.columns), own).cast("int"))
        return placed.withColumn(other_part, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_pl", "_pr")

    return dealt(left, "_pl", "_pr", "_a", "_b").join(dealt(right, "_pr", "_pl", "_b", "_a"), [*keys, "_a", "_b"]).drop("_a", "_b")


def close_pairs(
    points: DataFrame,
    mids: DataFrame,
    radius_m: float,
    distance: Callable[..., Column] = haversine_m,
) -> DataFrame:
    """Pairs of a point (lat, lon) and a road midpoint (mid_lat, mid_lon) within ``radius_m``, with ``dist_m``.

    The globe is cut into bands of latitude, and each band into equal cells that are at least the radius wide at the farthest latitude
    of the band and its neighbours.  A midpoint is copied to its own band and the two beside it, in each to the cell of its longitude
    and the two around it, over the date line too; rings near a pole, of few cells, are one cell.  So it meets every point it can reach.
    """
    size = radius_m * 1.02 / 110000.0

    def cell(band: Column, lon: str) -> tuple[Column, Column]:
        far = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * size + size, F.lit(90.0))
        fit = F.floor(F.lit(360.0 / size) * F.cos(F.radians(far)))
        n = F.when(fit < LEAST_RING, F.lit(1)).otherwise(fit).cast("bigint")
        return F.pmod(F.floor((F.col(lon) + 180.0) * n / 360.0).cast("bigint"), n), n

    band = lambda lat: F.floor(F.col(lat) / F.lit(size)).cast("bigint")
    left = points.withColumn("_ci", band("lat")).withColumn("_cj", cell(F.col("_ci"), "lon")[0])
    right = mids.withColumn("_ci", F.explode(F.array(*[band("mid_lat") + k for k in (-1, 0, 1)])))
    at, n = cell(F.col("_ci"), "mid_lon")
    right = right.withColumn("_cj", F.explode(F.array_distinct(F.array(F.pmod(at - 1, n), at, F.pmod(at + 1, n)))))
    pairs = cell_join(left, right, ["_ci", "_cj"]).drop("_ci", "_cj")
    return pairs.withColumn("dist_m", distance("lat", "lon", "mid_lat", "mid_lon")).filter(F.col("dist_m") <= radius_m)


def in_box_pairs(points: DataFrame, mids: DataFrame, pad: float) -> DataFrame:
    """Pairs whose midpoint lies within ``pad`` degrees of the point on both axes, ends included."""
    size = pad * 1.01
    left = points.withColumns(_grid("lat", "lon", size, size))
    right = _around(mids.withColumns(_grid("mid_lat", "mid_lon", size, size)))
    inside = F.col("mid_lat").between(F.col("lat") - pad, F.col("lat") + pad) & F.col("mid_lon").between(
        F.col("lon") - pad, F.col("lon") + pad
    )
    return cell_join(left, right, ["_ci", "_cj"]).filter(inside).drop("_ci", "_cj")


def nearest_in_box(points: DataFrame, roads: DataFrame, pad: float = 0.001) -> DataFrame:
    """Add ``matched_link_id`` and ``matched_road_name``: the link whose midpoint is nearest within the box.

    Equal positions are matched once.  Equal distances go to the lowest link id.
    """
    mids = road_mid(roads).groupBy("mid_lat", "mid_lon").agg(
        F.min("link_id").alias("link_id"), F.min_by("road_name", "link_id").alias("road_name")
    )
    spots = points.select("lat", "lon").filter("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    pairs = in_box_pairs(spots, mids, pad).withColumn("_d", flat_m("lat", "lon", "mid_lat", "mid_lon"))
    best = pairs.groupBy("lat", "lon").agg(
        F.min_by(F.struct("link_id", "road_name"), F.struct(F.round("_d", 3), "link_id")).alias("_best")
    )
    out = points.join(best, ["lat", "lon"], "left")
    name = F.when(F.col("_best").isNull(), F.lit(UNMAPPED_NAME)).otherwise(
        F.coalesce(F.col("_best.road_name"), F.lit(UNNAMED_ROAD))
    )
    return out.select(*points.columns, F.col("_best.link_id").alias("matched_link_id"), name.alias("matched_road_name"))


def _box_gap(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest haversine distance between anything in box ``a`` and anything in box ``b``; boxes are columns of (lat1, lat2, lon1, lon2)."""
    (alat1, alat2, alon1, alon2), (blat1, blat2, blon1, blon2) = ([F.col(f"{x}{n}") for n in ("lat1", "lat2", "lon1", "lon2")] for x in (a, b))
    zero, half = F.lit(0.0), F.lit(180.0)
    near_lat = F.greatest(zero, blat1 - alat2, alat1 - blat2)
    far_lat = F.greatest(blat2 - alat1, alat2 - blat1)
    span = F.greatest(blon2 - alon1, alon2 - blon1)
    near_lon = F.when(span > half, zero).otherwise(F.greatest(zero, blon1 - alon2, alon1 - blon2))

    def cosines(lat1, lat2):
        ends = F.cos(F.radians(lat1)), F.cos(F.radians(lat2))
        return F.least(*ends), F.when((lat1 <= 0) & (lat2 >= 0), F.lit(1.0)).otherwise(F.greatest(*ends))

    (a_min, a_max), (b_min, b_max) = cosines(alat1, alat2), cosines(blat1, blat2)

    def metres(dlat, dlon, weight):
        h = F.pow(F.sin(F.radians(dlat) / 2), 2) + weight * F.pow(F.sin(F.radians(dlon) / 2), 2)
        return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))

    return metres(near_lat, near_lon, a_min * b_min), metres(far_lat, F.least(half, span), a_max * b_max)


def _places(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the finest cell (``_i``, ``_j``) of a position; a cell of a coarser level drops low bits."""
    cells = 1 << FINEST
    at = lambda value, least, width: F.greatest(F.least(F.floor((F.col(value) - least) / width * cells), F.lit(cells - 1)), F.lit(0)).cast("bigint")
    return df.withColumns({"_i": at(lat, -90.0, 180.0), "_j": at(lon, -180.0, 360.0)})


def _cells(df: DataFrame, lat: str, lon: str, levels: Sequence[int], prefix: str) -> DataFrame:
    """One row per cell of each level that holds a position: its box and its number of positions."""
    each = F.array(*[F.struct(F.lit(n).alias("l"), F.shiftright("_i", FINEST - n).alias("i"), F.shiftright("_j", FINEST - n).alias("j")) for n in levels])
    rows = df.select(lat, lon, F.inline(each))
    names = [f"{prefix}{n}" for n in ("lat1", "lat2", "lon1", "lon2")]
    return rows.groupBy("l", "i", "j").agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(name) for name, (c, f) in zip(names, ((lat, F.min), (lat, F.max), (lon, F.min), (lon, F.max)))]
    )


def nearest_join(points: DataFrame, targets: DataFrame, target_id: str, out_id: str, out_dist: str, leaf: int = LEAF_POSITIONS) -> DataFrame:
    """Nearest target by haversine distance, without a cut-off, for each row of ``points`` (lat, lon).

    Targets form a quad tree: a cell is split, eight times along each axis, until it holds at most ``leaf`` positions; the positions of all levels are
    counted in one pass.  Points are put into the cells of the same grid.  From the widest cells down, cells of points are held against cells of targets: those whose
    boxes are farther apart than the farthest corner of another one go, and both sides of the others are split.  Points meet targets only in
    the leaves that are left for their cell and, after the same test with the point itself, for them.  So neither many targets in one spot nor many points in one
    make a task of all pairs.

    Equal positions, on both sides, are handled once; ties (to the millimetre) go to the lowest id.  Rows without a position get NULL, and so
    do all rows when there is no target.
    """
    spots = _places(points.select(F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).dropna().distinct(), "_plat", "_plon")
    spots = cut_lineage(spots.filter(~F.isnan("_plat") & ~F.isnan("_plon")))
    known = targets.dropna(subset=["lat", "lon"]).groupBy("lat", "lon").agg(F.min(target_id).alias("_tid"))
    known = cut_lineage(_places(known, "lat", "lon"))
    extent = known.agg(F.min("_i"), F.max("_i"), F.min("_j"), F.max("_j")).first()
    i1, i2, j1, j2 = (0 if v is None else v for v in extent)
    # start at the finest level where at most 2 x 2 cells hold all targets
    top = next(n for n in range(FINEST, -1, -SPLIT_BITS) if all(hi >> FINEST - n <= (lo >> FINEST - n) + 1 for lo, hi in ((i1, i2), (j1, j2))))
    levels = list(range(top, FINEST + 1, SPLIT_BITS))
    up = lambda c: F.shiftright(c, SPLIT_BITS)
    siblings = Window.partitionBy("l", up("i"), up("j"))
    tree = _cells(known, "lat", "lon", levels, "t_").withColumn("_parent_n", F.sum("n").over(siblings))
    tree = tree.filter((F.col("l") == top) | (F.col("_parent_n") > leaf))
    tree = cut_lineage(tree.withColumn("is_leaf", (F.col("n") <= leaf) | (F.col("l") == FINEST)).drop("_parent_n"))
    depth = tree.agg(F.max("l")).first()[0]
    if depth is None:
        return points.withColumns({out_id: F.lit(None).cast(targets.schema[target_id].dataType), out_dist: F.lit(None).cast("double")})
    levels = [n for n in levels if n <= depth]
    asking = cut_lineage(_cells(spots, "_plat", "_plon", levels, "p_"))
    boxes = lambda x: [f"{x}_{n}" for n in ("lat1", "lat2", "lon1", "lon2")]
    nodes = tree.select(F.col("l").alias("tl"), F.col("i").alias("ti"), F.col("j").alias("tj"), "is_leaf", *boxes("t"))
    lower, upper = _box_gap("p_", "t_")

    def prune(pairs: DataFrame, per: list[str], lo: Column, hi: Column) -> DataFrame:
        cut = F.min("_hi").over(Window.partitionBy(*per))
        return pairs.withColumns({"_lo": lo, "_hi": hi}).withColumn("_cut", cut).filter(F.col("_lo") <= F.col("_cut") + SLACK_M).drop("_lo", "_hi", "_cut")

    roots = [(i, j) for i in {i1 >> FINEST - top, i2 >> FINEST - top} for j in {j1 >> FINEST - top, j2 >> FINEST - top}]
    first = F.array(*[F.struct(F.lit(i).cast("bigint").alias("ti"), F.lit(j).cast("bigint").alias("tj")) for i, j in roots])
    at_level = lambda n: asking.filter(F.col("l") == n).select(F.col("i").alias("pi"), F.col("j").alias("pj"), *boxes("p"))
    held = at_level(top).select("*", F.inline(first)).join(nodes.filter(F.col("tl") == top), ["ti", "tj"])
    held = prune(held, ["pi", "pj"], lower, upper)
    for n in levels[1:]:
        below = at_level(n).withColumns({"_ui": up("pi"), "_uj": up("pj")})
        held = held.drop(*boxes("p")).withColumnsRenamed({"pi": "_ui", "pj": "_uj"}).join(below, ["_ui", "_uj"]).drop("_ui", "_uj")
        parts = nodes.filter(F.col("tl") == n).select(
            F.col("tl").alias("_l"), up("ti").alias("_ui"), up("tj").alias("_uj"), *[F.col(c).alias(f"_{c}") for c in ("ti", "tj", "is_leaf", *boxes("t"))]
        )
        # a leaf has no parts and stays itself
        split = (F.col("ti") == F.col("_ui")) & (F.col("tj") == F.col("_uj")) & ~F.col("is_leaf")
        held = held.join(parts, split, "left")
        held = held.withColumns({c: F.coalesce(f"_{c}", c) for c in ("ti", "tj", "is_leaf", *boxes("t"))} | {"tl": F.coalesce("_l", "tl")})
        held = prune(held.select("pi", "pj", *boxes("p"), "tl", "ti", "tj", "is_leaf", *boxes("t")), ["pi", "pj"], lower, upper)
    held = cut_lineage(held.select("pi", "pj", "tl", "ti", "tj", *boxes("t")))
    low = FINEST - levels[-1]
    asked = spots.select("_plat", "_plon", F.shiftright("_i", low).alias("pi"), F.shiftright("_j", low).alias("pj")).join(held, ["pi", "pj"])
    asked = asked.withColumns({"p_lat1": F.col("_plat"), "p_lat2": F.col("_plat"), "p_lon1": F.col("_plon"), "p_lon2": F.col("_plon")})
    asked = prune(asked, ["_plat", "_plon"], lower, upper).select("_plat", "_plon", "tl", "ti", "tj")
    each = F.array(*[F.struct(F.lit(n).alias("tl"), F.shiftright("_i", FINEST - n).alias("ti"), F.shiftright("_j", FINEST - n).alias("tj")) for n in levels])
    leaves = nodes.filter("is_leaf").select("tl", "ti", "tj")
    in_leaf = known.select("lat", "lon", "_tid", F.inline(each)).join(leaves, ["tl", "ti", "tj"])
    dist = haversine_m("_plat", "_plon", "lat", "lon")
    best = (
        asked.join(in_leaf, ["tl", "ti", "tj"])
        .withColumn("_d", dist)
        .groupBy("_plat", "_plon")
        .agg(F.min_by(F.struct("_tid", "_d"), F.struct(F.round("_d", 3), "_tid")).alias("_best"))
    )
    joined = points.join(best, (F.col("lat") == F.col("_plat")) & (F.col("lon") == F.col("_plon")), "left")
    return joined.select(*points.columns, F.col("_best._tid").alias(out_id), F.col("_best._d").alias(out_dist))


def incident_links(incidents: DataFrame, roads: DataFrame) -> DataFrame:
    """Nearest road link of each incident, by link midpoint."""
    mids = road_mid(roads).select("link_id", F.col("mid_lat").alias("lat"), F.col("mid_lon").alias("lon"))
    return nearest_join(incidents, mids, "link_id", "nearest_link_id", "dist_to_road_m")


def link_stations(roads: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest rain station of each link."""
    mids = road_mid(roads).select("link_id", F.col("mid_lat").alias("lat"), F.col("mid_lon").alias("lon"))
    return nearest_join(mids, stations, "station_id", "nearest_station_id", "_m").select("link_id", "nearest_station_id")


def exact_quantiles(df: DataFrame, col: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles of distances in metres, with linear interpolation, as one row.

    Equal values are counted first.  Ranks come from running counts over kilometres, then millimetres
    within a kilometre, then values within a millimetre, so no task sees more than one such slice.
    """
    values = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    values = values.withColumns({"_km": F.floor(F.col("_v") / 1000), "_mm": F.floor(F.col("_v") * 1000)})
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    running = lambda name, w: F.coalesce(F.sum(name).over(w), F.lit(0))
    km = values.groupBy("_km").agg(F.sum("_c").alias("_n"))
    # No distance on the globe is over 20,038 km, hence at most that many rows in this one ordered pass.
    km = km.withColumn("_b1", running("_n", before().orderBy("_km"))).drop("_n")
    mm = values.groupBy("_km", "_mm").agg(F.sum("_c").alias("_n"))
    mm = mm.withColumn("_b2", running("_n", before("_km").orderBy("_mm"))).drop("_n")
    ranked = values.join(mm, ["_km", "_mm"]).join(km, "_km")
    ranked = ranked.withColumn("_b3", running("_c", before("_km", "_mm").orderBy("_v")))
    first = F.col("_b1") + F.col("_b2") + F.col("_b3")
    total = values.agg(F.sum("_c").alias("_total"))
    ranked = ranked.select("_v", first.alias("_first"), (first + F.col("_c") - 1).alias("_last"))
    ranked = ranked.withColumn("_total", total.scalar())
    picks = []
    for name, q in quantiles.items():
        rank = F.lit(q) * (F.col("_total") - 1)
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            picks.append(F.max(F.when((F.col("_first") <= at) & (at <= F.col("_last")), F.col("_v"))).alias(f"{name}_{side}"))
        picks.append(F.max(rank - F.floor(rank)).alias(f"{name}_part"))
    row = ranked.agg(*picks)
    return row.select(
        *[(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_part")).alias(n) for n in quantiles]
    )


def distance_summary(df: DataFrame, col: str = "dist_to_road_m", limits: Sequence[int] = (200, 500)) -> DataFrame:
    d = F.col(col)
    df = cut_lineage(df.select(col))  # read several times below
    moments = df.agg(
        F.count(d).alias("n"),
        F.avg(d).alias("mean"),
        F.stddev_samp(d).alias("std"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
        *[F.count_if(d > limit).alias(f"over_{limit}m") for limit in limits],
    )
    quantiles = exact_quantiles(df, col, {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    moments = moments.withColumn("_q", quantiles.select(F.struct("*")).scalar())
    return moments.select("*", "_q.*").drop("_q")
