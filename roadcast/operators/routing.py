"""Least-length paths with alternatives for a table of trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.session import cut_and_count, cut_lineage

PENALTY = 1.5  # fixed value
MAX_ROUTES = 3  # fixed value
LANDMARKS = 16
FIRST_WIDTH = 32  # nodes of a trip that go on in the first round


def _least_edges(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.min("length").alias("length"))


def landmark_vectors(edges: DataFrame, n: int = LANDMARKS) -> DataFrame:
    """(node, far): per node its distances from ``n`` nodes picked by hash, negated, and to them, infinite where there is no way.

    All are relaxed at once, against the edges and against the reversed ones; a state has 2 n rows per node.
    """
    best = _least_edges(edges)
    ways = best.select(F.lit(0).alias("back"), F.col("src").alias("node"), F.col("dst").alias("_to"), "length").unionByName(
        best.select(F.lit(1).alias("back"), F.col("dst").alias("node"), F.col("src").alias("_to"), "length")
    )
    ways = cut_lineage(ways)
    picked = [row["node"] for row in ways.select("node").distinct().orderBy(F.xxhash64("node"), "node").limit(n).collect()]
    start = [F.struct(F.lit(at).alias("mark"), F.lit(back).alias("back"), F.lit(node).alias("node")) for at, node in enumerate(picked) for back in (0, 1)]
    reached = edges.sparkSession.range(1).select(F.inline(F.array(*start))) if picked else ways.select(F.lit(0).alias("mark"), "back", "node").limit(0)
    reached = cut_lineage(reached.select("mark", "back", "node", F.lit(0.0).alias("dist"), F.lit(True).alias("fresh")))
    open_rows = len(start)
    while open_rows:
        steps = reached.filter("fresh").join(ways, ["back", "node"])
        steps = steps.select("mark", "back", F.col("_to").alias("node"), (F.col("dist") + F.col("length")).alias("dist"), F.lit(True).alias("fresh"))
        merged = reached.withColumn("fresh", F.lit(False)).unionByName(steps)
        merged = merged.groupBy("mark", "back", "node").agg(F.min(F.struct("dist", "fresh")).alias("_s")).select("mark", "back", "node", "_s.*")
        reached, counts = cut_and_count(merged, fresh="fresh")
        open_rows = counts["fresh"]
    slots = [F.min(F.when((F.col("mark") == at) & (F.col("back") == back), F.col("dist"))) for at in range(len(picked)) for back in (0, 1)]
    ways_far = [F.coalesce(slot, F.lit(float("inf"))) * sign for slot, sign in zip(slots, [-1, 1] * len(picked))]
    return cut_lineage(reached.groupBy("node").agg(F.array(*ways_far).alias("far")))


def _at_least(far: Column, goal_far: Column) -> Column:
    """A lower bound of the way from a node to the goal, by the triangle inequality at each landmark; infinite where a landmark shows that there is none."""
    parts = F.zip_with(far, goal_far, lambda a, b: F.nanvl(a - b, F.lit(0.0)))
    return F.greatest(F.lit(0.0), F.coalesce(F.array_max(parts), F.lit(0.0)))


def shortest_paths(
    trips: DataFrame, edges: DataFrame, used: DataFrame | None = None, penalty: float = PENALTY, landmarks: DataFrame | None = None
) -> DataFrame:
    """(od_id, hop, node) along the least-length path of each trip (od_id, src, dst); trips without one are absent.

    Lengths are relaxed from all sources at once, one hop per round.  A node is dropped when its length and the least it can be from the goal, by the
    ``landmarks`` of :func:`landmark_vectors`, exceed the way to the goal known so far.  Until a trip has such a way only its most
    promising nodes go on, half as many again in each round; then all that are left do.  ``used`` (od_id, src,
    dst, times) makes edges of earlier paths ``penalty`` ** times as long.  Each round starts from files.
    """
    best = cut_lineage(_least_edges(edges))
    best = best.select(F.col("src").alias("node"), F.col("dst").alias("_to"), "length")
    if landmarks is None:
        landmarks = landmark_vectors(edges)
    # edges that get shorter with use may undercut the bounds
    bounded = used is None or penalty >= 1
    goals = trips.select("od_id", F.col("dst").alias("node")).join(landmarks, "node").select("od_id", F.col("far").alias("_goal_far")).dropDuplicates(["od_id"])
    goals = cut_lineage(goals)

    def bound(rows: DataFrame) -> DataFrame:
        rows = rows.join(goals, "od_id", "left").join(landmarks, "node", "left")
        low = _at_least(F.col("far"), F.col("_goal_far")) if bounded else F.lit(0.0)
        return rows.withColumn("low", low).drop("far", "_goal_far")

    def expand(front: DataFrame) -> DataFrame:
        """Rows (od_id, node, goal, dist, hops) carried over every edge that leaves their node."""
        steps = front.join(best, "node").select(
            "od_id", F.col("node").alias("prev"), F.col("_to").alias("node"), "goal", "dist", "hops", "length"
        )
        if used is not None:
            worn = used.select("od_id", F.col("src").alias("prev"), F.col("dst").alias("node"), "times")
            steps = steps.join(worn, ["od_id", "prev", "node"], "left")
            steps = steps.withColumn("length", F.col("length") * F.pow(F.lit(penalty), F.coalesce("times", F.lit(0))))
        return steps.select("od_id", "node", "goal", (F.col("dist") + F.col("length")).alias("dist"), (F.col("hops") + 1).alias("hops"), "prev")

    def within(rows: DataFrame, reached: DataFrame) -> DataFrame:
        """Rows that may lie on a path no longer than the one known, ``_limit``; the bounds are sums and may be off in their last digits."""
        limit = reached.filter("node = goal").groupBy("od_id").agg(F.min("dist").alias("_limit"))
        rows = rows.join(limit, "od_id", "left")
        return rows.filter((F.col("low") < float("inf")) & (F.col("_limit").isNull() | ((F.col("dist") + F.col("low")) <= F.col("_limit") * (1 + 1e-9))))

    names = ["od_id", "node", "goal", "dist", "hops", "fresh", "low"]
    reached = trips.select("od_id", F.col("src").alias("node"), F.col("dst").alias("goal"), F.lit(0.0).alias("dist"), F.lit(0).alias("hops"), F.lit(True).alias("fresh"))
    reached = cut_lineage(bound(reached).select(*names))
    width = FIRST_WIDTH
    while True:
        front = within(reached.filter("fresh AND node <> goal"), reached)
        promise = Window.partitionBy("od_id").orderBy(F.col("dist") + F.col("low"), "node")
        front = front.withColumn("_place", F.row_number().over(promise)).filter(F.col("_limit").isNotNull() | (F.col("_place") <= width))
        front, counts = cut_and_count(front.select(*names).withColumn("fresh", F.lit(False)), rows="true")
        if not counts["rows"]:
            break
        offers = expand(front).drop("prev").withColumn("fresh", F.lit(True))
        merged = reached.drop("low").unionByName(front.drop("low")).unionByName(offers).groupBy("od_id", "node").agg(
            F.first("goal").alias("goal"), F.min(F.struct("dist", "hops", "fresh")).alias("_s")
        )
        reached = cut_lineage(within(bound(merged.select("od_id", "node", "goal", "_s.*")), reached).select(*names))
        width = width * 3 // 2
    # Of equal lengths, a stop keeps the lowest node before it among those reached with the fewest hops or with an even number of them.
    reached = cut_lineage(within(reached, reached).select("od_id", "node", "goal", "dist", "hops"))
    held = reached.select("od_id", "node", F.col("dist").alias("_dist"), F.col("hops").alias("_hops"))
    before = expand(reached).join(held, ["od_id", "node"]).filter("dist = _dist AND _hops > 0 AND (hops = _hops OR hops % 2 = 1)")
    before = before.groupBy("od_id", "node").agg(F.min("prev").alias("prev"))
    return _walk_back(cut_lineage(reached.join(before, ["od_id", "node"], "left")))


def _walk_back(reached: DataFrame) -> DataFrame:
    """Follow ``prev`` from each destination to its source, twice as far in each round."""
    jump = reached.filter(F.col("prev").isNotNull()).select("od_id", "node", "prev")
    walked = cut_lineage(reached.filter("node = goal").select("od_id", "node", F.lit(0).cast("bigint").alias("back")))
    width = 1
    while True:
        jump = cut_lineage(jump)
        more = walked.join(jump, ["od_id", "node"]).select("od_id", F.col("prev").alias("node"), (F.col("back") + width).alias("back"))
        more, counts = cut_and_count(more, rows="true")
        if not counts["rows"]:
            break
        walked = walked.unionByName(more)
        far = jump.select("od_id", F.col("node").alias("prev"), F.col("prev").alias("_far"))
        jump = jump.join(far, ["od_id", "prev"]).select("od_id", "node", F.col("_far").alias("prev"))
        width *= 2
    hops = walked.groupBy("od_id").agg(F.max("back").alias("_hops"))
    return walked.join(hops, "od_id").select("od_id", (F.col("_hops") - F.col("back")).alias("hop"), "node")


def path_edges(paths: DataFrame) -> DataFrame:
    """(od_id, src, dst) of each step, by joining each stop with the next one."""
    after = paths.select("od_id", (F.col("hop") - 1).alias("hop"), F.col("node").alias("dst"))
    return paths.withColumnRenamed("node", "src").join(after, ["od_id", "hop"]).select("od_id", "src", "dst")


def path_lengths(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """(od_id, n_edges, length) of paths without penalties."""
    best = edges.groupBy("src", "dst").agg(F.min("length").alias("length"))
    steps = path_edges(paths).join(best, ["src", "dst"])
    return steps.groupBy("od_id").agg(F.count(F.lit(1)).alias("n_edges"), F.sum("length").alias("length"))


def alternative_paths(trips: DataFrame, edges: DataFrame, k: int = MAX_ROUTES, penalty: float = PENALTY) -> DataFrame:
    """(od_id, alt, hop, node): ``k`` paths per trip; each path makes its edges longer for the next ones."""
    used, out, landmarks = None, None, landmark_vectors(edges)
    for alt in range(max(1, k)):
        paths = cut_lineage(shortest_paths(trips, edges, used, penalty, landmarks))
        found = paths.withColumn("alt", F.lit(alt)).select("od_id", "alt", "hop", "node")
        out = found if out is None else out.unionByName(found)
        steps = path_edges(paths).withColumn("times", F.lit(1))
        used = steps if used is None else used.unionByName(steps)
        used = cut_lineage(used.groupBy("od_id", "src", "dst").agg(F.sum("times").alias("times")))
    return out


def snap_to_nodes(trips: DataFrame, nodes: DataFrame) -> DataFrame:
    """(od_id, src, dst) from trips with from/to coordinates; ``nodes`` has node, lat, lon."""
    from roadcast.operators.spatial import nearest_join

    start = trips.select("od_id", F.col("from_lat").alias("lat"), F.col("from_lon").alias("lon"))
    end = trips.select("od_id", F.col("to_lat").alias("lat"), F.col("to_lon").alias("lon"))
    src = nearest_join(start, nodes, "node", "src", "_m").select("od_id", "src")
    dst = nearest_join(end, nodes, "node", "dst", "_m").select("od_id", "dst")
    return src.join(dst, "od_id")


def path_points(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Paths as route points (route_id "od-alt"), ready for route matching."""
    route = F.concat_ws("-", F.col("od_id").cast("string"), F.col("alt").cast("string"))
    return paths.join(nodes, "node").select(route.alias("route_id"), F.col("hop").alias("seq"), "lat", "lon")
