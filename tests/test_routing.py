import heapq
import random

from conftest import rows

from roadcast.operators.routing import alternative_paths, landmark_vectors, path_points, snap_to_nodes


def least(edges, src, dst, worn):
    best, todo = {src: 0.0}, [(0.0, src)]
    while todo:
        d, at = heapq.heappop(todo)
        if at == dst:
            return d
        for (a, b), length in edges.items():
            if a == at and d + length * 1.5 ** worn.get((a, b), 0) < best.get(b, 1e18):
                best[b] = d + length * 1.5 ** worn.get((a, b), 0)
                heapq.heappush(todo, (best[b], b))
    return None


def test_paths_are_least_under_their_penalties(spark):
    rng = random.Random(4)
    raw = [(a, b, float(rng.randrange(10, 90))) for a in range(12) for b in rng.sample(range(12), 3) if a != b]
    raw += [(a, b, length + 5) for a, b, length in raw[:6]] + [(50, 51, 1.0)]
    edges = {}
    for a, b, length in raw:
        edges[a, b] = min(length, edges.get((a, b), 1e18))
    trips = [(0, 0, 7), (1, 3, 9), (2, 4, 4), (3, 0, 51), (4, 0, 777)]
    out = alternative_paths(
        spark.createDataFrame(trips, "od_id BIGINT, src BIGINT, dst BIGINT"),
        spark.createDataFrame(raw, "src BIGINT, dst BIGINT, length DOUBLE"), k=2,
    ).collect()
    for od, src, dst in trips:
        worn = {}
        for alt in range(2):
            nodes = [r.node for r in sorted((r for r in out if (r.od_id, r.alt) == (od, alt)), key=lambda r: r.hop)]
            want = least(edges, src, dst, worn)
            if want is None:
                assert nodes == []
                continue
            assert nodes[0] == src and nodes[-1] == dst
            steps = list(zip(nodes, nodes[1:]))
            assert abs(sum(edges[s] * 1.5 ** worn.get(s, 0) for s in steps) - want) < 1e-9
            for s in steps:
                worn[s] = worn.get(s, 0) + 1


def test_snap_and_points(spark):
    nodes = spark.createDataFrame([(1, 1.3, 103.8), (2, 1.4, 103.8)], "node BIGINT, lat DOUBLE, lon DOUBLE")
    trips = spark.createDataFrame([(7, 1.31, 103.8, 1.39, 103.8)], "od_id BIGINT, from_lat DOUBLE, from_lon DOUBLE, to_lat DOUBLE, to_lon DOUBLE")
    assert rows(snap_to_nodes(trips, nodes)) == [(7, 1, 2)]
    paths = spark.createDataFrame([(7, 0, 0, 1), (7, 0, 1, 2)], "od_id BIGINT, alt INT, hop BIGINT, node BIGINT")
    assert rows(path_points(paths, nodes)) == [("7-0", 0, 1.3, 103.8), ("7-0", 1, 1.4, 103.8)]


def test_landmark_distances(spark):
    rng = random.Random(5)
    raw = [(a, b, float(rng.randrange(10, 90))) for a in range(9) for b in rng.sample(range(9), 2) if a < b] + [(20, 21, 5.0)]
    edges = {}
    for a, b, length in raw:
        edges[a, b] = min(length, edges.get((a, b), 1e18))
    found = landmark_vectors(spark.createDataFrame(raw, "src BIGINT, dst BIGINT, length DOUBLE"), 3).collect()
    marks = [next(r.node for r in found if r.far[2 * at] == 0) for at in range(3)]
    for r in found:
        for at, mark in enumerate(marks):
            out, back = least(edges, mark, r.node, {}), least(edges, r.node, mark, {})
            assert r.far[2 * at] == (float("-inf") if out is None else -out)
            assert r.far[2 * at + 1] == (float("inf") if back is None else back)
