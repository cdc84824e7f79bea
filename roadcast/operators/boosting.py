"""Boosted trees for several classes or two, grown from histograms that Spark sums.

Each round grows one tree per class (one for two classes) on the gradients of the rounds before it.  A level of all these trees is one pass over
the rows: tasks add up gradients by node, feature and bin, and a shuffle by node brings the sums together, where the best cut is found.  What meets in one place is a
node's histogram, of a size that does not depend on the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from roadcast.session import cut_lineage

BINS = 64  # values of a feature are told apart by this many bins, the last one for missing values
MISSING = BINS - 1
L2 = 1.0
LEAST_GAIN = 1e-6
CUT_ROUNDS = 5  # margins are written after so many rounds; until then passes add the newest trees themselves
_ROWS = "id BIGINT, bins BINARY, label INT, w DOUBLE, margins BINARY"


@dataclass
class Forest:
    """Trees in heap order: node n has the children 2n + 1 (left) and 2n + 2.  Arrays are by (round, class, node); feature -1 is a leaf."""

    features: list[str]
    edges: list[list[float]]
    n_classes: int
    depth: int
    feature: np.ndarray = field(default=None)
    cut: np.ndarray = field(default=None)
    missing_left: np.ndarray = field(default=None)
    value: np.ndarray = field(default=None)

    @property
    def outputs(self) -> int:
        return 1 if self.n_classes == 2 else self.n_classes

    def blank(self, rounds: int) -> None:
        shape = (rounds, self.outputs, 2 ** (self.depth + 1) - 1)
        self.feature, self.cut = np.full(shape, -1, np.int16), np.zeros(shape, np.uint8)
        self.missing_left, self.value = np.zeros(shape, bool), np.zeros(shape)

    def _tables(self):
        return self.feature, self.cut, self.missing_left, self.value


def _bin(columns: list[np.ndarray], edges: list[list[float]]) -> np.ndarray:
    """Bins of a row: how many edges are at most the value."""
    out = np.empty((len(columns[0]), len(columns)), np.uint8)
    for n, (values, cuts) in enumerate(zip(columns, edges)):
        out[:, n] = np.where(np.isnan(values), MISSING, np.searchsorted(cuts, values, "right"))
    return out


def _descend(bins: np.ndarray, tree: tuple, levels: int) -> np.ndarray:
    """Node of each row after ``levels`` steps."""
    feature, cut, missing_left, _ = tree
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        asked = feature[node]
        held = bins[rows, np.maximum(asked, 0)]
        left = np.where(held == MISSING, missing_left[node], held <= cut[node])
        node = np.where(asked < 0, node, 2 * node + 2 - left)
    return node


def _add_trees(margins: np.ndarray, bins: np.ndarray, rounds: list[tuple], depth: int) -> np.ndarray:
    for tables in rounds:
        for k in range(margins.shape[1]):
            tree = tuple(t[k] for t in tables)
            margins[:, k] += tree[3][_descend(bins, tree, depth)]
    return margins


def _gradients(margins: np.ndarray, label: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if margins.shape[1] == 1:
        p = 1 / (1 + np.exp(-margins))
        return (p - label[:, None]) * w[:, None], p * (1 - p) * w[:, None]
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    g = p.copy()
    g[np.arange(len(p)), label] -= 1
    return g * w[:, None], np.maximum(2 * p * (1 - p), 1e-16) * w[:, None]


def _coin(ids: np.ndarray, turn: int) -> np.ndarray:
    """A repeatable number in [0, 1) per row and round."""
    code = (ids.astype(np.uint64) + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (code >> np.uint64(11)).astype(np.float64) / 2.0**53


def _rows_of(batch: pa.RecordBatch, n_features: int, outputs: int):
    column = lambda name, kind, width: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(-1, width)
    return column("bins", np.uint8, n_features), column("margins", np.float64, outputs).copy()


_SUMS = "part INT, tree INT, node INT, sums BINARY"


def _histograms(n_features: int, outputs: int, depth: int, newest: list[tuple], growing: tuple, level: int, columns: list[np.ndarray], turn: int, subsample: float):
    """A task's sums of gradients and curvatures by tree, node, feature and bin."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        width = 2**level
        sums = np.zeros((outputs, width, n_features, BINS, 2))
        for batch in batches:
            bins, margins = _rows_of(batch, n_features, outputs)
            g, h = _gradients(_add_trees(margins, bins, newest, depth), batch.column("label").to_numpy(), batch.column("w").to_numpy())
            taken = _coin(batch.column("id").to_numpy(), turn) < subsample
            for k in range(outputs):
                tree = tuple(t[k] for t in growing)
                node = _descend(bins, tree, level) - (width - 1)
                use = taken & (node >= 0)
                at, gk, hk = node[use] * BINS, g[use, k], h[use, k]
                for f in columns[k]:
                    cell = at + bins[use, f]
                    sums[k, :, f, :, 0] += np.bincount(cell, gk, width * BINS).reshape(width, BINS)
                    sums[k, :, f, :, 1] += np.bincount(cell, hk, width * BINS).reshape(width, BINS)
        found = [(k, n) for k in range(outputs) for n in range(width) if sums[k, n, :, :, 1].any()]
        part = TaskContext.get().partitionId()
        arrays = [[part] * len(found), [k for k, _ in found], [n for _, n in found], [sums[k, n].tobytes() for k, n in found]]
        yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["part", "tree", "node", "sums"])

    return run


_CUTS = "tree INT, node INT, feature INT, cut INT, missing_left BOOLEAN, value DOUBLE, left_value DOUBLE, right_value DOUBLE"


def best_cut(sums: np.ndarray, least_child: float) -> tuple[int, int, bool, float, float, float]:
    """(feature, cut, missing values go left, sum, left sum, right sum) of a node's histogram (feature, bin, 2); sums as leaf values.

    Bins up to ``cut`` go left.  Rows without the feature's value are tried on both sides.  Feature -1 where no cut gains anything.
    """
    used = np.flatnonzero(sums[:, :, 1].any(axis=1))
    total = sums[used[0]].sum(axis=0)
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + L2)
    leaf = lambda s: float(-s[0] / (s[1] + L2))
    before = np.cumsum(sums[used, : MISSING - 1], axis=1)
    lefts = np.stack([before + sums[used][:, MISSING : MISSING + 1], before], axis=2)  # (feature, cut, missing left first, 2)
    rights = total - lefts
    gain = score(lefts) + score(rights) - score(total)
    gain[(lefts[..., 1] < least_child) | (rights[..., 1] < least_child)] = -np.inf
    f, cut, side = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[f, cut, side] > LEAST_GAIN:
        return -1, 0, False, leaf(total), 0.0, 0.0
    return int(used[f]), int(cut), side == 0, leaf(total), leaf(lefts[f, cut, side]), leaf(rights[f, cut, side])


def _best_cuts(n_features: int, least_child: float):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["part"].to_numpy(), kind="stable")  # the same sum in any order of arrival
        parts = table["sums"].to_pylist()
        sums = sum(np.frombuffer(parts[n]).reshape(n_features, BINS, 2) for n in order.tolist())
        row = (table["tree"][0].as_py(), table["node"][0].as_py(), *best_cut(sums, least_child))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.float64())
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names=[c.split()[0] for c in _CUTS.split(", ")])

    return run


def _prepare(edges: list[list[float]], outputs: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[: len(edges)]]
            n = batch.num_rows
            bins = _bin(columns, edges)
            arrays = [np.arange(made, made + n), [b.tobytes() for b in bins], batch.column("label"), batch.column("w"), [bytes(8 * outputs)] * n]
            made += n
            yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=["id", "bins", "label", "w", "margins"])

    return run


def _advance(n_features: int, outputs: int, depth: int, newest: list[tuple]):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margins = _rows_of(batch, n_features, outputs)
            margins = _add_trees(margins, bins, newest, depth)
            yield batch.set_column(4, "margins", pa.array([m.tobytes() for m in margins], pa.binary()))

    return run


def fit_forest(
    train: DataFrame, features: Sequence[str], label: str, n_classes: int, rounds: int, depth: int, rate: float, subsample: float, share: float,
    least_child: float = 1.0, weight: str | None = None, seed: int = 42,
) -> Forest:
    """Boosted trees of ``depth`` levels; ``label`` counts classes from 0.

    Each round takes ``subsample`` of the rows and each tree ``share`` of the features.  A cut needs ``least_child`` of curvature on both sides.  NULL and NaN
    are missing values: every cut sends them to the side that fits better.  Rows without a label are left out.  An empty table gives a forest of
    empty trees, which predicts class 0.
    """
    rng = np.random.default_rng(seed)
    names = [f"_x{n}" for n in range(len(features))]
    rows = train.select(
        *[F.col(c).cast("double").alias(x) for c, x in zip(features, names)], F.col(label).cast("int").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
    ).filter("label IS NOT NULL")
    quantiles = rows.approxQuantile(names, [n / (BINS - 2) for n in range(1, BINS - 1)], 0.001)
    edges = [sorted(set(q))[: BINS - 2] for q in quantiles]
    forest = Forest(list(features), edges, n_classes, depth)
    forest.blank(rounds)
    outputs, n_features = forest.outputs, len(features)
    table = cut_lineage(rows.mapInArrow(_prepare(edges, outputs), _ROWS))
    written = 0
    for turn in range(rounds):
        columns = [np.sort(rng.choice(n_features, max(1, round(share * n_features)), replace=False)) for _ in range(outputs)]
        newest = [tuple(t[r] for t in forest._tables()) for r in range(written, turn)]
        growing = tuple(t[turn] for t in forest._tables())  # views: cuts are entered below
        for level in range(depth):
            held = tuple(t.copy() for t in growing)
            sums = table.mapInArrow(_histograms(n_features, outputs, depth, newest, held, level, columns, turn, subsample), _SUMS)
            cuts = sums.groupBy("tree", "node").applyInArrow(_best_cuts(n_features, least_child), _CUTS).collect()
            for c in cuts:
                node = c.node + 2**level - 1
                growing[3][c.tree, node] = rate * c.value
                if c.feature >= 0:
                    growing[0][c.tree, node], growing[1][c.tree, node], growing[2][c.tree, node] = c.feature, c.cut, c.missing_left
                    growing[3][c.tree, 2 * node + 1], growing[3][c.tree, 2 * node + 2] = rate * c.left_value, rate * c.right_value
            if all(c.feature < 0 for c in cuts):
                break
        if turn + 1 - written == CUT_ROUNDS and turn + 1 < rounds:
            newest = [tuple(t[r] for t in forest._tables()) for r in range(written, turn + 1)]
            table, written = cut_lineage(table.mapInArrow(_advance(n_features, outputs, depth, newest), _ROWS)), turn + 1
    return forest


def predict_forest(forest: Forest, df: DataFrame, classes: str = "_class", probabilities: str = "_probabilities") -> DataFrame:
    """Add the most likely class (the lower one of equals) and the probability of each."""
    names = [f"_x{n}" for n in range(len(forest.features))]
    asked = df.select(*df.columns, *[F.col(c).cast("double").alias(x) for c, x in zip(forest.features, names)])
    schema = StructType([*df.schema.fields, StructField(classes, IntegerType()), StructField(probabilities, ArrayType(DoubleType()))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        rounds = [tuple(t[r] for t in forest._tables()) for r in range(len(forest.feature))]
        for batch in batches:
            kept = batch.columns[: -len(names)]
            values = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[-len(names) :]]
            margins = _add_trees(np.zeros((batch.num_rows, forest.outputs)), _bin(values, forest.edges), rounds, forest.depth)
            if forest.outputs == 1:
                p = 1 / (1 + np.exp(-margins[:, 0]))
                p = np.column_stack([1 - p, p])
            else:
                p = np.exp(margins - margins.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, forest.n_classes), pa.int32()), pa.array(p.ravel()))
            best = pa.array(p.argmax(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*kept, best, listed], names=[*batch.schema.names[: -len(names)], classes, probabilities])

    return asked.mapInArrow(run, schema)


def cut_counts(forest: Forest) -> list[tuple[str, float]]:
    """How many cuts of all trees are on each feature."""
    used = forest.feature[forest.feature >= 0]
    return list(zip(forest.features, np.bincount(used, minlength=len(forest.features)).astype(float).tolist()))


_SAVED = "facts STRING, name STRING, kind STRING, shape ARRAY<INT>, content BINARY"


def save_forest(spark: SparkSession, forest: Forest, path: str) -> None:
    """One row per array; a forest is as large as its trees, whatever it was fitted on."""
    facts = json.dumps({"features": forest.features, "edges": forest.edges, "n_classes": forest.n_classes, "depth": forest.depth})
    rows = [(facts, n, a.dtype.str, list(a.shape), a.tobytes()) for n, a in zip(("feature", "cut", "missing_left", "value"), forest._tables())]
    spark.createDataFrame(rows, _SAVED).coalesce(1).write.mode("overwrite").parquet(path)


def load_forest(spark: SparkSession, path: str) -> Forest:
    rows = spark.read.schema(_SAVED).parquet(path).collect()
    arrays = {r.name: np.frombuffer(bytes(r.content), r.kind).reshape(r.shape).copy() for r in rows}
    return Forest(**json.loads(rows[0].facts), **arrays)
