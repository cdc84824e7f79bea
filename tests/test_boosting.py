import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roadcast.operators import boosting as bo
from roadcast.operators import models as md


def loss(df, label, k):
    """Mean log loss of the probabilities in ``_probabilities``."""
    p = F.greatest(F.element_at("_probabilities", F.col(label) + 1), F.lit(1e-9))
    return df.agg(F.avg(-F.log(p))).first()[0]


def three_classes(spark, n, seed):
    rng = np.random.default_rng(seed)
    x, y, z = rng.normal(size=n), rng.normal(size=n), rng.integers(0, 5, n)
    kind = np.where(x * y > 0.2, 0, np.where(z > 2, 1, 2))
    kind = np.where(rng.random(n) < 0.05, rng.integers(0, 3, n), kind)
    return spark.createDataFrame([(float(a), float(b), int(c), int(k)) for a, b, c, k in zip(x, y, z, kind)], "x DOUBLE, y DOUBLE, z INT, kind INT")


def test_loss_falls_every_round_and_beats_a_forest(spark):
    train, held_out = three_classes(spark, 3000, 1), three_classes(spark, 2000, 2)
    model = bo.fit_forest(train, ["x", "y", "z"], "kind", 3, 20, 4, 0.3, 1.0, 1.0)
    losses = []
    for n in range(0, 21, 4):
        part = bo.Forest(model.features, model.edges, 3, model.depth, *[t[:n] for t in model._tables()])
        losses.append(loss(bo.predict_forest(part, train), "kind", 3))
    assert abs(losses[0] - np.log(3)) < 1e-6 and all(b < a for a, b in zip(losses, losses[1:]))
    assembler = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features")
    forest = RandomForestClassifier(labelCol="kind", numTrees=20, maxDepth=4, seed=1).fit(assembler.transform(train))
    other = forest.transform(assembler.transform(held_out)).withColumn("_probabilities", vector_to_array("probability"))
    assert loss(bo.predict_forest(model, held_out), "kind", 3) < loss(other, "kind", 3)


def test_missing_values_tell_the_label(spark):
    """The value says nothing; whether there is one says all.  Missing values go the way the training rows show."""
    rows = [(float(n % 7) if n % 3 else None, n % 5, int(n % 3 == 0)) for n in range(900)]
    frame = spark.createDataFrame(rows, "rain DOUBLE, other INT, label INT")
    for flip in (False, True):
        data = frame.withColumn("label", 1 - F.col("label")) if flip else frame
        model = bo.fit_forest(data, ["rain", "other"], "label", 2, 3, 2, 0.5, 1.0, 1.0)
        wrong = bo.predict_forest(model, data).filter("_class <> label").count()
        assert wrong == 0 and {f for f in model.feature[:, :, 0].ravel().tolist()} == {0}
    nan = spark.createDataFrame([(float("nan"), 1), (None, 1)], "rain DOUBLE, other INT")
    assert [r._class for r in bo.predict_forest(model, nan).collect()] == [0, 0]


def slow_cut(values, g, h, least_child):
    """Best gain by trying each cut and both sides for missing values (None)."""
    score = lambda a, b: a * a / (b + 1)
    best = 0.0
    for cut in sorted({v for v in values if v is not None}):
        for missing_left in (True, False):
            left = [missing_left if v is None else v <= cut for v in values]
            gl, hl = sum(a for a, s in zip(g, left) if s), sum(b for b, s in zip(h, left) if s)
            gr, hr = sum(g) - gl, sum(h) - hl
            if hl >= least_child and hr >= least_child:
                best = max(best, score(gl, hl) + score(gr, hr) - score(sum(g), sum(h)))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_best_cut_against_all_cuts(seed):
    rng = np.random.default_rng(seed)
    values = [None if rng.random() < 0.2 else int(rng.integers(0, 6)) for _ in range(60)]
    g, h = rng.normal(size=60), rng.random(60)
    sums = np.zeros((1, bo.BINS, 2))
    for v, a, b in zip(values, g, h):
        sums[0, bo.MISSING if v is None else v] += (a, b)
    f, cut, missing_left, *_ = bo.best_cut(sums, 1.0)
    left = np.array([missing_left if v is None else v <= cut for v in values])
    score = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    gain = score(left) + score(~left) - score(np.ones(60, bool))
    assert f == 0 and abs(gain - slow_cut(values, g, h, 1.0)) < 1e-9


def test_weights_and_empty_table(spark):
    frame = spark.createDataFrame([(1.0, 0, 1.0)] * 10 + [(1.0, 1, 9.0)] * 4, "x DOUBLE, label INT, w DOUBLE")
    model = bo.fit_forest(frame, ["x"], "label", 2, 10, 2, 0.3, 1.0, 1.0, weight="w")
    assert bo.predict_forest(model, frame).first()["_class"] == 1
    empty = bo.fit_forest(frame.filter("FALSE"), ["x"], "label", 3, 2, 2, 0.3, 1.0, 1.0)
    assert bo.predict_forest(empty, frame).select("_class").distinct().collect()[0][0] == 0
    assert bo.predict_forest(model, frame.filter("FALSE")).collect() == []


def test_change_model(spark):
    values = lambda n: tuple(float((n * (k + 3)) % 11) for k in range(len(md.CHANGE_FEATURES)))
    data = [(*values(n)[:11], None if n % 9 == 0 else values(n)[11], *values(n)[12:], n % 2) for n in range(120)]
    schema = ", ".join(f"{c} DOUBLE" for c in md.CHANGE_FEATURES) + ", change INT"
    frame = md.row_weights(spark.createDataFrame(data, schema), 5.0)
    assert {r.w for r in frame.select("w").distinct().collect()} <= {1.0, 5.0}
    out = md.predict_change(md.fit_change_model(frame, rounds=2, depth=3), frame)
    assert out.count() == 120 and out.filter("(prob >= 0.25) <> (pred = 1)").count() == 0
