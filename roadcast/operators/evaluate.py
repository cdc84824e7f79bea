"""Scores of predictions.  Every score is a ratio of sums, so partial aggregates are all that moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50)


def _share(hit: Column, of: Column | None = None) -> Column:
    value = hit.cast("double")
    return F.avg(value if of is None else F.when(of, value))


def class_metrics(
    df: DataFrame, y: str = "y_tp15", pred: str = "prediction", base: str = "sb", group: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, mean absolute error, share within one band, for the prediction and for the persistence baseline.

    The ``change`` columns look at rows with base != y only and are NULL when there are none.
    """
    t, p, b = F.col(y), F.col(pred), F.col(base)
    moved = b != t
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        _share(p == t).alias("acc"),
        F.avg(F.abs(p - t)).alias("mae"),
        _share(F.abs(p - t) <= 1).alias("within1"),
        _share(b == t).alias("base_acc"),
        F.avg(F.abs(b - t)).alias("base_mae"),
        _share(F.abs(b - t) <= 1).alias("base_within1"),
        F.count_if(moved).alias("change_rows"),
        _share(p == t, moved).alias("change_acc"),
        _share(b == t, moved).alias("base_change_acc"),
    )


def subset_accuracy(df: DataFrame, flag: str, y: str = "y_tp15", pred: str = "prediction", base: str = "sb") -> DataFrame:
    """Rows with ``flag`` = 1: how many, and the accuracy of prediction and baseline on them."""
    return df.filter(F.col(flag) == 1).agg(
        F.count(F.lit(1)).alias("n"),
        _share(F.col(pred) == F.col(y)).alias("acc"),
        _share(F.col(base) == F.col(y)).alias("base_acc"),
    )


def _scores(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    def ratio(num, den):
        return F.when(den == 0, F.lit(0.0)).otherwise(num / den)

    return [
        ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def binary_metrics(df: DataFrame, y: str, pred: Column, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 prediction; a division by zero counts as 0."""
    t, p = F.col(y) == 1, pred == 1
    counts = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )
    return counts.select(*group, "n", *_scores(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def threshold_sweep(df: DataFrame, y: str, prob: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Precision, recall and F1 at each threshold, from one pass over the rows."""
    t = F.col(y) == 1
    counts = []
    for n, cut in enumerate(thresholds):
        hit = F.col(prob) >= F.lit(cut)
        counts += [F.count_if(t & hit).alias(f"tp{n}"), F.count_if(~t & hit).alias(f"fp{n}"), F.count_if(t & ~hit).alias(f"fn{n}")]
    one = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(F.lit(float(cut)).alias("threshold"), *[F.col(f"{c}{n}").alias(c) for c in ("tp", "fp", "fn")])
            for n, cut in enumerate(thresholds)
        ]
    )
    sweep = one.select(F.inline(rows))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    _, precision, recall, f1 = _scores(tp, fp, fn, F.lit(0))
    return sweep.select("threshold", precision, recall, f1)


def change_summary(df: DataFrame, y: str, pred: Column) -> DataFrame:
    """Change rate, number of change rows, and the share of them that was foreseen."""
    t = F.col(y) == 1
    return df.agg(
        F.avg(F.col(y)).alias("change_rate"),
        F.count_if(t).alias("change_rows"),
        _share(pred == 1, t).alias("hit_rate"),
    )


def flag_rate(df: DataFrame, flag: str, group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(F.col(flag)).alias("rate"), F.count_if(F.col(flag) == 1).alias("rows"))
