"""Band and band-change models on boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.functions.columns import dow_of, hour_of
from roadcast.operators.boosting import Forest, cut_counts, fit_forest, load_forest, predict_forest, save_forest
from roadcast.operators.features import road_mid

# Feature lists, fixed values.
BAND_FEATURES = {
    "noroads": ["sb", "sb_tm5", "sb_tm10", "sb_tm15"],
    "roads": ["sb", "sb_tm5", "sb_tm10", "sb_tm15", "road_category", "dow_sg", "hour_sg", "mid_lat", "mid_lon"],
    "incidents": ["sb", "sb_tm5", "sb_tm10", "sb_tm15", "road_category", "mid_lat", "mid_lon", "has_incident"],
    "incident_types": [
        "sb", "sb_tm5", "sb_tm10", "sb_tm15", "road_category", "mid_lat", "mid_lon", "has_incident", "inc_type_code",
    ],
}
CHANGE_FEATURES = [
    "sb", "sb_tm5", "sb_tm10", "sb_tm15", "delta_0_5", "delta_5_10", "delta_10_15", "mid_lat", "mid_lon",
    "acceleration", "link_dist_proxy", "rain_mm", "is_raining", "road_category", "is_weekend", "is_peak",
    "incident_nearby", "mins_since_nearby_start", "nearby_accident", "nearby_roadwork", "nearby_breakdown",
]
CHANGE_CUT = 0.25
N_BANDS = 8
# Learning settings, fixed values.
BAND_ROUNDS, BAND_DEPTH, BAND_RATE, BAND_SUBSAMPLE, BAND_SHARE = 300, 6, 0.1, 0.8, 0.8
CHANGE_ROUNDS, CHANGE_DEPTH, CHANGE_RATE, CHANGE_SUBSAMPLE, CHANGE_SHARE, CHANGE_LEAST_CHILD = 465, 8, 0.08, 0.84, 0.64, 6.0


def fit_band_model(
    train: DataFrame, features: Sequence[str], label: str = "label", rounds: int = BAND_ROUNDS, depth: int = BAND_DEPTH, seed: int = 42
) -> Forest:
    """Eight-class model of the next band, one tree per class and round; ``label`` is band - 1."""
    return fit_forest(train, features, label, N_BANDS, rounds, depth, BAND_RATE, BAND_SUBSAMPLE, BAND_SHARE, seed=seed)


def predict_band(model: Forest, df: DataFrame, out: str = "prediction") -> DataFrame:
    scored = predict_forest(model, df)
    return scored.select(*df.columns, (F.col("_class") + 1).cast("int").alias(out))


def row_weights(df: DataFrame, factor: float = 1.0, flag: str = "incident_nearby", out: str = "w") -> DataFrame:
    return df.withColumn(out, F.when(F.col(flag) == 1, F.lit(float(factor))).otherwise(F.lit(1.0)))


def fit_change_model(
    train: DataFrame,
    features: Sequence[str] = CHANGE_FEATURES,
    label: str = "change",
    weight: str = "w",
    rounds: int = CHANGE_ROUNDS,
    depth: int = CHANGE_DEPTH,
    seed: int = 42,
) -> Forest:
    """Two-class model: does the band change.  Missing values (rain) go to the side that each cut learns for them."""
    return fit_forest(train, features, label, 2, rounds, depth, CHANGE_RATE, CHANGE_SUBSAMPLE, CHANGE_SHARE, CHANGE_LEAST_CHILD, weight, seed)


def predict_change(model: Forest, df: DataFrame, cut: float = CHANGE_CUT) -> DataFrame:
    """Add ``prob`` and ``pred`` = 1 from ``cut`` on."""
    scored = predict_forest(model, df).withColumn("prob", F.col("_probabilities")[1])
    return scored.select(*df.columns, "prob", (F.col("prob") >= cut).cast("int").alias("pred"))


def score_links(model: Forest, lags: DataFrame, roads: DataFrame, now_ts: int, shift_s: int = 28800) -> DataFrame:
    """(link_id, prediction_tp15) from the current lag columns; NULL for links without a road category."""
    mids = road_mid(roads).select("link_id", "road_category", "mid_lat", "mid_lon")
    rows = lags.join(mids, "link_id", "left")
    now = F.lit(now_ts).cast("bigint")
    rows = rows.withColumns({"hour_sg": hour_of(now, shift_s), "dow_sg": dow_of(now, shift_s)})
    scored = predict_band(model, rows, "_pred")
    known = F.col("road_category").isNotNull() & F.col("mid_lat").isNotNull()
    return scored.select("link_id", F.when(known, F.col("_pred")).alias("prediction_tp15"))


def save_model(spark: SparkSession, model: Forest, path: str) -> None:
    save_forest(spark, model, path)


def load_model(spark: SparkSession, path: str) -> Forest:
    return load_forest(spark, path)


def importance(spark: SparkSession, model: Forest, n: int = 15) -> DataFrame:
    """The ``n`` features that most cuts are on.  There is one value per feature, held by the model."""
    rows = sorted(cut_counts(model), key=lambda r: (-r[1], r[0]))[:n]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
