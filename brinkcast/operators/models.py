"""Trained threshold models: boosted trees, isotonic calibration, scoring."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.functions.keys import feature_hash
from brinkcast.functions.scores import PROB_COLUMNS
from brinkcast.operators.baselines import chrono_holdout
from brinkcast.operators.isotonic import isotonic_blocks, with_isotonic
from brinkcast.operators.metrics import average_precision, brier_score
from brinkcast.operators.ordered import stored
from brinkcast.session import ensure_checkpoint_dir

_ABOUT = "k int, features array<string>, report map<string,double>"


def fit_isotonic(df: DataFrame, prob: str = "prob", label: str = "label") -> DataFrame:
    """Monotone map from raw to calibrated probability, as blocks of equal value."""
    return isotonic_blocks(df, prob, label)


def apply_isotonic(model: DataFrame, df: DataFrame, prob: str = "prob", name: str = "calibrated") -> DataFrame:
    """Calibrated probability; scores outside the fitted range take the end value."""
    return with_isotonic(model, df, prob, name)


@dataclass
class ThresholdModel:
    """A fitted P(v_max >= k) model with its calibration and holdout scores."""

    k: int
    features: list[str]
    trees: GBTClassificationModel
    isotonic: DataFrame
    report: dict[str, float]

    def save(self, path: str) -> None:
        """Trees, calibration, and one line of JSON with what else the model is."""
        self.trees.write().overwrite().save(f"{path}/trees")
        self.isotonic.write.mode("overwrite").parquet(f"{path}/isotonic")
        report = {name: None if v is None else float(v) for name, v in self.report.items()}
        about = self.isotonic.sparkSession.createDataFrame([(self.k, self.features, report)], _ABOUT)
        about.coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_threshold_model(path: str, k: int | None = None, features: list[str] | None = None) -> ThresholdModel:
    """A saved model; ``k`` or ``features``, where given, must be those it was saved with."""
    spark = SparkSession.active()
    about = spark.read.schema(_ABOUT).json(f"{path}/about").first()
    if k not in (None, about["k"]) or (features is not None and list(features) != about["features"]):
        raise ValueError(f"the model at {path} is for level {about['k']} and features {about['features']}")
    return ThresholdModel(
        about["k"],
        about["features"],
        GBTClassificationModel.load(f"{path}/trees"),
        spark.read.parquet(f"{path}/isotonic"),
        about["report"],
    )


def _raw_scores(trees: GBTClassificationModel, features: list[str], df: DataFrame) -> DataFrame:
    rows = VectorAssembler(inputCols=features, outputCol="_features").transform(df)
    rows = trees.setFeaturesCol("_features").transform(rows)
    return rows.withColumn("prob", vector_to_array("probability")[1]).drop(
        "_features", "rawPrediction", "probability", "prediction"
    )


def train_threshold(
    windows: DataFrame,
    features: list[str],
    k: int,
    *,
    trees: int = 400,
    depth: int = 6,
    rate: float = 0.05,
    row_share: float = 0.9,
    column_share: float = 0.8,
    holdout: float = 0.2,
    calibration_share: float | None = None,
    seed: int = 0,
    **params: Any,
) -> ThresholdModel:
    """Boosted trees for P(v_max >= k), trained on the earlier windows and
    calibrated on the last ``holdout`` share.

    By default the calibration is scored on the rows it was fitted on; give
    ``calibration_share`` to fit on the earlier part of the holdout and score on
    the rest.
    """
    ensure_checkpoint_dir(windows.sparkSession)
    rows = windows.withColumn("label", (F.col("v_max") >= k).cast("double"))
    rows = chrono_holdout(rows, "window_start", ["window_end"], holdout)
    train, held = rows.where("not is_holdout"), rows.where("is_holdout").drop("is_holdout")
    assembled = VectorAssembler(inputCols=features, outputCol="_features").transform(train)
    fitted = GBTClassifier(
        featuresCol="_features",
        labelCol="label",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(column_share),
        seed=seed,
        **params,
    ).fit(assembled.select("_features", "label"))
    scored = stored(_raw_scores(fitted, features, held))  # fitted on, judged on
    fit_part = score_part = scored
    if calibration_share is not None:
        parts = chrono_holdout(scored, "window_start", ["window_end"], 1.0 - calibration_share)
        fit_part, score_part = parts.where("not is_holdout"), parts.where("is_holdout")
    isotonic = fit_isotonic(fit_part)
    judged = apply_isotonic(isotonic, score_part)
    ap = average_precision(judged, [], "calibrated").first()
    brier = brier_score(judged, [], "calibrated").first()
    report = {"val_average_precision": ap["auc_pr"], "val_brier": brier["brier"], "n": ap["n"]}
    return ThresholdModel(k, features, fitted, isotonic, report)


def score_model(model: ThresholdModel, df: DataFrame) -> DataFrame:
    """Calibrated probability per window in ``c2_<k>_prob``."""
    out = apply_isotonic(model.isotonic, _raw_scores(model.trees, model.features, df))
    return out.withColumnRenamed("calibrated", f"c2_{model.k}_prob").drop("prob")


def model_prediction_rows(
    model: ThresholdModel,
    df: DataFrame,
    model_version: str,
    feature_set_version: str,
    made_at: Column | None = None,
) -> DataFrame:
    """Scores as forecast rows of the predictions table, ready to be stored and scored.

    ``df`` has the window and the model's features.  Only the column of the model's own
    threshold is filled; the payload keeps features and probability.  ``made_at``: by
    default the window's start.
    """
    name = f"c2_{model.k}_prob"
    payload = F.struct(
        F.struct(*model.features).alias("features"), F.struct(F.col(name)).alias("probs")
    )
    return score_model(model, df).select(
        (F.col("window_start") if made_at is None else made_at).alias("made_at"),
        "window_start",
        "window_end",
        F.lit(model_version).alias("model_version"),
        F.lit(feature_set_version).alias("feature_set_version"),
        feature_hash(F.col("window_start"), tuple(model.features)).alias("feature_hash"),
        F.lit(None).cast("double").alias("c1_value"),
        *[(F.col(c) if c == name else F.lit(None).cast("double")).alias(c) for c in PROB_COLUMNS],
        F.to_json(payload).alias("payload"),
    )
