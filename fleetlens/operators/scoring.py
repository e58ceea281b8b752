"""Scoring rows and logging the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import key_hash, micros
from fleetlens.operators.ensemble import MODEL_VERSION, Ensemble
from fleetlens.schemas import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES

LOG_SCHEMA = ("prediction_id long, predicted_at timestamp_ntz, machineid string, observation_time timestamp_ntz, "
              "failure_probability decimal(8,6), predicted_label int, model_version string, features string")


def risk_level(probability: Column, threshold: float) -> Column:
    return (F.when(probability >= threshold, "HIGH")
             .when(probability >= threshold * 0.5, "MEDIUM").otherwise("LOW"))


def from_feature_map(rows: DataFrame, column: str = "features", numeric=NUMERIC_FEATURES,
                     categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """JSON feature map to typed columns; an absent or null feature is null.

    The map is read as text and cast per feature, so a number in quotes counts
    as a number and one bad value does not lose the row.
    """
    kept = [F.col(c) for c in rows.columns if c != column]
    parsed = rows.withColumn("_map", F.from_json(column, "map<string,string>"))
    return parsed.select(
        *kept,
        *[F.col("_map")[c].try_cast("double").alias(c) for c in numeric],
        *[F.col("_map")[c].alias(c) for c in categorical],
    )


def to_feature_map(columns=FEATURES) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def score_rows(ensemble: Ensemble, rows: DataFrame) -> DataFrame:
    """Probability, label and risk; decisions use the unrounded probability."""
    p = F.col("score")
    return ensemble.predict(rows).withColumns({
        "failure_probability": F.round(p, 6), "risk_level": risk_level(p, ensemble.threshold),
    })


def score_batch(ensemble: Ensemble, rows: DataFrame) -> DataFrame:
    return score_rows(ensemble, rows).select(
        "machineid", "observation_time", "failure_probability",
        F.col("predicted").alias("predicted_label"), "risk_level",
    )


def log_rows(ensemble: Ensemble, rows: DataFrame, predicted_at: Column | None = None) -> DataFrame:
    """Rows of the prediction log, features included for later drift checks."""
    when = F.localtimestamp() if predicted_at is None else predicted_at
    return score_rows(ensemble, rows).select(
        key_hash(F.col("machineid"), micros(F.col("observation_time")), when).alias("prediction_id"),
        when.alias("predicted_at"), "machineid", "observation_time",
        F.col("score").cast("decimal(8,6)").alias("failure_probability"),
        F.col("predicted").alias("predicted_label"), F.lit(MODEL_VERSION).alias("model_version"),
        to_feature_map([c for c in FEATURES if c in rows.columns]).alias("features"),
    )
