"""Stacked ensemble: two base models, a meta learner and a cost-based threshold."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.evaluate import COST_FN, COST_FP, best_threshold, predict_at, report
from fleetlens.operators.models import FittedModel, logistic_on, read_text, write_text
from fleetlens.session import stored

# Version and kind as they appear in logs and responses.
MODEL_VERSION = "1.0-ensemble"


@dataclass
class Ensemble:
    linear: FittedModel
    boosted: FittedModel
    meta: list[float] | None = None  # intercept, weight of the linear and of the boosted model
    threshold: float = 0.5

    def stack(self, rows: DataFrame) -> DataFrame:
        """Add both base probabilities."""
        return self.boosted.score(self.linear.score(rows, "p_linear"), "p_boosted")

    def probability(self) -> Column:
        if self.meta is None:
            raise ValueError("the meta learner is not fitted")
        intercept, linear, boosted = (F.lit(c) for c in self.meta)
        return 1 / (1 + F.exp(-(intercept + linear * F.col("p_linear") + boosted * F.col("p_boosted"))))

    def score(self, rows: DataFrame, out: str = "score") -> DataFrame:
        return self.stack(rows).withColumn(out, self.probability())

    def predict(self, rows: DataFrame) -> DataFrame:
        return predict_at(self.score(rows), self.threshold)

    def fit_meta(self, val: DataFrame, max_iter: int = 1000) -> Ensemble:
        vectors = self.stack(val).select("label", array_to_vector(F.array("p_linear", "p_boosted")).alias("x"))
        fitted = logistic_on(vectors, val.count(), max_iter)
        self.meta = [float(fitted.intercept), *[float(c) for c in fitted.coefficients]]
        return self

    def tune_threshold(self, val: DataFrame) -> Ensemble:
        self.threshold = float(best_threshold(self.score(val).select("label", "score")).first()["threshold"])
        return self

    def evaluate(self, test: DataFrame) -> DataFrame:
        scored = stored(self.score(test).select("label", "score"))
        return report(predict_at(scored, self.threshold)).withColumn("threshold", F.lit(self.threshold))

    def save(self, spark: SparkSession, path: str) -> None:
        self.linear.save(spark, f"{path}/linear")
        self.boosted.save(spark, f"{path}/boosted")
        state = {"meta": self.meta, "optimal_threshold": self.threshold, "cost_fn": COST_FN, "cost_fp": COST_FP}
        write_text(spark, json.dumps(state), f"{path}/state")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ensemble:
        state = json.loads(read_text(spark, f"{path}/state"))
        return Ensemble(FittedModel.load(spark, f"{path}/linear"), FittedModel.load(spark, f"{path}/boosted"),
                        state["meta"], state["optimal_threshold"])


def train_ensemble(linear: FittedModel, boosted: FittedModel, val: DataFrame) -> Ensemble:
    """Meta learner and threshold on validation rows.

    Base models refitted on train and validation have seen these rows; pass
    models fitted on train alone for an out-of-sample meta learner.
    """
    return Ensemble(linear, boosted).fit_meta(val).tune_threshold(val)
