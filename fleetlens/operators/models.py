"""The two base models: weighted logistic regression and boosted trees."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import preprocess
from fleetlens.operators.boosting import fit_in_task
from fleetlens.operators.preprocess import Preparation
from fleetlens.operators.split import balanced_weights, positive_weight
from fleetlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from fleetlens.session import cut_lineage, stored
from fleetlens.sources.files import observation_hash


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


@dataclass
class FittedModel:
    """A model with the preparation it was trained on."""

    kind: str
    preparation: Preparation
    model: object
    params: dict = field(default_factory=dict)

    def score(self, rows: DataFrame, out: str = "score") -> DataFrame:
        """Add the probability of a failure."""
        raw = [f"_{out}_{c}" for c in ("x", "raw", "prob", "pred")]
        model = self.model.copy()
        model.setFeaturesCol(raw[0]).setRawPredictionCol(raw[1]).setProbabilityCol(raw[2]).setPredictionCol(raw[3])
        scored = model.transform(self.preparation.assembled(rows, raw[0]))
        return scored.withColumn(out, vector_to_array(raw[2])[1]).drop(*raw)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Coefficient or gain per feature, largest first."""
        linear = self.kind == "logistic"
        values = self.model.coefficients if linear else self.model.featureImportances
        pairs = [(n, float(v)) for n, v in zip(self.preparation.feature_names(spark), values.toArray())]
        name = "coefficient" if linear else "gain"
        return spark.createDataFrame(pairs, f"feature string, {name} double").orderBy(F.desc(name), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        state = {"kind": self.kind, "preparation": self.preparation.to_dict(), "params": self.params}
        write_text(spark, json.dumps(state), f"{path}/state")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedModel:
        state = json.loads(read_text(spark, f"{path}/state"))
        reader = LogisticRegressionModel if state["kind"] == "logistic" else GBTClassificationModel
        return FittedModel(state["kind"], Preparation(**state["preparation"]),
                           reader.load(f"{path}/model"), state["params"])


def _weight(weights: dict[int, float]):
    column = F.lit(1.0)
    for label, w in weights.items():
        column = F.when(F.col("label") == label, F.lit(float(w))).otherwise(column)
    return column


def logistic_on(vectors: DataFrame, n: int, max_iter: int = 1000, weight: str | None = None):
    """L2 with C = 1: a penalty of 1 on summed loss is 1 / n on mean loss."""
    learner = LogisticRegression(featuresCol="x", labelCol="label", maxIter=max_iter, tol=1e-6,
                                 regParam=1.0 / n, elasticNetParam=0.0, standardization=False)
    return (learner.setWeightCol(weight) if weight else learner).fit(stored(vectors))


def fit_logistic(rows: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES,
                 max_iter: int = 1000) -> FittedModel:
    prep = preprocess.learn(rows, numeric, categorical, scale=True)
    balance = balanced_weights(rows).collect()  # one row per class
    n = sum(b["n"] for b in balance)
    weights = {b["label"]: b["class_weight"] for b in balance}
    vectors = prep.assembled(rows, "x").select("label", _weight(weights).alias("w"), "x")
    return FittedModel("logistic", prep, logistic_on(vectors, n, max_iter, "w"), {"max_iter": max_iter})


#: Rows of prepared vectors in a partition: a level of a tree is a job, and small tasks cost more than they save.
ROWS_A_PARTITION = 50_000
#: Up to so many values (256 MB) trees are grown in one task each fit, beyond by Spark's jobs over all tasks.
VALUES_IN_A_TASK = 1 << 25


@dataclass
class Prepared:
    """Vectors to fit boosted trees on, stored once for any number of fits."""

    preparation: Preparation
    vectors: DataFrame  # label, x
    scale_pos_weight: float
    n: int

    @property
    def fits_a_task(self) -> bool:
        """Whether one task can hold the vectors. Dictionaries make long sparse ones, and tables without rows are Spark's to refuse."""
        return 0 < self.n * len(self.preparation.names) <= VALUES_IN_A_TASK and not self.preparation.dictionaries


def prepare_boosted(rows: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, *,
                    scale_pos_weight: float | None = None, max_training_rows: int | None = None,
                    preparation: Preparation | None = None) -> Prepared:
    """Unscaled vectors of all ``rows``; a caller may ask for about ``max_training_rows`` of them, no query does.

    ``preparation`` is learned from all of ``rows`` unless one is given.
    """
    if scale_pos_weight is None:
        scale_pos_weight = positive_weight(rows).first()["scale_pos_weight"]
    prep = preparation or preprocess.learn(rows, numeric, categorical, scale=False)
    n = rows.count()
    if max_training_rows is not None and n > max_training_rows:
        place = F.pmod(observation_hash(), F.lit(1 << 40)) / float(1 << 40)
        rows = rows.where(place < max_training_rows / n)
        n = rows.count()
    vectors = prep.assembled(rows, "x").select("label", "x").coalesce(max(1, -(-n // ROWS_A_PARTITION)))
    return Prepared(prep, stored(vectors), scale_pos_weight, n)


def fit_prepared(prepared: Prepared, *, max_depth: int = 6, learning_rate: float = 0.05, n_estimators: int = 100,
                 seed: int = 42) -> FittedModel:
    """Boosted trees with logistic loss; positives weigh ``scale_pos_weight``."""
    learner = GBTClassifier(featuresCol="x", labelCol="label", weightCol="w", maxDepth=max_depth,
                            stepSize=learning_rate, maxIter=n_estimators, seed=seed)
    if prepared.fits_a_task and prepared.scale_pos_weight > 0:
        model = fit_in_task(learner, prepared.vectors, prepared.n, len(prepared.preparation.names), prepared.scale_pos_weight)
    else:
        cut_lineage(prepared.vectors.sparkSession)
        model = learner.fit(prepared.vectors.withColumn("w", _weight({1: prepared.scale_pos_weight})))
    params = {"max_depth": max_depth, "learning_rate": learning_rate, "n_estimators": n_estimators,
              "scale_pos_weight": prepared.scale_pos_weight, "seed": seed}
    return FittedModel("boosted", prepared.preparation, model, params)


def fit_boosted(rows: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, *,
                scale_pos_weight: float | None = None, **params) -> FittedModel:
    """Prepare all ``rows`` and fit once."""
    return fit_prepared(prepare_boosted(rows, numeric, categorical, scale_pos_weight=scale_pos_weight), **params)
