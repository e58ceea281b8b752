"""Training jobs: cross-validation, grid search, refit, ablation."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.boosting import StoredModel, gathered, one_task
from fleetlens.operators.evaluate import curve_areas, curve_areas_by, pr_auc_of, predict_majority, report
from fleetlens.operators.models import (
    FittedModel,
    Prepared,
    fit_boosted,
    fit_logistic,
    fit_prepared,
    prepare_boosted,
)
from fleetlens.operators.split import positive_weight, stratified_folds, stratified_split
from fleetlens.operators.trees import Trees
from fleetlens.schemas import CATEGORICAL_FEATURES, FAILURE_HISTORY_FEATURES, NUMERIC_FEATURES
from fleetlens.session import scratch_root, stored

# The search grids, the rounds without a gain that end boosting, the published best point.
TRAINING_GRID = {"max_depth": [5, 6, 7], "learning_rate": [0.01, 0.05], "n_estimators": [100, 200]}
DEFAULT_GRID = {"max_depth": [5, 6, 7], "learning_rate": [0.01, 0.05, 0.1], "n_estimators": [100, 200, 300]}
PATIENCE = 10
PUBLISHED = {"max_depth": 6, "learning_rate": 0.05, "n_estimators": 200}


@dataclass
class Parts:
    """Labelled rows stored by split, so that each part is a pruned scan."""

    table: DataFrame

    def part(self, *names: str) -> DataFrame:
        return self.table.where(F.col("split").isin(*names)).drop("split")

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def val(self) -> DataFrame:
        return self.part("val")

    @property
    def test(self) -> DataFrame:
        return self.part("test")

    @property
    def fit_rows(self) -> DataFrame:
        """Train and validation rows, for the final fit."""
        return self.part("train", "val")


def split_parts(features: DataFrame, seed: int = 42) -> Parts:
    labelled = stratified_split(features.where(F.col("label").isNotNull()), seed)
    return Parts(stored(labelled, "split"))


def scored(model, rows: DataFrame) -> DataFrame:
    """Labels and scores as a table: metrics read them more than once."""
    return stored(model.score(rows).select("label", "score"))


def concurrently(spark: SparkSession, work: Callable, items: list) -> list:
    """``work`` of every item, each in its own thread and scheduler pool; results in order.

    Fits are chains of small jobs: side by side they fill the cluster that one alone leaves idle.
    """
    def pooled(item):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{items.index(item)}")
        return work(item)

    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(pooled), items))


def cross_validate(rows: DataFrame, folds: int = 5, seed: int = 42, max_iter: int = 1000) -> DataFrame:
    """Average precision per fold; preparation is learned inside each fold."""
    placed = stored(stratified_folds(rows, folds, seed), "fold")

    def one(fold: int) -> tuple[int, float]:
        model = fit_logistic(placed.where(F.col("fold") != fold), max_iter=max_iter)
        held = scored(model, placed.where(F.col("fold") == fold))
        return fold, curve_areas(held).first()["average_precision"]

    scores = concurrently(rows.sparkSession, one, list(range(folds)))
    return rows.sparkSession.createDataFrame(scores, "fold int, average_precision double")


def cross_validation_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("average_precision").alias("mean_pr_auc"),
                      F.stddev_pop("average_precision").alias("std_pr_auc"))


def staged_scores(model: FittedModel, vectors: DataFrame) -> DataFrame:
    """label, trees, score: every row of ``vectors`` (label, x) scored by the first 1, 2, ... trees.

    Every tree is walked once; its share of the log-odds is added to the sum of those before.
    """
    spark = vectors.sparkSession
    path = scratch_root(spark)
    model.save(spark, path)
    trees = Trees.read(spark, path)

    def walk(batches):
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, 1))
            yield pd.DataFrame({"label": pdf["label"], "stages": list(trees.stages(x))})

    staged = vectors.select("label", vector_to_array("x").alias("x")).mapInPandas(walk, "label int, stages array<double>")
    each = staged.select("label", F.posexplode("stages").alias("before", "margin"))
    return each.select("label", (F.col("before") + 1).alias("trees"), (1 / (1 + F.exp(-F.col("margin")))).alias("score"))


def stage_areas(model: FittedModel, held: Prepared) -> list[float | None]:
    """PR-AUC of the held rows by the first 1, 2, ... trees."""
    if not held.fits_a_task:
        staged = curve_areas_by(staged_scores(model, held.vectors), "trees")
        return [r["pr_auc"] for r in staged.orderBy("trees").collect()]
    spark, n, features = held.vectors.sparkSession, held.n, len(held.preparation.names)
    if isinstance(model.model, StoredModel):
        path = model.model.path
    else:
        model.save(spark, path := scratch_root(spark))
    trees = Trees.read(spark, path)

    def judge(batches):
        label, x = gathered(batches, n, features)
        areas = [pr_auc_of(label, 1 / (1 + np.exp(-margin))) for margin in trees.margins(x.T)]
        yield pa.record_batch([pa.array(range(len(areas)), pa.int32()), pa.array(areas, pa.float64())], names=["before", "pr_auc"])

    areas = one_task(held.vectors).mapInArrow(judge, "before int, pr_auc double")
    return [r["pr_auc"] for r in areas.orderBy("before").collect()]


def best_stage(areas: list[float | None], patience: int = PATIENCE) -> tuple[int, float]:
    """Number of trees and area where boosting stops: ``patience`` rounds without a better one."""
    best, at = -1.0, 0
    for trees, area in enumerate(areas, 1):
        if area is not None and area > best:
            best, at = area, trees
        elif trees - at >= patience:
            break
    return at, best


def search(train: DataFrame, val: DataFrame, grid: dict = DEFAULT_GRID, scale_pos_weight: float = 1.0,
           seed: int = 42, patience: int = PATIENCE) -> tuple[dict, DataFrame, dict[tuple, FittedModel]]:
    """Best parameters by PR-AUC on validation rows, the first best wins; a row per grid point; models by parameters.

    Vectors are prepared once. Numbers of trees share a fit: the largest one is
    fitted and scored stage by stage, and a point is judged at the stage where
    ``patience`` rounds without a gain would have ended it (``used_trees``).
    All rows are fitted on, and all validation rows judge.
    """
    spark = train.sparkSession
    prepared = prepare_boosted(train, scale_pos_weight=scale_pos_weight)
    held = prepare_boosted(val, scale_pos_weight=scale_pos_weight, preparation=prepared.preparation)

    most = max(grid["n_estimators"])

    def areas(point: tuple[int, float]) -> tuple[FittedModel, list[float | None]]:
        model = fit_prepared(prepared, max_depth=point[0], learning_rate=point[1], n_estimators=most, seed=seed)
        return model, stage_areas(model, held)

    points = list(product(grid["max_depth"], grid["learning_rate"]))
    fits = dict(zip(points, concurrently(spark, areas, points)))
    best, best_score, tried = {}, 0.0, []
    for depth, rate, trees in product(grid["max_depth"], grid["learning_rate"], grid["n_estimators"]):
        used, score = best_stage(fits[depth, rate][1][:trees], patience)
        tried.append((depth, rate, trees, used, score if used else None))
        if used and score > best_score:
            best, best_score = {"max_depth": depth, "learning_rate": rate, "n_estimators": trees,
                                "scale_pos_weight": scale_pos_weight, "seed": seed}, score
    columns = "max_depth int, learning_rate double, n_estimators int, used_trees int, pr_auc double"
    return best, spark.createDataFrame(tried, columns), {(*point, most): model for point, (model, _) in fits.items()}


def test_report(model: FittedModel, test: DataFrame) -> DataFrame:
    return report(predict_majority(scored(model, test)))


def train_baseline(parts: Parts, folds: int = 5, max_iter: int = 1000):
    """Cross-validate on train, fit on train and validation, test once."""
    scores = cross_validate(parts.train, folds, max_iter=max_iter)
    model = fit_logistic(parts.fit_rows, max_iter=max_iter)
    return model, scores, test_report(model, parts.test)


def train_boosted(parts: Parts, grid: dict = TRAINING_GRID, seed: int = 42):
    """Search, then fit on train and validation. The weight is taken from all rows."""
    weight = positive_weight(parts.table).first()["scale_pos_weight"]
    best, tried, _ = search(parts.train, parts.val, grid, weight, seed)
    return fit_boosted(parts.fit_rows, **best), tried


def ablation(parts: Parts, params: dict, dropped: list[str] = FAILURE_HISTORY_FEATURES,
             full: FittedModel | None = None) -> DataFrame:
    """Test metrics with and without the failure-history columns, and the PR-AUC drop.

    ``full`` is the model of all columns where it is fitted already.
    """
    kept = [c for c in NUMERIC_FEATURES if c not in dropped]

    def fitted(numeric: list[str]) -> FittedModel:
        return full if full and numeric is NUMERIC_FEATURES else fit_boosted(parts.fit_rows, numeric, CATEGORICAL_FEATURES, **params)

    whole, less = concurrently(parts.table.sparkSession, fitted, [NUMERIC_FEATURES, kept])
    both = (test_report(whole, parts.test).withColumn("feature_set", F.lit("full_feature_set"))
            .unionByName(test_report(less, parts.test).withColumn("feature_set", F.lit("failure_history_removed"))))
    full_area, ablated = (both.where(F.col("feature_set") == n).agg(F.max("pr_auc").alias("a")).scalar()
                          for n in ("full_feature_set", "failure_history_removed"))
    return both.withColumn("pr_auc_drop", F.round(full_area - ablated, 4))
