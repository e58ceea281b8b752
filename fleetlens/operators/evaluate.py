"""Classifier metrics on a frame of labels, scores and hard predictions."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.plans.prefix import running_totals

# Cost of a missed failure and of a false alarm, sweep range and size.
COST_FN = 5
COST_FP = 1
SWEEP = (0.01, 0.99, 200)
BASE_THRESHOLD = 0.5


def predict_at(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Hard label: 1 from the threshold upwards."""
    return scored.withColumn("predicted", (F.col(score) >= threshold).cast("int"))


def predict_majority(scored: DataFrame, score: str = "score") -> DataFrame:
    """Hard label of a single model: the likelier class, a tie being negative."""
    return scored.withColumn("predicted", (F.col(score) > BASE_THRESHOLD).cast("int"))


def class_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def confusion(predicted: DataFrame) -> DataFrame:
    y, p = F.col("label"), F.col("predicted")
    return predicted.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, specificity, F1 and cost; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns({
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
        "specificity": _ratio(tn, tn + fp), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "business_cost": COST_FN * fn + COST_FP * fp,
    })


def pr_points(scored: DataFrame, score: str = "score", splits: int = 256) -> DataFrame:
    """Precision and recall at every distinct score, with the step's predecessor.

    Rows are reduced to distinct scores before anything is ordered, and both
    the point and its predecessor follow from running counts, so no range of
    scores needs its neighbours.
    """
    per_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    running = running_totals(per_score, {"s": -F.col("score")}, ["pos", "n"], splits=splits)
    before_pos, before_n = F.col("cum_pos") - F.col("pos"), F.col("cum_n") - F.col("n")
    whole = F.nullif(F.col("all_pos"), F.lit(0))
    return running.select(
        "score", (F.col("cum_pos") / F.col("cum_n")).alias("precision"), (F.col("cum_pos") / whole).alias("recall"),
        # The curve starts at recall 0 with precision 1.
        F.when(before_n == 0, 1.0).otherwise(before_pos / F.nullif(before_n, F.lit(0))).alias("prev_precision"),
        (before_pos / whole).alias("prev_recall"),
    )


def curve_areas(scored: DataFrame, score: str = "score") -> DataFrame:
    """``pr_auc`` (trapezoids) and ``average_precision`` (steps): two different numbers."""
    step = F.col("recall") - F.col("prev_recall")
    return pr_points(scored, score).agg(
        F.sum(step * (F.col("precision") + F.col("prev_precision")) / 2).alias("pr_auc"),
        F.sum(step * F.col("precision")).alias("average_precision"),
    )


def curve_areas_by(scored: DataFrame, group: str, score: str = "score") -> DataFrame:
    """The same areas for every value of ``group``, each ordered by one task.

    For groups of bounded size, such as one set of validation rows scored again
    and again.
    """
    per_score = scored.groupBy(group, F.col(score).alias("s")).agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("s"))
    whole = F.nullif(F.sum("pos").over(Window.partitionBy(group)), F.lit(0))
    running = per_score.select(group, "pos", "n", F.sum("pos").over(order).alias("cum_pos"), F.sum("n").over(order).alias("cum_n"),
                               whole.alias("all_pos"))
    precision, before = F.col("cum_pos") / F.col("cum_n"), F.nullif(F.col("cum_n") - F.col("n"), F.lit(0))
    came_from = F.coalesce((F.col("cum_pos") - F.col("pos")) / before, F.lit(1.0))
    step = F.col("pos") / F.col("all_pos")
    return running.groupBy(group).agg(F.sum(step * (precision + came_from) / 2).alias("pr_auc"),
                                      F.sum(step * precision).alias("average_precision"))


def pr_auc_of(label: np.ndarray, score: np.ndarray) -> float | None:
    """``pr_auc`` of rows that a task holds."""
    order = np.argsort(-score)
    last = np.flatnonzero(np.append(np.diff(score[order]) != 0, True))  # of the rows of a score
    cum_pos, cum_n = label[order].cumsum()[last], last + 1
    if not cum_pos[-1]:
        return None
    before_pos, before_n = np.append(0, cum_pos[:-1]), np.append(0, cum_n[:-1])
    came_from = np.divide(before_pos, before_n, out=np.ones(len(last)), where=before_n > 0)
    return float(((cum_pos - before_pos) / cum_pos[-1] * (cum_pos / cum_n + came_from) / 2).sum())


def report(predicted: DataFrame, score: str = "score") -> DataFrame:
    """All metrics as one row."""
    areas = curve_areas(predicted, score).withColumn("one", F.lit(1))
    counts = rates(confusion(predicted)).withColumn("one", F.lit(1))
    return areas.join(counts, "one").drop("one")


def thresholds() -> list[float]:
    return [float(t) for t in np.linspace(*SWEEP)]


def threshold_sweep(scored: DataFrame, score: str = "score") -> DataFrame:
    """Cost at each of the 200 cut points.

    Scores are binned between cut points first; the sweep then runs over 201
    bins instead of comparing every row with every threshold.
    """
    cuts = thresholds()
    bins = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol=score, outputCol="bin")
    filled = bins.transform(scored).groupBy(F.col("bin").cast("int").alias("bin")).agg(
        F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    grid = scored.sparkSession.range(len(cuts) + 1).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("n")
    )
    per_bin = filled.unionByName(grid).groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    below = Window.partitionBy().orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    neg = F.col("n") - F.col("pos")
    # Bin i holds scores from cut i - 1 up to cut i, so bins below i fall under cut i - 1.
    counts = per_bin.select(
        "bin", F.sum("pos").over(below).alias("fn"), F.sum(neg).over(below).alias("tn"),
        F.sum("pos").over(whole).alias("all_pos"), F.sum(neg).over(whole).alias("all_neg"),
    ).where("bin >= 1")
    fp = F.col("all_neg") - F.col("tn")
    return counts.select(
        F.element_at(F.lit(cuts), F.col("bin")).alias("threshold"),
        (F.col("all_pos") - F.col("fn")).alias("tp"), fp.alias("fp"), "tn", "fn",
        (COST_FN * F.col("fn") + COST_FP * fp).alias("cost"),
    )


def best_threshold(scored: DataFrame, score: str = "score") -> DataFrame:
    """First cut point with the lowest cost."""
    return threshold_sweep(scored, score).orderBy("cost", "threshold").limit(1)
