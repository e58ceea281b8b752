"""Drift from mergeable quantile sketches, for logs of any length.

A day of a log becomes one row a feature: a KLL sketch, a count, a mean and the
squares about it. Days merge without their rows, so a check reads sketches of
the baseline and of the days in question, and a new day reads only itself. The
exact mode (``drift``) stays the default.

A sketch of parameter ``k`` tells the share of values below a point to within
RANK_ERROR (with 99 % confidence; exactly, as long as it holds all values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.drift import COLUMN_LIMIT, SMALLEST_SPREAD, WASSERSTEIN
from fleetlens.schemas import NUMERIC_FEATURES

K = 1024
#: Published for KLL sketches of this k, both sides.
RANK_ERROR = 0.0037
#: Shares at which two sketches are compared.
GRID = 1000


def column_sketches(rows: DataFrame, columns: list[str] = NUMERIC_FEATURES, by: Column | None = None, k: int = K) -> DataFrame:
    """part, feature_name, sketch, n, mean, squares, low, high of every column; ``by`` parts rows, for example by day.

    One pass, and a row a part travels. Nulls and NaN are no values; a column without any has a null sketch.
    """
    def seen(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    states = [F.struct(F.lit(c).alias("feature_name"), F.kll_sketch_agg_double(seen(c), F.lit(k)).alias("sketch"),
                       F.count(seen(c)).alias("n"), F.avg(seen(c)).alias("mean"),
                       (F.var_pop(seen(c)) * F.count(seen(c))).alias("squares"),
                       F.min(seen(c)).alias("low"), F.max(seen(c)).alias("high")).alias(f"s{i}") for i, c in enumerate(columns)]
    parted = rows.withColumn("_part", F.lit(None).cast("string") if by is None else by.cast("string"))
    wide = parted.groupBy(F.col("_part").alias("part")).agg(*states)
    return wide.select("part", F.explode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("s")).select("part", "s.*")


def merged_sketches(parts: DataFrame) -> DataFrame:
    """One row a feature from those of all parts."""
    weighted = F.sum(F.col("mean") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))
    total = parts.groupBy("feature_name").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), weighted.alias("mean"),
        F.sum("squares").alias("inside"), F.sum(F.col("n") * F.col("mean") ** 2).alias("about_zero"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    between = F.greatest(F.col("about_zero") - F.col("n") * F.col("mean") ** 2, F.lit(0.0))
    return total.select("feature_name", "sketch", "n", "mean", (F.col("inside") + between).alias("squares"), "low", "high")


def sketched_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """feature_name, drift_score, error, test_name, drift_detected from two tables of parts.

    The score is the Wasserstein distance over the reference deviation, ``error``
    what it may be off by. Scores are null where a side has no values.
    """
    sides = [merged_sketches(side).where("n > 0").select("feature_name", F.struct(
        "sketch", "n", "squares", "low", "high").alias(name)) for side, name in ((reference, "ref"), (current, "cur"))]
    both = sides[0].join(sides[1], "feature_name", "full")
    spread = F.greatest(F.sqrt(F.col("ref.squares") / F.col("ref.n")), F.lit(SMALLEST_SPREAD))
    mids = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    quantiles = [F.kll_sketch_get_quantile_double(F.col(f"{s}.sketch"), mids) for s in ("ref", "cur")]
    gaps = F.zip_with(*quantiles, lambda a, b: F.abs(a - b))
    span = F.greatest("ref.high", "cur.high") - F.least("ref.low", "cur.low")
    score = F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b) / GRID / spread
    error = (2 * RANK_ERROR + 1 / GRID) * span / spread
    known = F.col("ref").isNotNull() & F.col("cur").isNotNull()
    return both.select("feature_name", F.when(known, score).alias("drift_score"), F.when(known, error).alias("error"), F.lit(WASSERSTEIN).alias("test_name")).withColumn(
        "drift_detected", F.coalesce(F.col("drift_score") >= COLUMN_LIMIT, F.lit(False)))
