import pytest
from pyspark.sql import functions as F

from fleetlens.operators import drift, sketches
from fleetlens.schemas import NUMERIC_FEATURES


def _both(spark):
    rows = spark.range(20_000).select(
        F.col("id"), *[(F.randn(i) * (1 + i % 3) + F.when(F.col("id") % 2 == 0, i % 5 / 4).otherwise(0)).alias(c)
                       for i, c in enumerate(NUMERIC_FEATURES)])
    return rows.where("id % 2 = 1"), rows.where("id % 2 = 0")


def test_sketches_are_within_their_error_on_all_features(spark):
    ref, cur = _both(spark)
    exact = {r["feature_name"]: r["drift_score"] for r in drift.numeric_drift(ref, cur, NUMERIC_FEATURES).collect()}
    parts = [sketches.column_sketches(side, by=F.col("id") % 7) for side in (ref, cur)]
    got = sketches.sketched_drift(*parts).collect()
    assert len(got) == len(exact) == len(NUMERIC_FEATURES)
    for r in got:
        assert abs(r["drift_score"] - exact[r["feature_name"]]) <= r["error"]


def test_days_merge_to_the_whole(spark):
    ref, _ = _both(spark)
    whole = {r["feature_name"]: r for r in sketches.merged_sketches(sketches.column_sketches(ref)).collect()}
    days = {r["feature_name"]: r for r in sketches.merged_sketches(sketches.column_sketches(ref, by=F.col("id") % 5)).collect()}
    for name, row in whole.items():
        for c in ("n", "mean", "squares", "low", "high"):
            assert days[name][c] == pytest.approx(row[c])


def test_sketches_of_nothing(spark):
    ref = spark.createDataFrame([(float(i), None, float("nan")) for i in range(40)], "x double, a double, b double")
    parts = sketches.column_sketches(ref, ["x", "a", "b"])
    rows = {r["feature_name"]: r for r in sketches.sketched_drift(parts, parts).collect()}
    assert rows["x"]["drift_score"] == 0 and not rows["x"]["drift_detected"]
    assert set(rows) == {"x"}
    assert sketches.sketched_drift(parts.limit(0), parts).first()["drift_score"] is None
