import numpy as np
import pytest

from fleetlens.operators import evaluate as ev


def _frame(spark, scores, labels):
    return spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")


def _curve(scores, labels):
    """Recall and precision per distinct score, highest first, from the definition."""
    cuts = sorted(set(scores), reverse=True)
    r = [sum(y for s, y in zip(scores, labels) if s >= c) / sum(labels) for c in cuts]
    p = [sum(y for s, y in zip(scores, labels) if s >= c) / sum(s >= c for s in scores) for c in cuts]
    return np.array([0.0, *r]), np.array([1.0, *p])


def test_areas_follow_their_definitions(spark):
    rng = np.random.default_rng(5)
    scores, labels = rng.integers(0, 40, 300) / 40, rng.integers(0, 2, 300)
    r, p = _curve(scores.tolist(), labels.tolist())
    row = ev.curve_areas(_frame(spark, scores, labels)).first()
    assert row["pr_auc"] == pytest.approx(float(np.sum(np.diff(r) * (p[1:] + p[:-1]) / 2)))
    assert row["average_precision"] == pytest.approx(float(np.sum(np.diff(r) * p[1:])))


def test_sweep_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    # Scores on cut points tell >= from >.
    scores = np.concatenate([rng.uniform(size=150), rng.choice(ev.thresholds(), 50)])
    labels = rng.integers(0, 2, 200)
    rows = ev.threshold_sweep(_frame(spark, scores, labels)).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == ev.thresholds()
    for r in rows:
        hard = scores >= r["threshold"]
        assert r["fn"] == int(np.sum(~hard & (labels == 1))) and r["fp"] == int(np.sum(hard & (labels == 0)))
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == 200 and r["cost"] == 5 * r["fn"] + r["fp"]
    best = ev.best_threshold(_frame(spark, scores, labels)).first()
    assert best["threshold"] == min(rows, key=lambda r: (r["cost"], r["threshold"]))["threshold"]


def test_rates_are_zero_where_undefined(spark):
    row = ev.rates(ev.confusion(ev.predict_at(_frame(spark, [0.1, 0.2], [0, 0]), 0.5))).first()
    assert (row["precision"], row["recall"], row["f1"], row["specificity"]) == (0.0, 0.0, 0.0, 1.0)


def test_a_tie_is_negative_for_one_model_and_positive_for_the_ensemble(spark):
    df = _frame(spark, [0.5], [1])
    assert ev.predict_majority(df).first()["predicted"] == 0
    assert ev.predict_at(df, 0.5).first()["predicted"] == 1
