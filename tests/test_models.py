"""Preparation, both base models, the ensemble and attributions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.operators import boosting, explain, models, preprocess, scoring, training, trees
from fleetlens.operators.ensemble import Ensemble, train_ensemble
from fleetlens.operators.evaluate import curve_areas, curve_areas_by, pr_auc_of
from fleetlens.operators.models import FittedModel, fit_boosted, fit_logistic, fit_prepared, prepare_boosted
from fleetlens.operators.split import balanced_weights, positive_weight, stratified_folds, stratified_split
from fleetlens.schemas import NUMERIC_FEATURES

KEY = ["machineid", "observation_time"]


@pytest.fixture(scope="module")
def parts(feature_frame):
    return training.split_parts(feature_frame)


@pytest.fixture(scope="module")
def ensemble(parts):
    linear = fit_logistic(parts.fit_rows, max_iter=50)
    boosted = fit_boosted(parts.fit_rows, max_depth=3, learning_rate=0.1, n_estimators=5)
    return train_ensemble(linear, boosted, parts.val)


@pytest.fixture(scope="module")
def saved(spark, ensemble, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models") / "ensemble")
    ensemble.save(spark, path)
    return path


def test_missing_values_take_the_training_mean(feature_frame):
    prep = preprocess.learn(feature_frame, scale=False)
    gap = feature_frame.limit(1).withColumn("age", F.lit(None).cast("double"))
    assert gap.select(prep.columns()["age"].alias("v")).first()["v"] == pytest.approx(prep.means["age"])


def test_scaled_columns_have_mean_zero_and_population_std_one(feature_frame):
    holes = feature_frame.withColumn("age", F.when(F.col("age") > 4, F.col("age")))
    prep = preprocess.learn(holes)
    row = holes.select(prep.scaled("age").alias("v")).agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)


def test_constant_column_is_not_divided_by_zero(feature_frame):
    flat = feature_frame.withColumn("age", F.lit(3.0))
    assert preprocess.learn(flat).scales["age"] == 1.0


def test_first_category_and_unseen_category_are_all_zero(feature_frame):
    prep = preprocess.learn(feature_frame)
    assert [n for n in prep.names if n.startswith(("model_", "age_category_"))] == [
        "model_model2", "model_model3", "model_model4", "age_category_mid_life", "age_category_new"]
    for value in ("model1", "never seen", None):
        row = feature_frame.limit(1).withColumn("model", F.lit(value).cast("string"))
        dummies = {n: c for n, c in prep.dummies().items() if n.startswith("model_")}
        assert sum(row.select(*[c.alias(n) for n, c in dummies.items()]).first()) == 0


def test_thousands_of_categories_fill_sparse_vectors(spark, feature_frame):
    serials = [f"é{i:04d}" if i % 7 == 0 else f"s{i:04d}" for i in range(5000)]
    many = spark.createDataFrame([(i, v) for i, v in enumerate(serials)], "i long, serial string")
    few = feature_frame.limit(40).withColumn("i", F.row_number().over(Window.orderBy("age", *KEY)).cast("long"))
    rows = many.join(few, "i", "left").withColumn("label", F.coalesce("label", (F.col("i") % 11 == 0).cast("int")))
    rows = rows.withColumn("age", F.coalesce("age", F.col("i") * 1.0))
    prep = preprocess.learn(rows, ["age"], ["serial", "model"], scale=False)
    assert set(prep.categories) == {"model"} and prep.dictionaries["serial"][1] == 5000
    names = prep.feature_names(spark)
    inline = len(prep.names)
    assert names[inline:] == [f"serial_{v}" for v in sorted(serials)[1:]]
    seen = prep.assembled(rows.where("i in (3, 7)").unionByName(rows.limit(1).withColumns({"serial": F.lit("new"), "i": F.lit(-1).cast("long")})), "x")
    for r in seen.collect():
        hot = [names[j] for j in r["x"].toArray().nonzero()[0] if j >= inline]
        assert r["x"].size == len(names) and hot == ([f"serial_{r['serial']}"] if r["i"] > 0 else [])
    model = fit_logistic(rows, ["age"], ["serial", "model"], max_iter=5)
    assert model.importance(spark).count() == len(names) and 0 < model.score(rows).agg(F.avg("score")).first()[0] < 1


def test_split_is_stratified_disjoint_and_repeatable(feature_frame):
    rows = stratified_split(feature_frame).select(*KEY, "label", "split").collect()
    assert len(rows) == feature_frame.count()
    for label in (0, 1):
        of_class = [r["split"] for r in rows if r["label"] == label]
        for name, share in (("train", 0.6), ("val", 0.2), ("test", 0.2)):
            assert abs(of_class.count(name) - share * len(of_class)) <= 1
    again = stratified_split(feature_frame.repartition(7)).select(*KEY, "label", "split").collect()
    assert sorted(rows) == sorted(again)


def test_split_by_machine_keeps_machines_together(feature_frame):
    by = F.xxhash64("machineid")
    rows = stratified_split(feature_frame.withColumn("label", F.lit(0)), by=by).select("machineid", "split").distinct()
    assert rows.count() == feature_frame.select("machineid").distinct().count()


def test_folds_partition_each_class(feature_frame):
    counts = stratified_folds(feature_frame).groupBy("label", "fold").count().collect()
    assert {r["fold"] for r in counts} == set(range(5))
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["label"] == label]
        assert max(sizes) - min(sizes) <= 1


def test_class_weights(feature_frame):
    n = {r["label"]: r["count"] for r in feature_frame.groupBy("label").count().collect()}
    assert positive_weight(feature_frame).first()["scale_pos_weight"] == pytest.approx(n[0] / n[1])
    for r in balanced_weights(feature_frame).collect():
        assert r["class_weight"] == pytest.approx(sum(n.values()) / 2 / n[r["label"]])
    assert positive_weight(feature_frame.where("label = 0")).first()["scale_pos_weight"] == 1.0


def test_logistic_minimises_the_penalised_loss(feature_frame):
    """Gradient of sum(w * log loss) + |b|^2 / 2 vanishes at the solution."""
    few = ["age", "vibration_mean_24h", "error_count_24h"]
    model = fit_logistic(feature_frame, few, [], max_iter=500)
    weight = {r["label"]: r["class_weight"] for r in balanced_weights(feature_frame).collect()}
    scored = model.score(feature_frame)
    pdf = scored.select("label", "score", *[model.preparation.scaled(c).alias(f"x_{c}") for c in few]).toPandas()
    w = pdf["label"].map(weight)
    for i, c in enumerate(few):
        gradient = (w * (pdf["score"] - pdf["label"]) * pdf[f"x_{c}"]).sum() + model.model.coefficients[i]
        assert abs(gradient) < 0.05


@pytest.mark.parametrize("kind, column", [("linear", "coefficient"), ("boosted", "gain")])
def test_base_models(spark, ensemble, feature_frame, kind, column):
    model = getattr(ensemble, kind)
    p = [r["score"] for r in model.score(feature_frame).select("score").collect()]
    assert len(p) == feature_frame.count() and all(0 <= x <= 1 for x in p)
    values = [r[column] for r in model.importance(spark).collect()]
    assert len(values) == len(model.preparation.names) and values == sorted(values, reverse=True)


def test_report_has_all_metrics(parts, ensemble):
    row = training.test_report(ensemble.linear, parts.test).first()
    assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == parts.test.count()
    assert all(0 <= row[c] <= 1 for c in ("pr_auc", "average_precision", "precision", "recall", "specificity", "f1"))


def test_ensemble_threshold_cost_and_labels(parts, ensemble):
    assert 0 < ensemble.threshold < 1
    row = ensemble.evaluate(parts.test).first()
    assert row["business_cost"] == 5 * row["fn"] + row["fp"]
    wrong = ensemble.predict(parts.test).where((F.col("score") >= ensemble.threshold).cast("int") != F.col("predicted"))
    assert wrong.count() == 0


def test_unfitted_meta_learner_raises(ensemble, feature_frame):
    with pytest.raises(ValueError, match="not fitted"):
        Ensemble(ensemble.linear, ensemble.boosted).score(feature_frame)


def test_save_and_load_give_the_same_scores(spark, ensemble, saved, feature_frame):
    again = Ensemble.load(spark, saved)
    assert again.threshold == ensemble.threshold
    both = again.score(ensemble.score(feature_frame, "a").drop("p_linear", "p_boosted"), "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_grid_search_returns_the_best_point(parts):
    best, tried, models = training.search(parts.train, parts.val, {"max_depth": [1, 2], "learning_rate": [0.3], "n_estimators": [3]})
    rows = tried.collect()
    assert set(models) == {(1, 0.3, 3), (2, 0.3, 3)}
    assert len(rows) == 2 and best["max_depth"] == max(rows, key=lambda r: r["pr_auc"])["max_depth"]


def test_cross_validation_and_ablation(parts):
    scores = training.cross_validate(parts.train, folds=2, max_iter=20)
    assert scores.count() == 2
    summary = training.cross_validation_summary(scores).first()
    assert 0 < summary["mean_pr_auc"] <= 1 and summary["std_pr_auc"] >= 0
    params = {"max_depth": 2, "learning_rate": 0.3, "n_estimators": 3, "scale_pos_weight": 1.0, "seed": 1}
    rows = {r["feature_set"]: r for r in training.ablation(parts, params).collect()}
    drop = rows["full_feature_set"]["pr_auc"] - rows["failure_history_removed"]["pr_auc"]
    assert rows["full_feature_set"]["pr_auc_drop"] == pytest.approx(drop, abs=1e-4)


def test_risk_levels_and_rounding(ensemble, feature_frame):
    rows = scoring.score_rows(ensemble, feature_frame).collect()
    t = ensemble.threshold
    for r in rows:
        assert r["risk_level"] == ("HIGH" if r["score"] >= t else "MEDIUM" if r["score"] >= t / 2 else "LOW")
        assert r["failure_probability"] == round(r["failure_probability"], 6)


def test_partial_and_odd_feature_maps(spark, ensemble):
    rows = spark.createDataFrame([
        ("1", '{"age": 15, "model": "model3", "voltage_mean_3h": "169.5"}'),
        ("2", '{"age": null, "model": "model9"}'), ("3", "{}"), ("4", "not json"),
    ], "machineid string, features string").withColumn("observation_time", F.lit("2026-01-01").cast("timestamp_ntz"))
    typed = scoring.from_feature_map(rows)
    got = {r["machineid"]: r for r in typed.collect()}
    assert got["1"]["age"] == 15.0 and got["1"]["voltage_mean_3h"] == 169.5 and got["1"]["model"] == "model3"
    assert got["2"]["age"] is None and got["3"]["model"] is None and got["4"]["age"] is None
    assert scoring.score_batch(ensemble, typed).count() == 4
    assert scoring.score_batch(ensemble, typed.limit(0)).count() == 0


def test_logged_features_can_be_read_back(ensemble, feature_frame):
    log = scoring.log_rows(ensemble, feature_frame)
    back = scoring.from_feature_map(log.select(*KEY, "features")).select(*KEY, *NUMERIC_FEATURES)
    assert sorted(back.collect()) == sorted(feature_frame.select(*KEY, *NUMERIC_FEATURES).collect())
    assert log.select("prediction_id").distinct().count() == feature_frame.count()


def test_linear_impacts_add_up(ensemble, feature_frame):
    names = ensemble.linear.preparation.names
    all_of_them = explain.linear_impacts(ensemble.linear, feature_frame, k=len(names))
    sums = all_of_them.groupBy(*KEY).agg(F.sum("impact").alias("s"))
    scored = ensemble.linear.score(feature_frame).select(*KEY, F.ln(F.col("score") / (1 - F.col("score"))).alias("logit"))
    off = scored.join(sums, KEY).where(F.abs(F.col("logit") - F.col("s") - ensemble.linear.model.intercept) > 1e-6)
    assert off.count() == 0


def test_tree_impacts_add_up_to_the_log_odds(ensemble, saved, feature_frame):
    rows = feature_frame.select(*KEY, *NUMERIC_FEATURES, "model", "age_category")
    attributed, base = explain.tree_attributions(ensemble.boosted, f"{saved}/boosted", rows)
    total = sum((F.col(f"imp_{i}") for i in range(len(ensemble.boosted.preparation.names))), F.lit(0.0))
    scored = ensemble.boosted.score(feature_frame).select(*KEY, F.ln(F.col("score") / (1 - F.col("score"))).alias("logit"))
    off = scored.join(attributed.select(*KEY, total.alias("t")), KEY).where(F.abs(F.col("logit") - F.col("t") - base) > 1e-6)
    assert off.count() == 0


def test_top_impacts_are_ordered(ensemble, saved, feature_frame):
    top = explain.tree_impacts(ensemble.boosted, f"{saved}/boosted", feature_frame, 5)
    rows = top.where("machineid = '3'").orderBy(*KEY, "rank").collect()
    assert {r["rank"] for r in rows} == {1, 2, 3, 4, 5}
    for a, b in zip(rows, rows[1:]):
        if a["observation_time"] == b["observation_time"]:
            assert abs(a["impact"]) >= abs(b["impact"])


def _shapley_by_subsets(value, shares, passed):
    m = len(shares)

    def known(present):
        return value * np.prod([passed[i] if i in present else shares[i] for i in range(m)])

    def of(j):
        others = [i for i in range(m) if i != j]
        return sum(factorial(len(s)) * factorial(m - len(s) - 1) / factorial(m) * (known({*s, j}) - known(set(s)))
                   for size in range(m) for s in combinations(others, size))

    return [of(j) for j in range(m)]


@pytest.mark.parametrize("shares", [[0.3], [0.3, 0.6], [0.3, 0.6, 0.25], [0.9, 0.1, 0.5, 0.7, 0.2, 0.4, 0.35]])
def test_leaf_values_equal_shapley_values_from_the_definition(shares):
    m = len(shares)
    leaf = trees.Leaf(2.0, np.arange(m), np.array(shares), np.zeros(m), np.ones(m))
    patterns = np.array([[code >> i & 1 for i in range(m)] for code in range(1 << m)], dtype=float)
    got = trees.shapley(leaf, patterns)
    for pattern, values in zip(patterns, got):
        assert values == pytest.approx(_shapley_by_subsets(2.0, shares, pattern))


def test_deep_attributions_add_up():
    """300 random trees of depth 7: attributions sum to the margin less what is expected of an unknown row."""
    rng, nodes = np.random.default_rng(1), {k: [] for k in ("feature", "threshold", "left", "right", "value", "weight")}
    roots = []

    def grow(depth, weight):
        at = len(nodes["feature"])
        leaf = depth == 0
        for k, v in zip(nodes, (-1 if leaf else rng.integers(20), rng.random(), -1, -1, rng.normal() if leaf else 0.0, weight)):
            nodes[k].append(v)
        if not leaf:
            share = rng.uniform(0.1, 0.9)
            nodes["left"][at], nodes["right"][at] = grow(depth - 1, weight * share), grow(depth - 1, weight * (1 - share))
        return at

    for _ in range(300):
        roots.append(grow(7, 1000.0))
    forest = trees.Trees(np.array(roots), *(np.array(v) for v in nodes.values()))
    x = rng.random((40, 20))
    stages = forest.stages(x)
    assert stages.shape == (40, 300)
    total = trees.attributions(list(forest.leaves()), x).sum(axis=1)
    assert np.allclose(total, stages[:, -1] - forest.expected())


def test_every_stage_has_the_area_of_its_own_model(parts):
    """The first k stages score like a model of k trees, and their areas are those of the exact curve."""
    prepared = prepare_boosted(parts.train, scale_pos_weight=3.0)
    held = prepare_boosted(parts.val, preparation=prepared.preparation, scale_pos_weight=3.0)
    whole = fit_prepared(prepared, max_depth=3, learning_rate=0.3, n_estimators=6)
    staged = training.staged_scores(whole, held.vectors)
    areas = {r["trees"]: (r["pr_auc"], r["average_precision"]) for r in curve_areas_by(staged, "trees").collect()}
    assert set(areas) == set(range(1, 7))
    for k in (1, 4, 6):
        alone = fit_prepared(prepared, max_depth=3, learning_rate=0.3, n_estimators=k)
        exact = curve_areas(alone.score(parts.val)).first()
        assert areas[k] == pytest.approx((exact["pr_auc"], exact["average_precision"]))


def test_trees_of_one_task_are_those_of_spark(monkeypatch, parts):
    """Under 10,000 rows thresholds are the same too, and rows that were trained on have the same scores.

    Where two features part these rows alike either may be tested, so other rows may differ.
    """
    prepared = prepare_boosted(parts.train, scale_pos_weight=3.7)
    params = {"max_depth": 4, "learning_rate": 0.2, "n_estimators": 8}
    found = []
    for values in (models.VALUES_IN_A_TASK, 0):
        monkeypatch.setattr(models, "VALUES_IN_A_TASK", values)
        model = fit_prepared(prepared, **params)
        scores = {tuple(r)[:2]: r["score"] for r in model.score(parts.train).select(*KEY, "score").collect()}
        found.append((scores, training.stage_areas(model, prepared), model.model.totalNumNodes))
        assert model.model.getNumTrees == 8 and model.model.treeWeights == [1.0] + [0.2] * 7 and model.model.getMaxIter() == 8
    (scores, areas, nodes), (scores_by_jobs, areas_by_jobs, nodes_by_jobs) = found
    assert scores == pytest.approx(scores_by_jobs) and areas == pytest.approx(areas_by_jobs) and len(areas) == 8
    assert nodes == nodes_by_jobs


def test_a_fit_has_as_many_jobs_whatever_the_trees(spark, parts):
    prepared, jobs = prepare_boosted(parts.train, scale_pos_weight=3.0), []
    for trees_wanted in (2, 12):
        spark.sparkContext.setJobGroup(f"fit-{trees_wanted}", "a fit")
        fit_prepared(prepared, max_depth=3, n_estimators=trees_wanted)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{trees_wanted}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[0] == jobs[1]


def test_thresholds_are_midpoints_or_weighted_quantiles():
    assert boosting.thresholds(np.array([3.0, 0.0, 1.0, 1.0]), np.ones(4)).tolist() == [0.5, 2.0]
    assert boosting.thresholds(np.zeros(5), np.ones(5)).tolist() == []
    cuts = boosting.thresholds(np.arange(3200.0), np.ones(3200))
    assert cuts.tolist() == [100 * k - 0.5 for k in range(1, 32)]
    heavy = boosting.thresholds(np.arange(3200.0), np.where(np.arange(3200) < 1600, 3.0, 1.0))
    assert len(heavy) == 31 and (heavy < 1600).sum() in (23, 24)


@pytest.mark.parametrize("labels", [[0, 2], [1, -1]])
def test_other_labels_than_two_are_refused(labels):
    with pytest.raises(ValueError, match="labels"):
        boosting._Rows(np.zeros((1, 2)), np.array(labels, dtype=float), 1.0)


def test_rows_alike_make_one_leaf():
    for labels in ([0, 0, 0], [1, 1, 1], [0, 1, 0]):
        rows = boosting._Rows(np.ones((2, 3)), np.array(labels, dtype=float), 2.0)
        grown = list(boosting.boosted(rows, 3, 0.1, 4))
        assert [len(nodes) for nodes in grown] == [1] * 4 and [n[0]["rawCount"] for n in grown] == [3] * 4
    share = (-1 + 2 - 1) / 4  # the positive weighs two
    assert grown[0][0]["prediction"] == pytest.approx(share)


def test_area_of_an_array_is_the_exact_one(spark):
    rows = [(int(i * 7 % 5 == 0), (i * 13 % 40) / 40) for i in range(200)]
    exact = curve_areas(spark.createDataFrame(rows, "label int, score double")).first()["pr_auc"]
    label, score = (np.array(c, dtype=float) for c in zip(*rows))
    assert pr_auc_of(label, score) == pytest.approx(exact)
    assert pr_auc_of(np.zeros(3), np.ones(3)) is None


def test_boosting_stops_after_rounds_without_a_gain():
    assert training.best_stage([0.1, 0.3, 0.2, 0.25, 0.9], patience=2) == (2, 0.3)
    assert training.best_stage([0.1, 0.3, 0.2, 0.25, 0.9], patience=3) == (5, 0.9)
    assert training.best_stage([None, 0.2, 0.2], patience=10) == (2, 0.2)
    assert training.best_stage([None, None], patience=1)[0] == 0


def test_training_rows_are_bounded(feature_frame):
    few = prepare_boosted(feature_frame, max_training_rows=200)
    n = few.vectors.count()
    assert 120 < n < 280 and few.vectors.rdd.getNumPartitions() == 1
    assert few.scale_pos_weight == prepare_boosted(feature_frame).scale_pos_weight


def test_all_rows_are_trained_on(spark, feature_frame):
    many = feature_frame.select("label", *KEY, "age", "model").crossJoin(spark.range(300)).withColumn(
        "observation_time", F.expr("observation_time + MAKE_DT_INTERVAL(0, 0, 0, id)"))
    prepared = prepare_boosted(many, ["age"], ["model"])
    assert prepared.vectors.count() == 300 * feature_frame.count() > 200_000


def test_fits_side_by_side_equal_fits_one_by_one(spark, parts):
    grid = {"max_depth": [1, 3], "learning_rate": [0.1, 0.3], "n_estimators": [2, 5]}
    _, tried, _ = training.search(parts.train, parts.val, grid)
    for row in tried.collect():
        single = {k: [row[k]] for k in grid}
        assert training.search(parts.train, parts.val, single)[1].first() == row
    assert training.concurrently(spark, lambda i: i * 2, [3, 1, 2]) == [6, 2, 4]


def test_model_state_survives_alone(spark, saved):
    assert FittedModel.load(spark, f"{saved}/boosted").params["max_depth"] == 3
