"""Every operator as a named query over one test-data folder.

A query takes (spark, folder) and returns a DataFrame; all of them read whole
tables. Functions are looked up lazily so that importing the catalog is cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from types import SimpleNamespace

from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import num, plain
from fleetlens.operators import checks, drift, explain, promote, scoring, sketches, split, traffic, training
from fleetlens.operators import distributions as di
from fleetlens.operators import evaluate as ev
from fleetlens.operators import failures as fa
from fleetlens.operators import features as ft
from fleetlens.operators import prototypes as fp
from fleetlens.operators import quality as dq
from fleetlens.operators import sensors as te
from fleetlens.operators import service as ma
from fleetlens.operators.ensemble import Ensemble, train_ensemble
from fleetlens.operators.models import FittedModel, fit_boosted, fit_logistic
from fleetlens.operators.promote import KINDS
from fleetlens.operators.preprocess import Preparation, apply_columns, learn
from fleetlens.schemas import STAGING_COLUMNS
from fleetlens.session import scratch_root
from fleetlens.sources import files
from fleetlens.sources.fixtures import Fleet, fleet
from fleetlens.sources.log import Gate, append_batch, read_log, violations
from fleetlens.streaming.features import rolling_sensors_stream
from fleetlens.streaming.run import drain
from fleetlens.streaming.scoring import prediction_log_stream
from fleetlens.streaming.traffic import latency_quantile_stream, request_rate_stream

Query = Callable[[SparkSession, str], DataFrame]


def _on(build: Callable[[Fleet], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(fleet(spark, sf_dir)))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, so that engines agree on the text."""
    return df.select(*[
        num(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def _five(f: Fleet):
    return f.machines, f.telemetry, f.errors, f.maintenance, f.failures


def quality_queries() -> dict[str, Query]:
    return {
        "dq1_row_counts": _on(lambda f: dq.row_counts({
            "machines": f.machines, "telemetry": f.telemetry, "errors": f.errors,
            "maintenance": f.maintenance, "failures": f.failures})),
        "dq2_temporal_coverage": _on(lambda f: dq.temporal_coverage({
            "telemetry": f.telemetry, "failures": f.failures, "maintenance": f.maintenance})),
        "dq3_telemetry_nulls": _on(lambda f: dq.telemetry_nulls(f.telemetry)),
        "dq4_event_nulls": _on(lambda f: dq.event_nulls({
            "errors": (f.errors, "errorid"), "maintenance": (f.maintenance, "comp"),
            "failures": (f.failures, "failure")})),
        "dq5_duplicate_readings": _on(lambda f: dq.duplicate_readings(f.telemetry)),
        "dq6_orphan_rows": _on(lambda f: dq.orphan_rows({
            "telemetry": f.telemetry, "errors": f.errors, "failures": f.failures,
            "maintenance": f.maintenance}, f.machines)),
        "dq7_machine_coverage": _on(lambda f: dq.machine_coverage(f.machines, f.telemetry)),
        "dq8_failure_classes": _on(lambda f: dq.failure_classes(f.failures)),
        "dq9_worst_machines": _on(lambda f: dq.worst_machines(f.machines, f.failures)),
        "dq10_error_frequency": _on(lambda f: dq.error_frequency(f.errors)),
        "dq11_age_summary": _on(lambda f: dq.age_summary(f.machines)),
    }


def exploration_queries() -> dict[str, Query]:
    return {
        "di1_fleet_by_model": _on(lambda f: di.fleet_by_model(f.machines)),
        "di2_fleet_by_age": _on(lambda f: di.fleet_by_age(f.machines)),
        "di3_burden_by_model": _on(lambda f: di.burden_by_model(f.machines, f.failures)),
        "di4_burden_by_age": _on(lambda f: di.burden_by_age(f.machines, f.failures)),
        "di5_failure_types_by_model": _on(lambda f: di.failure_types_by_model(f.machines, f.failures)),
        "di6_pareto": _on(lambda f: di.pareto(f.machines, f.failures)),
        "di7_never_failed": _on(lambda f: di.never_failed(f.machines, f.failures)),
        "fa1_failure_sequence": _on(lambda f: fa.failure_sequence(f.failures)),
        "fa2_time_between_failures": _on(lambda f: fa.time_between_failures(f.failures)),
        "fa3_mean_time_between_failures": _on(lambda f: fa.mean_time_between_failures(f.failures)),
        "fa4_cumulative_failures": _on(lambda f: fa.cumulative_failures(f.machines, f.failures)),
        "fa5_monthly_failures": _on(lambda f: fa.monthly_failures(f.failures)),
        "te1_sensor_summary_wide": _on(lambda f: te.sensor_summary_wide(f.telemetry)),
        "te2_sensor_summary_long": _on(lambda f: te.sensor_summary_long(f.telemetry)),
        "te3_rolling_averages": _on(lambda f: te.rolling_averages(f.telemetry)),
        "te4_pre_failure_means": _on(lambda f: te.pre_failure_means(f.telemetry, f.failures)),
        "te5_pre_failure_spread": _on(lambda f: te.pre_failure_spread(f.telemetry, f.failures)),
        "te6_pre_failure_deltas": _on(lambda f: te.pre_failure_deltas(f.telemetry, f.failures)),
        "ma1_services_by_component": _on(lambda f: ma.services_by_component(f.maintenance)),
        "ma2_failures_after_service": _on(lambda f: ma.failures_after_service(f.maintenance, f.failures)),
        "ma3_failure_rate_after_service": _on(
            lambda f: ma.failure_rate_after_service(f.maintenance, f.failures)),
        "ma3_failure_rate_per_service": _on(
            lambda f: ma.failure_rate_after_service(f.maintenance, f.failures, dedupe=True)),
        "ma4_services_without_later_failure": _on(
            lambda f: ma.services_without_later_failure(f.maintenance, f.failures)),
        "ma5_time_to_next_failure": _on(lambda f: ma.time_to_next_failure(f.maintenance, f.failures)),
    }


def feature_queries() -> dict[str, Query]:
    return {
        "fp1_static": _on(lambda f: fp.static_prototype(f.machines)),
        "fp2_rolling": _on(lambda f: _rounded(fp.rolling_prototype(f.telemetry))),
        "fp3_errors": _on(lambda f: fp.errors_prototype(f.telemetry, f.errors)),
        "fp4_service": _on(lambda f: fp.service_prototype(f.telemetry, f.maintenance)),
        "fp5_failures": _on(lambda f: fp.failures_prototype(f.telemetry, f.failures)),
        "fp6_assembled": _on(lambda f: _rounded(fp.assembled_prototype(*_five(f)))),
        "fp7_rolling_with_label": _on(lambda f: _rounded(fp.rolling_with_label(f.telemetry, f.failures))),
        "f1_static": _on(lambda f: ft.static_features(f.machines)),
        "f2_rolling_sensors": _on(lambda f: ft.rolling_sensors(f.telemetry)),
        "f3_errors": _on(lambda f: ft.error_features(f.telemetry, f.errors)),
        "f4_service": _on(lambda f: ft.service_features(f.telemetry, f.maintenance)),
        "f5_failure_history": _on(lambda f: ft.failure_features(f.telemetry, f.failures)),
        "l1_label": _on(lambda f: ft.labels(f.telemetry, f.failures)),
        "f6_features": _on(lambda f: ft.build_features(*_five(f))),
        "f6_features_dedupe": _on(lambda f: ft.build_features(*_five(f), dedupe=True)),
        "v1_total_rows": _on(lambda f: ft.total_rows(ft.build_features(*_five(f)))),
        "v1_class_balance": _on(lambda f: ft.class_balance(ft.build_features(*_five(f)))),
        "v1_non_null_share": _on(lambda f: ft.non_null_share(ft.build_features(*_five(f)))),
        "v1_time_range": _on(lambda f: ft.time_range(ft.build_features(*_five(f)))),
    }


# Queries below train or write. They share one stored feature table and one
# trained ensemble per folder, as separate jobs of a pipeline would.

LR_ITERATIONS = 1000

_stored: dict[tuple, str] = {}


def _version(f: Fleet) -> tuple:
    """Session, folder and the files in it: new files are new data."""
    files_read = sorted(f.parquet("events").inputFiles() + f.parquet("supplier").inputFiles())
    return f.spark.sparkContext.applicationId, f.sf_dir, tuple(files_read)


def _stored_path(f: Fleet, what: str, build: Callable[[str], object]) -> str:
    key = (*_version(f), what)
    if key not in _stored:
        path = f"{scratch_root(f.spark)}/{what}"
        build(path)
        _stored[key] = path
    return _stored[key]


def _features(f: Fleet) -> DataFrame:
    path = _stored_path(f, "features", lambda p: files.store_features(ft.build_features(*_five(f)), p))
    return files.read_features(f.spark, path)


_splits: dict[tuple, training.Parts] = {}


def _parts(f: Fleet) -> training.Parts:
    key = _version(f)
    if key not in _splits:
        _splits[key] = training.split_parts(_features(f))
    return _splits[key]


_searches: dict[tuple, tuple[dict, DataFrame, dict]] = {}


def _search(f: Fleet) -> tuple[dict, DataFrame, dict]:
    """Best parameters, a row per point of the training grid, and the models fitted on train rows."""
    key = _version(f)
    if key not in _searches:
        parts = _parts(f)
        weight = split.positive_weight(parts.table).first()["scale_pos_weight"]
        _searches[key] = training.search(parts.train, parts.val, training.TRAINING_GRID, weight)
    return _searches[key]


def _boosted(f: Fleet) -> FittedModel:
    """The best point fitted again on train and validation rows."""
    path = _stored_path(f, "boosted", lambda p: fit_boosted(_parts(f).fit_rows, **_search(f)[0]).save(f.spark, p))
    return FittedModel.load(f.spark, path)


def _ensemble_path(f: Fleet) -> str:
    def train(path):
        linear = fit_logistic(_parts(f).fit_rows, max_iter=LR_ITERATIONS)
        train_ensemble(linear, _boosted(f), _parts(f).val).save(f.spark, path)

    return _stored_path(f, "ensemble", train)


def _ensemble(f: Fleet) -> Ensemble:
    return Ensemble.load(f.spark, _ensemble_path(f))


def _scratch(f: Fleet) -> str:
    return scratch_root(f.spark)


def _raw_folder(f: Fleet, leave_out: tuple[str, ...] = (), kind: str = "staging") -> str:
    """CSV files as the loader expects them."""
    folder = _scratch(f)
    names = {"machines": "PdM_machines.csv", "telemetry": "PdM_telemetry.csv", "errors": "PdM_errors.csv",
             "maintenance": "PdM_maint.csv", "failures": "PdM_failures.csv"}
    for table, name in names.items():
        if table not in leave_out:
            upper = [c.upper() for c in STAGING_COLUMNS[table]]
            files.write_csv_text(f.table(f"{kind}_{table}").toDF(*upper), f"{folder}/{name}")
    return folder


def _csv_source(f: Fleet) -> DataFrame:
    return files.read_csv_text(f.spark, f"{_raw_folder(f)}/PdM_telemetry.csv")


def _csv_folder(f: Fleet) -> DataFrame:
    return files.loaded_report(*files.read_staging(f.spark, _raw_folder(f, leave_out=("maintenance",))))


def _loaded(f: Fleet, repeats: int) -> dict[str, DataFrame]:
    """CSV to base tables; loading twice must leave the same tables."""
    staging, _ = files.read_staging(f.spark, _raw_folder(f))
    folder = _scratch(f)
    for _ in range(repeats):
        stored = files.load_base_tables(promote.promote(staging), folder)
    return stored


def _loaded_rows(f: Fleet, repeats: int) -> DataFrame:
    """All rows of the loaded tables, without the ids that a load gives out."""
    tables = [df.drop("id").withColumnsRenamed({c: "detail" for c in ("model", "errorid", "comp", "failure")}).withColumn("table_name", F.lit(name))
              for name, df in _loaded(f, repeats).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


_reports: dict[tuple, DataFrame] = {}


def _quarantine(f: Fleet) -> tuple[str, DataFrame]:
    """Folder and report of a load with quarantine."""
    def load(path):
        staging, _ = files.read_staging(f.spark, _raw_folder(f, kind="spoilt"), with_source=True)
        _reports[_version(f)] = files.load_with_quarantine(staging, path)

    return _stored_path(f, "quarantine", load), _reports[_version(f)]


def _rejected(f: Fleet, table: str) -> DataFrame:
    rows = files.rejected_rows(f.spark, _quarantine(f)[0], table)
    return rows.withColumn("source_file", F.regexp_extract("source_file", r"(PdM_\w+\.csv)/", 1))


def _accepted(f: Fleet, table: str) -> DataFrame:
    return files.accepted_rows(f.spark, _quarantine(f)[0], table)


def quarantine_queries() -> dict[str, Query]:
    numbered = dict(zip(KINDS, range(1, 6)))
    return {
        "p0_quarantine_report": _on(lambda f: _quarantine(f)[1]),
        **{f"p{i}_{t}_accepted": _on(lambda f, t=t: _accepted(f, t)) for t, i in numbered.items()},
        **{f"p{i}_{t}_rejected": _on(lambda f, t=t: _rejected(f, t)) for t, i in numbered.items()},
    }


def _log_batch(f: Fleet, when: str) -> DataFrame:
    return f.table("log_rows").where(when)


def _log_gate(f: Fleet) -> Gate:
    columns = ["prediction_id", "predicted_at", "machineid", "failure_probability", "predicted_label"]
    return Gate(["prediction_id"], columns, checks.prediction_rules(), {"machineid": (f.machines, "machineid")})


def _retried_log(f: Fleet) -> str:
    """Batches by id modulo 5: some sent twice, one torn before its manifest, one refused."""
    def build(path):
        for part in (0, 1, 0, 2, 2):
            append_batch(_log_batch(f, f"prediction_id % 5 = {part}"), path, f"part-{part}")
        _log_batch(f, "prediction_id % 5 = 3").write.parquet(f"{path}/data/batch=part-3/attempt=torn")

    return _stored_path(f, "retried_log", build)


def _read_retried(f: Fleet) -> DataFrame:
    return read_log(f.spark, _retried_log(f), f.table("log_rows").schema)


def _gate_report(f: Fleet) -> DataFrame:
    """What a batch of all rows of some machines, some of them twice, would break after two thirds of the rows were committed."""
    gate = _log_gate(f)

    def build(path):
        sound = _log_batch(f, "prediction_id % 3 < 2 AND failure_probability <= 1").join(f.machines, "machineid", "left_semi")
        append_batch(sound.select(f.table("log_rows").columns), path, "first", gate)

    path = _stored_path(f, "gated_log", build)
    again = _log_batch(f, "prediction_id % 3 > 0").union(_log_batch(f, "prediction_id % 30 = 2"))
    doubtful = again.withColumn("machineid", F.when(F.col("prediction_id") % 7 > 0, F.col("machineid")))
    return violations(doubtful, path, gate)


def _prediction_log(f: Fleet) -> str:
    """The same batch sent twice: a job that ran again."""
    def build(path):
        for _ in range(2):
            append_batch(scoring.log_rows(_ensemble(f), _features(f), F.col("observation_time")), path, "features")

    return _stored_path(f, "prediction_log", build)


def _log(f: Fleet) -> DataFrame:
    return read_log(f.spark, _prediction_log(f), scoring.LOG_SCHEMA)


def _logged(f: Fleet) -> DataFrame:
    return _log(f).where(F.col("features").isNotNull())


def _monitored(f: Fleet) -> DataFrame:
    return drift.monitoring_rows(_fixture_drift(f), F.lit("2024-02-01 06:00:00").cast("timestamp"))


def _monitor_log(f: Fleet) -> DataFrame:
    path = f"{_scratch(f)}/model_monitoring"
    for _ in range(2):
        append_batch(_monitored(f), path, "2024-02-01")
    return read_log(f.spark, path, _monitored(f).schema)


def _metric_export(f: Fleet) -> DataFrame:
    path = f"{_scratch(f)}/metrics"
    scored = ev.predict_at(f.scored, 0.3)
    files.export_json(_rounded(ev.report(scored)), f"{path}/json")
    return f.spark.read.json(f"{path}/json")


def _importance_export(f: Fleet) -> DataFrame:
    path = f"{_scratch(f)}/importance"
    files.export_csv(_ensemble(f).linear.importance(f.spark), path)
    return files.read_csv_text(f.spark, path)


def storage_queries() -> dict[str, Query]:
    return {
        "s1_csv_source": _on(_csv_source),
        "s2_csv_folder": _on(_csv_folder),
        "s3_base_load": _on(lambda f: dq.row_counts(_loaded(f, 1))),
        "s3_loaded_rows": _on(lambda f: _loaded_rows(f, 1)),
        "s4_feature_store": _on(lambda f: _features(f).agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))),
        "s5_repeated_load": _on(lambda f: dq.row_counts(_loaded(f, 2))),
        "s5_reloaded_rows": _on(lambda f: _loaded_rows(f, 2)),
        "s6_feature_read": _on(_features),
        "s7_prediction_log": _on(_log),
        "s7_retried_batches": _on(_read_retried),
        "s8_monitoring_log": _on(lambda f: _rounded(plain(_monitor_log(f)), 4)),
        "s9_reference_sample": _on(lambda f: files.reference_sample(_features(f), 5000)),
        "s10_log_read": _on(lambda f: _logged(f).agg(F.count(F.lit(1)).alias("logged"))),
        "s11_metric_export": _on(_metric_export),
        "s11_importance_export": _on(_importance_export),
        "p1_machines": _on(lambda f: promote.machines(f.table("staging_machines"))),
        "p2_telemetry": _on(lambda f: promote.telemetry(f.table("staging_telemetry"))),
        "p3_errors": _on(lambda f: promote.errors(f.table("staging_errors"))),
        "p4_maintenance": _on(lambda f: promote.maintenance(f.table("staging_maintenance"))),
        "p5_failures": _on(lambda f: promote.failures(f.table("staging_failures"))),
    }


def check_queries() -> dict[str, Query]:
    required = ["datetime", "machineid"]
    return {
        "c1_primary_key": _on(lambda f: checks.repeated_keys(f.telemetry, "machineid", "datetime")),
        "c1_machine_key": _on(lambda f: checks.repeated_keys(f.machines, "machineid")),
        "c2_foreign_key": _on(lambda f: checks.missing_parents({
            "telemetry": f.telemetry, "errors": f.errors, "maintenance": f.maintenance,
            "failures": f.failures}, f.machines)),
        "c3_not_null": _on(lambda f: checks.null_values({
            "machines": (f.machines, ["machineid", "model", "age"]),
            "telemetry": (f.telemetry, [*required, "volt"]),
            "errors": (f.errors, [*required, "errorid"]),
            "maintenance": (f.maintenance, [*required, "comp"]),
            "failures": (f.failures, [*required, "failure"])})),
        "c1_to_c4_gate": _on(_gate_report),
        # Scores are stretched beyond their range so that the rules find something.
        "c4_check": _on(lambda f: checks.failed_checks(
            f.scored.select((F.col("score") * 4).alias("p"), (F.col("label") * 2).alias("y")),
            checks.prediction_rules("p", "y"))),
        "c5_unique_observation": _on(lambda f: checks.repeated_keys(
            _features(f), "machineid", "observation_time").agg(F.count(F.lit(1)).alias("repeated"))),
    }


def _named(f: Fleet, columns: Callable) -> DataFrame:
    rows = _features(f)
    keys = ["machineid", "observation_time"]
    return _rounded(apply_columns(rows, columns(rows), keys))


def _imputed(rows: DataFrame):
    prep = learn(rows)
    return {name: prep.imputed(name) for name in prep.numeric}


def _standardised(rows: DataFrame):
    prep = learn(rows)
    return {name: prep.scaled(name) for name in prep.numeric}


def _cross_validation(f: Fleet) -> DataFrame:
    path = _stored_path(f, "cross_validation", lambda p: training.cross_validate(
        _parts(f).train, max_iter=LR_ITERATIONS).write.parquet(p))
    return f.spark.read.parquet(path)


def _out_of_sample(f: Fleet) -> DataFrame:
    """Base models that have not seen the validation rows the meta learner is fitted on."""
    parts = _parts(f)
    linear = fit_logistic(parts.train, max_iter=LR_ITERATIONS)
    best, _, models = _search(f)
    found = models.get((best["max_depth"], best["learning_rate"], best["n_estimators"]))
    return train_ensemble(linear, found or fit_boosted(parts.train, **best), parts.val).evaluate(parts.test)


def _round_trip(f: Fleet) -> DataFrame:
    """Rows whose score changes when the ensemble is saved and loaded again."""
    first = _ensemble(f)
    path = f"{_scratch(f)}/copy"
    first.save(f.spark, path)
    rows = first.score(_features(f), "before")
    again = Ensemble.load(f.spark, path).score(rows.drop("p_linear", "p_boosted"), "after")
    return again.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_change"))


def model_queries() -> dict[str, Query]:
    keys = ["machineid", "observation_time", "label"]
    return {
        "m1_stratified_split": _on(lambda f: split.stratified_split(_features(f)).select(*keys, "split")),
        "m2_positive_weight": _on(lambda f: _rounded(split.positive_weight(_features(f)))),
        "m3_balanced_weight": _on(lambda f: _rounded(split.balanced_weights(_features(f)))),
        "m4_imputed": _on(lambda f: _named(f, _imputed)),
        "m5_standardised": _on(lambda f: _named(f, _standardised)),
        "m6_one_hot": _on(lambda f: _named(f, lambda rows: learn(rows).dummies())),
        "m7_logistic": _on(lambda f: training.test_report(
            fit_logistic(_parts(f).fit_rows, max_iter=LR_ITERATIONS), _parts(f).test)),
        "m8_cross_validation": _on(_cross_validation),
        "m8_cross_validation_summary": _on(lambda f: training.cross_validation_summary(_cross_validation(f))),
        "m9_boosted": _on(lambda f: training.test_report(
            fit_boosted(_parts(f).fit_rows, **training.PUBLISHED), _parts(f).test)),
        "m10_grid_search": _on(lambda f: _search(f)[1]),
        "m11_refit_and_test": _on(lambda f: training.test_report(_boosted(f), _parts(f).test)),
        "m12_coefficients": _on(lambda f: _ensemble(f).linear.importance(f.spark)),
        "m12_gains": _on(lambda f: _ensemble(f).boosted.importance(f.spark)),
        "m13_stacked": _on(lambda f: _ensemble(f).stack(_features(f)).select(*keys, "p_linear", "p_boosted")),
        "m14_meta_learner": _on(lambda f: _ensemble(f).evaluate(_parts(f).test)),
        "m14_meta_learner_out_of_sample": _on(_out_of_sample),
        "m15_threshold_sweep": _on(lambda f: ev.threshold_sweep(f.scored)),
        "m15_best_threshold": _on(lambda f: ev.best_threshold(f.scored)),
        "m16_predict": _on(lambda f: ev.predict_at(f.scored, 0.3).select("event_id", "score", "predicted")),
        "m17_ablation": _on(lambda f: training.ablation(_parts(f), _search(f)[0], full=_boosted(f))),
        "m18_round_trip": _on(_round_trip),
    }


def evaluation_queries() -> dict[str, Query]:
    def hard(f):
        return ev.predict_at(f.scored, 0.3)

    return {
        "e1_confusion": _on(lambda f: ev.confusion(hard(f))),
        "e2_pr_auc": _on(lambda f: _rounded(ev.curve_areas(f.scored)).select("pr_auc")),
        "e3_average_precision": _on(lambda f: _rounded(ev.curve_areas(f.scored)).select("average_precision")),
        "e4_rates": _on(lambda f: _rounded(ev.rates(ev.confusion(hard(f)))).drop("business_cost")),
        "e5_business_cost": _on(lambda f: ev.rates(ev.confusion(hard(f))).select("business_cost")),
        "e6_class_distribution": _on(lambda f: ev.class_distribution(f.scored)),
    }


FIXTURE_NUMERIC = ["k", "value"]
FIXTURE_CATEGORICAL = ["event_type"]


def _fixture_log(f: Fleet, extra: tuple[str, ...] = (), since: str | None = None) -> DataFrame:
    log = f.table("prediction_log")
    log = log.where(F.col("ts") >= F.lit(since).cast("timestamp")) if since else log
    return drift.logged_features(log, [*FIXTURE_NUMERIC, *extra], FIXTURE_CATEGORICAL)


def _fixture_drift(f: Fleet, test: str = drift.WASSERSTEIN) -> DataFrame:
    more = ("age", "flat")
    log = _fixture_log(f, more, "2024-01-16")
    return drift.drift_by_column(f.table("baseline"), log, [*FIXTURE_NUMERIC, *more], FIXTURE_CATEGORICAL, test)


def _feature_drift(f: Fleet) -> DataFrame:
    """Logged predictions against the training baseline, all 43 features, all rows."""
    return drift.drift_by_column(_features(f), drift.logged_features(_logged(f)))


def _sketched_drift(f: Fleet) -> DataFrame:
    """Which scores from daily sketches are off the exact ones by no more than they say."""
    log = f.table("prediction_log")
    late = log.where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp"))
    columns = [*FIXTURE_NUMERIC, "flat"]
    current = scoring.from_feature_map(late, "features", columns, [])
    parts = (sketches.column_sketches(f.table("baseline"), columns),
             sketches.column_sketches(current, columns, F.to_date("ts")))
    exact = drift.numeric_drift(f.table("baseline"), current, columns).select("feature_name", F.col("drift_score").alias("exact"))
    return sketches.sketched_drift(*parts).join(exact, "feature_name").select(
        "feature_name", num(F.col("exact"), 6).alias("exact"), (F.abs(F.col("drift_score") - F.col("exact")) <= F.col("error")).alias("within_error"))


# A linear model and a meta learner with given parameters, for results that do not depend on a fit.
GIVEN_MEANS = {"age": 10.0, "voltage_mean_3h": 170.0, "vibration_mean_24h": 42.0, "error_count_24h": 0.5, "days_since_last_failure": 8.0}
GIVEN_SCALES = {"age": 5.0, "voltage_mean_3h": 8.0, "vibration_mean_24h": 4.0, "error_count_24h": 1.0, "days_since_last_failure": 6.0}
GIVEN_MODELS = ["model1", "model2", "model3", "model4"]
GIVEN_COEFFICIENTS = [0.5, -0.25, 1.5, 0.75, -0.5, 0.125, -0.375, 0.625]
GIVEN_META = [-2.0, 3.0, 1.5]
GIVEN_THRESHOLD = 0.3


def _given_impacts(f: Fleet) -> DataFrame:
    prep = Preparation(list(GIVEN_MEANS), GIVEN_MEANS, GIVEN_SCALES, {"model": GIVEN_MODELS})
    model = FittedModel("logistic", prep, SimpleNamespace(coefficients=Vectors.dense(GIVEN_COEFFICIENTS)))
    return _rounded(explain.linear_impacts(model, _features(f)))


def _given_stack(f: Fleet) -> DataFrame:
    ensemble = Ensemble(None, None, GIVEN_META, GIVEN_THRESHOLD)
    rows = f.scored.select("event_id", F.col("score").alias("p_linear"), (F.col("score") * F.col("score")).alias("p_boosted"))
    scored = ev.predict_at(rows.withColumn("score", ensemble.probability()), ensemble.threshold)
    return scored.select("event_id", num(F.col("score"), 6).alias("probability"), "predicted",
                         scoring.risk_level(F.col("score"), ensemble.threshold).alias("risk_level"))


def scoring_queries() -> dict[str, Query]:
    return {
        "b1_batch_scores": _on(lambda f: scoring.score_batch(_ensemble(f), _features(f))),
        "b2_risk_level": _on(lambda f: f.scored.select(
            "event_id", "score", scoring.risk_level(F.col("score"), 0.3).alias("risk_level"))),
        "b3_feature_map": _on(lambda f: scoring.from_feature_map(
            f.table("prediction_log").drop("ts"), "features", FIXTURE_NUMERIC, FIXTURE_CATEGORICAL)),
        "b4_linear_impacts": _on(lambda f: explain.linear_impacts(_ensemble(f).linear, _features(f))),
        "b4_linear_impacts_given": _on(_given_impacts),
        "b1_given_stack": _on(_given_stack),
        "b4_tree_impacts": _on(lambda f: explain.tree_impacts(
            _ensemble(f).boosted, f"{_ensemble_path(f)}/boosted", _features(f))),
        "b4_tree_impacts_dashboard": _on(lambda f: explain.tree_impacts(
            _ensemble(f).boosted, f"{_ensemble_path(f)}/boosted", _features(f), 7)),
        "b5_log_rows": _on(lambda f: scoring.log_rows(
            _ensemble(f), _features(f), F.col("observation_time")).drop("failure_probability", "predicted_label")),
        "b6_logged_features": _on(lambda f: _fixture_log(f, ("age",))),
        "b7_drift_gate": _on(lambda f: drift.drift_gate(_fixture_log(f))),
        "b8_column_drift": _on(lambda f: _rounded(_fixture_drift(f))),
        "b8_column_drift_ks": _on(lambda f: _rounded(_fixture_drift(f, drift.KOLMOGOROV))),
        "b8_column_drift_psi": _on(lambda f: _rounded(_fixture_drift(f, drift.STABILITY))),
        "b8_feature_drift": _on(lambda f: _rounded(_feature_drift(f))),
        "b8_sketched_drift": _on(_sketched_drift),
        "b9_dataset_drift": _on(lambda f: drift.dataset_drift(_fixture_drift(f))),
        "b10_monitoring_rows": _on(lambda f: _rounded(plain(_monitored(f)), 4)),
        "b11_request_rate": _on(lambda f: _rounded(traffic.request_rate(f.requests, "handler"))),
        "b12_status_rate": _on(lambda f: _rounded(traffic.request_rate(f.requests, "status"))),
        "b13_latency_p95": _on(lambda f: _rounded(traffic.latency_quantile(f.requests))),
    }


def _request_stream(f: Fleet) -> DataFrame:
    schema = f.parquet("events").schema
    events = f.spark.readStream.schema(schema).parquet(f"{f.sf_dir}/events.parque[t]")  # a file or a folder of files
    return events.select(
        "ts", F.col("event_type").alias("handler"), F.col("value").alias("latency_ms"),
        F.when(F.col("user_id") % 20 == 0, 500).otherwise(200).alias("status"))


def _stream_folders(f: Fleet) -> tuple[str, str]:
    folder = _scratch(f)
    return f"{folder}/out", f"{folder}/checkpoint"


def _drained(f: Fleet, stream: DataFrame) -> DataFrame:
    return drain(stream, *_stream_folders(f))


def _scoring_stream(f: Fleet) -> DataFrame:
    stored = _features(f)
    path = _stored[(*_version(f), "features")]
    observations = f.spark.readStream.schema(stored.schema).parquet(path)
    return _drained(f, prediction_log_stream(_ensemble(f), observations))


def stream_queries() -> dict[str, Query]:
    return {
        "b11_request_rate_stream": _on(lambda f: _rounded(
            request_rate_stream(_request_stream(f), "handler", *_stream_folders(f)))),
        "b12_status_rate_stream": _on(lambda f: _rounded(
            request_rate_stream(_request_stream(f), "status", *_stream_folders(f)))),
        "b13_latency_p95_stream": _on(lambda f: _rounded(
            latency_quantile_stream(_request_stream(f), *_stream_folders(f)))),
        "b5_prediction_log_stream": _on(_scoring_stream),
        "f2_rolling_sensors_stream": _on(lambda f: rolling_sensors_stream(f.stream("telemetry"), *_stream_folders(f))),
    }


def queries() -> dict[str, Query]:
    # Models before the logs that need them: each query then does its own part of the training.
    return (quality_queries() | exploration_queries() | feature_queries() | model_queries() | storage_queries()
            | quarantine_queries() | check_queries() | evaluation_queries() | scoring_queries() | stream_queries())
