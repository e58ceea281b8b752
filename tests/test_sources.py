import pytest
from pyspark.sql import functions as F

from fleetlens.operators import checks, promote
from fleetlens.sources import files
from fleetlens.sources.log import Gate, Refused, append_batch, commits, key_filter, read_log, suspected_keys


def _csv(folder, name, text):
    (folder / name).write_text(text)


def test_headers_lower_case_types_text_missing_files_named(spark, tmp_path):
    _csv(tmp_path, "PdM_errors.csv", "datetime,machineID,errorID\n2024-01-01 06:00:00,1,error1\n")
    tables, missing = files.read_staging(spark, str(tmp_path))
    assert list(tables) == ["errors"] and len(missing) == 4 and "PdM_maint.csv" in missing
    assert tables["errors"].dtypes == [("datetime", "string"), ("machineid", "string"), ("errorid", "string")]


def test_loading_twice_replaces(spark, tmp_path):
    _csv(tmp_path, "PdM_machines.csv", "machineID,model,age\n1,model1,3\n 1 ,model1, 3\n2,,4\n")
    _csv(tmp_path, "PdM_errors.csv", "datetime,machineID,errorID\n2024-01-01 06:00:00,1,error1\n")
    for _ in range(2):
        staging, _ = files.read_staging(spark, str(tmp_path))
        stored = files.load_base_tables(promote.promote(staging), str(tmp_path / "base"))
    assert [tuple(r) for r in stored["machines"].collect()] == [("1", "model1", 3)]
    assert stored["errors"].count() == 1 and "id" in stored["errors"].columns


def test_strict_load_names_what_is_broken(spark, tmp_path):
    machines = spark.createDataFrame([("1", "m", 3), ("1", "m", 4)], "machineid string, model string, age int")
    errors = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01' AS datetime, '9' AS machineid, CAST(NULL AS STRING) AS errorid")
    with pytest.raises(ValueError) as refused:
        files.load_base_tables({"machines": machines, "errors": errors}, str(tmp_path), strict=True)
    assert str(refused.value) == ("load refused: 1 nulls in errors.errorid; 1 repeated machines; "
                                  "1 rows of errors without a machine")
    assert not any(tmp_path.iterdir())
    fine = {"machines": machines.limit(1), "errors": errors.selectExpr("datetime", "'1' AS machineid", "'e' AS errorid")}
    assert set(files.load_base_tables(fine, str(tmp_path), strict=True)) == set(fine)


def test_null_filter_runs_before_trimming(spark):
    staging = spark.createDataFrame([("2024-01-01", " ", "e1"), ("2024-01-01", None, "e2")],
                                    "datetime string, machineid string, errorid string")
    assert [r["machineid"] for r in promote.errors(staging).collect()] == [""]


@pytest.mark.parametrize("volt", ["12x", "10000.5"])
def test_a_bad_or_oversized_number_fails_the_load(spark, volt):
    staging = spark.createDataFrame([("2024-01-01", "1", volt, "1", "1", "1")],
                                    "datetime string, machineid string, volt string, rotate string, pressure string, vibration string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        promote.telemetry(staging).collect()


def test_logs_append_and_features_filter(spark, tmp_path):
    rows = spark.createDataFrame([("1", '{"a": 1}'), ("2", None)], "machineid string, features string")
    for _ in range(2):
        files.append_log(rows, str(tmp_path / "log"))
    assert files.read_prediction_log(spark, str(tmp_path / "log")).count() == 2
    files.store_features(spark.range(4).select(
        F.col("id").cast("string").alias("machineid"), F.lit("2024-01-01").cast("timestamp_ntz").alias("observation_time"),
        F.when(F.col("id") > 1, 1).alias("label")), str(tmp_path / "features"))
    assert files.read_features(spark, str(tmp_path / "features")).count() == 2


def test_reference_sample_is_repeatable_and_labelled(feature_frame):
    a = files.reference_sample(feature_frame, 50).collect()
    b = files.reference_sample(feature_frame.repartition(5), 50).collect()
    assert len(a) == 50 and sorted(a) == sorted(b)
    assert sorted(a) != sorted(files.reference_sample(feature_frame, 50, seed=1).collect())


def test_checks_find_violations(spark):
    machines = spark.createDataFrame([("1", "m"), ("1", "n")], "machineid string, model string")
    facts = spark.createDataFrame([("1", 0.5, 1), ("9", 1.5, 2), (None, None, None)],
                                  "machineid string, failure_probability double, predicted_label int")
    assert checks.repeated_keys(machines, "machineid").first()["n"] == 2
    assert checks.missing_parents({"facts": facts}, machines).first()["orphaned_rows"] == 2
    nulls = checks.null_values({"facts": (facts, ["machineid", "predicted_label"])}).collect()
    assert [r["null_rows"] for r in nulls] == [1, 1]
    failed = {r["rule"]: r["violations"] for r in checks.failed_checks(facts, checks.prediction_rules()).collect()}
    assert failed == {"probability_in_range": 1, "label_is_binary": 1}


LOG = "prediction_id long, machineid string, p double"


def _log_rows(spark, ids, machine="1", p=0.5):
    return spark.createDataFrame([(i, machine, p) for i in ids], LOG)


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path, LOG).count() == 0
    assert append_batch(_log_rows(spark, range(5)), path, "a")
    assert not append_batch(_log_rows(spark, range(5)), path, "a")  # sent again
    _log_rows(spark, range(100, 140)).write.parquet(f"{path}/data/batch=b/attempt=torn")  # ended before its manifest
    assert append_batch(_log_rows(spark, range(5, 8)), path, "c")
    assert sorted(r["prediction_id"] for r in read_log(spark, path, LOG).collect()) == list(range(8))
    assert {(r["batch"], r["rows"]) for r in commits(spark, path).collect()} == {("a", 5), ("c", 3)}
    assert append_batch(_log_rows(spark, range(100, 140)), path, "b")  # and again, whole
    assert read_log(spark, path, LOG).count() == 48


def test_of_two_attempts_one_is_committed(spark, tmp_path):
    from fleetlens.sources import log

    folder = str(tmp_path / "log" / "commits")
    assert log._publish(spark, folder, "a.json", '{"batch": "a"}') and not log._publish(spark, folder, "a.json", "{}")
    assert [r["batch"] for r in commits(spark, str(tmp_path / "log")).collect()] == ["a"]


def test_gates_refuse_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    machines = spark.createDataFrame([("1",), ("2",)], "machineid string")
    gate = Gate(["prediction_id"], ["machineid"], {"p in range": F.col("p").between(0, 1)}, {"machineid": (machines, "machineid")}, 1000)
    assert append_batch(_log_rows(spark, range(500)), path, "a", gate)
    assert append_batch(_log_rows(spark, range(500, 1000), "2"), path, "b", gate)
    bad = (_log_rows(spark, [7, 700, 2000, 2000]).union(_log_rows(spark, [2001], "9")).union(_log_rows(spark, [2002], None))
           .union(_log_rows(spark, [2003], "1", 1.5)))
    with pytest.raises(Refused, match="batch c refused: 2 x key committed before; 1 x key repeated in the batch; "
                                      "1 x null in machineid; 1 x p in range; 1 x unknown machineid"):
        append_batch(bad, path, "c", gate)
    assert read_log(spark, path, LOG).count() == 1000
    assert append_batch(_log_rows(spark, range(2000, 2003)), path, "c", gate)


def test_filters_suspect_all_committed_keys_and_few_others(spark):
    gate = Gate(["prediction_id", "machineid"], expected_keys=2000)
    old, new = _log_rows(spark, range(2000)), _log_rows(spark, range(1000, 5000)).union(_log_rows(spark, [7], None))
    halves = key_filter(old.where("prediction_id < 1200"), gate).union(key_filter(old.where("prediction_id >= 1200"), gate))
    suspects = {r["prediction_id"] for r in suspected_keys(new, halves, gate).collect()}
    assert set(range(1000, 2000)) <= suspects and len(suspects) < 1060


def test_quarantine_keeps_what_a_load_fails_on(spark, tmp_path):
    _csv(tmp_path, "PdM_telemetry.csv", "datetime,machineID,volt,rotate,pressure,vibration\n2024-01-01 06:00:00, 1 ,170.5,,1,2\n"
         "never,2,12x,1,1,1\n2024-01-01 07:00:00,,1,123456.7,1,1\n")
    _csv(tmp_path, "PdM_machines.csv", "machineID,model,age\n1,model1,3\n 1 ,model1, 3\n2,,4\n3,model2,old\n")
    staging, _ = files.read_staging(spark, str(tmp_path), with_source=True)
    report = files.load_with_quarantine(staging, str(tmp_path / "judged"))
    assert sorted(tuple(r) for r in report.collect()) == [("machines", 4, 2, 2), ("telemetry", 3, 1, 2)]
    good = files.accepted_rows(spark, str(tmp_path / "judged"), "telemetry").collect()
    assert [(r["machineid"], float(r["volt"]), r["rotate"]) for r in good] == [("1", 170.5, None)]
    assert files.accepted_rows(spark, str(tmp_path / "judged"), "machines").count() == 1
    bad = files.rejected_rows(spark, str(tmp_path / "judged"), "telemetry").orderBy("datetime").collect()
    assert [(r["datetime"], r["reasons"]) for r in bad] == [
        ("2024-01-01 07:00:00", "machineid is missing; rotate is unreadable"), ("never", "datetime is unreadable; volt is unreadable")]
    assert all(r["source_file"].endswith("PdM_telemetry.csv") for r in bad)


def test_files_of_other_column_order_are_not_read_shifted(spark, tmp_path):
    folder = tmp_path / "PdM_errors.csv"
    folder.mkdir()
    _csv(folder, "part-0.csv", "datetime,machineID,errorID\n2024-01-01 06:00:00,1,error1\n")
    _csv(folder, "part-1.csv", "machineID,datetime,errorID\n1,2024-01-01 06:00:00,error1\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv_text(spark, str(folder)).collect()
