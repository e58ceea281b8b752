"""A stream that has read everything equals the batch result."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fleetlens import catalog
from fleetlens.functions.columns import DAY, HOUR
from fleetlens.operators.features import rolling_sensors
from fleetlens.sources.fixtures import fleet
from fleetlens.plans.cells import CELL
from fleetlens.schemas import SENSORS
from fleetlens.streaming.features import RollingSensors, measures, merged, rolling_sensors_stream, windows
from fleetlens.streaming.traffic import request_rate_stream

SF_DIR = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    queries = catalog.queries()
    for name in ("b11_request_rate", "b13_latency_p95"):
        batch = queries[name](spark, SF_DIR)
        assert sorted(queries[f"{name}_stream"](spark, SF_DIR).collect()) == sorted(batch.collect())


def test_late_rows_and_many_files_lose_nothing(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").selectExpr("ts", "event_type AS handler", "event_id")
    for part in (2, 0, 1):  # files in no order of time
        events.where(f"event_id % 3 = {part}").drop("event_id").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp_ntz, handler string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rates = request_rate_stream(stream, "handler", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rates.selectExpr("sum(requests) AS n").first()["n"] == 12 * events.count()


def test_scoring_stream_logs_every_row(spark):
    queries = catalog.queries()
    logged = queries["b5_prediction_log_stream"](spark, SF_DIR)
    batch = queries["b1_batch_scores"](spark, SF_DIR)
    both = logged.join(batch.withColumnRenamed("failure_probability", "p"), ["machineid", "observation_time"])
    assert both.count() == batch.count() == logged.count()
    assert both.where(F.abs(F.col("failure_probability") - F.col("p")) > 1e-9).count() == 0


def _telemetry_in_parts(spark, folder, cuts):
    """Readings in files that follow no order of time."""
    readings = fleet(spark, SF_DIR).telemetry
    for part in cuts:
        readings.where(f"id % {len(cuts)} = {part}").drop("id").coalesce(1).write.mode("append").parquet(folder)
    schema = readings.drop("id").schema
    return readings, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_rolling_features_of_shuffled_files_equal_the_batch(spark, tmp_path):
    readings, stream = _telemetry_in_parts(spark, f"{tmp_path}/in", (2, 0, 3, 1))
    # A machine without a name, a time without numbers, a time read twice.
    odd = readings.drop("id").limit(3).withColumn("machineid", F.lit(None).cast("string")).withColumn("volt", F.lit(None).cast("decimal(8,4)"))
    odd.union(odd).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = rolling_sensors_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", late="60 days")
    want = rolling_sensors(readings.drop("id").union(odd).union(odd))
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # A second run with nothing new changes nothing; one with more readings goes on from the state.
    more = readings.drop("id").withColumn("volt", (F.col("volt") + 1).cast("decimal(8,4)")).limit(40)
    more.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    again = rolling_sensors_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", late="60 days")
    want = rolling_sensors(readings.drop("id").union(odd).union(odd).union(more))
    assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()


def test_window_sums():
    u = np.array([0, HOUR, 3 * HOUR, 4 * HOUR]) + 10 * DAY
    values = np.array([[1.0, np.nan, 5, 5]] * 2 + [[3.0, 2, 5, 5]] * 2)
    out = windows(u, measures(values), np.arange(4))
    volt_3h = out[:, 1:5]
    assert volt_3h[:, 0].tolist() == [1, 2, 2, 2] and volt_3h[:, 1].tolist() == [1, 2, 4, 6]
    again, held = merged(np.concatenate([u, u[:1]]), np.vstack([measures(values), measures(values[:1])]))
    assert again.tolist() == u.tolist() and held[:, 0].tolist() == [2, 1, 1, 1]


def test_a_group_leaves_as_one_block_of_whole_numbers():
    """Columns made one by one cost a group of twenty readings more than all of its sums."""
    state = SimpleNamespace(exists=lambda: False, update=lambda held: None)
    handle = SimpleNamespace(getValueState=lambda *_: state, registerTimer=lambda at: None)
    processor = RollingSensors(CELL)
    processor.init(handle)
    readings = pd.DataFrame({"u": [HOUR, HOUR, 5 * HOUR]} | {raw: [np.nan, np.nan, 20_000.0] for raw in SENSORS})
    out = next(processor.handleInputRows(("7", 0), iter([readings]), None))
    assert out["machineid"].tolist() == ["7", "7"] and out["u"].tolist() == [HOUR, 5 * HOUR]
    assert out["k"].tolist() == [2, 1] and out["version"].tolist() == [0, 0]
    assert set(out.drop(columns="machineid").dtypes) == {np.dtype("int64")}
