from __future__ import annotations

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.features import build_features
from fleetlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from fleetlens.session import configure


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def feature_frame(spark):
    """Features of a small fleet, by the production feature build.

    Twelve machines report every four hours for ten days. Every third one wears
    out: its vibration climbs until it fails, errors come the day before, and
    after a service it starts anew. Nulls are filled: models get whole rows.
    """
    grid = spark.range(12 * 60).selectExpr(
        "id", "CAST(id DIV 60 AS INT) AS unit", "CAST(id % 60 AS INT) AS step").selectExpr(
        "id", "CAST(unit AS STRING) AS machineid", "unit", "step",
        "TIMESTAMP_NTZ '2024-03-01' + MAKE_DT_INTERVAL(0, step * 4) AS datetime",
        # Days since the last renewal of a machine that wears out, else none.
        "IF(unit % 3 = 0, (step + unit) % 18, 0) AS wear",
        "CAST(PMOD(HASH(id), 1000) AS DOUBLE) / 1000 AS noise")
    telemetry = grid.selectExpr(
        "id", "datetime", "machineid", "CAST(160 + 20 * noise AS DECIMAL(8,4)) AS volt",
        "CAST(470 - wear - 30 * noise AS DECIMAL(8,4)) AS rotate", "CAST(95 + 10 * noise + unit % 2 AS DECIMAL(8,4)) AS pressure",
        "CAST(38 + wear / 2 + 4 * noise AS DECIMAL(8,4)) AS vibration")
    machines = spark.range(12).selectExpr(
        "CAST(id AS STRING) AS machineid", "CONCAT('model', id % 4 + 1) AS model", "CAST(1 + id * 5 % 18 AS INT) AS age")

    def happened(when, column, value):
        return grid.where(when).selectExpr("id", "datetime", "machineid", f"{value} AS {column}")

    errors = happened("wear IN (12, 14, 16) OR noise < 0.05", "errorid", "CONCAT('error', id % 5 + 1)")
    maintenance = happened("wear = 17 OR (unit % 3 = 1 AND step % 25 = 7)", "comp", "CONCAT('comp', unit % 4 + 1)")
    failures = happened("wear = 17 OR noise > 0.99", "failure", "CONCAT('comp', unit % 4 + 1)")
    rows = build_features(machines, telemetry, errors, maintenance, failures)
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(30.0)).alias(c) for c in NUMERIC_FEATURES]
    held = rows.select(*numbers, *CATEGORICAL_FEATURES, F.col("label").cast("int").alias("label"), "machineid", "observation_time")
    return held.cache()
