"""Table layouts and the feature list."""

from __future__ import annotations

from pyspark.sql import types as T

# File names, table layouts and feature names of the data model.
RAW_FILES = {
    "PdM_machines.csv": "machines",
    "PdM_telemetry.csv": "telemetry",
    "PdM_errors.csv": "errors",
    "PdM_maint.csv": "maintenance",
    "PdM_failures.csv": "failures",
}

STAGING_COLUMNS = {
    "machines": ["machineid", "model", "age"],
    "telemetry": ["datetime", "machineid", "volt", "rotate", "pressure", "vibration"],
    "errors": ["datetime", "machineid", "errorid"],
    "maintenance": ["datetime", "machineid", "comp"],
    "failures": ["datetime", "machineid", "failure"],
}

SENSORS = {
    "volt": "voltage",
    "rotate": "rotation",
    "pressure": "pressure",
    "vibration": "vibration",
}

WINDOW_HOURS = [3, 12, 24]

EVENT_TYPE_COLUMN = {"errors": "errorid", "maintenance": "comp", "failures": "failure"}

FAILURE_HISTORY_FEATURES = [
    "total_prior_failures",
    "days_since_last_failure",
    "distinct_failure_types",
]

EVENT_FEATURES = [
    "error_count_24h",
    "hours_since_last_error",
    "distinct_error_types",
    "days_since_last_maintenance",
    "component_diversity",
    *FAILURE_HISTORY_FEATURES,
]

CATEGORICAL_FEATURES = ["model", "age_category"]

READING_TYPE = "decimal(8,4)"
RECENCY_TYPE = "decimal(10,2)"


def sensor_features() -> list[str]:
    """The 32 rolling columns: mean and std per window, min and max for 3 h."""
    names = []
    for hours in WINDOW_HOURS:
        for sensor in SENSORS.values():
            stats = ["mean", "std"] + (["min", "max"] if hours == 3 else [])
            names += [f"{sensor}_{stat}_{hours}h" for stat in stats]
    return names


NUMERIC_FEATURES = ["age", *sensor_features(), *EVENT_FEATURES]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES


def staging_schema(table: str) -> T.StructType:
    """All-text schema of a staging table."""
    return T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS[table]])
