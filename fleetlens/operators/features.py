"""Production features: one row per (machine, observation time), plus the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.ages import PRODUCTION, age_category
from fleetlens.functions.columns import DAY, HOUR, micros, rnd, rnd_sql
from fleetlens.plans.cells import CELL, CellWindow, event_parts, over_cells
from fleetlens.plans.whole import SCALE, SPLIT
from fleetlens.schemas import (
    EVENT_TYPE_COLUMN,
    FEATURES,
    READING_TYPE,
    RECENCY_TYPE,
    SENSORS,
    WINDOW_HOURS,
    sensor_features,
)

OBSERVED = "CAST(timestamp_micros(u) AS TIMESTAMP_NTZ) AS observation_time"



def static_features(machines: DataFrame, limits=PRODUCTION) -> DataFrame:
    return machines.select(
        "machineid", "model", "age", age_category(F.col("age"), limits).alias("age_category")
    )


def readings_spine(telemetry: DataFrame) -> DataFrame:
    """Keys only: one row per reading."""
    return telemetry.select("machineid", micros(F.col("datetime")).alias("u"), _one("k"))


def timed(events: DataFrame, kind: str | None = None) -> DataFrame:
    cols = ["machineid", micros(F.col("datetime")).alias("u")]
    return events.select(*cols, *([kind] if kind else []))


def _one(name: str) -> Column:
    return F.lit(1).cast("bigint").alias(name)


def _sensor_measures(telemetry: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Per reading and sensor: count, sum, sum of squares in two parts, minimum, maximum."""
    cols, combine = ["1L AS k"], {"k": "sum"}
    for raw in SENSORS:
        reading = f"CAST({raw} AS {READING_TYPE})"
        scaled = f"CAST({reading} * {SCALE} AS BIGINT)"
        cols += [
            f"CASE WHEN {raw} IS NOT NULL THEN 1L END AS {raw}_n",
            f"{scaled} AS {raw}_s",
            f"{scaled} * {scaled} div {SPLIT} AS {raw}_q",
            f"{scaled} * {scaled} % {SPLIT} AS {raw}_r",
            f"{scaled} AS {raw}_min",
            f"{scaled} AS {raw}_max",
        ]
        combine |= {f"{raw}_{m}": "sum" for m in "nsqr"} | {f"{raw}_min": "min", f"{raw}_max": "max"}
    timed_rows = telemetry.select("machineid", micros(F.col("datetime")).alias("u"), *SENSORS)
    return timed_rows.selectExpr("machineid", "u", *cols), combine


def _sensor_windows(w: CellWindow) -> list[str]:
    cols = []
    for hours in WINDOW_HOURS:
        for raw, sensor in SENSORS.items():
            cols += [f"{w.mean(raw, hours * HOUR)} AS {sensor}_mean_{hours}h",
                     f"{w.deviation(raw, hours * HOUR)} AS {sensor}_std_{hours}h"]
            if hours == 3:
                cols += [
                    f"{w.extreme('min', f'{raw}_min', 3 * HOUR)} AS {sensor}_min_3h",
                    f"{w.extreme('max', f'{raw}_max', 3 * HOUR)} AS {sensor}_max_3h",
                ]
    return cols


def sensor_results() -> list[str]:
    """Mean and population std from count, sum and sum of squares."""
    cols = []
    for name in sensor_features():
        sensor, stat, window = name.rsplit("_", 2)
        n, s, q, r = (f"{sensor}_{m}_{window}" for m in "nsqr")
        count = f"nullif(CAST({n} AS DOUBLE), 0D)"
        if stat == "mean":
            value = rnd_sql(f"{s} / {count} / {SCALE}", 4)
        elif stat == "std":
            # n * sum(x^2) - sum(x)^2 is a whole number, hence exact.
            squares = f"(CAST({q} AS DECIMAL(18,0)) * {SPLIT} + CAST({r} AS DECIMAL(18,0)))"
            spread = (f"CAST({n} AS DECIMAL(12,0)) * CAST({squares} AS DECIMAL(25,0))"
                      f" - CAST({s} AS DECIMAL(18,0)) * CAST({s} AS DECIMAL(18,0))")
            value = rnd_sql(f"sqrt(CAST({spread} AS DOUBLE)) / {count} / {SCALE}", 4)
        else:
            value = name
        cols.append(f"CAST({value} AS {READING_TYPE}) AS {name}")
    return cols


def rolling_sensors(telemetry: DataFrame, cell: int = CELL) -> DataFrame:
    """32 rolling columns over (t - h, t] for 3, 12 and 24 hours."""
    spine, combine = _sensor_measures(telemetry)
    out = over_cells([spine], {}, combine, _sensor_windows, lookback=DAY, cell=cell)
    return out.selectExpr("machineid", OBSERVED, *sensor_features())


def _events(errors=None, maintenance=None, failures=None) -> dict[str, list[DataFrame]]:
    given = {"errors": errors, "maintenance": maintenance, "failures": failures}
    return {
        name: event_parts(name, timed(df, EVENT_TYPE_COLUMN[name]), EVENT_TYPE_COLUMN[name])
        for name, df in given.items()
        if df is not None
    }


def _event_combine(events: dict[str, list[DataFrame]]) -> dict[str, str]:
    return {part.columns[-1]: "sum" for parts in events.values() for part in parts}


def _since(name: str, unit: int, w: CellWindow) -> str:
    return f"CAST({rnd_sql(f'(u - {w.last(name)}) / {unit}', 2)} AS {RECENCY_TYPE})"


def _copies(dedupe: bool) -> str:
    """Plain counts run over the join with readings, so k copies of a reading count k times."""
    return "1" if dedupe else "k"


def _error_windows(w: CellWindow, dedupe: bool) -> list[str]:
    return [
        f"CAST({w.back('errors_n', DAY)} * {_copies(dedupe)} AS INT) AS error_count_24h",
        f"{_since('errors', HOUR, w)} AS hours_since_last_error",
        f"CAST({w.total('errors_new')} AS INT) AS distinct_error_types",
    ]


def _service_windows(w: CellWindow) -> list[str]:
    return [
        f"{_since('maintenance', DAY, w)} AS days_since_last_maintenance",
        f"CAST({w.total('maintenance_new')} AS INT) AS component_diversity",
    ]


def _failure_windows(w: CellWindow, dedupe: bool) -> list[str]:
    return [
        f"CAST({w.total('failures_n')} * {_copies(dedupe)} AS INT) AS total_prior_failures",
        f"{_since('failures', DAY, w)} AS days_since_last_failure",
        f"CAST({w.total('failures_new')} AS INT) AS distinct_failure_types",
    ]


def _label(w: CellWindow) -> str:
    return f"CAST({w.ahead('failures_n', DAY)} > 0 AS INT) AS label"


def _event_features(telemetry, events, build, *, carry=(), lookback=0, lookahead=0, cell=CELL):
    out = over_cells(
        [readings_spine(telemetry)], events, {"k": "sum", **_event_combine(events)}, build,
        carry=list(carry), lookback=lookback, lookahead=lookahead, cell=cell,
    )
    rest = [c for c in out.columns if c not in ("machineid", "u", "k")]
    return out.selectExpr("machineid", OBSERVED, *rest)


def error_features(telemetry, errors, dedupe: bool = False, cell: int = CELL) -> DataFrame:
    return _event_features(telemetry, _events(errors=errors), lambda w: _error_windows(w, dedupe),
                           carry=["errors"], lookback=DAY, cell=cell)


def service_features(telemetry, maintenance, cell: int = CELL) -> DataFrame:
    return _event_features(telemetry, _events(maintenance=maintenance), _service_windows,
                           carry=["maintenance"], cell=cell)


def failure_features(telemetry, failures, dedupe: bool = False, cell: int = CELL) -> DataFrame:
    return _event_features(telemetry, _events(failures=failures), lambda w: _failure_windows(w, dedupe),
                           carry=["failures"], cell=cell)


def labels(telemetry, failures, cell: int = CELL) -> DataFrame:
    """1 if the machine fails within (t, t + 24 h]."""
    events = {"failures": event_parts("failures", timed(failures), None)}
    return _event_features(telemetry, events, lambda w: [_label(w)], lookahead=DAY, cell=cell)


def build_features(machines, telemetry, errors, maintenance, failures,
                   dedupe: bool = False, cell: int = CELL) -> DataFrame:
    """The whole feature table in one window pass.

    Readings and events meet in one union, so all features and the label share
    a single shuffle by (machine, cell); only the machine attributes are joined.
    """
    spine, combine = _sensor_measures(telemetry)
    events = _events(errors, maintenance, failures)
    out = over_cells(
        [spine], events, {**combine, **_event_combine(events)},
        lambda w: [*_sensor_windows(w), *_error_windows(w, dedupe), *_service_windows(w),
                   *_failure_windows(w, dedupe), _label(w)],
        carry=list(events), lookback=DAY, lookahead=DAY, cell=cell,
    )
    event_cols = [c for c in FEATURES if c in out.columns and c not in sensor_features()]
    wide = out.selectExpr("machineid", OBSERVED, *sensor_features(), *event_cols, "label")
    joined = wide.join(static_features(machines), "machineid", "left")
    return joined.select("machineid", "observation_time", "model", "age", "age_category",
                         *sensor_features(), *event_cols, "label")


# Checks to run on a finished feature table.

def total_rows(features: DataFrame) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("total_rows"))


def class_balance(features: DataFrame) -> DataFrame:
    return features.groupBy("label").agg(F.count(F.lit(1)).alias("count"))


def non_null_share(features: DataFrame, column: str = "voltage_mean_3h") -> DataFrame:
    total, present = F.count(F.lit(1)), F.count(column)
    share = rnd(100.0 * present / F.nullif(total, F.lit(0)), 2).cast("double")
    return features.agg(total.alias("total"), present.alias("non_null"), share.alias("pct_non_null"))


def time_range(features: DataFrame) -> DataFrame:
    return features.agg(
        F.min("observation_time").alias("earliest"),
        F.max("observation_time").alias("latest"),
        F.countDistinct("machineid").alias("unique_machines"),
    )
