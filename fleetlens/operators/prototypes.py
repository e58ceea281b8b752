"""Feature prototypes: row-based windows, bounded recency, strict history.

They differ from the production features on purpose (rows instead of hours,
sample instead of population std) and are kept beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.ages import PROTOTYPE
from fleetlens.functions.columns import DAY, HOUR, num_sql
from fleetlens.operators.features import OBSERVED, readings_spine, static_features, timed
from fleetlens.operators.sensors import failures_ahead, placed_readings
from fleetlens.plans.cells import event_parts, over_cells, trailing_rows
from fleetlens.schemas import SENSORS

ROLLING = [f"{name}_{stat}_3h" for name in SENSORS.values() for stat in ("mean", "std")]


def static_prototype(machines: DataFrame) -> DataFrame:
    return static_features(machines, PROTOTYPE)


def _mean_and_std(w) -> list[Column]:
    frame = w.rowsBetween(-2, 0)
    stats = {"mean": F.avg, "std": F.stddev_samp}
    return [f(F.col(raw).cast("double")).over(frame).alias(f"{name}_{stat}_3h")
            for raw, name in SENSORS.items() for stat, f in stats.items()]


def rolling_prototype(telemetry: DataFrame) -> DataFrame:
    """Mean and sample std over three readings; one row per reading."""
    rows = trailing_rows(placed_readings(telemetry), ["u", "id"], 2, _mean_and_std)
    return rows.select("machineid", F.col("datetime").alias("observation_time"), *ROLLING)


def _events(name: str, events: DataFrame):
    return {name: event_parts(name, timed(events), None)}


def _history(telemetry, events, build, **how) -> DataFrame:
    combine = {"k": "sum"} | {f"{name}_n": "sum" for name in events}
    out = over_cells([readings_spine(telemetry)], events, combine, build, **how)
    rest = [c for c in out.columns if c not in ("machineid", "u", "k")]
    return out.selectExpr("machineid", OBSERVED, *rest)


def _error_columns(w, copies: str) -> list[str]:
    last = w.last("errors")
    recent = f"CASE WHEN {last} > u - {DAY} THEN {last} END"
    return [
        f"{w.back('errors_n', DAY)} * {copies} AS error_count_24h",
        f"{num_sql(f'(u - {recent}) / {HOUR}', 2)} AS hours_since_last_error",
    ]


def _service_columns(w) -> list[str]:
    return [f"{num_sql(f'(u - {w.last('maintenance')}) / {DAY}', 2)} AS days_since_last_maintenance"]


def _failure_columns(w, copies: str) -> list[str]:
    last = w.last("failures", strict=True)
    return [
        f"{w.total('failures_n', strict=True)} * {copies} AS total_prior_failures",
        f"{num_sql(f'(u - {last}) / {DAY}', 2)} AS days_since_last_failure",
    ]


def errors_prototype(telemetry: DataFrame, errors: DataFrame) -> DataFrame:
    """Errors in (t - 24 h, t] and hours since the last of them."""
    return _history(telemetry, _events("errors", errors), lambda w: _error_columns(w, "1"),
                    lookback=DAY)


def service_prototype(telemetry: DataFrame, maintenance: DataFrame) -> DataFrame:
    return _history(telemetry, _events("maintenance", maintenance), _service_columns, carry=["maintenance"])


def failures_prototype(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    """Failures strictly before t."""
    return _history(telemetry, _events("failures", failures), lambda w: _failure_columns(w, "1"),
                    carry=["failures"])


def assembled_prototype(machines, telemetry, errors, maintenance, failures) -> DataFrame:
    """One row per reading of a known machine.

    Counts run over the join with readings, so k copies of a key count k times.
    """
    events = (_events("errors", errors) | _events("maintenance", maintenance) | _events("failures", failures))
    history = _history(
        telemetry, events,
        lambda w: [*_error_columns(w, "k"), *_service_columns(w), *_failure_columns(w, "k"),
                   f"CAST({w.ahead('failures_n', DAY)} > 0 AS INT) AS label"],
        carry=list(events), lookback=DAY, lookahead=DAY,
    )
    rows = rolling_prototype(telemetry).join(history, ["machineid", "observation_time"])
    return rows.join(static_prototype(machines), "machineid").select(
        "machineid", "observation_time", "model", "age", "age_category", *ROLLING,
        "error_count_24h", "hours_since_last_error", "days_since_last_maintenance",
        "total_prior_failures", "days_since_last_failure", "label",
    )


def rolling_with_label(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    rows = trailing_rows(failures_ahead(placed_readings(telemetry), failures), ["u", "id"], 2, _mean_and_std)
    return rows.select("machineid", F.col("datetime").alias("observation_time"),
                       *[f"{name}_mean_3h" for name in SENSORS.values()],
                       (F.col("ahead") > 0).cast("int").alias("label"))
