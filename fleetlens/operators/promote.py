"""Staging text to typed base tables.

Null filters look at the raw text, so an all-blank id survives as an empty
string. A value that does not parse fails the load, unless rows are ``judged``:
then each row carries what is wrong with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import EVENT_TYPE_COLUMN, READING_TYPE, SENSORS


def _text(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def _time(name: str = "datetime") -> Column:
    return F.trim(F.col(name)).cast("timestamp_ntz").alias(name)


def _reading(name: str) -> Column:
    value = F.nullif(F.trim(F.col(name)), F.lit(""))
    # Parsed as (10,4) first: a value too large for the column is an error, not a null.
    return value.cast("decimal(10,4)").cast(READING_TYPE).alias(name)


def machines(staging: DataFrame) -> DataFrame:
    rows = staging.dropna(subset=["machineid", "model", "age"])
    return rows.select(_text("machineid"), _text("model"), F.trim("age").cast("int").alias("age")).distinct()


def telemetry(staging: DataFrame) -> DataFrame:
    rows = staging.dropna(subset=["datetime", "machineid"])
    return rows.select(_time(), _text("machineid"), *[_reading(c) for c in SENSORS])


def _events(staging: DataFrame, kind: str) -> DataFrame:
    rows = staging.dropna(subset=["datetime", "machineid", kind])
    return rows.select(_time(), _text("machineid"), _text(kind))


def errors(staging: DataFrame) -> DataFrame:
    return _events(staging, EVENT_TYPE_COLUMN["errors"])


def maintenance(staging: DataFrame) -> DataFrame:
    return _events(staging, EVENT_TYPE_COLUMN["maintenance"])


def failures(staging: DataFrame) -> DataFrame:
    return _events(staging, EVENT_TYPE_COLUMN["failures"])


def promote(staging: dict[str, DataFrame]) -> dict[str, DataFrame]:
    steps = {"machines": machines, "telemetry": telemetry, "errors": errors,
             "maintenance": maintenance, "failures": failures}
    return {name: step(staging[name]) for name, step in steps.items() if name in staging}


# Column kinds of a table; a reading may be missing, all else may not.
_READING = "reading"
KINDS = {
    "machines": {"machineid": "string", "model": "string", "age": "int"},
    "telemetry": {"datetime": "timestamp_ntz", "machineid": "string", **dict.fromkeys(SENSORS, _READING)},
    **{name: {"datetime": "timestamp_ntz", "machineid": "string", kind: "string"} for name, kind in EVENT_TYPE_COLUMN.items()},
}


def _tried(name: str, kind: str) -> Column:
    text = F.trim(F.col(name))
    if kind == _READING:
        return F.nullif(text, F.lit("")).try_cast("decimal(10,4)").try_cast(READING_TYPE)
    return text if kind == "string" else text.try_cast(kind)


def _problem(name: str, kind: str) -> Column:
    given = F.col(name).isNotNull() & (F.trim(name) != "") if kind == _READING else F.col(name).isNotNull()
    unreadable = F.when(given & _tried(name, kind).isNull(), F.lit(f"{name} is unreadable"))
    return unreadable if kind == _READING else F.when(F.col(name).isNull(), F.lit(f"{name} is missing")).otherwise(unreadable)


def judged(staging: DataFrame, table: str, keep: list[str] = ()) -> DataFrame:
    """Typed columns, ``raw`` (the row as text), ``reasons`` and ``rejected`` for every staging row.

    Nothing is dropped: what ``promote`` leaves out or fails on is rejected,
    with every reason. ``keep`` names further columns to carry along.
    """
    kinds = KINDS[table]
    problems = F.filter(F.array(*[_problem(n, k) for n, k in kinds.items()]), lambda p: p.isNotNull())
    return staging.select(
        *[_tried(n, k).alias(n) for n, k in kinds.items()], F.struct(*kinds).alias("raw"),
        F.array_join(problems, "; ").alias("reasons"), (F.size(problems) > 0).alias("rejected"), *keep)
