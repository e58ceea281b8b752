"""Sensor statistics and what sensors do in the day before a failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import DAY, micros, num
from fleetlens.plans.cells import CELL, cell_of, trailing_rows
from fleetlens.schemas import SENSORS

STATS = {"min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev_samp}


def _summary(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(*[
        num(f(F.col(raw).cast("double")), 2).alias(f"{stat}_{name}")
        for raw, name in SENSORS.items() for stat, f in STATS.items()
    ])


def sensor_summary_wide(telemetry: DataFrame) -> DataFrame:
    rename = {f"stddev_{name}": f"{name}_stddev" for name in SENSORS.values()}
    return _summary(telemetry).withColumnsRenamed(rename)


def sensor_summary_long(telemetry: DataFrame) -> DataFrame:
    """One scan: aggregate wide, then turn the single row."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("sensor"), *[F.col(f"{stat}_{name}").alias(stat) for stat in STATS])
        for name in SENSORS.values()
    ])
    return _summary(telemetry).select(F.explode(entries).alias("s")).select("s.*")


def placed_readings(telemetry: DataFrame) -> DataFrame:
    u = micros(F.col("datetime"))
    return telemetry.select("id", "machineid", "datetime", *SENSORS, u.alias("u"), cell_of(u).alias("cell"))


def _rolling_averages(w) -> list[Column]:
    return [num(F.avg(F.col(raw).cast("double")).over(w.rowsBetween(-2, 0)), 2).alias(f"{raw}_3h_avg")
            for raw in SENSORS]


def rolling_averages(telemetry: DataFrame) -> DataFrame:
    """Means over the current and two preceding readings of a machine."""
    rows = trailing_rows(placed_readings(telemetry), ["u", "id"], 2, _rolling_averages)
    return rows.select("machineid", "datetime", *SENSORS, *[f"{raw}_3h_avg" for raw in SENSORS])


def failures_ahead(rows: DataFrame, failures: DataFrame, span: int = DAY, cell: int = CELL) -> DataFrame:
    """Add ``ahead``: failures of the machine within (t, t + span].

    A failure is copied into the preceding cell where that cell can see it.
    """
    u = micros(F.col("datetime"))
    marks = failures.select("machineid", u.alias("u")).groupBy("machineid", "u").agg(
        F.count(F.lit(1)).alias("hits")
    )
    home = cell_of(F.col("u"), cell)
    seen_from = F.array_compact(F.array(home, F.when(F.col("u") < home + span, home - cell)))
    both = rows.withColumn("is_row", F.lit(True)).unionByName(
        marks.withColumn("cell", F.explode(seen_from)), allowMissingColumns=True
    )
    w = Window.partitionBy("machineid", "cell").orderBy("u")

    def upto(offset):
        hits = F.sum("hits").over(w.rangeBetween(Window.unboundedPreceding, offset))
        return F.coalesce(hits, F.lit(0))

    counted = both.withColumn("ahead", upto(span) - upto(0))
    return counted.where("is_row").drop("is_row", "hits")


def labelled_rolling(telemetry: DataFrame, failures: DataFrame, build=_rolling_averages) -> DataFrame:
    rows = failures_ahead(placed_readings(telemetry), failures)
    return trailing_rows(rows, ["u", "id"], 2, build).withColumn("is_pre_failure", F.col("ahead") > 0)


def pre_failure_means(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    """Means of the rounded rolling averages, before failures and otherwise."""
    return labelled_rolling(telemetry, failures).groupBy("is_pre_failure").agg(
        *[num(F.avg(f"{raw}_3h_avg"), 2).alias(f"avg_{raw}_3h") for raw in SENSORS]
    )


def pre_failure_spread(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    """Sample std of the rolling averages, before failures and otherwise."""
    return labelled_rolling(telemetry, failures).groupBy("is_pre_failure").agg(
        *[num(F.stddev_samp(f"{raw}_3h_avg"), 2).alias(f"stddev_{raw}_3h") for raw in SENSORS]
    )


def pre_failure_deltas(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    """Machines by distance between normal and pre-failure rolling averages."""
    def mean_when(raw, flag):
        return F.avg(F.when(F.col("is_pre_failure") == flag, F.col(f"{raw}_3h_avg")))

    deltas = {raw: f"avg_{name}_delta" for raw, name in SENSORS.items()}
    per_machine = labelled_rolling(telemetry, failures).groupBy("machineid").agg(
        *[num(F.abs(mean_when(raw, True) - mean_when(raw, False)), 4).alias(out)
          for raw, out in deltas.items()]
    )
    total = sum((F.col(out) for out in deltas.values()), F.lit(0.0))
    return per_machine.withColumn("total_delta", num(total, 4)).where(F.col("total_delta").isNotNull())
