"""Data-quality queries: counts, coverage, nulls, duplicates, orphans, shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import month, num, pct

def overall(column: str) -> Column:
    """Grand total, for results that hold one row per class."""
    return F.sum(column).over(Window.partitionBy())


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def temporal_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([
        df.groupBy(month(F.col("datetime")).alias("month"))
        .agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
        .agg(F.min("lo").alias("earliest"), F.max("hi").alias("latest"),
             F.count("month").alias("months_covered"))
        .select(F.lit(name).alias("source"), "earliest", "latest", "months_covered")
        for name, df in tables.items()
    ])


def telemetry_nulls(telemetry: DataFrame) -> DataFrame:
    cols = {"datetime": "null_datetime", "machineid": "null_machine_id", "volt": "null_volt",
            "rotate": "null_rotate", "pressure": "null_pressure", "vibration": "null_vibration"}
    return telemetry.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(out) for c, out in cols.items()],
    )


def event_nulls(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``tables``: name -> (events, payload column)."""
    return _stack([
        df.agg(
            F.count_if(F.col("datetime").isNull()).alias("null_datetime"),
            F.count_if(F.col("machineid").isNull()).alias("null_machineid"),
            F.count_if(F.col(payload).isNull()).alias("null_payload"),
        ).select(F.lit(name).alias("table_name"), "null_datetime", "null_machineid", "null_payload")
        for name, (df, payload) in tables.items()
    ])


def duplicate_readings(telemetry: DataFrame, top: int | None = 10) -> DataFrame:
    """Most repeated (machine, time) keys; a report of ten by default."""
    repeated = (
        telemetry.groupBy("machineid", "datetime").agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where("duplicate_count > 1")
    )
    if top is None:
        return repeated
    return repeated.orderBy(F.desc("duplicate_count"), "machineid", "datetime").limit(top)


def orphan_rows(tables: dict[str, DataFrame], machines: DataFrame, key: str = "machineid") -> DataFrame:
    """Rows without a machine. Counting per machine first keeps the join small."""
    known = machines.select(key).distinct()
    return _stack([
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(known, key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_rows"))
        .select(F.lit(name).alias("table_name"), "orphaned_rows")
        for name, df in tables.items()
    ])


def machine_coverage(machines: DataFrame, telemetry: DataFrame) -> DataFrame:
    seen = telemetry.select("machineid").distinct().withColumn("seen", F.lit(1))
    total, covered = F.count("machineid"), F.count("seen")
    return machines.select("machineid").distinct().join(seen, "machineid", "left").agg(
        total.alias("total_machines"),
        covered.alias("machines_with_telemetry_reading"),
        (total - covered).alias("machines_missing_telemetry_reading"),
    )


def failure_classes(failures: DataFrame) -> DataFrame:
    counts = failures.groupBy("failure").agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.withColumn("pct_of_total", pct(F.col("occurrences"), overall("occurrences")))


def failures_per_machine(machines: DataFrame, failures: DataFrame) -> DataFrame:
    """One row per machine with its number of failures, zero included."""
    counts = failures.groupBy("machineid").agg(F.count(F.lit(1)).alias("n"))
    return (
        machines.join(counts, "machineid", "left")
        .groupBy("machineid", "model", "age")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_failures"))
    )


def worst_machines(machines: DataFrame, failures: DataFrame, top: int | None = 20) -> DataFrame:
    per_machine = failures_per_machine(machines, failures)
    total = per_machine.agg(F.sum("total_failures").alias("t")).scalar()
    shares = per_machine.withColumn("pct_of_total_failures", pct(F.col("total_failures"), total))
    if top is None:
        return shares
    return shares.orderBy(F.desc("total_failures"), "machineid").limit(top)


def error_frequency(errors: DataFrame) -> DataFrame:
    per_machine = errors.groupBy("errorid", "machineid").agg(F.count(F.lit(1)).alias("n"))
    counts = per_machine.groupBy("errorid").agg(
        F.sum("n").alias("occurrences"), F.count("machineid").alias("machines_affected")
    )
    return counts.withColumn("pct_of_total", pct(F.col("occurrences"), overall("occurrences")))


def age_summary(machines: DataFrame) -> DataFrame:
    quartiles = F.percentile("age", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return machines.agg(
        F.min("age").alias("min_age"), F.max("age").alias("max_age"),
        num(F.avg("age"), 1).alias("avg_age"), quartiles.alias("q"),
    ).select("min_age", "max_age", "avg_age",
             *[F.col("q")[i].alias(name) for i, name in enumerate(["p25", "p50", "p75"])])
