"""Failure history per machine and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import DAY, from_micros, micros, month, num
from fleetlens.plans.cells import cell_of, numbered, trailing_rows


def _placed(failures: DataFrame) -> DataFrame:
    u = micros(F.col("datetime"))
    return failures.select("machineid", "datetime", "failure", "id", u.alias("u"), cell_of(u).alias("cell"))


def failure_sequence(failures: DataFrame) -> DataFrame:
    rows = numbered(_placed(failures), ["u", "id"], "failure_number")
    return rows.select("machineid", "datetime", "failure", "failure_number")


def time_between_failures(failures: DataFrame) -> DataFrame:
    rows = trailing_rows(
        _placed(failures), ["u", "id"], 1, lambda w: [F.lag("u").over(w).alias("prev_u")]
    )
    return rows.select(
        "machineid", F.col("failure").alias("failure_type"), "datetime",
        from_micros(F.col("prev_u")).alias("prev_failure_datetime"),
        num((F.col("u") - F.col("prev_u")) / DAY, 1).alias("days_since_prev_failure"),
    )


def mean_time_between_failures(failures: DataFrame) -> DataFrame:
    """The gaps of a machine add up to its last minus its first failure time."""
    u = micros(F.col("datetime"))
    spans = failures.groupBy("machineid").agg(
        F.count(F.lit(1)).alias("total_failures"), (F.max(u) - F.min(u)).alias("span")
    )
    gaps = F.col("total_failures") - 1
    return spans.where(gaps >= 1).select(
        "machineid", "total_failures", num(F.col("span") / gaps / DAY, 1).alias("avg_days_between_failures")
    )


def cumulative_failures(machines: DataFrame, failures: DataFrame) -> DataFrame:
    known = numbered(_placed(failures), ["u", "failure", "id"], "cumulative_failures").join(machines, "machineid")
    return known.select("machineid", "model", "age", "datetime",
                        F.col("failure").alias("failure_type"), "cumulative_failures")


def monthly_failures(failures: DataFrame, months: int = 3) -> DataFrame:
    """Months without failures are absent, so the average spans listed months."""
    counts = failures.groupBy(month(F.col("datetime")).alias("month")).agg(
        F.count(F.lit(1)).alias("failure_count")
    )
    # One row per calendar month.
    recent = Window.partitionBy().orderBy("month").rowsBetween(-(months - 1), 0)
    return counts.withColumn(f"rolling_{months}m_avg", num(F.avg("failure_count").over(recent), 1))
