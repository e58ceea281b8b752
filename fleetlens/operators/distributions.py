"""How machines and failures are spread over models and ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.ages import LIFE_STAGE, age_category, category_order
from fleetlens.functions.columns import num, pct
from fleetlens.operators.quality import failures_per_machine, overall
from fleetlens.plans.prefix import running_totals


def fleet_by_model(machines: DataFrame) -> DataFrame:
    counts = machines.groupBy("model").agg(
        F.count(F.lit(1)).alias("machine_count"), num(F.avg("age"), 1).alias("avg_age")
    )
    return counts.withColumn("pct_of_total", pct(F.col("machine_count"), overall("machine_count")))


def fleet_by_age(machines: DataFrame) -> DataFrame:
    counts = machines.groupBy(age_category(F.col("age"), LIFE_STAGE).alias("age_category")).agg(
        F.count(F.lit(1)).alias("category_count")
    )
    shares = counts.withColumn(
        "pct_of_total", pct(F.col("category_count"), overall("category_count"))
    )
    return shares.orderBy(category_order(F.col("age_category"), LIFE_STAGE))


def _burden(machines: DataFrame, failures: DataFrame, name: str, group: Column) -> DataFrame:
    """Failures per machine and share of all failures, by any machine attribute."""
    per_machine = failures.groupBy("machineid").agg(F.count(F.lit(1)).alias("n"))
    joined = machines.withColumn(name, group).join(per_machine, "machineid", "left")
    sums = joined.groupBy(name).agg(
        F.countDistinct("machineid").alias("machine_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_failures"),
    )
    total = F.col("total_failures")
    return sums.select(
        name, "machine_count", "total_failures",
        num(total / F.nullif(F.col("machine_count"), F.lit(0)), 2).alias("failures_per_machine"),
        pct(total, overall("total_failures")).alias("pct_of_total_failures"),
    )


def burden_by_model(machines: DataFrame, failures: DataFrame) -> DataFrame:
    return _burden(machines, failures, "model", F.col("model"))


def burden_by_age(machines: DataFrame, failures: DataFrame) -> DataFrame:
    by_age = _burden(machines, failures, "age_category", age_category(F.col("age"), LIFE_STAGE))
    return by_age.orderBy(category_order(F.col("age_category"), LIFE_STAGE))


def failure_types_by_model(machines: DataFrame, failures: DataFrame, more_than: int = 10) -> DataFrame:
    """Shares are among the (model, type) pairs that pass the filter."""
    per_machine = failures.groupBy("machineid", "failure").agg(F.count(F.lit(1)).alias("n"))
    pairs = (
        per_machine.join(machines, "machineid")
        .groupBy("model", F.col("failure").alias("failure_type"))
        .agg(F.sum("n").alias("failure_count"))
        .where(F.col("failure_count") > more_than)
    )
    within = F.sum("failure_count").over(Window.partitionBy("model"))
    return pairs.withColumn("pct_within_model", pct(F.col("failure_count"), within))


def pareto(machines: DataFrame, failures: DataFrame) -> DataFrame:
    """Machines by falling failure count with their cumulative share."""
    per_machine = failures_per_machine(machines, failures)
    ranked = running_totals(
        per_machine, {"t": -F.col("total_failures"), "m": F.col("machineid")}, ["total_failures"]
    )
    total = F.col("all_total_failures")
    return ranked.select(
        "machineid", "model", "age", "total_failures",
        pct(F.col("total_failures"), total).alias("pct_of_total"),
        pct(F.col("cum_total_failures"), total).alias("cumulative_pct"),
    )


def never_failed(machines: DataFrame, failures: DataFrame) -> DataFrame:
    failed = failures.select("machineid").distinct().withColumn("failed", F.lit(1))
    sums = machines.join(failed, "machineid", "left").groupBy("model").agg(
        F.countDistinct("machineid").alias("total_machines"),
        F.count_if(F.col("failed").isNull()).alias("never_failed_count"),
    )
    return sums.withColumn("never_failed_pct", pct(F.col("never_failed_count"), F.col("total_machines")))
