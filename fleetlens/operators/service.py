"""Does service prevent failures?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import DAY, from_micros, micros, num
from fleetlens.plans.cells import CELL, cell_of, event_parts, over_cells

SALTS = 64


def _services(maintenance: DataFrame) -> DataFrame:
    return maintenance.select(
        "machineid", F.col("datetime").alias("maintenance_datetime"),
        F.col("comp").alias("component"), micros(F.col("datetime")).alias("u"),
    )


def _failure_times(failures: DataFrame) -> DataFrame:
    return failures.select("machineid", micros(F.col("datetime")).alias("u"))


def _spine(services: DataFrame) -> DataFrame:
    return services.select("machineid", "u", F.lit(1).cast("bigint").alias("k"))


def services_by_component(maintenance: DataFrame) -> DataFrame:
    per_machine = maintenance.groupBy("comp", "machineid").agg(F.count(F.lit(1)).alias("n"))
    return per_machine.groupBy(F.col("comp").alias("component")).agg(
        F.sum("n").alias("maintenance_count"), F.count("machineid").alias("distinct_machines_serviced")
    )


def failures_after_service(maintenance: DataFrame, failures: DataFrame, days: int = 30,
                           cell: int = CELL) -> DataFrame:
    """Every service with each failure in (t, t + days], or once without.

    A service lies in one time cell; a failure is listed in each cell from
    which it can be seen. Joining on (machine, cell) therefore meets every
    pair once and splits a hot machine by time.
    """
    span = days * DAY
    services = _services(maintenance).withColumn("cell", cell_of(F.col("u"), cell))
    f = F.col("failure_u")
    seen_from = F.sequence(cell_of(f - span, cell), cell_of(f - 1, cell), F.lit(cell))
    marks = failures.select(
        F.col("machineid").alias("f_machineid"), F.col("datetime").alias("failure_datetime"),
        micros(F.col("datetime")).alias("failure_u"),
    ).withColumn("f_cell", F.explode(seen_from))
    within = (
        (F.col("machineid") == F.col("f_machineid")) & (F.col("cell") == F.col("f_cell"))
        & (f > F.col("u")) & (f <= F.col("u") + span)
    )
    return services.join(marks, within, "left").select(
        "machineid", "maintenance_datetime", "component", "failure_datetime",
        F.col("failure_datetime").isNotNull().alias("failure_within_30d" if days == 30 else f"failure_within_{days}d"),
    )


def failure_rate_after_service(maintenance: DataFrame, failures: DataFrame, days: int = 30,
                               dedupe: bool = False) -> DataFrame:
    """Post-service failure rate per component.

    The literal rate follows the join: a service with three failures counts
    three times above and below the line. ``dedupe`` counts each service once.
    Failures ahead of a service are counted, not paired.
    """
    services = _services(maintenance)
    ahead = over_cells(
        [_spine(services)], {"failures": event_parts("failures", _failure_times(failures), None)},
        {"k": "sum", "failures_n": "sum"},
        lambda w: [f"{w.ahead('failures_n', days * DAY)} AS hits"],
        lookahead=days * DAY,
    ).drop("k")
    per_time = services.groupBy("machineid", "u", "component").agg(F.count(F.lit(1)).alias("n"))
    hits, n = F.col("hits"), F.col("n")
    rows = F.sum(n) if dedupe else F.sum(n * F.greatest(hits, F.lit(1)))
    failed = F.sum(n * F.least(hits, F.lit(1))) if dedupe else F.sum(n * hits)
    sums = per_time.join(ahead, ["machineid", "u"]).groupBy("component").agg(
        rows.alias("total_replacements"), failed.alias(f"failures_within_{days}d")
    )
    return sums.withColumn(
        "post_maintenance_failure_rate",
        num(F.col(f"failures_within_{days}d") / F.col("total_replacements"), 4),
    )


def services_without_later_failure(maintenance: DataFrame, failures: DataFrame) -> DataFrame:
    last = _failure_times(failures).groupBy("machineid").agg(F.max("u").alias("last_u"))
    return (
        _services(maintenance).join(last, "machineid", "left")
        .where(F.col("last_u").isNull() | (F.col("last_u") <= F.col("u")))
        .select("machineid", "maintenance_datetime", "component")
    )


def time_to_next_failure(maintenance: DataFrame, failures: DataFrame) -> DataFrame:
    """Days from each distinct service to the next failure, and the component's mean.

    With time reversed, the next failure is the last event before t.
    """
    def flipped(df):
        return df.withColumn("u", -F.col("u"))

    services = _services(maintenance)
    following = over_cells(
        [_spine(flipped(services))],
        {"failures": event_parts("failures", flipped(_failure_times(failures)), None)},
        {"k": "sum", "failures_n": "sum"},
        lambda w: [f"-{w.last('failures', strict=True)} AS next_u"],
        carry=["failures"],
    ).select("machineid", (-F.col("u")).alias("u"), "next_u").where(F.col("next_u").isNotNull())
    gaps = services.distinct().join(following, ["machineid", "u"]).withColumn(
        "days", (F.col("next_u") - F.col("u")) / DAY
    )
    # Few components, and one may hold most services: means are copied to every
    # salt, so that a component's gaps meet them in SALTS parts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    means = gaps.groupBy("component").agg(num(F.avg("days"), 1).alias("avg_days_until_failure")).withColumn("salt", salts)
    salted = gaps.withColumn("salt", F.pmod(F.hash("machineid", "u"), F.lit(SALTS)))
    return salted.join(means, ["component", "salt"]).select(
        "machineid", "component", "maintenance_datetime",
        from_micros(F.col("next_u")).alias("next_failure_datetime"),
        num(F.col("days"), 1).alias("days_until_failure"), "avg_days_until_failure",
    )
