"""Request rate and latency over a sliding minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import from_micros, micros

# One-minute range, evaluated every five seconds; upper limits of latency buckets.
RANGE_SECONDS = 60
STEP_SECONDS = 5
BUCKETS_MS = [5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0]

STEP = STEP_SECONDS * 1_000_000
RANGE = RANGE_SECONDS * 1_000_000


def slots(requests: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """Partial results per (key, five-second slot); slots of several inputs can be merged.

    A busy handler sends at most one row per slot and task through the shuffle.
    """
    u = micros(F.col("ts"))
    return requests.groupBy(key, (u - F.pmod(u, F.lit(STEP))).alias("slot")).agg(
        *[s.alias(name) for name, s in sums.items()])


def slide(partial: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Sums per (key, window) over the slots of a window; ``top`` is a largest value."""
    starts = F.sequence(F.col("slot") - (RANGE - STEP), F.col("slot"), F.lit(STEP))
    windows = partial.withColumn("start", F.explode(starts)).groupBy(key, "start").agg(
        *[(F.max if name == "top" else F.sum)(name).alias(name) for name in names])
    return windows.select(key, from_micros(F.col("start")).alias("window_start"),
                          from_micros(F.col("start") + RANGE).alias("window_end"), *names)


def rate_sums() -> dict[str, Column]:
    return {"requests": F.count(F.lit(1))}


def rates(partial: DataFrame, key: str) -> DataFrame:
    return slide(partial, key, list(rate_sums())).withColumn("rate", F.col("requests") / RANGE_SECONDS)


def request_rate(requests: DataFrame, key: str) -> DataFrame:
    """Requests per second over each window, by handler or status."""
    return rates(slots(requests, key, rate_sums()), key)


def bucket_counts(latency: Column, limits: list[float] = BUCKETS_MS) -> dict[str, Column]:
    """Cumulative counts per upper limit, in all, and the largest value."""
    at_most = {f"le_{i}": F.count_if(latency <= limit) for i, limit in enumerate(limits)}
    return at_most | {"requests": F.count(F.lit(1)), "top": F.max(latency)}


def bucket_quantile(q: float, limits: list[float] = BUCKETS_MS) -> Column:
    """Quantile from cumulative buckets, linear inside a bucket.

    The bucket beyond the last limit reaches up to the largest value.
    """
    rank, last = q * F.col("requests"), len(limits) - 1

    def inside(low, high, below, upto):
        return low + (high - low) * (rank - below) / F.nullif(upto - below, F.lit(0))

    result = inside(F.lit(limits[last]), F.col("top"), F.col(f"le_{last}"), F.col("requests"))
    for i in reversed(range(len(limits))):
        low, below = (limits[i - 1], F.col(f"le_{i - 1}")) if i else (0.0, F.lit(0))
        value = inside(F.lit(low), F.lit(limits[i]), below, F.col(f"le_{i}"))
        result = F.when(F.col(f"le_{i}") >= rank, value).otherwise(result)
    return result


def latency_quantiles(partial: DataFrame, q: float = 0.95, limits: list[float] = BUCKETS_MS) -> DataFrame:
    sums = slide(partial, "handler", list(bucket_counts(F.lit(0), limits)))
    return sums.select("handler", "window_start", "window_end", "requests", bucket_quantile(q, limits).alias("latency_ms"))


def latency_quantile(requests: DataFrame, q: float = 0.95, limits: list[float] = BUCKETS_MS) -> DataFrame:
    """Latency quantile per handler and window, from mergeable bucket counts."""
    return latency_quantiles(slots(requests, "handler", bucket_counts(F.col("latency_ms"), limits)), q, limits)
