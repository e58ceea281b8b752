"""The traffic queries as streams.

A stream only adds up five-second slots, one folder of partial results per
micro-batch; windows are summed from slots when they are read. So no row is too
late, no window waits for a watermark, and a batch that runs again replaces
what it had written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.traffic import (
    BUCKETS_MS,
    bucket_counts,
    latency_quantiles,
    rate_sums,
    rates,
    slots,
)


def _partials(requests: DataFrame, key: str, sums: dict[str, Column], out: str, checkpoint: str) -> DataFrame:
    """Process all available input and return the slots gathered so far."""

    def add(batch: DataFrame, number: int) -> None:
        slots(batch, key, sums).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (requests.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    empty = requests.sparkSession.createDataFrame([], requests.schema)
    return requests.sparkSession.read.schema(slots(empty, key, sums).schema).parquet(out)


def request_rate_stream(requests: DataFrame, key: str, out: str, checkpoint: str) -> DataFrame:
    return rates(_partials(requests, key, rate_sums(), out, checkpoint), key)


def latency_quantile_stream(requests: DataFrame, out: str, checkpoint: str, q: float = 0.95,
                            limits: list[float] = BUCKETS_MS) -> DataFrame:
    sums = bucket_counts(F.col("latency_ms"), limits)
    return latency_quantiles(_partials(requests, "handler", sums, out, checkpoint), q, limits)
