"""Rolling sensor features as a stateful stream.

State belongs to a (machine, cell of time): the readings of the cell and those
of the day before it, merged by time. A micro-batch adds readings, in whatever
order they come, and sends again what they change: the window sums of all
times up to a day behind them. Rows are numbered by version; the newest of a
(machine, time) counts. A cell's state goes when no reading that it needs can
come any more, by a timer on event time.

Python only adds up whole numbers. Means and deviations are the expressions of
the batch job, so that both round alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetlens.functions.columns import DAY, HOUR, micros
from fleetlens.operators.features import OBSERVED, SCALE, SPLIT, sensor_results
from fleetlens.plans.cells import CELL
from fleetlens.schemas import READING_TYPE, SENSORS, WINDOW_HOURS

_NONE_LOW, _NONE_HIGH = np.iinfo(np.int64).max, np.iinfo(np.int64).min
#: Per time: number of readings, then per sensor n, s, q, r (sums) and its minimum and maximum.
_SUMS = 1 + 4 * len(SENSORS)


def _sum_names() -> list[str]:
    return [f"{sensor}_{m}_{h}h" for h in WINDOW_HOURS for sensor in SENSORS.values() for m in "nsqr"]


def _extreme_names() -> list[str]:
    return [f"{sensor}_{m}_3h" for m in ("min", "max") for sensor in SENSORS.values()]


_NUMBERS = ["u", "version", "k", *_sum_names(), *_extreme_names()]
OUT = ", ".join(["machineid string", *(f"{c} long" for c in _NUMBERS)])


def measures(values: np.ndarray) -> np.ndarray:
    """Per reading: 1, then n, s, q, r of every sensor, all minima, all maxima; ``values`` are in ten-thousandths, NaN for none."""
    known = ~np.isnan(values)
    whole = np.where(known, values, 0).astype(np.int64)
    squares = whole * whole
    parts = np.stack([known.astype(np.int64), whole, squares // SPLIT, squares % SPLIT], axis=2).reshape(len(values), -1)
    return np.hstack([np.ones((len(values), 1), dtype=np.int64), parts,
                      np.where(known, whole, _NONE_LOW), np.where(known, whole, _NONE_HIGH)])


def merged(u: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row a time."""
    order = np.argsort(u, kind="stable")
    u, held = u[order], held[order]
    starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    lows = slice(_SUMS, _SUMS + len(SENSORS))
    return u[starts], np.hstack([np.add.reduceat(held[:, :_SUMS], starts), np.minimum.reduceat(held[:, lows], starts),
                                 np.maximum.reduceat(held[:, lows.stop:], starts)])


def windows(u: np.ndarray, held: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Window sums and 3 h extremes at the times with positions ``at``: columns like OUT from k on; an extreme of nothing is a limit."""
    running = np.vstack([np.zeros((1, _SUMS), dtype=np.int64), held[:, :_SUMS].cumsum(axis=0)])
    out = [held[at, :1]]
    for hours in WINDOW_HOURS:
        first = np.searchsorted(u, u[at] - hours * HOUR, side="right")
        out.append((running[at + 1] - running[first])[:, 1:])
    first = np.searchsorted(u, u[at] - 3 * HOUR, side="right")
    bounds = np.column_stack([first, at + 1]).ravel()
    ends = np.vstack([held, held[-1:]])[:, _SUMS:]  # a row more, so that a window may end behind the last
    m = len(SENSORS)
    out += [np.minimum.reduceat(ends[:, :m], bounds)[::2], np.maximum.reduceat(ends[:, m:], bounds)[::2]]
    return np.hstack(out)


class RollingSensors(StatefulProcessor):
    def __init__(self, cell: int):
        self.cell = cell

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("readings", "u binary, held binary, version long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        machineid, cell = key
        new = list(rows)
        new = pd.concat(new) if len(new) > 1 else new[0]
        u, held, version = new["u"].to_numpy(dtype=np.int64), measures(new[list(SENSORS)].to_numpy(dtype=float)), 0
        low, high = u.min(), u.max()
        if self.state.exists():
            old_u, old_held, version = self.state.get()
            u = np.concatenate([np.frombuffer(old_u, dtype=np.int64), u])
            held = np.vstack([np.frombuffer(old_held, dtype=np.int64).reshape(-1, held.shape[1]), held])
        u, held = merged(u, held)
        self.state.update((u.tobytes(), held.tobytes(), version + 1))
        # Readings up to a day behind the cell's own are late for nobody.
        self.handle.registerTimer((cell + self.cell) // 1000)
        at = np.flatnonzero((u >= max(low, cell)) & (u < min(high + DAY, cell + self.cell)))
        if len(at):
            # One block of numbers: groups are many and small, and every column made on its own costs more than its sums.
            numbers = np.column_stack([u[at], np.full(len(at), version), windows(u, held, at)])
            out = pd.DataFrame(numbers, columns=_NUMBERS)
            out.insert(0, "machineid", machineid)
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def rolling_sensors_stream(telemetry: DataFrame, out: str, checkpoint: str, late: str = "7 days",
                           cell: int = CELL) -> DataFrame:
    """Process all that has arrived and return the newest features: columns of ``rolling_sensors``.

    Readings may come up to ``late`` behind the newest one of any machine; later
    ones are lost. Readings without a machine belong to no state and are left
    out like by the batch job's keys. ``out`` gets one folder per micro-batch,
    which a repeated batch replaces.
    """
    spark = telemetry.sparkSession
    home = f"(u - pmod(u, {cell}L))"
    scaled = [f"CAST(CAST({raw} AS {READING_TYPE}) * {SCALE} AS DOUBLE) AS {raw}" for raw in SENSORS]
    timed = telemetry.withColumn("seen_at", F.col("datetime").cast("timestamp")).withWatermark("seen_at", late)
    placed = timed.withColumn("u", micros(F.col("datetime"))).selectExpr(
        "coalesce(machineid, '\\u0000') AS machineid", "seen_at", "u", *scaled,
        f"explode(array_compact(array({home}, CASE WHEN u > {home} + {cell - DAY}L THEN {home} + {cell}L END))) AS cell")
    changed = placed.groupBy("machineid", "cell").transformWithStateInPandas(
        RollingSensors(cell), OUT, outputMode="Update", timeMode="eventTime")
    changed = changed.withColumns({c: F.when(~F.col(c).isin(_NONE_LOW, _NONE_HIGH), F.col(c)) for c in _extreme_names()})

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = (changed.writeStream.foreachBatch(add).outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return newest(spark.read.schema(OUT).parquet(out))


def newest(versions: DataFrame) -> DataFrame:
    """Features of the newest version of every (machine, time)."""
    values = [c for c in versions.columns if c not in ("machineid", "u")]
    last = versions.groupBy("machineid", "u").agg(F.max_by(F.struct(*values), "version").alias("v")).select("machineid", "u", "v.*")
    extremes = {c: F.expr(f"CAST(CAST({c} AS DECIMAL(18,0)) / {SCALE} AS {READING_TYPE})") for c in _extreme_names()}
    return last.withColumns(extremes).selectExpr("nullif(machineid, '\\u0000') AS machineid", OBSERVED, *sensor_results())
