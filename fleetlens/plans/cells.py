"""Per-machine time windows that survive a hot machine.

A plain ``Window.partitionBy("machineid")`` puts all rows of a machine into
one task. Here time is cut into cells (three days by default) and the window
runs per (machine, cell), so even a machine that owns a third of all rows is
spread over many tasks. Two things make the cells exact:

* halo  - a row that a neighbouring cell can see through a bounded window is
          copied into that cell;
* carry - what an unbounded window would see before the cell (counts, last
          event) arrives as one summary row per (machine, cell). Summaries
          are running totals over cells, so their number depends on the time
          span and not on the number of rows.

Sums over a bounded window are the difference of two running sums, however
many rows the window spans. They are taken over whole numbers, so nothing is
lost in the subtraction. Spark shuffles and sorts the rows by (machine, cell,
time); the running sums of a batch of whole cells are array operations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import DAY
from fleetlens.plans.whole import deviation, mean, reading
from fleetlens.schemas import READING_TYPE

CELL = 3 * DAY
#: Windows with whole numbers as results; the others have readings.
WHOLE = ("back", "ahead", "total", "last")


def cell_of(u: Column, width: int = CELL) -> Column:
    """Start of the cell that holds ``u`` (floors, also before 1970)."""
    return u - F.pmod(u, F.lit(width))


def merge_by_time(parts: list[DataFrame], combine: dict[str, str], key: str = "machineid") -> DataFrame:
    """One row per (key, u) out of several row sets.

    ``combine`` maps a measure to sum, min or max; sums of nothing are 0.
    Repeated keys collapse before the shuffle, so a group of copies costs one
    row per task.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    text = {"sum": "coalesce(sum({c}), 0) AS {c}", "min": "min({c}) AS {c}", "max": "max({c}) AS {c}"}
    return rows.groupBy(key, "u").agg(*[F.expr(text[f].format(c=c)) for c, f in combine.items()])


def event_parts(name: str, events: DataFrame, kind: str | None, key: str = "machineid") -> list[DataFrame]:
    """Occurrences ``<name>_n`` and, for typed events, first-of-a-type ``<name>_new``."""
    parts = [events.select(key, "u", F.lit(1).cast("bigint").alias(f"{name}_n"))]
    if kind is not None:
        firsts = events.where(F.col(kind).isNotNull()).groupBy(key, kind).agg(F.min("u").alias("u"))
        parts.append(firsts.select(key, "u", F.lit(1).cast("bigint").alias(f"{name}_new")))
    return parts


@dataclass(frozen=True)
class Frame:
    """One window: what it takes of which input column, and how far it reaches."""

    kind: str
    columns: tuple[str, ...]
    span: int = 0
    strict: bool = False


class CellWindow:
    """Windows over one (machine, cell), as names of their results.

    Inputs are SQL text over the placed rows and whole numbers throughout.
    Every input and every window is noted once.
    """

    def __init__(self, key: str, carried: list[str] = ()):
        self.key = key
        self.carried = set(carried)
        self.inputs: dict[str, str] = {}  # SQL text -> column
        self.windows: dict[Frame, str] = {}  # window -> column of its result
        self.seen_ahead: set[str] = set()

    def _noted(self, kind: str, *texts: str, span: int = 0, strict: bool = False) -> str:
        columns = tuple(self.inputs.setdefault(text, f"in_{len(self.inputs)}") for text in texts)
        return self.windows.setdefault(Frame(kind, columns, span, strict), f"out_{len(self.windows)}")

    def back(self, measure: str, span: int) -> str:
        """Sum over (t - span, t]."""
        return self._noted("back", f"coalesce({measure}, 0L)", span=span)

    def ahead(self, measure: str, span: int) -> str:
        """Sum over (t, t + span]."""
        self.seen_ahead.add(measure)
        return self._noted("ahead", f"coalesce({measure}, 0L)", span=span)

    def extreme(self, func: str, measure: str, span: int) -> str:
        """Minimum or maximum over (t - span, t], of whole ten-thousandths as decimals."""
        return self._noted(func, measure, span=span)

    def mean(self, raw: str, span: int) -> str:
        """Mean over (t - span, t] from ``<raw>_n`` and ``<raw>_s``."""
        return self._noted("mean", *(f"coalesce({raw}_{m}, 0L)" for m in "ns"), span=span)

    def deviation(self, raw: str, span: int) -> str:
        """Population deviation over (t - span, t] from ``<raw>_n``, ``_s``, ``_q`` and ``_r``."""
        return self._noted("deviation", *(f"coalesce({raw}_{m}, 0L)" for m in "nsqr"), span=span)

    def total(self, measure: str, strict: bool = False) -> str:
        """Sum over all rows up to t (before t if strict)."""
        seen = f"coalesce(before_{measure}, CASE WHEN own THEN {measure} END, 0L)"
        return self._noted("total", seen, strict=strict)

    def last(self, name: str, strict: bool = False) -> str:
        """Time of the latest event up to t (before t if strict); without carry,
        of the latest one inside the cell and its halo."""
        seen = f"CASE WHEN {name}_n > 0 THEN u END"
        if name in self.carried:
            seen = f"coalesce(before_{name}_u, {seen})"
        return self._noted("last", seen, strict=strict)


def _group_starts(table: pa.Table, key: str) -> np.ndarray:
    """Positions where a (key, cell) begins."""
    codes = table[key].combine_chunks().dictionary_encode("encode").indices.to_numpy()
    cells = table["cell"].to_numpy()
    return np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (cells[1:] != cells[:-1])]))


def _evaluated(table: pa.Table, key: str, windows: dict[Frame, str], reach: tuple[int, int, int]) -> pa.RecordBatch:
    """Results of all windows for the kept rows of whole cells, sorted by key, cell and time.

    A position on one line, cells apart further than any window reaches, stands for (cell, time):
    a window begins and ends where a position is found.
    """
    width, lookback, lookahead = reach
    n, starts = len(table), _group_starts(table, key)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    begin, row = starts[group], np.arange(n)
    length = width + 2 * (lookback + lookahead + 1)
    place = group * length + (table["u"].to_numpy() - table["cell"].to_numpy()) + lookback + 1
    kept = np.flatnonzero(table["kept"].to_numpy())
    begin, upto = begin[kept], kept
    bounds, sums, latest = {}, {}, {}

    def bound(offset: int) -> np.ndarray:
        """For every kept row: the first row after t + offset."""
        if offset not in bounds:
            bounds[offset] = np.searchsorted(place, place[kept] + offset, side="right")
        return bounds[offset]

    def running(column: str) -> np.ndarray:
        """Sums of the rows before a position."""
        if column not in sums:
            sums[column] = np.concatenate([[0], np.cumsum(table[column].to_numpy(), dtype=np.int64)])
        return sums[column]

    def known(column: str) -> tuple[np.ndarray, np.ndarray]:
        values = table[column].combine_chunks()
        return values.fill_null(0).to_numpy(), values.is_valid().to_numpy(zero_copy_only=False)

    def back(column: str, span: int) -> np.ndarray:
        return running(column)[upto + 1] - running(column)[bound(-span)]

    def result(w: Frame) -> pa.Array:
        column = w.columns[0]
        if w.kind in ("mean", "deviation"):
            return (mean if w.kind == "mean" else deviation)(*(back(c, w.span) for c in w.columns))
        if w.kind == "back":
            return pa.array(back(column, w.span))
        if w.kind == "ahead":
            total = running(column)
            return pa.array(total[bound(w.span)] - total[upto + 1])
        if w.kind == "total":
            total = running(column)
            return pa.array(total[upto + (not w.strict)] - total[begin])
        values, valid = known(column)
        if w.kind == "last":
            if column not in latest:
                latest[column] = np.maximum.accumulate(np.where(valid, row, -1))
            at = np.where(upto >= w.strict, latest[column][upto - w.strict], -1)
            return pa.array(values[np.maximum(at, 0)], mask=at < begin)
        func, nothing = (np.minimum, np.iinfo(np.int64).max) if w.kind == "min" else (np.maximum, np.iinfo(np.int64).min)
        filled = np.append(np.where(valid, values, nothing), nothing)
        edges = np.column_stack([bound(-w.span), upto + 1]).ravel()
        found = func.reduceat(filled, edges)[::2] if len(edges) else filled[:0]
        return reading(np.where(found == nothing, 0, found), found == nothing)

    plain = [table[c].combine_chunks().take(pa.array(kept)) for c in (key, "u", "k")]
    return pa.RecordBatch.from_arrays([*plain, *map(result, windows)], [key, "u", "k", *windows.values()])


def _windows_over(rows: DataFrame, window: CellWindow, reach: tuple[int, int, int]) -> DataFrame:
    """Results of the windows for the rows with ``kept``; a task holds a batch and the cell it ends in."""
    key, windows = window.key, dict(window.windows)

    def whole_cells(batches):
        pending = []
        for batch in batches:
            if not batch.num_rows:
                continue
            piece = pa.Table.from_batches([batch])
            last = int(_group_starts(piece, key)[-1])
            if last:
                yield _evaluated(pa.concat_tables([*pending, piece.slice(0, last)]), key, windows, reach)
                pending = []
            pending.append(piece.slice(last))
        if pending:
            yield _evaluated(pa.concat_tables(pending), key, windows, reach)

    types = {w: "long" if w.kind in WHOLE else READING_TYPE for w in windows}
    schema = ", ".join([f"{key} {rows.schema[key].dataType.simpleString()}", "u long", "k long", *(f"{c} {types[w]}" for w, c in windows.items())])
    ordered = rows.repartition(key, "cell").sortWithinPartitions(key, "cell", "u")
    return ordered.mapInArrow(whole_cells, schema)


def over_cells(
    spine: list[DataFrame],
    events: dict[str, list[DataFrame]],
    combine: dict[str, str],
    build: Callable[[CellWindow], list[str]],
    *,
    carry: list[str] = (),
    lookback: int = 0,
    lookahead: int = 0,
    key: str = "machineid",
    cell: int = CELL,
) -> DataFrame:
    """Evaluate time windows for every (key, u) of the spine.

    spine    row sets with key, u, ``k`` (1 per row) and any measures
    events   name -> parts from ``event_parts``
    combine  aggregate per measure, see ``merge_by_time``
    build    window -> output columns as SQL text
    carry    names of events whose whole past matters
    """
    width = max(cell, lookback, lookahead)
    all_events = [part for parts in events.values() for part in parts]
    rows = merge_by_time([*spine, *all_events], combine, key)

    window = CellWindow(key, carry)
    columns = build(window)

    home = f"(u - pmod(u, {width}L))"
    copies = [home]
    if lookback:
        copies.append(f"CASE WHEN u > {home} + {width - lookback}L THEN {home} + {width}L END")
    if lookahead:  # only rows with something that is looked for
        seen = " OR ".join(f"{measure} != 0" for measure in sorted(window.seen_ahead)) or "false"
        copies.append(f"CASE WHEN u < {home} + {lookahead}L AND ({seen}) THEN {home} - {width}L END")
    cells = f"explode(array_compact(array({', '.join(copies)})))" if len(copies) > 1 else home
    placed = rows.selectExpr("*", f"{cells} AS cell")
    own = f"cell = {home}"
    if carry:
        placed = placed.unionByName(
            _carry_rows(spine, {n: events[n] for n in carry}, key, width, lookback),
            allowMissingColumns=True,
        )
        own += " AND is_carry IS NULL"
    inputs = [f"{text} AS {name}" for text, name in window.inputs.items()]
    rows = placed.where("u IS NOT NULL").selectExpr("*", f"{own} AS own").selectExpr(
        key, "cell", "u", "coalesce(k, 0L) AS k", "coalesce(own AND k > 0, false) AS kept", *inputs)
    return _windows_over(rows, window, (width, lookback, lookahead)).selectExpr(key, "u", "k", *columns)


def _carry_rows(spine, events, key, width, lookback) -> DataFrame:
    """What happened before each cell, as one early row per (key, cell)."""
    home = cell_of(F.col("u"), width).alias("cell")
    cells = [part.select(key, home) for part in spine]
    sums, lasts = [], []
    for name, parts in events.items():
        for part in parts:
            measure = part.columns[-1]
            sums.append(measure)
            if measure == f"{name}_n":
                lasts.append(f"{name}_u")
                cells.append(part.select(key, home, measure, F.col("u").alias(f"{name}_u")))
            else:
                cells.append(part.select(key, home, measure))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cells)
    per_cell = merged.groupBy(key, "cell").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in lasts]
    )
    earlier = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return per_cell.select(
        key,
        "cell",
        (F.col("cell") - lookback - 1).alias("u"),
        F.lit(True).alias("is_carry"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.max(c).over(earlier).alias(f"before_{c}") for c in lasts],
    )


def trailing_rows(
    rows: DataFrame,
    order: list[str],
    depth: int,
    build: Callable[[object], list[Column]],
    *,
    key: str = "machineid",
) -> DataFrame:
    """Windows over the current and the ``depth`` preceding rows of a machine.

    ``rows`` needs key, cell and the ``order`` columns (a total order that
    starts with time). Within a cell the frame is ready except for the first
    ``depth`` rows. Those are taken from a second window over cell edges only
    - at most ``2 * depth`` rows per (machine, cell) - which holds every
    predecessor they can have. Both branches read the same shuffle.
    """
    per_cell = Window.partitionBy(key, "cell")
    ordered = per_cell.orderBy(*order)
    ranked = rows.withColumn("pos", F.row_number().over(ordered)).withColumn(
        "left", F.count(F.lit(1)).over(per_cell) - F.col("pos")
    )
    inner = ranked.select("*", *build(ordered)).where(F.col("pos") > depth)
    edges = ranked.where((F.col("pos") <= depth) | (F.col("left") < depth))
    per_key = Window.partitionBy(key).orderBy(*order)
    first = edges.select("*", *build(per_key)).where(F.col("pos") <= depth)
    return inner.unionByName(first).drop("pos", "left")


def numbered(rows: DataFrame, order: list[str], name: str, *, key: str = "machineid") -> DataFrame:
    """Running row number per machine: position in the cell plus rows before the cell."""
    counts = rows.groupBy(key, "cell").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key).alias("o_key"), F.col("cell").alias("o_cell"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
    )
    pos = F.row_number().over(Window.partitionBy(key, "cell").orderBy(*order))
    same = F.col(key).eqNullSafe(F.col("o_key")) & (F.col("cell") == F.col("o_cell"))
    placed = rows.withColumn("pos", pos).join(offsets, same)
    return placed.withColumn(name, F.col("offset") + F.col("pos")).drop("offset", "pos", "o_key", "o_cell")
