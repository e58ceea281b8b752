"""Running totals over a global order without a single-task sort.

Rows are cut into ranges at split points taken from the data (the rows with
the smallest hashes). Each range is ordered on its own; range sums, a few
hundred rows, supply what came before. Any split points give the same result,
so sampling affects only the balance.

The input is read three times (split points, range sums, rows). If it ends in
an aggregation, all three need the same columns of it and share its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = 256


def _splits(rows: DataFrame, key: Column, measures: list[str], splits: int) -> Column:
    # Hashing the measures too keeps the columns equal to those of the other readers.
    picked = rows.select(key.alias("s"), *measures).orderBy(F.xxhash64("s", *measures), "s").limit(splits)
    return picked.agg(F.sort_array(F.collect_list("s")).alias("s")).scalar()


def running_totals(
    rows: DataFrame,
    order: dict[str, Column],
    measures: list[str],
    group: list[str] = (),
    splits: int = SPLITS,
    previous: bool = False,
) -> DataFrame:
    """Add ``cum_<measure>``, the sum up to and including each row, and ``all_<measure>``.

    ``order`` names the ascending sort expressions; together with ``group``, a
    column with few values, they should identify a row. ``previous`` adds ``prev_<name>``, the value of
    the first sort expression in the row before.
    """
    group = list(group)
    keyed = rows.withColumns({f"_o_{name}": expr for name, expr in order.items()})
    order_cols = [f"_o_{name}" for name in order]
    lead = order_cols[0]
    key = F.struct(*group, *order_cols)
    bounded = keyed.withColumn("_bounds", _splits(keyed, key, measures, splits))
    placed = bounded.withColumn("range", F.size(F.filter("_bounds", lambda s: s < key))).drop("_bounds")

    per_range = placed.groupBy(*group, "range").agg(
        *[F.sum(m).alias(f"s_{m}") for m in measures], F.max(lead).alias("top")
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # A group spans neighbouring ranges, so there are at most splits + groups rows
    # here. Groups are listed columns, never data keys: safe to broadcast.
    offsets = per_range.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("range").alias("_range"),
        *[F.coalesce(F.sum(f"s_{m}").over(earlier), F.lit(0)).alias(f"b_{m}") for m in measures],
        *[F.sum(f"s_{m}").over(whole).alias(f"all_{m}") for m in measures],
        F.max("top").over(earlier).alias("b_top"),
    )
    inside = Window.partitionBy(*group, "range").orderBy(*order_cols)
    # Null-safe equality: a plain one would push "range is not null" below the aggregation.
    match = F.col("range").eqNullSafe(F.col("_range"))
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    totals = [(F.col(f"b_{m}") + F.col(f"r_{m}")).alias(f"cum_{m}") for m in measures]
    totals += [F.col(f"all_{m}") for m in measures]
    before = [F.coalesce("r_prev", "b_top").alias(f"prev_{next(iter(order))}")] if previous else []
    running = {f"r_{m}": F.sum(m).over(inside) for m in measures}
    if previous:
        running["r_prev"] = F.lag(lead).over(inside)
    return placed.withColumns(running).join(F.broadcast(offsets), match).select(*rows.columns, *totals, *before)
