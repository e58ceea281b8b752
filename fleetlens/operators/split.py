"""Stratified splits, folds and class weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.sources.files import observation_hash

# Ranges of the hash that are counted to find a quantile.
RANGES = 4096


def _limits(hashed: DataFrame, cuts: list[float]) -> dict[int, list[int]]:
    """Exact quantiles of the hash per label, at any number of rows.

    Counts per range of the hash tell in which range a quantile lies (labels x
    RANGES numbers); only the rows of that range are put in order.
    """
    ends = hashed.agg(F.min("h").alias("low"), F.max("h").alias("high")).first()
    if ends["low"] is None:
        return {}
    # In doubles, since hashes may span all 64 bits; any rising map to ranges will do.
    width = (float(ends["high"]) - float(ends["low"])) / RANGES or 1.0
    place = F.floor((F.col("h").cast("double") - float(ends["low"])) / width)
    ranged = hashed.select("label", "h", place.cast("int").alias("range"))
    counts: dict[int, list[tuple[int, int]]] = {}
    for label, at, n in ranged.groupBy("label", "range").count().orderBy("label", "range").collect():
        counts.setdefault(label, []).append((at, n))
    wanted = []
    for label, found in counts.items():
        total = sum(n for _, n in found)
        for cut in cuts:
            rank = max(1, math.ceil(cut * total - 1e-9))
            for at, n in found:
                if rank <= n:
                    wanted.append((label, cut, at, rank))
                    break
                rank -= n
    inside = F.lit(False)
    for label, at in {(w[0], w[2]) for w in wanted}:
        inside = inside | ((F.col("label") == label) & (F.col("range") == at))
    nth = F.row_number().over(Window.partitionBy("label", "range").orderBy("h"))
    ranked = ranged.where(inside).withColumn("nth", nth)
    here = F.lit(False)
    for label, _, at, rank in wanted:
        here = here | ((F.col("label") == label) & (F.col("range") == at) & (F.col("nth") == rank))
    values = {(r["label"], r["range"], r["nth"]): r["h"] for r in ranked.where(here).collect()}
    return {label: [values[w[0], w[2], w[3]] for w in wanted if w[0] == label] for label in counts}


def _part(rows: DataFrame, cuts: list[float], name: str, row_hash: Column) -> DataFrame:
    """Number each row by where its hash lies between the class's hash quantiles."""
    hashed = rows.withColumn("h", row_hash.cast("long"))
    above = F.lit(0)
    for label, limits in _limits(hashed, cuts).items():
        place = sum((F.when(F.col("h") > limit, 1).otherwise(0) for limit in limits), F.lit(0))
        above = F.when(F.col("label").eqNullSafe(F.lit(label)), place).otherwise(above)
    return hashed.withColumn(name, above).drop("h")


def stratified_split(rows: DataFrame, seed: int = 42, by: Column | None = None) -> DataFrame:
    """Add ``split``: 60 % train, 20 % val, 20 % test of each class.

    The split depends on row keys only, so every job that reads the table
    repeats it. ``by`` replaces the row hash, for example with a hash of the
    machine, which keeps neighbouring readings on one side.
    """
    parts = _part(rows, [0.6, 0.8], "part", observation_hash(seed) if by is None else by)
    name = F.when(F.col("part") == 0, "train").when(F.col("part") == 1, "val").otherwise("test")
    return parts.withColumn("split", name).drop("part")


def stratified_folds(rows: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    cuts = [i / folds for i in range(1, folds)]
    return _part(rows, cuts, "fold", observation_hash(seed + 1))


def positive_weight(rows: DataFrame) -> DataFrame:
    """Negatives per positive; 1 without positives."""
    neg, pos = F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)
    ratio = F.coalesce(neg / F.nullif(pos, F.lit(0)), F.lit(1.0))
    return rows.agg(neg.alias("negatives"), pos.alias("positives"), ratio.alias("scale_pos_weight"))


def balanced_weights(rows: DataFrame) -> DataFrame:
    """n / (2 * rows of the class)."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select("label", "n", (total / (2 * F.col("n"))).alias("class_weight"))
