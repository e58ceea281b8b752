"""Imputation, scaling and one-hot columns, learned on training rows.

The learned state is a handful of numbers per column; applying it is plain
column arithmetic inside the scan stage. A column of many categories has a
dictionary table instead, which rows are joined with, and fills sparse vectors.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.plans.prefix import running_totals
from fleetlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from fleetlens.session import stored

#: Columns of more categories are encoded by a dictionary table.
INLINE_CATEGORIES = 1000


@dataclass(frozen=True)
class Preparation:
    numeric: list[str]
    means: dict[str, float]
    scales: dict[str, float] | None
    categories: dict[str, list[str]]
    #: Columns of many categories: path and size of the table (value, rank), ranks in order of the values from 0.
    dictionaries: dict[str, tuple[str, int]] = field(default_factory=dict)

    def imputed(self, name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(self.means[name]))

    def scaled(self, name: str) -> Column:
        if self.scales is None:
            return self.imputed(name)
        return (self.imputed(name) - F.lit(self.means[name])) / F.lit(self.scales[name])

    def dummies(self) -> dict[str, Column]:
        """All categories but the first; an unseen or missing one gives zeros."""
        return {
            f"{column}_{value}": F.when(F.col(column) == value, 1.0).otherwise(0.0)
            for column, values in self.categories.items() for value in values[1:]
        }

    def columns(self) -> dict[str, Column]:
        return {name: self.scaled(name) for name in self.numeric} | self.dummies()

    @property
    def names(self) -> list[str]:
        return list(self.columns())

    def vector(self) -> Column:
        """All columns but those with a dictionary."""
        return array_to_vector(F.array(*self.columns().values()))

    def assembled(self, rows: DataFrame, out: str) -> DataFrame:
        """Add the vector of all columns, those with a dictionary last: sparse where that is shorter."""
        if not self.dictionaries:
            return rows.withColumn(out, self.vector())
        spark, kept = rows.sparkSession, rows.columns
        plain = {f"_{out}_{i}": c for i, c in enumerate(self.columns().values())}
        rows, parts = rows.withColumns(plain), list(plain)
        for name, (path, size) in self.dictionaries.items():
            place, sparse = f"_{out}_{name}", f"_{out}_{name}_x"
            ranks = spark.read.parquet(path).select(F.col("value").alias(f"{place}_value"), "rank")
            # The first value, an unseen and a missing one come last and are dropped.
            rows = rows.join(ranks, F.col(name) == F.col(f"{place}_value"), "left").withColumn(
                place, F.when(F.col("rank") > 0, F.col("rank") - 1.0).otherwise(F.lit(size - 1.0))).drop("rank", f"{place}_value")
            sizes = spark.createDataFrame([(0.0,), (size - 1.0,)], f"{place} double")
            rows = OneHotEncoder(inputCol=place, outputCol=sparse).fit(sizes).transform(rows)
            parts.append(sparse)
        return VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="keep").transform(rows).select(*kept, out)

    def feature_names(self, spark: SparkSession) -> list[str]:
        """Names in vector order."""
        many = [f"{name}_{r['value']}" for name, (path, _) in self.dictionaries.items()
                for r in spark.read.parquet(path).where("rank > 0").orderBy("rank").collect()]
        return self.names + many

    def to_dict(self) -> dict:
        return asdict(self)


def learn(rows: DataFrame, numeric: list[str] = NUMERIC_FEATURES,
          categorical: list[str] = CATEGORICAL_FEATURES, scale: bool = True) -> Preparation:
    """One aggregate for all numeric columns and one per categorical column."""
    stats = [f"{f}(CAST({name} AS DOUBLE))" for name in numeric for f in ("avg", "var_pop", "count")]
    result = rows.selectExpr(*[f"{s} AS s{i}" for i, s in enumerate(stats)], "count(*) AS n").first()
    means, scales = {}, {}
    for i, name in enumerate(numeric):
        mean, variance, present = result[3 * i], result[3 * i + 1], result[3 * i + 2]
        means[name] = mean if mean is not None else 0.0
        # Imputed rows sit on the mean: they shrink the variance and nothing else.
        spread = math.sqrt(variance * present / result["n"]) if present else 0.0
        scales[name] = spread or 1.0
    categories, dictionaries = {}, {}
    for name in categorical:
        found = rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.lit(1).alias("one"))
        few = found.limit(INLINE_CATEGORIES + 1).collect()
        if len(few) > INLINE_CATEGORIES:
            dictionaries[name] = _dictionary(stored(found))
        else:
            categories[name] = sorted(row["value"] for row in few)
    return Preparation(list(numeric), means, scales if scale else None, categories, dictionaries)


def _dictionary(found: DataFrame) -> tuple[str, int]:
    """Path and size of the stored table (value, rank) of these values."""
    ranked = running_totals(found, {"value": F.col("value")}, ["one"]).select("value", (F.col("cum_one") - 1).cast("int").alias("rank"))
    table = stored(ranked)
    return table.inputFiles()[0].rsplit("/", 1)[0], table.count()


def apply_columns(rows: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    return rows.select(*keep, *[c.alias(name) for name, c in columns.items()])
