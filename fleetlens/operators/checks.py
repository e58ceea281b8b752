"""Constraints as check jobs: each returns what violates the rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.quality import orphan_rows


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Primary key or UNIQUE: key values that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_parents(tables: dict[str, DataFrame], machines: DataFrame) -> DataFrame:
    """Foreign key: rows per table whose machine does not exist."""
    return orphan_rows(tables, machines)


def null_values(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """NOT NULL: nulls per required column, one aggregate per table."""
    parts = []
    for name, (df, columns) in tables.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.explode(pairs).alias("p"))
                     .select("table_name", "p.*"))
    return reduce(DataFrame.unionByName, parts)


def failed_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """CHECK: rows per rule for which it is false (null passes, as in SQL)."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def prediction_rules(probability: str = "failure_probability", label: str = "predicted_label") -> dict[str, Column]:
    return {
        "probability_in_range": F.col(probability).between(0, 1),
        "label_is_binary": F.col(label).isin(0, 1),
    }


#: Columns that a base table may not hold nulls in (sensor readings may).
REQUIRED = {
    "machines": ["machineid", "model", "age"],
    "telemetry": ["datetime", "machineid"],
    "errors": ["datetime", "machineid", "errorid"],
    "maintenance": ["datetime", "machineid", "comp"],
    "failures": ["datetime", "machineid", "failure"],
}


def broken_constraints(tables: dict[str, DataFrame]) -> list[str]:
    """What would stop a load of base tables: repeated machines, unknown machines, nulls."""
    found = []
    nulls = null_values({name: (df, REQUIRED[name]) for name, df in tables.items()})
    found += [f"{r['null_rows']} nulls in {r['table_name']}.{r['column_name']}"
              for r in nulls.where("null_rows > 0").collect()]
    if "machines" in tables:
        repeated = repeated_keys(tables["machines"], "machineid").count()
        found += [f"{repeated} repeated machines"] if repeated else []
        facts = {name: df for name, df in tables.items() if name != "machines"}
        if facts:
            orphans = missing_parents(facts, tables["machines"]).where("orphaned_rows > 0").collect()
            found += [f"{r['orphaned_rows']} rows of {r['table_name']} without a machine" for r in orphans]
    return sorted(found)
