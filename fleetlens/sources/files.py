"""CSV sources, table writers, logs and small exports."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import key_hash, micros
from fleetlens.operators.checks import broken_constraints
from fleetlens.operators.promote import KINDS, judged
from fleetlens.schemas import FEATURES, RAW_FILES, STAGING_COLUMNS


def read_csv_text(spark: SparkSession, path: str, with_source: bool = False) -> DataFrame:
    """Headers in lower case, every column as text; no pass over the data for types.

    A file whose header differs from the others' fails the read instead of
    being taken column by column. ``with_source`` adds ``source_file``.
    """
    df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    named = [F.col(f"`{c}`").alias(c.lower()) for c in df.columns]
    return df.select(*named, *([F.col("_metadata.file_path").alias("source_file")] if with_source else []))


def read_staging(spark: SparkSession, folder: str, with_source: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """The raw files that exist, by table, and the names of the missing ones."""
    tables, missing = {}, []
    for file_name, table in RAW_FILES.items():
        try:
            df = read_csv_text(spark, f"{folder}/{file_name}", with_source)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition()):
                raise
            missing.append(file_name)
            continue
        tables[table] = df.select(*STAGING_COLUMNS[table], *(["source_file"] if with_source else []))
    return tables, missing


def write_csv_text(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))


def replace_table(df: DataFrame, path: str, cluster_by: list[str] = ()) -> DataFrame:
    """Full refresh: a second load replaces the first.

    Sorting inside the write tasks costs no shuffle and lets parquet skip row
    groups by machine and time.
    """
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_base_tables(tables: dict[str, DataFrame], folder: str, strict: bool = False) -> dict[str, DataFrame]:
    """Store promoted tables; facts get a surrogate id.

    ``strict`` refuses the whole load where a key, a reference or a NOT NULL
    rule is broken, and says which.
    """
    broken = broken_constraints(tables) if strict else []
    if broken:
        raise ValueError("load refused: " + "; ".join(broken))
    stored = {}
    for name, df in tables.items():
        if name == "machines":
            stored[name] = replace_table(df, f"{folder}/{name}")
        else:
            keyed = df.withColumn("id", F.monotonically_increasing_id())
            stored[name] = replace_table(keyed, f"{folder}/{name}", ["machineid", "datetime"])
    return stored


def load_with_quarantine(staging: dict[str, DataFrame], folder: str) -> DataFrame:
    """Store judged rows, accepted and rejected apart, and report how many there were of each.

    One pass a table: the write deals rows to both folders and counts them on the way.
    """
    spark, counts = next(iter(staging.values())).sparkSession, []
    for name, df in staging.items():
        seen = Observation()
        keep = ["source_file"] if "source_file" in df.columns else []
        rows = judged(df, name, keep).observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if("rejected").alias("rejected"))
        rows.write.mode("overwrite").partitionBy("rejected").parquet(f"{folder}/{name}")
        counts.append((name, seen.get["n"], seen.get["n"] - seen.get["rejected"], seen.get["rejected"]))
    return spark.createDataFrame(counts, "table_name string, read_rows long, accepted long, rejected long")


def accepted_rows(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Typed rows of a load with quarantine, machines without repetitions."""
    rows = spark.read.parquet(f"{folder}/{table}").where(F.col("rejected") == "false").select(*KINDS[table])
    return rows.distinct() if table == "machines" else rows


def rejected_rows(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Rows in quarantine as they came, with the reasons and, where it is known, their file."""
    rows = spark.read.parquet(f"{folder}/{table}").where(F.col("rejected") == "true")
    return rows.select("raw.*", "reasons", *(c for c in rows.columns if c == "source_file"))


def store_features(features: DataFrame, path: str) -> DataFrame:
    return replace_table(features, path, ["machineid", "observation_time"])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Labelled rows only; the filter reaches the parquet scan."""
    return spark.read.parquet(path).where(F.col("label").isNotNull())


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("features").isNotNull())


def observation_hash(seed: int = 42) -> Column:
    return key_hash(F.col("machineid"), micros(F.col("observation_time")), seed=seed)


def reference_sample(features: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """The n labelled rows with the smallest key hash: random, but repeatable."""
    labelled = features.where(F.col("label").isNotNull())
    picked = labelled.withColumn("h", observation_hash(seed)).orderBy("h", "machineid", "observation_time")
    return picked.limit(n).select("machineid", "observation_time", *[c for c in FEATURES if c in features.columns])


def export_json(result: DataFrame, path: str) -> None:
    """Metric rows, one file."""
    result.coalesce(1).write.mode("overwrite").json(path)


def export_csv(result: DataFrame, path: str) -> None:
    """Importance rows, one file in their given order."""
    result.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def loaded_report(tables: dict[str, DataFrame], missing: list[str]) -> DataFrame:
    """What a load found: rows per file, null where the file is missing."""
    spark = next(iter(tables.values())).sparkSession
    parts = [
        tables[table].agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(file_name).alias("file_name"), F.lit(table).alias("table_name"), "row_count")
        for file_name, table in RAW_FILES.items() if table in tables
    ]
    if missing:
        parts.append(spark.createDataFrame(
            [(m, RAW_FILES[m], None) for m in missing], "file_name string, table_name string, row_count bigint"))
    return reduce(DataFrame.unionByName, parts)
