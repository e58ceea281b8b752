"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
all but the last return the columns of ``documents``. Stages are written to
Parquet and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, lines, packing, quality, simhash
from fleetlens.llm.queries import BYTE_BPE
from fleetlens.llm.shared import stored

#: Packing cuts texts by a vocabulary: not a thing for SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a rule learned from ``labels`` reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.learn_rules(quality.labelled(docs, labels)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines keep one occurrence; a document all of whose lines stand elsewhere goes."""
    kept = lines.dedupe_lines(docs).where("n_removed = 0 or trim(text) <> ''")
    return kept.select(*[F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the documents left."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
