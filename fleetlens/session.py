"""Session settings the package relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on, for the whole session.

    Base tables use zone-less timestamps; UTC keeps their conversion to epoch
    microseconds free of daylight-saving jumps.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A value that does not fit its type fails a load instead of becoming null.
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # The JVM never compiles methods above 8000 bytes. Wide feature projections
    # would exceed that as one whole-stage method and run interpreted; below
    # the limit Spark generates them split into small methods instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate files.

    A cluster names one in ``spark.checkpoint.dir`` (or by ``setCheckpointDir``).
    Without one, a local temporary folder serves a session on one machine, and
    anything else fails: executors would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/fleetlens-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    local = tempfile.mkdtemp(prefix="fleetlens-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return local


def cut_lineage(spark: SparkSession) -> None:
    """Let iterative fits checkpoint: without a folder their lineage grows with every iteration."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a frame to the shared scratch folder and continue from there.

    Cuts the lineage before iterative work: each iteration then reads a plain
    table, and a lost executor costs a re-read instead of a recomputation.
    """
    path = scratch_root(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/table")
    return df.sparkSession.read.parquet(f"{path}/table")
