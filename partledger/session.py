"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8,000 bytes: a wide stage generated as one such method
    # runs interpreted, several times slower than its operators generated one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What one task reads does not grow with the tables: pieces of files and of shuffles have a size of their own.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A join whose smaller side fits a task's memory builds a hash table of it and sorts neither side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
}
# Settings of sessions that write tables. They hold less on disk and leave rows as they are.
TABLE_SETTINGS = {
    # What an execution has shuffled goes when it ends, not when the JVM next collects garbage: a table built from
    # written tables never needs the shuffles that these came from.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes few partitions writes them side by side instead of sorting its rows by them.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}
# Quick compression, of tables that are mostly read once. Spark hands the setting on to the writer.
ZSTD_LEVEL = "parquet.compression.codec.zstd.level"
# Compressed bytes of input for which a shuffle begins with one more partition; small ones are put together afterwards.
PARTITION_BYTES = 2 * 1024 * 1024
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "partledger", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **TABLE_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.conf.set(ZSTD_LEVEL, "1")
    return session


def apply_settings(spark: SparkSession, tables: bool = False) -> SparkSession:
    """Bring a session someone else made to the settings the plans, and those that write tables, are written for."""
    for name, value in (RUNTIME_SETTINGS | (TABLE_SETTINGS | {ZSTD_LEVEL: "1"} if tables else {})).items():
        spark.conf.set(name, value)
    return spark


def fit_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles begin with as many partitions as the input asks for, at least ``spark.sql.shuffle.partitions``."""
    spark.conf.set(FIRST_PARTITIONS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes // PARTITION_BYTES))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``shared_dir`` that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    ``spark.checkpoint.dir`` names storage that outlives an executor and that all of them reach. Only
    a local session may go without it: it gets a temporary folder, once per session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = getattr(spark, "_partledger_shared", None)
        if not base:
            base = tempfile.mkdtemp(prefix="partledger-")
            spark._partledger_shared = base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
