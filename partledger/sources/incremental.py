"""Watermarks, change positions and run ledgers: the small control records of incremental loads."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger import schemas
from partledger.context import EPOCH_START
from partledger.functions.columns import age_hours
from partledger.sinks import read_text, write_text


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """The control record, one JSON array in a file; empty where there is none yet."""
    if read_text(spark, path) is None:
        return spark.createDataFrame([], schemas.WATERMARK)
    return spark.read.schema(schemas.WATERMARK).json(path, multiLine=True)


def watermark_of(control: DataFrame, table: str) -> str:
    """Last committed watermark of a table; the start of time when there is none."""
    row = control.where(F.col("table_name") == table).agg(F.max("last_watermark")).first()
    return row[0] or EPOCH_START


def changed_between(df: DataFrame, column: str, after: str, upto: datetime | str) -> DataFrame:
    """Rows changed in (after, upto], stamped with the upper bound.

    The caller takes the upper bound once, before reading, and commits that same value afterwards.
    Both tests are plain comparisons, so they reach the Parquet or JDBC source.
    """
    kind = df.schema[column].dataType.simpleString()
    low, high = F.lit(str(after)).cast(kind), F.lit(str(upto)).cast(kind)
    changed = df.where((F.col(column) > low) & (F.col(column) <= high))
    return changed.withColumn("_ingestion_ts", F.lit(str(upto)).cast("timestamp"))


def land(changes: DataFrame, path: str, run_id: str) -> str:
    """Write a run's changed rows as Parquet in a folder of their own; a repeat by the same name replaces it."""
    folder = f"{path}/run={run_id}"
    changes.write.mode("overwrite").parquet(folder)
    return folder


def commit_watermarks(control: DataFrame, tables: list[str], upto: datetime, path: str) -> None:
    """Write the control record anew, after the data of the named tables has been committed.

    Tables the record lacks are added to it. The new record replaces the old one in one step.
    """
    stamp = upto.strftime("%Y-%m-%d %H:%M:%S")
    records = {r["table_name"]: r.asDict() for r in control.collect()}  # one row per source table
    for table in tables:
        records[table] = {**records.get(table, {"table_name": table}), "last_watermark": stamp}
    write_text(control.sparkSession, path, json.dumps([records[t] for t in sorted(records)]))


def changes_after(feed: DataFrame, positions: DataFrame, table: str, lsn: str) -> DataFrame:
    """Change-feed rows above the table's recorded position (all of them when it has none)."""
    row = positions.where(F.col("table_name") == table).agg(F.max("last_lsn")).first()
    return feed if row[0] is None else feed.where(F.col(lsn) > row[0])


def staleness(watermarks: DataFrame, now: Column, limit_hours: float) -> DataFrame:
    """Age in hours of each watermark. One that cannot be read, or lies in the future, does not pass."""
    seen = F.try_to_timestamp("last_watermark")
    aged = watermarks.select("table_name", "last_watermark", age_hours(now, seen).alias("age_hours"))
    return aged.select("*", F.col("age_hours").isNull().alias("unreadable"),
                       F.coalesce(F.col("age_hours").between(0, limit_hours), F.lit(False)).alias("passed"))


def latest_runs(ledger: DataFrame) -> DataFrame:
    """The newest state of every pipeline in a run ledger."""
    newest = F.max_by(F.struct("run_id", "status", "last_updated"), F.struct("last_updated", "run_id"))
    return ledger.groupBy("pipeline_name").agg(newest.alias("s")).select("pipeline_name", "s.*")


def all_succeeded(ledger: DataFrame) -> DataFrame:
    """One row: how many pipelines there are, how many succeeded, and whether the next layer may start."""
    ok = F.col("status") == "SUCCESS"
    return latest_runs(ledger).agg(
        F.count(F.lit(1)).alias("pipelines"), F.count_if(ok).alias("succeeded"),
        F.coalesce(F.bool_and(ok), F.lit(False)).alias("may_start"))
