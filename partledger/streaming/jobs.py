"""Streaming forms of the incremental loads. Each runs to the end of what is there and stops.

A batch writes only its own rows, to a folder named after the batch: a batch that is repeated after a
failure replaces its own output and nothing else, and its cost goes with its size, not with the size
of the table. Readers take the newest row per key (``current``); ``fold`` brings the batches together
from time to time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming import StreamingQuery

from partledger.operators.dedup import latest_per_key
from partledger.sources.files import CSV_DIALECT

LATENESS = "25 hours"


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def csv_arrivals(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Stream of CSV files as they arrive below a folder, with the file of each row."""
    reader = spark.readStream.schema(schema).options(**CSV_DIALECT).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.csv").csv(path).select("*", F.col("_metadata.file_path").alias("_source_file"))


def parquet_arrivals(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def _each_batch(stream: DataFrame, path: str, checkpoint: str, mode: str,
                step: Callable[[DataFrame], DataFrame]) -> None:
    def store(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    finish(writer.trigger(availableNow=True).foreachBatch(store).start())


def ingest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], by: Sequence[str]) -> None:
    """Store arriving rows, the newest per key of each batch. Files seen once are never read again."""
    _each_batch(stream, path, checkpoint, "append", lambda batch: latest_per_key(batch, keys, by))


def store_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Store every updated result of an aggregation."""
    _each_batch(stream, path, checkpoint, "update", lambda batch: batch)


def current(spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The table the batches make, key by key: the highest ``by`` wins, then the later batch."""
    return latest_per_key(spark.read.parquet(path), keys, [*by, "batch"]).drop("batch")


def current_of_feed(spark: SparkSession, path: str, keys: Sequence[str], lsn: str, op: str,
                    delete: str = "delete") -> DataFrame:
    """The table a stored change feed makes: per key the highest sequence number wins, deleted keys are gone."""
    final = latest_per_key(spark.read.parquet(path).drop("batch"), keys, [lsn])
    return final.where(~F.col(op).eqNullSafe(F.lit(delete))).drop(op)


def fold(table: DataFrame, path: str) -> None:
    """Write the table the batches make as batch -1 of a new folder, to go on from there."""
    table.write.mode("errorifexists").parquet(f"{path}/batch=-1")


def without_repeats(stream: DataFrame, time: str, keys: Sequence[str], lateness: str = LATENESS) -> DataFrame:
    """Drop repeats of a key that arrive within the lateness; state is bounded by it."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_activity(stream: DataFrame, time: str, by: Sequence[str], lateness: str = LATENESS) -> DataFrame:
    """Rows per day and group, on event time."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), *by, "n")


def to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append results to Parquet files: rows are final when they are written."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    finish(writer.trigger(availableNow=True).format("parquet").start(path))
