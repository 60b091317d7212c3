"""Dated file drops: scan, provenance, selection of new files, split into snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partledger.context import EPOCH_START
from partledger.functions.columns import file_date

CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": "\\", "mode": "PERMISSIVE"}


def csv_tree(spark: SparkSession, path: str, schema: str | StructType, pattern: str = "*.csv") -> DataFrame:
    """All CSV files below a folder, with the file of every row. The schema is given, never inferred."""
    reader = spark.read.schema(schema).options(**CSV_DIALECT)
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("_source_file"))


def parquet_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def jdbc_table(spark: SparkSession, url: str, table: str, split_column: str, lower: str, upper: str, parts: int,
               **options: str) -> DataFrame:
    """A database table read in parallel ranges; filters put on the result are pushed to the database."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_column, lowerBound=lower, upperBound=upper,
        numPartitions=str(parts), **options)
    return reader.load()


def listing(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Name, path, size and time of the files below a folder. Only file entries are read, not content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path",
        F.col("modificationTime").alias("modified_at"), F.col("length").alias("size_bytes"))


def newer_than(df: DataFrame, path_column: str, last_date: str | None) -> DataFrame:
    """Rows of files dated after the last load; with no last load, all dated files."""
    cutoff = F.lit(last_date or EPOCH_START).cast("date")
    return df.withColumn("file_date", file_date(F.col(path_column))).where(F.col("file_date") > cutoff)


def last_loaded(df: DataFrame) -> DataFrame:
    """The date to remember after a load: the largest file date, as a date."""
    return df.agg(F.coalesce(F.max("file_date"), F.lit(EPOCH_START).cast("date")).alias("last_load_date"))


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not list as processed."""
    done = ledger.where(F.col("status") == "PROCESSED").select("file_name").distinct()
    return files.join(done, "file_name", "left_anti")


def month_snapshot(created: Column, prefix: str = "cad_metadata") -> Column:
    """Name of the monthly snapshot a row belongs to: prefix_YYYY_MM_01."""
    return F.concat(F.lit(prefix + "_"), F.date_format(created, "yyyy_MM"), F.lit("_01"))


def write_snapshots(df: DataFrame, path: str, snapshot: Column, quote_all: bool = True,
                    drop: tuple[str, ...] = ()) -> None:
    """One folder of CSV files per snapshot name.

    ``rebalance`` gathers small snapshots into few files and splits a snapshot that holds a large
    share of the rows over several tasks.
    """
    named = df.withColumn("snapshot", snapshot).drop(*drop).hint("rebalance", "snapshot")
    as_is = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    named.write.partitionBy("snapshot").options(header="true", quoteAll=str(quote_all).lower(), **as_is).csv(path)


def file_stats(df: DataFrame, table: str) -> DataFrame:
    """Files, bytes, rows and newest change of a file-backed table, grouped per file first."""
    per_file = df.groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").agg(
        F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("num_files"), F.sum("file_size").alias("size_bytes"),
        F.sum("n").alias("row_count"), F.max("file_modification_time").alias("last_modified"))
