"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Keep the newest row of every key.

    Rows equal in ``by`` are ordered by all their other columns, so the winner never depends on the
    order of the input. Spark puts a group limit before the exchange: each task sends at most one row
    per key, so a key that owns a third of the table does not reach one reducer whole.
    """
    others = sorted(set(df.columns) - set(keys) - set(by))
    newest_first = [F.col(c).desc_nulls_last() for c in (*by, *others)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
