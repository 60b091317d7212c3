"""Work on large tables slice by slice, so that only one slice's shuffles lie on disk at a time.

A slice is the rows whose key hashes to its number. Operators that join or aggregate by that key find in a slice all they
would find in the whole table, so the slices' results together are the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.session import shared_dir

# Stored bytes of a table that make a slice, and most slices: each reads the table again.
SLICE_BYTES = 16 * 1024 * 1024
MOST_SLICES = 8


def how_many(stored_bytes: int) -> int:
    return max(1, min(MOST_SLICES, -(-stored_bytes // SLICE_BYTES)))


def number(key: str, n: int) -> Column:
    """A row's slice. Null is a key like others. The seed keeps slices apart from the hashes that shuffles and buckets go by."""
    return F.pmod(F.xxhash64(F.lit("slice"), F.col(key)), F.lit(n)).cast("int")


def of(df: DataFrame, key: str, n: int, i: int) -> DataFrame:
    return df.where(number(key, n) == i)


def stored(df: DataFrame, key: str, n: int, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build(df)`` for a ``build`` that needs the rows of one key together: lazy for one slice, else written slice by slice."""
    if n == 1:
        return build(df)
    path = shared_dir(df.sparkSession, "slices")
    for i in range(n):
        found = build(of(df, key, n, i))
        found.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)
