"""Upsert and change-feed application as plain DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partledger.functions.columns import null_safe
from partledger.operators.dedup import latest_per_key


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: str | None = None) -> DataFrame:
    """Target after the source rows replaced, or joined, those with the same key.

    Keys match null-safely. Columns new in the source appear (null on untouched rows); columns the
    source lacks keep the target's value on matched rows. The source must be unique on the keys; a
    small source is broadcast by Spark, so the target is streamed through without a shuffle. With
    ``newer_by``, source rows whose value there is below the target's (or null) are left out.
    """
    if newer_by:
        there = target.select(*keys, F.col(newer_by).alias("_there")).alias("t")
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
        stale = F.col("_there").isNotNull() & (F.col(f"s.{newer_by}").isNull() | (F.col(f"s.{newer_by}") < F.col("_there")))
        source = source.alias("s").join(there, [*same, stale], "left_anti").select(*source.columns)
    only_target = [c for c in target.columns if c not in source.columns]
    incoming = source
    if only_target:
        kept = target.select(*keys, *only_target).alias("k")
        cond = [F.col(f"s.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
        incoming = source.alias("s").join(kept, cond, "left").select(
            *[F.col(f"s.{c}") for c in source.columns], *[F.col(f"k.{c}") for c in only_target])
    source_keys = source.select(*keys)
    untouched = target.join(source_keys, null_safe(target, source_keys, keys), "left_anti")
    return untouched.unionByName(incoming, allowMissingColumns=True)


def upsert_in_one(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: str) -> DataFrame:
    """``upsert`` with ``newer_by`` for a source that has all columns of the target: the rows of a key meet once,
    instead of in a join for what is stale and another for what is replaced."""
    came, by = F.col("_came"), F.col(newer_by)
    rows = target.withColumn("_came", F.lit(False)).unionByName(source.withColumn("_came", F.lit(True)), allowMissingColumns=True)
    of_key = Window.partitionBy(*keys)
    met = rows.select(
        "*", F.max(F.when(~came, by)).over(of_key).alias("_there"), F.max(F.when(came, by)).over(of_key).alias("_newest"),
        F.max(came).over(of_key).alias("_hit"))

    def current(day: Column) -> Column:
        return F.col("_there").isNull() | F.coalesce(day >= F.col("_there"), F.lit(False))

    kept = F.when(came, current(by)).otherwise(~(F.col("_hit") & current(F.col("_newest"))))
    return met.where(kept).drop("_came", "_there", "_newest", "_hit")


def apply_change_feed(state: DataFrame, feed: DataFrame, keys: Sequence[str], lsn: str, op: str,
                      after: int | None = None, delete: str = "delete") -> DataFrame:
    """State after the feed: per key the change with the highest sequence number wins."""
    if after is not None:
        feed = feed.where(F.col(lsn) > F.lit(after))
    final = latest_per_key(feed, keys, [lsn])
    live = final.where(~F.col(op).eqNullSafe(F.lit(delete))).drop(op)
    touched = final.select(*keys)
    untouched = state.join(touched, null_safe(state, touched, keys), "left_anti")
    return untouched.unionByName(live, allowMissingColumns=True)
