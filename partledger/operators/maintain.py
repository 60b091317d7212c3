"""Aggregates kept up to date from row changes instead of being computed anew.

A change is a row with ``_n``: how many more of it there are now than before, below zero if fewer. Sums and
counts move by the changes. A least or greatest value moves when a better one arrives; only in groups
where the best value itself went, and nothing as good came, are the group's rows read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Totals:
    """Aggregates by keys; measures map a new column to an SQL expression over a row. ``sums`` add up
    (null counts as nothing), ``lows`` and ``highs`` are the least and greatest value."""

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    lows: Mapping[str, str] = field(default_factory=dict)
    highs: Mapping[str, str] = field(default_factory=dict)

    def compute(self, rows: DataFrame) -> DataFrame:
        """``keys, _rows`` and the measures: the form in which they are kept."""
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.coalesce(F.sum(F.expr(e)), F.lit(0)).alias(c) for c, e in self.sums.items()],
            *[F.min(F.expr(e)).alias(c) for c, e in self.lows.items()],
            *[F.max(F.expr(e)).alias(c) for c, e in self.highs.items()])

    def refresh(self, kept: DataFrame, changes: DataFrame, rows: DataFrame) -> DataFrame:
        """The kept aggregates after the changes. ``rows`` are all rows as they are now; they are read only
        for groups that lost their least or greatest value. Groups without rows vanish."""
        after, lost = self._moved(kept, changes)
        groups = after.where(lost).select(*self.keys)
        again = self.compute(rows.join(groups, _same(rows, groups, self.keys), "left_semi"))
        return after.where(~lost).select(*kept.columns).unionByName(
            again.select(*[F.col(f.name).cast(f.dataType) for f in kept.schema.fields]))

    def stale(self, kept: DataFrame, changes: DataFrame) -> DataFrame:
        """Keys of the groups that ``refresh`` reads again."""
        after, lost = self._moved(kept, changes)
        return after.where(lost).select(*self.keys)

    def _moved(self, kept: DataFrame, changes: DataFrame) -> tuple[DataFrame, Column]:
        came, went = F.col("_n") > 0, F.col("_n") < 0
        best = {**{c: (e, F.min, F.least) for c, e in self.lows.items()}, **{c: (e, F.max, F.greatest) for c, e in self.highs.items()}}
        delta = changes.groupBy(*self.keys).agg(
            F.sum("_n").alias("_rows"), *[F.sum(F.col("_n") * F.expr(e)).alias(c) for c, e in self.sums.items()],
            *[m(F.when(came, F.expr(e))).alias(f"_came_{c}") for c, (e, m, _) in best.items()],
            *[m(F.when(went, F.expr(e))).alias(f"_went_{c}") for c, (e, m, _) in best.items()]).alias("d")
        k = kept.alias("k")
        same = reduce(lambda a, b: a & b, (F.col(f"k.{c}").eqNullSafe(F.col(f"d.{c}")) for c in self.keys))
        types = {f.name: f.dataType for f in kept.schema.fields}
        both = k.join(delta, same, "full").withColumn(
            "_lost", reduce(lambda a, b: a | b, (self._gone(c, *best[c]) for c in best), F.lit(False)))
        # Keys that are null on both sides are one group; which side a group is on shows in its row counts.
        known = F.col("k._rows").isNotNull()
        after = both.select(
            *[F.when(known, F.col(f"k.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in self.keys],
            *[(F.coalesce(f"k.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))).cast(types[c]).alias(c) for c in ("_rows", *self.sums)],
            *[pick(F.col(f"k.{c}"), F.col(f"d._came_{c}")).alias(c) for c, (_, _, pick) in best.items()], "_lost")
        return after.where("_rows > 0"), F.col("_lost")

    @staticmethod
    def _gone(c: str, _e: str, _m, pick) -> Column:
        """The best value went, and nothing at least as good came."""
        was, went, came = F.col(f"k.{c}"), F.col(f"d._went_{c}"), F.col(f"d._came_{c}")
        as_good = came.isNotNull() & (pick(came, was) == came)
        return F.coalesce(went.isNotNull() & was.isNotNull() & (pick(went, was) == went) & ~as_good, F.lit(False))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[c]) for c in keys))
