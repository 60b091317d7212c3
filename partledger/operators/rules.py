"""Quarantine: every input row ends in exactly one of two outputs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.context import RunContext
from partledger.functions.columns import content_hash, percent

REASON = "_rejection_reason"


@dataclass(frozen=True)
class Rule:
    """A row passes when ``test`` is true; false and unknown both fail."""

    label: str
    test: Column

    @property
    def failed(self) -> Column:
        return ~F.coalesce(self.test, F.lit(False))


@dataclass(frozen=True)
class Verdict:
    clean: DataFrame
    rejected: DataFrame
    judged: DataFrame | None = None  # all rows, with the reason of those that are rejected


def first_failure(rules: list[Rule]) -> Column:
    return F.coalesce(*[F.when(r.failed, F.lit(r.label)) for r in rules])


def quarantine(df: DataFrame, rules: list[Rule]) -> Verdict:
    """Split by the first rule a row breaks. Both sides are lazy; nothing is counted here."""
    judged = df.withColumn(REASON, first_failure(rules))
    return Verdict(judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull()), judged)


def reject_ledger(rejected: DataFrame, ctx: RunContext) -> DataFrame:
    """Rejected rows as they are stored: with time, run and a hash of the row.

    Rows of one run may be equal, hash included; a run's rows from one watermark are one folder, which a repeat replaces.
    """
    content = content_hash(rejected)
    return rejected.select("*", ctx.ts.alias("_quarantine_ts"), F.lit(ctx.run_id).alias("_run_id"),
                           content.alias("_row_hash"))


def rejects_by_reason(tagged: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows per table and reason."""
    slim = [d.select(F.lit(name).alias("table_name"), F.col(REASON).alias("rejection_reason"))
            for name, d in tagged.items()]
    return reduce(DataFrame.unionByName, slim).groupBy("table_name", "rejection_reason").agg(
        F.count(F.lit(1)).alias("rows_rejected"))


def rule_report(checks: list[tuple[str, DataFrame, list[Rule]]]) -> DataFrame:
    """Rows tested, failed and passed per (table, rule): one aggregate per table, one job in all."""
    reports = []
    for table, df, rules in checks:
        counts = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(r.failed).alias(f"r{i}") for i, r in enumerate(rules)],
        )
        lines = F.array(*[F.struct(F.lit(r.label).alias("rule"), F.col(f"r{i}").alias("failed"))
                          for i, r in enumerate(rules)])
        reports.append(
            counts.select("total", F.inline(lines)).select(F.lit(table).alias("table_name"), "rule", "total", "failed")
        )
    merged = reduce(DataFrame.unionByName, reports)
    return merged.select("*", percent(F.col("failed"), F.col("total")).alias("failed_pct"),
                         (F.col("failed") == 0).alias("passed"))
