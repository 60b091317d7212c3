"""Governance: profiles, quality metrics, drift, alerts, table health, access reports.

Metrics are computed as DataFrames, all tables in one job, and stored with one write.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger import schemas
from partledger.context import RunContext
from partledger.functions.columns import any_null, banded, percent
from partledger.operators import skew
from partledger.operators.rules import REASON
from partledger.operators.skew import HotKeys
from partledger.sources.files import file_stats

Profiled = tuple[str, str, DataFrame, Sequence[str]]  # layer, table, rows, key columns


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_profile(tables: Sequence[Profiled]) -> DataFrame:
    """Rows and rows with a null key per table, one pass each."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(any_null(keys)).alias("null_key_rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*",
            percent(F.col("null_key_rows"), F.col("row_count")).alias("null_key_pct"))
        for layer, table, df, keys in tables])


def counted_profile(spark: SparkSession, counted: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """``key_profile`` from counts taken while the tables were written, (layer, table, rows, rows with a null key): nothing is read."""
    counts = spark.createDataFrame(list(counted), "layer string, table_name string, row_count long, null_key_rows long")
    return counts.select("layer", "table_name", "row_count", "null_key_rows",
                         percent(F.col("null_key_rows"), F.col("row_count")).alias("null_key_pct"))


def freshness(tables: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows and newest load time per table."""
    return _union([
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
               F.max(column).cast("timestamp").alias("latest"))
        for name, df, column in tables])


def quarantine_rate(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Share of rejected rows per table, from (table, clean, rejected)."""
    return _rate(_union([
        side.select(F.lit(table).alias("table_name"), F.lit(bad).alias("bad"))
        for table, clean, rejected in pairs for side, bad in ((clean, False), (rejected, True))]))


def judged_rate(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``quarantine_rate`` from (table, its judged rows): each table is read and judged once."""
    return _rate(_union([df.select(F.lit(table).alias("table_name"), F.col(REASON).isNotNull().alias("bad")) for table, df in tables]))


def _rate(tagged: DataFrame) -> DataFrame:
    counted = tagged.groupBy("table_name").agg(
        F.count_if("bad").alias("rejected_rows"), F.count(F.lit(1)).alias("total_rows"))
    return counted.select("*", percent(F.col("rejected_rows"), F.col("total_rows")).alias("quarantine_pct"))


def _metric(df: DataFrame, layer: Column, name: str, value: Column, limit: float, passed: Column) -> DataFrame:
    return df.select(
        layer.alias("layer"), "table_name", F.lit(name).alias("metric_name"), value.cast("double").alias("metric_value"),
        F.lit(float(limit)).alias("threshold"), F.coalesce(passed, F.lit(False)).alias("passed"))


def dq_metrics(ctx: RunContext, profile: DataFrame | None = None, rates: DataFrame | None = None,
               stale: DataFrame | None = None, drifted: DataFrame | None = None, log: DataFrame | None = None) -> DataFrame:
    """The metric log rows of a run, from whichever of the inputs there are: key profile, reject rates,
    watermark ages, drifted columns per table, run log."""
    out, lim = [], ctx.limits
    if profile is not None:
        null_pct = F.coalesce("null_key_pct", F.lit(0.0))
        out.append(_metric(profile, F.col("layer"), "row_count", F.col("row_count"), 0, F.lit(True)))
        out.append(_metric(profile, F.col("layer"), "null_key_pct", null_pct, lim.null_key_pct,
                           null_pct <= lim.null_key_pct))
    if rates is not None:
        rate = F.coalesce("quarantine_pct", F.lit(0.0))
        out.append(_metric(rates, F.lit("silver"), "quarantine_pct", rate, lim.quarantine_pct,
                           rate <= lim.quarantine_pct))
    if stale is not None:
        out.append(_metric(stale, F.lit("pipeline"), "watermark_age_hrs", F.col("age_hours"), lim.watermark_age_hours,
                           F.col("passed")))
    if drifted is not None:
        out.append(_metric(drifted, F.lit("schema"), "schema_drift", F.col("columns_drifted"), 0, F.col("columns_drifted") == 0))
    if log is not None:
        minutes = F.round(F.col("duration_seconds") / 60, 1)
        out.append(_metric(log, F.col("layer"), "duration_minutes", minutes, lim.layer_minutes,
                           F.col("duration_seconds") / 60 <= lim.layer_minutes))
    return _union(out).select(F.lit(ctx.run_id).alias("run_id"), ctx.today.alias("run_date"), "*",
                              ctx.ts.alias("logged_at"))


# Kind and severity of the alert a failing metric raises, and its message.
ALERTS = {
    "null_key_pct": ("DataQuality", "Warning", "%s: null key rate %s%% exceeds threshold %s%%"),
    "quarantine_pct": ("Quarantine", "Critical", "%s: %s%% rows quarantined — exceeds %s%% threshold"),
    "watermark_age_hrs": ("WatermarkStale", "Critical",
                          "%s: watermark not updated for %sh — pipeline may have stalled (limit %sh)"),
    "duration_minutes": ("SLABreach", "Critical", "%s: ran for %s min — SLA is %s min"),
    "schema_drift": ("SchemaDrift", "Critical", "%s: %s columns drifted (allowed %s)"),
}


def alerts(metrics: DataFrame) -> DataFrame:
    """One alert per failing metric."""
    bad = metrics.where(~F.col("passed"))

    name = F.col("metric_name")

    def pick(i: int, default: str) -> Column:
        return banded([(name == metric, F.lit(spec[i])) for metric, spec in ALERTS.items()], default)

    figures = ["table_name", F.col("metric_value").cast("string"), F.col("threshold").cast("string")]
    message = banded([(name == metric, F.format_string(text, *figures)) for metric, (_, _, text) in ALERTS.items()],
                     F.concat_ws(" ", "table_name", "metric_name"))
    return bad.select(
        "run_id", "run_date", pick(0, "DataQuality").alias("alert_type"), pick(1, "Warning").alias("severity"),
        "table_name", "metric_name", "metric_value", "threshold",
        message.alias("message"), "logged_at")


# Run log ------------------------------------------------------------------------------------------------

def run_log(spark: SparkSession, ctx: RunContext, entries: Sequence[dict]) -> DataFrame:
    """Log rows of a run: one entry per table written, a handful of constants."""
    rows = [(ctx.run_id, ctx.run_date, e["layer"], e["table_name"], e.get("status", "success"), e.get("rows_read", 0),
             e.get("rows_written", 0), e.get("rows_quarantined", 0), round(float(e.get("seconds", 0.0)), 2),
             e.get("error"), ctx.run_ts) for e in entries]
    return spark.createDataFrame(rows, schemas.RUN_LOG)


def sla_breaches(log: DataFrame, ctx: RunContext) -> DataFrame:
    """Runs that took longer than a layer may."""
    minutes = F.round(F.col("duration_seconds") / 60, 1)
    return log.where(F.col("duration_seconds") / 60 > ctx.limits.layer_minutes).select(
        "run_id", "layer", "table_name", minutes.alias("duration_minutes"),
        F.lit(ctx.limits.layer_minutes).alias("threshold"))


# Schema and content drift ---------------------------------------------------------------------------------

def schema_baseline(spark: SparkSession, tables: dict[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Columns and types of the tables now, technical columns left out. Reads no data."""
    rows = [(t, f.name, f.dataType.simpleString(), f.nullable, ctx.run_date, ctx.run_ts)
            for t, df in tables.items() for f in df.schema.fields if not f.name.startswith("_")]
    return spark.createDataFrame(rows, schemas.SCHEMA_BASELINE)


def schema_drift(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """Columns added, dropped or changed in type per table against the newest earlier baseline of the
    table (``table_name, columns_drifted``); a table without one has none."""
    newest = baseline.groupBy("table_name").agg(F.max("logged_at").alias("logged_at"))
    base = baseline.join(newest, ["table_name", "logged_at"], "left_semi")
    found = drift(now.join(newest, "table_name", "left_semi"), base).groupBy("table_name").agg(
        F.count_if(F.col("drift") != "same").alias("columns_drifted"))
    return now.select("table_name").distinct().join(found, "table_name", "left").select(
        "table_name", F.coalesce("columns_drifted", F.lit(0)).alias("columns_drifted"))


def column_profile(tables: dict[str, DataFrame], distinct: bool = True) -> DataFrame:
    """Type, rows, null share, smallest and largest value of every column, one pass per table."""
    out = []
    for table, df in tables.items():
        names = [c for c in df.columns if not c.startswith("_")]
        per_column = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(names):
            per_column += [F.count(c).alias(f"k{i}"), F.min(c).cast("string").alias(f"lo{i}"),
                           F.max(c).cast("string").alias(f"hi{i}")]
            if distinct:
                per_column.append(F.approx_count_distinct(c).alias(f"d{i}"))
        lines = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                     percent(F.col("n") - F.col(f"k{i}"), F.col("n")).alias("null_pct"),
                     F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                     *([F.col(f"d{i}").alias("approx_distinct")] if distinct else []))
            for i, c in enumerate(names)])
        out.append(df.agg(*per_column).select(F.lit(table).alias("table_name"), F.inline(lines)))
    return _union(out)


def drift(current: DataFrame, baseline: DataFrame, null_shift_pct: float = 5.0) -> DataFrame:
    """Columns added, dropped, changed in type, or shifted in null share or range since the baseline."""
    fields = [c for c in ("data_type", "null_pct", "min_value", "max_value") if c in current.columns and
              c in baseline.columns]
    key = ["table_name", "column_name"]
    now = current.select(*key, F.lit(True).alias("_now"), *[F.col(c).alias(f"{c}_now") for c in fields])
    base = baseline.select(*key, F.lit(True).alias("_base"), *[F.col(c).alias(f"{c}_base") for c in fields])
    both = now.join(base, key, "full_outer")
    kind = F.when(F.col("_base").isNull(), "added").when(F.col("_now").isNull(), "dropped").when(
        F.col("data_type_now") != F.col("data_type_base"), "changed")
    if "null_pct" in fields:
        moved = F.abs(F.col("null_pct_now") - F.col("null_pct_base")) > null_shift_pct
        for c in ("min_value", "max_value"):
            moved = moved | ~F.col(f"{c}_now").eqNullSafe(F.col(f"{c}_base"))
        kind = kind.when(moved, "shifted")
    return both.withColumn("drift", kind.otherwise("same")).drop("_now", "_base")


# Quality log --------------------------------------------------------------------------------------------

def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Child rows whose parent is missing."""
    return skew.join(child, parent.select(*keys).distinct(), keys, "left_anti", hot)


def covered(child: DataFrame, parent: DataFrame, keys: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Child rows whose parent exists."""
    return skew.join(child, parent.select(*keys).distinct(), keys, "left_semi", hot)


def quality_log(nulls: Sequence[tuple[str, DataFrame, Sequence[str]]],
                unique: Sequence[tuple[str, DataFrame, Sequence[str]]],
                references: Sequence[tuple[str, DataFrame, str, DataFrame, Sequence[str]]],
                business: DataFrame | None = None) -> DataFrame:
    """Null, duplicate, referential and business-rule checks in one result: table, rule, total, failed, pct, passed."""
    parts = []
    total = F.count(F.lit(1)).alias("total")
    for table, df, keys in nulls:
        parts.append(df.agg(total, F.count_if(any_null(keys)).alias("failed")).select(
            F.lit(table).alias("table_name"), F.lit(f"not null {','.join(keys)}").alias("rule"), "total", "failed"))
    for table, df, keys in unique:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                               F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed")).select(
            F.lit(table).alias("table_name"), F.lit(f"unique {','.join(keys)}").alias("rule"), "total", "failed"))
    for table, child, parent_name, parent, keys in references:
        # Children are counted per key first, so the join carries keys, not rows.
        per_key = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        known = parent.select(*keys).distinct().withColumn("_known", F.lit(True))
        parts.append(per_key.join(known, list(keys), "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed")).select(
            F.lit(table).alias("table_name"), F.lit(f"{','.join(keys)} in {parent_name}").alias("rule"), "total",
            "failed"))
    merged = _union(parts).select("*", percent(F.col("failed"), F.col("total")).alias("failed_pct"),
                                  (F.col("failed") == 0).alias("passed"))
    return merged if business is None else merged.unionByName(business)


# Summary ------------------------------------------------------------------------------------------------

def daily_summary(metrics: DataFrame, health: DataFrame) -> DataFrame:
    """Metrics of a day side by side per table, next to the table's health."""
    def value(name: str) -> Column:
        return F.max(F.when(F.col("metric_name") == name, F.col("metric_value"))).alias(name)

    wide = metrics.groupBy("run_date", "layer", "table_name").agg(
        value("row_count"), value("null_key_pct"), value("quarantine_pct"), value("watermark_age_hrs"),
        F.bool_and("passed").alias("all_checks_passed"), F.count_if(~F.col("passed")).alias("failed_checks"))
    sizes = health.select("run_date", "layer", "table_name", "num_files", "size_bytes")
    return wide.join(sizes, ["run_date", "layer", "table_name"], "left").orderBy("layer", "table_name")


# Access reports --------------------------------------------------------------------------------------------

# The actions that count as table access.
TABLE_ACTIONS = ["getTable", "selectFromTable", "describeTable", "createTable", "updateTable", "deleteFromTable"]


def table_access(audit: DataFrame, day: Column, service: str, catalog: str) -> DataFrame:
    """Table accesses of one day in one catalog, out of a nested audit log."""
    name = F.col("request_params.full_name_arg")
    return audit.where(
        (F.col("event_date") == day) & (F.col("service_name") == service) & F.col("action_name").isin(TABLE_ACTIONS)
        & name.like(f"{catalog}.%")
    ).select("event_time", "user_identity", "action_name", name.alias("full_name_arg"),
             F.col("response.status_code").alias("status_code"))


def top_tables(access: DataFrame, n: int = 10) -> DataFrame:
    """Most accessed (table, action) pairs; ties by name, so the list is always the same."""
    counted = access.groupBy("full_name_arg", "action_name").agg(F.count(F.lit(1)).alias("accesses"))
    return counted.orderBy(F.desc("accesses"), "full_name_arg", "action_name").limit(n)


def access_by_user(access: DataFrame) -> DataFrame:
    return access.groupBy("user_identity").agg(F.count(F.lit(1)).alias("accesses")).orderBy(
        F.desc("accesses"), "user_identity")


# Table health --------------------------------------------------------------------------------------------

def table_health(tables: Sequence[tuple[str, str, DataFrame]], ctx: RunContext) -> DataFrame:
    """Rows, files, bytes and newest change of file-backed tables, in one job."""
    stats = _union([file_stats(df, table).withColumn("layer", F.lit(layer)) for layer, table, df in tables])
    return stats.select(ctx.today.alias("run_date"), "layer", "table_name", "row_count", "size_bytes", "num_files",
                        "last_modified", ctx.ts.alias("logged_at"))
