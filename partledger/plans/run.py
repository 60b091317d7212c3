"""All layers in order, handed over through tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger import schemas
from partledger.context import RunContext
from partledger.functions.columns import file_date, percent
from partledger.operators import rules, slices
from partledger.operators.maintain import Totals
from partledger.operators.rules import reject_ledger
from partledger.operators.skew import EVEN, Hot
from partledger.plans import bronze, gold, governance, serving, silver, star
from partledger.schemas import TABLES, TableSpec
from partledger.session import drop_path, shared_dir
from partledger.sinks import Lake, attempt, by_bucket, bytes_of, moved
from partledger.sources import incremental
from partledger.sources.arrivals import Ledger, csv_batches, found


@dataclass(frozen=True)
class Sources:
    """Rows to load: whole sources, or what arrived since the last run."""

    cad: DataFrame
    revisions: DataFrame
    bom: DataFrame
    cost: DataFrame


@dataclass(frozen=True)
class Source:
    domain: str
    newest: Callable[[DataFrame], DataFrame]
    changed: str  # the column that says which of two rows of a key is newer


SOURCES = {
    "cad_metadata": Source("cad", bronze.cad_metadata, "_file_date"),
    "plm_revisions": Source("plm", bronze.plm_revisions, "last_modified"),
    "plm_bom": Source("plm", bronze.plm_bom, "last_modified"),
    "erp_cost": Source("erp", bronze.erp_cost, "last_updated"),
}


class Run:
    """One pass over the layers.

    Arriving rows are judged first; the clean ones are merged into bronze by key, newer rows winning.
    Every table above bronze is a function of the tables below it, so it is published whole, which
    also removes rows that are no longer true, and only when one of those tables, or the day that
    its ages and dates are counted to, has changed. Its pointer names the state of each of those tables
    that it was built from, so a run that follows one that died, or another's layers, builds what is stale.
    """

    def __init__(self, spark: SparkSession, lake: Lake, ctx: RunContext):
        self.spark, self.lake, self.ctx = spark, lake, ctx
        self.entries: list[dict] = []
        self.arrived: dict[str, tuple[int, int]] = {}  # rows that arrived, rows rejected

    @cached_property
    def hot(self) -> Hot:
        """Hot keys of the bronze tables, each looked for when a layer first needs it, whichever layer is run."""
        if not all(self.lake.exists(f"bronze.{n}") for n in SOURCES):
            return EVEN
        raw = {n: self.lake.read(f"bronze.{n}") for n in SOURCES}
        return Hot.measure(raw["plm_bom"], raw["erp_cost"], raw["plm_revisions"], cad=raw["cad_metadata"])

    @contextmanager
    def step(self, table: str):
        """Log what happens to a table: its rows, its time, and its error if it fails."""
        layer, name = table.split(".")
        entry = {"layer": layer, "table_name": name, "rows_written": 0}
        started = time.monotonic()
        try:
            yield entry
        except Exception as error:
            self.entries.append(entry | {"status": "failed", "error": str(error)[:1000], "seconds": time.monotonic() - started})
            self.log()
            raise
        self.entries.append(entry | {"seconds": time.monotonic() - started})

    def log(self) -> None:
        self.lake.append(governance.run_log(self.spark, self.ctx, self.entries), "govern.pipeline_run_log", self.ctx)

    def save(self, table: str, build: Callable[[], DataFrame], inputs: Sequence[str], dated: bool = False) -> DataFrame:
        """Publish a derived table, unless nothing that it is made from has changed."""
        state = self.lake.state(table)
        same_day = state and state["day"] == self.ctx.run_date.isoformat()
        present = {name: self.lake.state(name)["path"] for name in inputs}
        if state and state.get("inputs") == present and (same_day or not dated):
            return self.lake.read(table)
        spec = TABLES[table]
        with self.step(table) as entry:
            entry |= self.lake.publish(build(), table, self.ctx, spec.partition_by, spec.cluster_by, present, spec.required)
        return self.lake.read(table)

    def refresh(self, table: str, source: str, build: Callable[[DataFrame], DataFrame], dated: bool = False) -> DataFrame:
        """Publish a table that has the buckets of its source and needs, for each of them, that bucket only:
        those of the source that were written since are built anew."""
        state, spec, now = self.lake.state(table), TABLES[table], self.lake.state(source)
        places = by_bucket(now["folders"])
        if state is None or state["buckets"] != now["buckets"] or (dated and state["day"] != self.ctx.run_date.isoformat()):
            touched, spec = None, replace(spec, buckets=now["buckets"])
        else:
            touched = moved(places, by_bucket(state["source"]))
        if touched is None or touched:
            some = places if touched is None else {b: p for b, p in places.items() if b in touched}
            with self.step(table) as entry:
                entry |= self.lake.write_buckets(build(self.lake.read_buckets(now, some)), spec, self.ctx, touched, source=now["folders"])
        return self.lake.read(table)

    def totals(self, name: str, source: str, totals: Totals) -> DataFrame:
        """Aggregates of a table by key, kept as ``state.name`` and brought up to date from what changed in it."""
        lake, table, now = self.lake, f"state.{name}", self.lake.state(source)
        rows, state = lake.read(source), self.lake.state(table)
        columns = [c for c in rows.columns if not c.startswith("_")]
        if state is None:
            with self.step(table) as entry:
                entry |= lake.publish(totals.compute(rows.select(*columns)), table, self.ctx, source=now["folders"])
        elif state["source"] != now["folders"]:
            changes = lake.changes(source, by_bucket(state["source"]), columns)
            path = shared_dir(self.spark, "changes")
            changes.write.parquet(path)
            known = self.spark.read.schema(changes.schema).parquet(path)
            with self.step(table) as entry:
                entry |= lake.publish(totals.refresh(lake.read(table), known, rows.select(*columns)), table, self.ctx, source=now["folders"])
            drop_path(self.spark, path)
        return lake.read(table)

    # Arrivals -----------------------------------------------------------------------------------------

    def arrive(self, name: str, raw: DataFrame, after: str | None = None, written: bool = False) -> None:
        """Take in arriving rows of a source: reject, keep the newest per key, merge into bronze.

        ``after`` is the watermark that the rows were read from; rejects of a run are kept by it. Rows that are
        not ``written`` yet are judged while they are.
        """
        table, source = f"bronze.{name}", SOURCES[name]
        with self.step(table) as entry:
            if written:
                rows, verdict = raw, silver.judge_arrivals(name, raw)
            else:
                path, judged = shared_dir(self.spark, "arrivals"), silver.judge_arrivals(name, raw).judged
                judged.write.parquet(path)
                rows = self.spark.read.schema(judged.schema).parquet(path)
                bad = F.col(rules.REASON).isNotNull()
                verdict = rules.Verdict(rows.where(~bad).drop(rules.REASON),
                                        silver.judge_arrivals(name, rows.where(bad).drop(rules.REASON)).rejected)
            rejects = reject_ledger(verdict.rejected, self.ctx)
            stored = self.lake.append(rejects, f"silver.{name}_quarantine", self.ctx, after)
            rejected = self.spark.read.schema(rejects.schema).parquet(stored).count()
            total = rows.count()
            self.arrived[name] = (total, rejected)
            entry |= {"rows_read": total, "rows_quarantined": rejected}
            newest = source.newest(verdict.clean)
            if name == "cad_metadata":
                newest = newest.withColumn("_file_date", file_date(F.col("_source_file")))
            entry |= self.lake.upsert(bronze.stamp(newest, name, source.domain, self.ctx), TABLES[table], self.ctx, source.changed, unique=True)
            if not written:
                drop_path(self.spark, path)

    def bronze(self, src: Sources) -> None:
        for name, raw in {"cad_metadata": src.cad, "plm_revisions": src.revisions, "plm_bom": src.bom, "erp_cost": src.cost}.items():
            self.arrive(name, raw)

    def load(self, sources: Mapping[str, tuple[DataFrame, str]], control: str, upto: datetime) -> None:
        """Take in what changed since each source's watermark: (name → (table, change column)).

        The upper bound is taken once, by the caller. Rows are landed as they were read, then taken in;
        watermarks move after the data of all sources is stored. A run that dies in between reads the
        same rows again, which changes nothing: landing replaces, merging keeps the newer row. Landed rows
        and rejects lie in folders named by the run and the watermark it read from, so a repeat that follows
        the commit, and reads from the new watermark, leaves those of the first attempt.
        """
        marks = incremental.read_watermarks(self.spark, control)
        for name, (table, column) in sources.items():
            after = incremental.watermark_of(marks, name)
            rows = incremental.changed_between(table, column, after, upto)
            landed = incremental.land(rows, f"{self.lake.root}/landing/{name}", attempt(self.ctx.run_id, after))
            self.arrive(name, self.spark.read.schema(rows.schema).parquet(landed).drop("_ingestion_ts"), after, written=True)
        incremental.commit_watermarks(marks, list(sources), upto, control)

    def load_files(self, path: str, ledger: str) -> None:
        """Take in the design files below a folder that no run before has taken in.

        Files are claimed before they are read and marked after their rows are stored, so a run that dies in between
        reads the same files again; their rejects replace those of the attempt before.
        """
        book = Ledger(ledger)
        before, upto = book.committed(), book.claim(found(path))
        if upto > before:
            self.arrive("cad_metadata", csv_batches(self.spark, path, schemas.CAD_CSV, book, before, upto), f"files {before}")
            book.commit(upto)

    # Layers -------------------------------------------------------------------------------------------

    def cleaned(self, name: str) -> DataFrame:
        """The silver form of a source that needs nothing but its bronze rows."""
        build, dated = {
            "cad_metadata": (silver.cad_metadata, False), "erp_cost": (silver.erp_cost, False),
            "plm_revisions": (lambda rows: silver.plm_revisions(rows, self.ctx), True)}[name]
        return self.refresh(f"silver.{name}", f"bronze.{name}", lambda rows: silver.stamp(build(rows), f"bronze.{name}", self.ctx), dated)

    def silver(self) -> None:
        lake, ctx = self.lake, self.ctx
        raw = {n: lake.read(f"bronze.{n}") for n in SOURCES}

        def save(name: str, build: Callable[[], DataFrame], inputs: Sequence[str], dated: bool = False) -> DataFrame:
            return self.save(f"silver.{name}", lambda: silver.stamp(build(), f"bronze.{name}", ctx), inputs, dated)

        self.cleaned("cad_metadata")
        revisions = self.cleaned("plm_revisions")
        bom = save("plm_bom", lambda: silver.plm_bom(raw["plm_bom"], revisions, self.hot), ["bronze.plm_bom", "bronze.plm_revisions"])
        cost = self.cleaned("erp_cost")
        save("part_cost_view", lambda: silver.part_cost_view(bom, revisions, _prices(cost), self.hot, slices.how_many(bytes_of(bom)) > 1),
             ["silver.plm_bom", "silver.plm_revisions", "silver.erp_cost"])

    def gold(self, only: Sequence[str] | None = None) -> None:
        """All gold tables and the star schema, or just some of the gold tables."""
        revisions, bom, cad = (self.lake.read(f"silver.{n}") for n in ("plm_revisions", "plm_bom", "cad_metadata"))
        cost = _prices(self.lake.read("silver.erp_cost"))
        rev, lines, price, design = "silver.plm_revisions", "silver.plm_bom", "silver.erp_cost", "silver.cad_metadata"
        tables = {
            "dim_part": (lambda: gold.dim_part(revisions, cost, gold.revision_figures(self.totals("revisions", rev, gold.REVISION_TOTALS)),
                                               gold.supplier_figures(self.totals("offers", price, gold.OFFER_TOTALS))), [rev, price]),
            "dim_supplier": (lambda: gold.supplier_dimension(self.totals("suppliers", price, gold.SUPPLIER_TOTALS)), [price]),
            "fact_bom_cost": (lambda: gold.fact_bom_cost(bom, revisions, cost, self.hot), [lines, rev, price]),
            "agg_assembly_cost": (lambda: slices.stored(bom, "assembly_id", slices.how_many(bytes_of(bom)),
                                                        lambda rows: gold.agg_assembly_cost(rows, cost, self.hot)), [lines, price]),
            "agg_supplier_cost": (lambda: gold.agg_supplier_cost(bom, cost, self.hot), [lines, price]),
            "agg_part_revision_history": (lambda: gold.agg_part_revision_history(revisions, self.hot), [rev]),
            "agg_cad_activity": (lambda: gold.agg_cad_activity(cad), [design]),
        }
        for name in only or tables:
            build, inputs = tables[name]
            self.save(f"gold.{name}", lambda b=build: gold.stamp(b(), self.ctx), inputs)
        if only is None:
            self.star(cad, bom, revisions, cost)

    def star(self, cad: DataFrame, bom: DataFrame, revisions: DataFrame, cost: DataFrame) -> None:
        """The star schema, with the type-2 revision dimension."""
        rev, lines, price, design = "silver.plm_revisions", "silver.plm_bom", "silver.erp_cost", "silver.cad_metadata"
        parts = self.save("star.dim_part", lambda: star.dim_part(cad, bom, revisions, cost), [design, lines, rev, price])
        self.save("star.dim_assembly", lambda: star.dim_assembly(bom), [lines])
        suppliers = self.save("star.dim_supplier", lambda: star.dim_supplier(cost), [price])
        dim = self.save("star.dim_revision", lambda: star.dim_revision(revisions, self.hot.revision_parts), [rev])
        self.save("star.fact_bom", lambda: star.fact_bom(bom), [lines])
        self.save("star.fact_cost", lambda: star.fact_cost(cost, parts, suppliers, self.hot),
                  [price, "star.dim_part", "star.dim_supplier"])
        self.save("star.fact_design", lambda: star.fact_design(cad, dim, self.hot.cad_parts), [design, "star.dim_revision"])

    def serving(self) -> None:
        lake, ctx = self.lake, self.ctx
        g = {n: lake.read(f"gold.{n}") for n in (
            "dim_part", "dim_supplier", "fact_bom_cost", "agg_supplier_cost", "agg_part_revision_history",
            "agg_cad_activity")}
        bom = lake.read("silver.plm_bom")
        cost = _prices(lake.read("silver.erp_cost"))
        lines, price = "silver.plm_bom", "silver.erp_cost"
        rollup = gold.assembly_rollup(bom, cost, hot=self.hot)

        def priced() -> DataFrame:
            return serving.with_assembly(g["fact_bom_cost"], rollup, self.hot)

        tables = {
            "mart_assembly_cost": (lambda: serving.mart_assembly_cost(serving.with_part(priced(), g["dim_part"], self.hot), ctx),
                                   ["gold.fact_bom_cost", "gold.dim_part", lines, price]),
            "mart_supplier_scorecard": (lambda: serving.mart_supplier_scorecard(g["agg_supplier_cost"], g["dim_supplier"], ctx),
                                        ["gold.agg_supplier_cost", "gold.dim_supplier"]),
            "mart_open_revisions": (lambda: serving.mart_open_revisions(
                g["agg_part_revision_history"], g["dim_part"], ctx, self.hot), ["gold.agg_part_revision_history", "gold.dim_part"]),
            "api_part_cost_lookup": (lambda: serving.api_part_cost_lookup(g["dim_part"], cost, ctx, hot=self.hot),
                                     ["gold.dim_part", price]),
        }
        for name, (build, inputs) in tables.items():
            self.save(f"serving.{name}", lambda b=build: serving.stamp(b(), ctx), inputs, dated=True)
        views = {
            "vw_assembly_cost_dashboard": (lambda: serving.assembly_cost_dashboard(priced()), ["gold.fact_bom_cost", lines, price]),
            "vw_part_catalogue": (lambda: serving.part_catalogue(g["dim_part"]), ["gold.dim_part"]),
            "vw_supplier_scorecard": (lambda: serving.supplier_scorecard(g["agg_supplier_cost"], g["dim_supplier"]),
                                      ["gold.agg_supplier_cost", "gold.dim_supplier"]),
            "vw_revision_tracker": (lambda: serving.revision_tracker(g["agg_part_revision_history"]), ["gold.agg_part_revision_history"]),
            "vw_cad_pipeline_health": (lambda: serving.cad_pipeline_health(g["agg_cad_activity"]), ["gold.agg_cad_activity"]),
        }
        serving.register_lookup(self.spark, "serving.api_part_cost_lookup")
        for name, (build, inputs) in views.items():
            serving.register_view(self.save(f"serving.{name}", build, inputs), name)

    # Governance ---------------------------------------------------------------------------------------

    def profile(self, tables: Sequence[TableSpec]) -> DataFrame:
        """Rows and rows with a null key of each table, as counted when they were written; only tables written before
        counts were kept are read."""
        known = {t.id: self.lake.counts(t.id) for t in tables}
        counted = governance.counted_profile(self.spark, [
            (t.layer, t.name, known[t.id]["row_count"], known[t.id]["null_key_rows"]) for t in tables if known[t.id]])
        unknown = [(t.layer, t.name, self.lake.read(t.id), t.required) for t in tables if not known[t.id]]
        return counted.unionByName(governance.key_profile(unknown)) if unknown else counted

    def govern(self, control: str | None = None) -> None:
        """Profiles, rejects of this run, watermark ages, schema drift, quality rules, alerts, health, log."""
        lake, ctx, spark = self.lake, self.ctx, self.spark
        for name, schema in schemas.GOVERNANCE_TABLES.items():
            lake.ensure(f"govern.{name}", schema)
        stored = {t.id: lake.read(t.id) for t in TABLES.values()}
        profile = self.profile([t for t in TABLES.values() if t.keys])
        rates = spark.createDataFrame([(n, bad, total) for n, (total, bad) in self.arrived.items()],
                                      "table_name string, rejected_rows long, total_rows long").select(
            "*", percent(F.col("rejected_rows"), F.col("total_rows")).alias("quarantine_pct"))
        stale = None if control is None else incremental.staleness(
            incremental.read_watermarks(spark, control), ctx.ts, ctx.limits.watermark_age_hours)
        now = governance.schema_baseline(spark, stored, ctx)
        baseline = lake.read("govern.schema_baseline").where(F.col("run") != ctx.run_id)
        drifted = governance.schema_drift(now, baseline)
        metrics = governance.dq_metrics(ctx, profile, rates, stale, drifted, governance.run_log(spark, ctx, self.entries))
        lake.append(metrics, "govern.dq_metrics", ctx)
        lake.append(now, "govern.schema_baseline", ctx)
        lake.append(governance.quality_log(
            nulls=[("plm_bom", stored["silver.plm_bom"], ["part_id"]), ("erp_cost", stored["silver.erp_cost"], ["part_id"])],
            unique=[("plm_bom", stored["silver.plm_bom"], ["assembly_id", "part_id"])],
            references=[("plm_bom", stored["silver.plm_bom"], "erp_cost", stored["silver.erp_cost"], ["part_id"])],
            business=rules.rule_report([("erp_cost", stored["silver.erp_cost"], silver.COST_RULES())])), "govern.quality_log", ctx)
        own = lake.read_run("govern.dq_metrics", ctx.run_id)
        lake.append(governance.alerts(own), "govern.alert_log", ctx)
        lake.append(governance.table_health([(t.layer, t.name, stored[t.id]) for t in TABLES.values()], ctx),
                    "govern.table_health", ctx)
        health = lake.read_run("govern.table_health", ctx.run_id)
        lake.publish(governance.daily_summary(own, health), "govern.daily_summary", ctx)
        self.log()

    def layers(self, control: str | None = None) -> None:
        self.silver()
        self.gold()
        self.serving()
        self.govern(control)

    def all(self, src: Sources) -> None:
        self.bronze(src)
        self.layers()

    def incremental(self, sources: Mapping[str, tuple[DataFrame, str]], control: str, upto: datetime) -> None:
        self.load(sources, control, upto)
        self.layers(control)


def _prices(cost: DataFrame) -> DataFrame:
    return cost.select("part_id", "supplier_name", "cost", "currency", "last_updated")
