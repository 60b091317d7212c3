"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger import fixtures, schemas
from partledger.context import CURRENCIES, RunContext
from partledger.fixtures import DESIGN, PLANT
from partledger.functions.columns import code, file_date
from partledger.operators import history, merge, policy, rights, rules, sketches, skew, slices
from partledger.operators.dedup import duplicate_keys, latest_per_key
from partledger.operators.skew import Hot
from partledger.plans import bronze, gold, governance, serving, silver, star
from partledger.plans.run import SOURCES, Run, Sources
from partledger.session import apply_settings, drop_path, fit_partitions, shared_dir
from partledger.sinks import Lake, bytes_of, compact, existing, upsert_partitions, write_partitioned
from partledger.sources import arrivals, drift, files, incremental
from partledger.streaming import jobs, state

Query = Callable[["Plant"], DataFrame]
QUERIES: dict[str, Query] = {}


class Plant:
    """The layers over one data folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark, tables=True)
        self.folder = folder
        self._bytes = 0
        fit_partitions(self.spark, 0)
        self._given: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}
        self._kept: set[str] = set()

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = fixtures.given(self.spark, self.folder, name)
            self._bytes += bytes_of(self._given[name])
            fit_partitions(self.spark, self._bytes)
        return self._given[name]

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = fixtures.derive(self.spark, name, self.given)
        return self._raw[name]

    def kept(self, name: str) -> DataFrame:
        """A source that is read several times, derived once and written; all that read it later read the table."""
        if name not in self._kept:
            self._kept.add(name)
            self._raw[name] = self.stored(name, self.raw(name))
        return self._raw[name]

    @cached_property
    def hot(self) -> Hot:
        # On the silver tables, which are stored: their keys are those that joins and windows meet.
        return Hot({"bom": lambda: self.bom_lines, "cost": lambda: self.cost, "revisions": lambda: self.revisions, "cad": lambda: self.cad})

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """A silver table, built once and read by every consumer."""
        path = shared_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def ahead(self, *names: str) -> None:
        """Build several silver tables at the same time: each alone leaves most of the cores idle."""
        missing = [n for n in names if n not in self.__dict__]
        if len(missing) > 1:
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(lambda n: getattr(self, n), missing))

    @cached_property
    def cad(self):
        return self.stored("cad", silver.cad_metadata(self.raw("raw_cad")))

    @cached_property
    def revisions(self):
        return self.stored("revisions", silver.plm_revisions(self.raw("raw_revisions"), PLANT))

    @cached_property
    def bom_lines(self):
        return self.stored("bom-lines", silver.bom_lines(self.raw("raw_bom")))

    @cached_property
    def bom(self):
        self.ahead("bom_lines", "revisions")
        return silver.with_current_revision(self.bom_lines, self.revisions, self.hot)

    @cached_property
    def lines(self):
        """Lines with every column of their current revision, joined once."""
        self.ahead("bom_lines", "revisions", "cost")
        return silver.with_open_revision(self.bom_lines, self.revisions, self.hot)

    @cached_property
    def cost(self):
        return self.stored("cost", silver.erp_cost(self.raw("raw_cost")))

    @cached_property
    def fact(self):
        return gold.fact_bom_cost(self.lines, None, self.cost, self.hot)

    def with_totals(self, lines: DataFrame) -> DataFrame:
        """Lines with their assembly's figures. ``lines`` has every line of an assembly that it has any of."""
        bom = silver.with_current_revision(lines, self.revisions, self.hot)
        rollup = gold.assembly_rollup(bom, self.cost, hot=self.hot)
        return serving.with_needed_totals(lines.select("assembly_id", "part_id", "quantity"), self.cost, rollup, self.hot)

    def priced_assemblies(self, build: Callable[[DataFrame], DataFrame], dims: bool = False, store: bool = False) -> DataFrame:
        """``build`` of the cost fact's rows with their assembly's figures, and with ``dims`` their part's.

        The assembly's figures come first and the revision's columns after, where prices are joined, so they are not moved
        by assembly and then by part. Large tables go slice by slice, first by assembly, then by part: what a slice has
        moved is gone before the next begins, and so are the lines it has used up. What is made of slices is a written
        table; ``store`` asks for one in any case.
        """
        self.ahead("bom_lines", "revisions", "cost")
        n = slices.how_many(bytes_of(self.bom_lines))

        def priced(lines: DataFrame, revisions: DataFrame, cost: DataFrame) -> DataFrame:
            lines = silver.with_open_revision(lines, revisions, self.hot, together=n > 1)
            if dims:
                lines = serving.with_part(lines, gold.dim_part(revisions, cost), self.hot)
            return build(gold.fact_bom_cost(lines, None, cost, self.hot, together=n > 1))

        if n == 1:
            found = priced(self.with_totals(self.bom_lines), self.revisions, self.cost)
            return self.stored("priced", found) if store else found
        path, out = shared_dir(self.spark, "totals"), shared_dir(self.spark, "priced")
        for i in range(n):
            lines = self.with_totals(slices.of(self.bom_lines, "assembly_id", n, i))
            lines.withColumn("_slice", slices.number("part_id", n)).write.partitionBy("_slice").parquet(f"{path}/assemblies={i}")
        for i in range(n):
            folders = existing(self.spark, f"{path}/assemblies=*/_slice={i}")
            some = self.spark.read.schema(lines.schema).parquet(*folders) if folders else self.spark.createDataFrame([], lines.schema)
            found = priced(some, *[slices.of(df, "part_id", n, i) for df in (self.revisions, self.cost)])
            found.write.mode("append").parquet(out)
            for folder in folders:
                drop_path(self.spark, folder)
        return self.spark.read.schema(found.schema).parquet(out)

    def mart(self, last: Callable[[DataFrame], DataFrame] = lambda mart: mart, store: bool = False) -> DataFrame:
        """The assembly mart, or what ``last`` takes of each of its rows."""
        return self.priced_assemblies(lambda fact: last(serving.mart_assembly_cost(fact, PLANT)), dims=True, store=store)

    @cached_property
    def dim_part(self):
        self.ahead("revisions", "cost")
        return gold.dim_part(self.revisions, self.cost)

    @cached_property
    def dim_supplier(self):
        # Read once here, so it is not stored for this alone.
        return gold.dim_supplier(self.cost if "cost" in self.__dict__ else silver.erp_cost(self.raw("raw_cost")))

    @cached_property
    def agg_supplier(self):
        self.ahead("bom_lines", "cost")
        return gold.agg_supplier_cost(self.bom_lines, self.cost, self.hot)

    @cached_property
    def rev_history(self):
        return gold.agg_part_revision_history(self.revisions, self.hot)

    @cached_property
    def cad_activity(self):
        return gold.agg_cad_activity(silver.stamp(self.cad, "bronze.cad_metadata", DESIGN))

    @cached_property
    def dim_revision(self):
        return star.dim_revision(self.revisions, self.hot.revision_parts)

    @cached_property
    def star_parts(self):
        # A part is mentioned in the newest rows if it is in any clean one.
        mentions = (silver.judge_bom(self.raw("raw_bom")), silver.judge_revisions(self.raw("raw_revisions")), silver.judge_cost(self.raw("raw_cost")))
        return star.dim_part(silver.cad_metadata(self.raw("raw_cad")), *[m.clean for m in mentions])


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Sources ------------------------------------------------------------------------------------------------

@query
def bronze_audit_erp(p):
    return bronze.stamp(p.raw("raw_cost"), "/landing/erp/erp_cost", "erp", PLANT)


@query
def silver_audit_cad(p):
    return silver.stamp(p.cad, "bronze.cad_metadata", DESIGN)


@query
def gold_audit_dim_supplier(p):
    return gold.stamp(p.dim_supplier, PLANT)


def _drop_cad_files(p) -> str:
    """Write the CAD rows as dated CSV snapshots, the form in which they arrive."""
    path = shared_dir(p.spark, "cad")
    name = F.regexp_extract("_source_file", r"([^/]+)\.csv$", 1)
    files.write_snapshots(p.raw("raw_cad"), path, name, quote_all=False, drop=("_source_file",))
    return path


def _snapshot_name():
    return F.regexp_extract("_source_file", "snapshot=([^/]+)", 1)


@query
def csv_tree_scan(p):
    rows = files.csv_tree(p.spark, _drop_cad_files(p), schemas.CAD_CSV)
    return rows.select("*", file_date(F.col("_source_file")).alias("file_date"), _snapshot_name().alias("snapshot")
                       ).drop("_source_file")


@query
def csv_folder_listing(p):
    listed = files.listing(p.spark, _drop_cad_files(p))
    return listed.groupBy(F.regexp_extract("path", "snapshot=([^/]+)", 1).alias("snapshot")).agg(
        (F.sum("size_bytes") > 0).alias("has_bytes"))


@query
def monthly_split(p):
    path = shared_dir(p.spark, "monthly")
    files.write_snapshots(p.raw("raw_bom"), path, files.month_snapshot(F.col("last_modified"), "plm_bom"))
    rows = p.spark.read.schema(schemas.PLM_BOM + ", snapshot string").options(**files.CSV_DIALECT).csv(path)
    return rows.groupBy("snapshot").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("pieces"))


@query
def new_files_since(p):
    return files.newer_than(p.raw("raw_cad"), "_source_file", "2024-01-15")


@query
def last_load_date(p):
    return files.last_loaded(files.newer_than(p.raw("raw_cad"), "_source_file", None))


@query
def unprocessed_files(p):
    seen = p.raw("raw_cad").select(F.regexp_extract("_source_file", "([^/]+)$", 1).alias("file_name")).distinct()
    day = file_date(F.col("file_name"))
    ledger = seen.select("file_name", F.when(day <= "2024-01-20", "PROCESSED").otherwise("FAILED").alias("status"))
    return files.unprocessed(seen, ledger)


@query
def incremental_by_watermark(p):
    return incremental.changed_between(p.raw("raw_cost"), "last_updated", "1998-01-01", "2001-06-30")


@query
def land_increment(p):
    path = shared_dir(p.spark, "landing")
    for after, upto in (("1900-01-01", "1998-12-31"), ("1998-12-31", "2001-12-31")):
        incremental.land(incremental.changed_between(p.raw("raw_bom"), "last_modified", after, upto), path, upto)
    return p.spark.read.parquet(path).drop("run")


def _dropped_in_two_waves(p, drop: Callable[[str, int], None]) -> None:
    """CAD files arrive in a folder in two waves, the later dates first; after each, ``drop`` is called with folder and wave."""
    rows, folder = p.raw("raw_cad"), shared_dir(p.spark, "drops")
    late = F.coalesce(file_date(F.col("_source_file")) <= "2024-01-15", F.lit(True))
    name = F.regexp_extract("_source_file", r"([^/]+)\.csv$", 1)
    for wave, some in enumerate((rows.where(~late), rows.where(late)), 1):
        files.write_snapshots(some, f"{folder}/wave={wave}", name, quote_all=False, drop=("_source_file",))
        drop(folder, wave)


def _of_wave(rows: DataFrame) -> DataFrame:
    wave = F.regexp_extract("_source_file", "wave=([0-9]+)", 1).cast("int")
    return rows.select("*", file_date(F.col("_source_file")).alias("file_date"), wave.alias("wave"),
                       _snapshot_name().alias("snapshot")).drop("_source_file")


@query
def files_by_ledger(p):
    """Two loads from the ledger; the first attempt at the second dies before its files are marked."""
    book, out = arrivals.Ledger(shared_dir(p.spark, "ledger")), shared_dir(p.spark, "loads")

    def load(folder: str, wave: int) -> None:
        for marked in (wave == 1, True):
            before, upto = book.committed(), book.claim(arrivals.found(folder))
            if upto > before:
                rows = arrivals.csv_batches(p.spark, folder, schemas.CAD_CSV, book, before, upto)
                rows.write.mode("overwrite").parquet(f"{out}/load={before}")
            if marked:
                book.commit(upto)

    _dropped_in_two_waves(p, load)
    return _of_wave(p.spark.read.parquet(out).drop("load"))


@query
def stream_files_by_ledger(p):
    """The same files as a stream, which stops after each wave and goes on from its checkpoint."""
    book, out, checkpoint = (arrivals.Ledger(shared_dir(p.spark, "ledger")), shared_dir(p.spark, "streamed"),
                             shared_dir(p.spark, "ledger-checkpoint"))

    def load(folder: str, wave: int) -> None:
        jobs.to_files(arrivals.csv_stream(p.spark, folder, schemas.CAD_CSV, book), out, checkpoint)

    _dropped_in_two_waves(p, load)
    return _of_wave(p.spark.read.parquet(out))


def _landed_with_new_columns(p) -> DataFrame:
    """Price notices whose source has two columns more and one less than the schema, landed."""
    grown = p.raw("raw_cost").drop("currency").withColumns({
        "incoterm": F.when(F.month("last_updated") <= 6, F.lit("FOB")), "min_order": F.dayofmonth("last_updated")})
    known = "part_id string, supplier_name string, cost decimal(18,4), currency string, last_updated date"
    path = incremental.land(drift.fit(grown, known), shared_dir(p.spark, "landing"), "d1")
    return p.spark.read.parquet(path)


@query
def drifted_landing(p):
    return drift.unknown_columns(_landed_with_new_columns(p))


@query
def promoted_columns(p):
    rows = drift.promote(drift.promote(_landed_with_new_columns(p), "incoterm", "string"), "min_order", "int")
    return rows.select("part_id", "supplier_name", "cost", "currency", "last_updated", "incoterm", "min_order")


@query
def bulk_load_csv(p):
    path = shared_dir(p.spark, "loaded")
    typed = files.csv_tree(p.spark, _drop_cad_files(p), schemas.CAD_CSV).select(
        "part_id", "material", F.col("weight_kg").try_cast("decimal(18,4)").alias("weight_kg"),
        F.col("created_date").try_cast("date").alias("created_date"))
    typed.write.mode("append").parquet(path)
    return p.spark.read.parquet(path)


@query
def cdc_changes_after(p):
    feed = p.raw("raw_cdc")
    middle = feed.agg(F.lit("readings").alias("table_name"), F.floor(F.max("lsn") / 2).alias("last_lsn"))
    return incremental.changes_after(feed, middle, "readings", "lsn")


@query
def cad_file_date(p):
    return p.raw("raw_cad").select("part_id", "_source_file", file_date(F.col("_source_file")).alias("file_date"))


# Bronze and silver ----------------------------------------------------------------------------------------

@query
def dedup_latest_cad(p):
    return bronze.cad_metadata(p.raw("raw_cad"))


@query
def dedup_latest_revisions(p):
    return bronze.plm_revisions(p.raw("raw_revisions"))


@query
def dedup_latest_bom(p):
    return bronze.plm_bom(p.raw("raw_bom"))


@query
def dedup_latest_cost(p):
    return bronze.erp_cost(p.raw("raw_cost"))


@query
def clean_cad(p):
    return silver.cad_metadata(p.raw("raw_cad"))


@query
def clean_revisions(p):
    return silver.plm_revisions(p.raw("raw_revisions"), PLANT)


@query
def clean_bom(p):
    return silver.bom_lines(p.raw("raw_bom"))


@query
def clean_cost(p):
    return silver.erp_cost(p.raw("raw_cost"))


@query
def quarantine_cad(p):
    return silver.judge_cad(p.raw("raw_cad")).rejected


@query
def quarantine_revisions(p):
    return silver.judge_revisions(p.raw("raw_revisions")).rejected


@query
def quarantine_bom(p):
    return silver.judge_bom(p.raw("raw_bom")).rejected


@query
def quarantine_cost(p):
    return silver.judge_cost(p.raw("raw_cost")).rejected


def _verdicts(p):
    return {
        "cad_metadata": silver.judge_cad(p.raw("raw_cad")),
        "plm_revisions": silver.judge_revisions(p.raw("raw_revisions")),
        "plm_bom": silver.judge_bom(p.raw("raw_bom")),
        "erp_cost": silver.judge_cost(p.raw("raw_cost")),
    }


@query
def quarantine_ledger(p):
    stored = rules.reject_ledger(silver.judge_cost(p.raw("raw_cost")).rejected, PLANT)
    return stored.drop("_row_hash")


@query
def quarantine_summary(p):
    return rules.rejects_by_reason({t: v.rejected for t, v in _verdicts(p).items()})


@query
def revision_duration(p):
    return p.revisions.select("part_id", "revision", "is_current_revision", "revision_duration_days")


@query
def current_revision(p):
    return silver.current_revision(p.revisions)


@query
def bom_enriched(p):
    return p.bom


@query
def part_cost_view(p):
    return silver.part_cost_view(p.lines, None, p.cost, p.hot)


# Gold -----------------------------------------------------------------------------------------------------

@query
def dim_part(p):
    return p.dim_part


@query
def dim_supplier(p):
    return p.dim_supplier


@query
def fact_bom_cost(p):
    return p.fact


@query
def cheapest_supplier(p):
    return gold.price_position(p.cost, p.hot).where("is_lowest_cost_supplier").select(
        "part_id", "currency", "supplier_name", "cost")


@query
def cost_vs_cheapest(p):
    return gold.price_position(p.cost, p.hot).select(
        "part_id", "supplier_name", "currency", "cost", "is_lowest_cost_supplier", "cost_vs_cheapest")


@query
def agg_assembly_cost(p):
    return gold.agg_assembly_cost(p.bom, p.cost, p.hot)


@query
def agg_supplier_cost(p):
    return p.agg_supplier


@query
def agg_part_revision_history(p):
    return p.rev_history


@query
def agg_cad_activity(p):
    return p.cad_activity


@query
def revision_impact(p):
    p.ahead("bom_lines", "revisions", "cost")
    return gold.revision_impact(p.revisions, p.bom_lines, p.cost, "2001-06-01", p.hot)


# Serving --------------------------------------------------------------------------------------------------

@query
def assembly_cost_summary(p):
    return serving.assembly_cost_summary(gold.agg_assembly_cost(p.bom, p.cost, p.hot))


@query
def supplier_performance(p):
    return serving.supplier_performance(p.agg_supplier)


@query
def vw_assembly_cost_dashboard(p):
    return p.priced_assemblies(serving.assembly_cost_dashboard)


@query
def vw_part_catalogue(p):
    return serving.part_catalogue(p.dim_part)


@query
def vw_supplier_scorecard(p):
    return serving.supplier_scorecard(p.agg_supplier, p.dim_supplier)


@query
def vw_revision_tracker(p):
    return serving.revision_tracker(p.rev_history)


@query
def vw_cad_health(p):
    return serving.cad_pipeline_health(p.cad_activity)


@query
def mart_assembly_cost(p):
    return p.mart()


@query
def mart_supplier_scorecard(p):
    return serving.mart_supplier_scorecard(p.agg_supplier, p.dim_supplier, PLANT)


@query
def mart_open_revisions(p):
    return serving.mart_open_revisions(p.rev_history, p.dim_part, PLANT, p.hot)


@query
def api_part_cost_lookup(p):
    rows = serving.api_part_cost_lookup(p.dim_part, p.cost, PLANT, hot=p.hot)
    return rows.withColumn("all_suppliers", F.to_json("all_suppliers"))


@query
def part_cost_answers(p):
    """The lookup called from SQL for every line."""
    lookup = p.stored("lookup", serving.api_part_cost_lookup(p.dim_part, p.cost, PLANT, hot=p.hot))
    table, lines = f"lookup_{uuid.uuid4().hex}", f"lines_{uuid.uuid4().hex}"
    lookup.createOrReplaceTempView(table)
    p.bom_lines.createOrReplaceTempView(lines)
    serving.register_lookup(p.spark, table)
    return p.spark.sql(f"""
SELECT l.assembly_id, l.part_id, a.current_revision, a.cheapest_supplier, a.cheapest_unit_cost, a.supplier_pages
FROM {lines} l, LATERAL part_cost_lookup(l.part_id) a""")


MEMBERS = [("ines", "buyers"), ("buyers", "procurement_team"), ("procurement_team", "buyers"), ("otto", "data_analysts"),
           ("tom", "designers"), ("designers", "plm_engineers"), ("eve", "visitors")]


@query
def guarded_mart(p):
    """What four readers see through one view; groups are nested, two of them in a circle."""
    assembly = F.when(F.col("assembly_data_completeness") != "Incomplete", F.col("assembly_id"))
    mart, members, granted = (f"{n}_{uuid.uuid4().hex}" for n in ("mart", "members", "granted"))
    p.mart(lambda m: m.select(assembly.alias("assembly_id"), "part_id", "line_cost", "unit_cost"), store=True).createOrReplaceTempView(mart)
    p.spark.createDataFrame(MEMBERS, rights.MEMBERSHIPS).createOrReplaceTempView(members)
    rights.standard_rights(p.spark, mart, {"unit_cost": policy.COST_READERS}).createOrReplaceTempView(granted)
    seen = []
    for reader in ("ines", "otto", "tom", "eve"):
        rights.guarded_view(p.spark, f"{mart}_{reader}", mart, "assembly_id", ("unit_cost",), members, granted, f"'{reader}'")
        seen.append(p.spark.table(f"{mart}_{reader}").select(F.lit(reader).alias("reader"), "*"))
    return reduce(DataFrame.unionAll, seen)


@query
def masked_mart(p):
    return p.mart(lambda m: policy.mask_columns(m, {"unit_cost": policy.COST_READERS}, ["plm_engineers"]).select(
        "assembly_id", "part_id", "supplier_name", "unit_cost", "part_revision"))


@query
def row_filtered_mart(p):
    # Lines of assemblies that are not released to the reader have no assembly id.
    assembly = F.when(F.col("assembly_data_completeness") != "Incomplete", F.col("assembly_id"))
    return p.mart(lambda m: policy.filter_rows(m.withColumn("assembly_id", assembly), "assembly_id", ["procurement_team"]).select(
        "assembly_id", "part_id", "line_cost"))


@query
def domain_filtered_rejects(p):
    counts = quarantine_summary(p)
    domain = F.when(F.col("table_name") == "erp_cost", "erp").when(F.col("table_name") == "cad_metadata", "cad")
    return policy.filter_domains(counts.withColumn("domain", domain.otherwise("plm")), "domain", "engineering")


# Upsert, change feed, history -------------------------------------------------------------------------------

@query
def upsert_cost(p):
    notices = p.raw("raw_cost")
    until = F.lit("1999-12-31").cast("date")
    old = silver.erp_cost(notices.where(F.col("last_updated") <= until))
    new = silver.erp_cost(notices.where(F.col("last_updated") > until)).withColumn("wave", F.lit(2))
    return merge.upsert(old, new, ["part_id", "supplier_name"])


@query
def upsert_partitioned_revisions(p):
    path = shared_dir(p.spark, "partitions")
    rows = p.raw("raw_revisions")
    cut = F.lit("2000-07-01").cast("timestamp")
    keys = ["part_id", "revision"]
    old = latest_per_key(rows.where(F.col("last_modified") <= cut), keys, ["last_modified"])
    write_partitioned(old, path, ["status"])
    new = bronze.plm_revisions(rows.where(F.col("last_modified") > cut))
    upsert_partitions(p.spark, path, new, keys, ["status"])
    return p.spark.read.schema(old.schema).parquet(path)


@query
def cdc_apply(p):
    feed = p.raw("raw_cdc")
    half = feed.agg(F.floor(F.max("lsn") / 2)).first()[0]
    state = merge.apply_change_feed(feed.drop("op").limit(0), feed.where(F.col("lsn") <= half), ["part_no"], "lsn", "op")
    return merge.apply_change_feed(state, feed, ["part_no"], "lsn", "op", after=half)


@query
def scd2_revision(p):
    return history.version_chain(p.revisions, "part_id", "effective_from", ["revision", "status"], tie=["revision"],
                                 hot=p.hot.revision_parts)


@query
def scd2_status(p):
    return history.version_chain(p.revisions, "part_id", "effective_from", ["status"], tie=["revision"],
                                 hot=p.hot.revision_parts)


def _scd2_in_two_loads(p, late, tracked):
    """A dimension from the rows that are not late, brought up to date with the late ones."""
    hot = p.hot.revision_parts
    columns = ["part_id", *dict.fromkeys([*tracked, "revision"]), F.col("effective_from").alias("valid_from")]
    dim = history.version_chain(p.revisions.where(~late), "part_id", "effective_from", tracked, tie=["revision"], hot=hot)
    points = p.revisions.where(~late).select(*columns)
    changes = p.revisions.where(late).select(*columns)
    return history.apply_changes(dim, points, changes, "part_id", tracked, tie=["revision"], hot=hot)[0]


@query
def scd2_incremental(p):
    late = F.col("last_modified") >= F.lit("2000-07-01").cast("timestamp")
    return _scd2_in_two_loads(p, late, ["revision", "status"])


@query
def scd2_status_incremental(p):
    # The middle years arrive last, so states that were merged are parted again.
    return _scd2_in_two_loads(p, F.year("effective_from").isin(1994, 1996), ["status"])


@query
def revision_as_of(p):
    day = F.lit("1999-06-30").cast("timestamp")
    return history.active_on(p.dim_revision, day, "effective_from", "effective_to").select(
        "part_id", "revision", "status", "effective_from")


@query
def bom_revision_as_of(p):
    p.ahead("bom_lines", "revisions")
    return history.as_of(p.bom_lines, p.dim_revision, "part_id", "last_modified", "effective_from",
                         ["revision", "status"], end="effective_to", tie=["revision"], hot=p.hot.bom_parts)


@query
def revision_price_spans(p):
    """Which price each supplier asked for which revision of a part, from when to when: notices hold until the next."""
    notices = silver.judge_cost(p.raw("raw_cost")).clean
    if skew.find(notices.select("part_id"), ["part_id"]) is None:
        # Both histories then lie by part, and no step that follows moves a row again.
        notices = notices.select("part_id", "supplier_name", "cost", "currency", "last_updated").repartition("part_id")
    by_offer = ["part_id", "supplier_name"]
    offers = notices.select(*by_offer).distinct()
    # Every supplier of a part sees all its revisions.
    revisions = skew.join(offers, p.revisions.select("part_id", "revision", "status", "effective_from", "effective_to"), ["part_id"], "inner",
                          p.hot.cost_parts)
    prices = notices.select(*by_offer, "cost", "currency", "last_updated", F.lit(None).cast("timestamp").alias("until"))
    return history.overlaps(revisions, prices, by_offer, ("effective_from", "effective_to"), ("last_updated", "until"),
                            ["revision", "status"], ["cost", "currency"], ["revision"], ["cost", "currency"])


# The table store, and the layers as a run chains them ------------------------------------------------------------

def _lake(p, purpose: str = "lake") -> Lake:
    return Lake(p.spark, shared_dir(p.spark, purpose))


def _price_waves(p) -> tuple[DataFrame, DataFrame]:
    notices, until = p.raw("raw_cost"), F.lit("1999-12-31").cast("date")
    return tuple(silver.erp_cost(notices.where(c)) for c in (F.col("last_updated") <= until, F.col("last_updated") > until))


@query
def lake_upsert_reopened(p):
    lake, (old, new) = _lake(p), _price_waves(p)
    spec = schemas.TableSpec("reopened", "prices", ("part_id", "supplier_name"), ("currency",))
    lake.upsert(old, spec, PLANT, "last_updated")
    p.spark.sql("DROP DATABASE reopened CASCADE")  # as in a session that has never seen the table
    again = Lake(p.spark, lake.root)
    again.upsert(new, spec, DESIGN, "last_updated")
    return again.read(spec.id)


@query
def lake_upsert_repeat(p):
    lake, (old, new) = _lake(p), _price_waves(p)
    spec = schemas.TableSpec("repeated", "prices", ("part_id", "supplier_name"), ("currency",))
    for rows in (old, new, new, old):  # one run id throughout; the last wave is older and changes nothing
        lake.upsert(rows, spec, PLANT, "last_updated")
    return lake.read(spec.id)


def _bucketed(p, lake: Lake) -> schemas.TableSpec:
    """A table of offers by key buckets, in two loads; returns its description."""
    spec = schemas.TableSpec("bucketed", "prices", ("part_id", "supplier_name"), buckets=32)
    for rows in _price_waves(p):
        lake.upsert(rows, spec, PLANT, "last_updated")
    return spec


@query
def bucketed_upsert(p):
    lake = _lake(p)
    return lake.read(_bucketed(p, lake).id)


@query
def bucketed_changes(p):
    """What the second load changed, seen from where the buckets lay after the first."""
    lake, (old, new) = _lake(p), _price_waves(p)
    spec = schemas.TableSpec("bucketed", "offers", ("part_id", "supplier_name"), buckets=32)
    lake.upsert(old, spec, PLANT, "last_updated")
    then = lake.places(spec.id)
    lake.upsert(new, spec, PLANT, "last_updated")
    return lake.changes(spec.id, then, old.columns).withColumnRenamed("_n", "more")


def _three_loads(p, names: list[str], last: Callable[[Run], DataFrame]) -> DataFrame:
    """What is kept up to date from the changes of three loads, the second of them out of order."""
    lake, day = _lake(p), {"erp_cost": "last_updated", "plm_revisions": "last_modified"}
    raw = {name: p.kept({"erp_cost": "raw_cost", "plm_revisions": "raw_revisions"}[name]) for name in names}
    for run_id, (low, high) in {"m1": (1992, 1996), "m2": (1999, 2030), "m3": (1997, 1998)}.items():
        run = Run(p.spark, lake, RunContext(run_id, PLANT.run_ts))
        for name in names:
            run.arrive(name, raw[name].where(F.coalesce(F.year(day[name]), F.lit(low)).between(low, high)))
            run.cleaned(name)
        found = last(run)
    return found


@query
def dim_supplier_from_changes(p):
    return _three_loads(p, ["erp_cost"], lambda run: gold.supplier_dimension(run.totals("suppliers", "silver.erp_cost", gold.SUPPLIER_TOTALS)))


@query
def dim_part_from_changes(p):
    def part(run: Run) -> DataFrame:
        history = gold.revision_figures(run.totals("revisions", "silver.plm_revisions", gold.REVISION_TOTALS))
        offers = gold.supplier_figures(run.totals("offers", "silver.erp_cost", gold.OFFER_TOTALS))
        return gold.dim_part(run.lake.read("silver.plm_revisions"), run.lake.read("silver.erp_cost"), history, offers)

    return _three_loads(p, ["erp_cost", "plm_revisions"], part)


@query
def profile_of_writes(p):
    """The profile of tables that three loads wrote, from the counts taken on the way."""
    written = [schemas.TABLES[f"{layer}.erp_cost"] for layer in ("bronze", "silver")]
    return _three_loads(p, ["erp_cost"], lambda run: run.profile(written))


def _sources(p) -> Sources:
    return Sources(p.raw("raw_cad"), p.raw("raw_revisions"), p.raw("raw_bom"), p.raw("raw_cost"))


@query
def run_chain_rejects(p):
    run = Run(p.spark, _lake(p), PLANT)
    run.bronze(_sources(p))
    return rules.rejects_by_reason({n: run.lake.read_appended(f"silver.{n}_quarantine") for n in SOURCES})


@query
def run_chain_cost(p):
    run = Run(p.spark, _lake(p), PLANT)
    run.arrive("erp_cost", p.raw("raw_cost"))
    return silver.erp_cost(run.lake.read("bronze.erp_cost"))


@query
def run_chain_revisions(p):
    run = Run(p.spark, _lake(p), PLANT)
    run.arrive("plm_revisions", p.raw("raw_revisions"))
    return silver.plm_revisions(run.lake.read("bronze.plm_revisions"), PLANT)


@query
def run_chain_cad(p):
    run = Run(p.spark, _lake(p), PLANT)
    run.arrive("cad_metadata", p.raw("raw_cad"))
    return silver.cad_metadata(run.lake.read("bronze.cad_metadata"))


def _second_run(p, *tables: str) -> Run:
    """Two runs: in the first, revisions are still open, prices are fewer and in another currency."""
    lake, src = _lake(p), _sources(p)
    # A notice without an accepted currency has none in the first run either: taken in there, it would outlast its rejection.
    currency = F.when(code(F.col("currency")).isin(CURRENCIES), "jpy").otherwise(F.col("currency"))
    early = Sources(
        src.cad, src.revisions.withColumn("effective_to", F.lit(None).cast("date")),
        src.bom, src.cost.where(F.year("last_updated") < 1996).withColumn("currency", currency))
    for ctx, sources in ((PLANT, early), (RunContext("run-003", PLANT.run_ts), src)):
        run = Run(p.spark, lake, ctx)
        run.bronze(sources)
        run.silver()
        run.gold(tables)
    return run


@query
def gold_after_second_run(p):
    return _second_run(p, "agg_assembly_cost").lake.read("gold.agg_assembly_cost").drop("_gold_run_date", "_gold_processed_at", "_gold_pipeline_run")


@query
def open_revisions_after_second_run(p):
    run = _second_run(p, "agg_part_revision_history", "dim_part")
    return serving.mart_open_revisions(run.lake.read("gold.agg_part_revision_history"), run.lake.read("gold.dim_part"), PLANT)


@query
def watermark_commit(p):
    # Every supplier stands for a source table; those without a record yet are added to it.
    notices = p.raw("raw_cost").withColumn("table_name", F.trim("supplier_name"))
    path = shared_dir(p.spark, "control") + "/watermarks.json"
    known = incremental.read_watermarks(p.spark, path)
    for upto in (datetime(1996, 1, 1), datetime(2000, 1, 1)):
        names = [r[0] for r in notices.where(F.col("last_updated") <= F.lit(upto)).select("table_name").distinct().collect()]
        incremental.commit_watermarks(known, names, upto, path)
        known = incremental.read_watermarks(p.spark, path)
    return known.select("table_name", "last_watermark")


@query
def incremental_run(p):
    lake, control = _lake(p), shared_dir(p.spark, "control") + "/watermarks.json"
    for run_id, upto in (("i1", datetime(1996, 1, 1)), ("i2", datetime(1999, 6, 30)), ("i2", datetime(1999, 6, 30)),
                         ("i3", datetime(2003, 1, 1))):
        Run(p.spark, lake, RunContext(run_id, upto)).load({"erp_cost": (p.kept("raw_cost"), "last_updated")}, control, upto)
    return lake.read("bronze.erp_cost").select("part_id", "supplier_name", "cost", "currency", "last_updated")


# Star schema ------------------------------------------------------------------------------------------------

@query
def star_dim_part(p):
    return p.star_parts


@query
def star_dim_assembly(p):
    return star.dim_assembly(p.bom_lines)


@query
def star_dim_supplier(p):
    return star.dim_supplier(p.cost, p.raw("supplier_sites"))


@query
def star_dim_revision(p):
    return p.dim_revision


@query
def star_fact_bom(p):
    return star.fact_bom(p.bom_lines)


@query
def star_fact_cost(p):
    # Only parts with a design record are looked up, so others show the unknown member.
    parts = star.dim_part(p.cad)
    return star.fact_cost(p.cost, parts, star.dim_supplier(p.cost), p.hot)


@query
def star_fact_design(p):
    return star.fact_design(p.cad, p.dim_revision, p.hot.cad_parts)


# Governance ---------------------------------------------------------------------------------------------------

def _profile(p):
    return governance.key_profile([
        ("bronze", "cad_metadata", p.raw("raw_cad"), ["part_id"]),
        ("bronze", "plm_revisions", p.raw("raw_revisions"), ["part_id", "revision"]),
        ("bronze", "plm_bom", p.raw("raw_bom"), ["assembly_id", "part_id"]),
        ("bronze", "erp_cost", p.raw("raw_cost"), ["part_id", "supplier_name"]),
        ("silver", "cad_metadata", p.cad, ["part_id"]),
        ("silver", "plm_revisions", p.revisions, ["part_id", "revision"]),
        ("silver", "plm_bom", p.bom_lines, ["assembly_id", "part_id"]),
        ("silver", "erp_cost", p.cost, ["part_id", "supplier_name"]),
    ])


def _rates(p):
    return governance.judged_rate([(t, v.judged) for t, v in _verdicts(p).items()])


def _stale(p):
    newest = {"erp_cost": ("raw_cost", "last_updated"), "plm_bom": ("raw_bom", "last_modified"),
              "plm_revisions": ("raw_revisions", "effective_to")}
    marks = None
    for table, (raw, column) in newest.items():
        one = p.raw(raw).agg(F.lit(table).alias("table_name"), F.max(column).cast("string").alias("last_watermark"))
        marks = one if marks is None else marks.unionByName(one)
    return incremental.staleness(marks, PLANT.ts, PLANT.limits.watermark_age_hours)


def _metrics(p):
    # Each is read by the silver table, the profile, the rates and the newest dates.
    for name in ("raw_revisions", "raw_cost"):
        p.kept(name)
    p.ahead("cad", "revisions", "bom_lines", "cost")
    return governance.dq_metrics(PLANT, _profile(p), _rates(p), _stale(p))


@query
def dq_profile(p):
    return _profile(p)


@query
def table_freshness(p):
    return governance.freshness([
        ("plm_revisions", p.revisions, "last_modified"), ("plm_bom", p.bom_lines, "last_modified"),
        ("erp_cost", p.cost, "last_updated")])


@query
def quarantine_rate(p):
    return _rates(p)


@query
def watermark_age(p):
    return _stale(p)


@query
def supplier_freshness(p):
    marks = p.cost.groupBy(F.col("supplier_name").alias("table_name")).agg(
        F.max("last_updated").cast("string").alias("last_watermark"))
    return incremental.staleness(marks, PLANT.ts, PLANT.limits.watermark_age_hours)


@query
def dq_metrics(p):
    return _metrics(p)


@query
def alerts(p):
    return governance.alerts(_metrics(p))


@query
def daily_summary(p):
    sized = [("bronze", "cad_metadata", p.given("events")), ("bronze", "erp_cost", p.given("lineitem"))]
    summary = governance.daily_summary(_metrics(p), governance.table_health(sized, PLANT))
    return summary.withColumn("has_files", F.coalesce(F.col("num_files") > 0, F.lit(False))).drop("num_files", "size_bytes")


@query
def column_profile(p):
    return governance.column_profile({"erp_cost": p.cost, "plm_bom": p.bom_lines}, distinct=False)


@query
def column_drift(p):
    base = p.raw("raw_cost").withColumnRenamed("supplier_name", "vendor")
    return governance.drift(governance.column_profile({"erp_cost": p.cost}, distinct=False),
                            governance.column_profile({"erp_cost": base}, distinct=False))


def _yearly_states(p, rows: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """Summaries of the rows of each span of years, as runs store them."""
    lake = _lake(p)
    for run_id, (low, high) in {"s1": (1992, 1996), "s2": (1997, 1998), "s3": (1999, 2030)}.items():
        some = rows.where(F.coalesce(F.year(day), F.lit(low)).between(low, high))
        lake.append(sketches.summarise("erp_cost", some, run_id, columns), "govern.column_states", RunContext(run_id, PLANT.run_ts))
    return lake.read("govern.column_states").drop("run").withColumn("run", F.lit("all"))


SKETCHED = ["part_id", "supplier_name", "cost", "currency", "last_updated"]


@query
def merged_column_states(p):
    """Exact figures of each column, and whether the merged sketches give them within their stated errors."""
    merged = sketches.merge(_yearly_states(p, p.cost, "last_updated", SKETCHED))
    one = sketches.summarise("erp_cost", p.cost, "whole", SKETCHED)
    exact = p.cost.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED], F.count_if(F.col("cost") <= 500).alias("_below"), F.count("cost").alias("_n"))
    counts = exact.select(F.explode(F.create_map(*[x for c in SKETCHED for x in (F.lit(c), F.col(c))])).alias("column_name", "distinct_count"),
                          (F.col("_below") / F.col("_n")).alias("below"))
    estimate, whole = sketches.distinct_values(F.col("distinct_state")), sketches.distinct_values(F.col("whole_state"))
    rank = F.when(F.col("column_name") == "cost", F.kll_sketch_get_rank_double("rank_state", F.lit(500.0)))
    return merged.join(one.select("column_name", F.col("distinct_state").alias("whole_state")), "column_name").join(counts, "column_name").select(
        "table_name", "column_name", "row_count", "nulls", "distinct_count",
        (F.abs(estimate - F.col("distinct_count")) <= F.col("distinct_count") * sketches.HLL_ERROR).alias("distinct_within_error"),
        (F.abs(estimate - whole) <= whole * sketches.HLL_ERROR).alias("merged_as_one_pass"),
        F.coalesce(F.abs(rank - F.col("below")) <= sketches.KLL_ERROR, F.lit(True)).alias("rank_within_error"))


@query
def profile_distinct_counts(p):
    """Exact distinct counts of every column, and whether the profile's are within three times their standard error."""
    tables = {"erp_cost": p.cost, "plm_bom": p.bom_lines}
    profile = governance.column_profile(tables).select("table_name", "column_name", "approx_distinct")
    exact = []
    for name, df in tables.items():
        columns = [c for c in df.columns if not c.startswith("_")]
        pairs = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])
        exact.append(df.agg(*[F.count_distinct(c).alias(c) for c in columns]).select(
            F.lit(name).alias("table_name"), F.explode(pairs).alias("column_name", "distinct_count")))
    gap = F.abs(F.col("approx_distinct") - F.col("distinct_count"))
    return reduce(DataFrame.unionAll, exact).join(profile, ["table_name", "column_name"]).select(
        "table_name", "column_name", "distinct_count", (gap <= 0.15 * F.col("distinct_count")).alias("within_error"))


@query
def duplicate_bom_keys(p):
    return duplicate_keys(p.raw("raw_bom"), ["assembly_id", "part_id"])


@query
def referential_orphans(p):
    return governance.orphans(p.bom_lines.select("assembly_id", "part_id"), p.cost, ["part_id"],
                              p.hot.bom_parts)


@query
def covered_lines(p):
    return governance.covered(p.bom_lines.select("assembly_id", "part_id"), p.cost, ["part_id"],
                              p.hot.bom_parts)


@query
def quality_log(p):
    typed_cost = silver.judge_cost(p.raw("raw_cost"))
    cost_rows = typed_cost.clean.unionByName(typed_cost.rejected.drop(rules.REASON))
    business = rules.rule_report([("erp_cost", cost_rows, silver.COST_RULES())])
    return governance.quality_log(
        nulls=[("cad_metadata", p.raw("raw_cad"), ["part_id"])],
        unique=[("plm_bom", p.raw("raw_bom"), ["assembly_id", "part_id"])],
        references=[("plm_bom", p.bom_lines, "erp_cost", p.cost, ["part_id"])],
        business=business)


@query
def run_gate(p):
    return incremental.all_succeeded(p.raw("raw_runs"))


@query
def latest_runs(p):
    return incremental.latest_runs(p.raw("raw_runs"))


@query
def sla_breaches(p):
    log = p.raw("raw_runs").select("run_id", F.lit("bronze").alias("layer"), F.col("pipeline_name").alias("table_name"),
                                   F.col("duration_seconds").cast("double").alias("duration_seconds"))
    return governance.sla_breaches(log, PLANT)


def _access(p):
    return governance.table_access(fixtures.nested_audit(p.raw("raw_audit")), F.lit("2024-01-15").cast("date"),
                                   "tables", "plant")


@query
def table_access(p):
    return _access(p)


@query
def access_top10(p):
    return governance.top_tables(_access(p), 10)


@query
def access_by_user(p):
    return governance.access_by_user(_access(p))


@query
def table_file_stats(p):
    stats = files.file_stats(p.given("lineitem"), "lineitem")
    return stats.select("table_name", "row_count", (F.col("num_files") > 0).alias("has_files"),
                        (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def compact_cluster(p):
    path = shared_dir(p.spark, "clustered")
    compact(p.given("lineitem"), path, ["l_partkey", "l_suppkey"], numeric=True)
    return p.spark.read.parquet(path)


# Streaming ------------------------------------------------------------------------------------------------

@query
def stream_ingest_cad(p):
    arrivals = jobs.csv_arrivals(p.spark, _drop_cad_files(p), schemas.CAD_CSV)
    rows = arrivals.withColumn("snapshot", _snapshot_name()).withColumn("file_date", file_date(F.col("_source_file")))
    out = shared_dir(p.spark, "cad-batches")
    newest = ["file_date", "snapshot"]
    jobs.ingest(rows.drop("_source_file"), out, shared_dir(p.spark, "cad-checkpoint"), ["part_id"], newest)
    return jobs.current(p.spark, out, ["part_id"], newest)


def _event_stream(p):
    path = f"{p.folder}/events*.parquet"  # a pattern covers one file and a folder of files alike
    stream = jobs.parquet_arrivals(p.spark, path, p.given("events").schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _as_feed(events: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert")
    return events.select(
        F.col("event_id").alias("lsn"), F.col("user_id").alias("part_no"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("reading"), op.otherwise("update").alias("op"))


@query
def stream_cdc_apply(p):
    feed = _as_feed(_event_stream(p))
    out = shared_dir(p.spark, "cdc-batches")
    jobs.ingest(feed, out, shared_dir(p.spark, "cdc-checkpoint"), ["part_no"], ["lsn"])
    return jobs.current_of_feed(p.spark, out, ["part_no"], "lsn", "op")


@query
def stream_cdc_state(p):
    """The feed in three loads, the newest first and the second sent twice, merged through the state store."""
    feed, arrivals, checkpoint, lake = _as_feed(p.given("events")), shared_dir(p.spark, "feed"), shared_dir(p.spark, "state"), _lake(p)
    spec = schemas.TableSpec("streamed", "readings", ("part_no",), buckets=16)
    newest = feed.agg(F.max("lsn")).first()[0] or 0
    third = F.coalesce(F.floor(F.col("lsn") * 3 / F.lit(newest + 1)), F.lit(0))
    for load in (2, 1, 1, 0):
        feed.where(third == load).write.mode("append").parquet(arrivals)
        state.apply_changes(jobs.parquet_arrivals(p.spark, arrivals, feed.schema), lake, spec, PLANT, checkpoint, "lsn", "op")
    return lake.read(spec.id)


@query
def stream_without_repeats(p):
    out = shared_dir(p.spark, "unique")
    twice = _event_stream(p).union(_event_stream(p))  # every event is sent again
    once = jobs.without_repeats(twice, "ts", ["event_id"])
    jobs.to_files(once.select("event_id", "user_id", "event_type"), out, shared_dir(p.spark, "unique-checkpoint"))
    return p.spark.read.parquet(out)


@query
def stream_daily_activity(p):
    out = shared_dir(p.spark, "daily")
    jobs.store_updates(jobs.daily_activity(_event_stream(p), "ts", ["event_type"]), out,
                       shared_dir(p.spark, "daily-checkpoint"))
    return jobs.current(p.spark, out, ["day", "event_type"])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Plant(spark, folder))
