from datetime import datetime

import pytest
from pyspark.sql import functions as F

from partledger import fixtures, schemas
from partledger.context import RunContext
from partledger.plans.run import Run, Sources
from partledger.schemas import TABLES
from partledger.session import shared_dir
from partledger.sinks import Lake
from partledger.streaming import jobs

SMALLEST = "/root/testdata/sf0.001"
HEAD = "part_id,part_name,material,weight_kg,designer,created_date\n"


def test_files_are_ingested_once(spark, tmp_path, rows):
    drop = tmp_path / "drop"
    drop.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def load():
        rows_in = jobs.csv_arrivals(spark, str(drop), schemas.CAD_CSV)
        named = rows_in.withColumn("file", F.element_at(F.split("_source_file", "/"), -1)).drop("_source_file")
        jobs.ingest(named, out, checkpoint, ["part_id"], ["file"])
        return jobs.current(spark, out, ["part_id"])

    (drop / "cad_metadata_2026-03-01.csv").write_text(HEAD + "P1,bolt,steel,1,a,2026-03-01\nP2,nut,steel,1,a,2026-03-01\n")
    first = rows(load(), "part_id", "material")
    assert first == [("P1", "steel"), ("P2", "steel")]
    assert rows(load(), "part_id", "material") == first
    (drop / "cad_metadata_2026-03-02.csv").write_text(HEAD + "P1,bolt,iron,1,a,2026-03-01\nP3,cap,tin,1,a,2026-03-01\n")
    last = load()
    assert rows(last, "part_id", "material") == [("P1", "iron"), ("P2", "steel"), ("P3", "tin")]
    jobs.fold(last, str(tmp_path / "folded"))
    assert rows(jobs.current(spark, str(tmp_path / "folded"), ["part_id"])) == rows(last)


def test_change_feed_in_two_batches(spark, tmp_path, rows):
    schema = "k int, v string, lsn long, op string"
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))

    def load(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(feed)
        jobs.ingest(jobs.parquet_arrivals(spark, feed, schema), out, checkpoint, ["k"], ["lsn"])
        return rows(jobs.current_of_feed(spark, out, ["k"], "lsn", "op"), "k", "v")

    assert load([(1, "a", 1, "insert"), (2, "b", 2, "insert"), (1, "A", 3, "update")]) == [("1", "A"), ("2", "b")]
    assert load([(2, None, 4, "delete"), (3, "c", 5, "insert")]) == [("1", "A"), ("3", "c")]


def test_repeats_and_daily_counts(spark, tmp_path, rows):
    data = [(1, datetime(2026, 3, 1, 1), "x"), (1, datetime(2026, 3, 1, 2), "x"), (2, datetime(2026, 3, 2, 1), "x")]
    src = str(tmp_path / "events")
    spark.createDataFrame(data, "id int, ts timestamp, kind string").write.parquet(src)
    schema = "id int, ts timestamp, kind string"
    out = str(tmp_path / "once")
    jobs.to_files(jobs.without_repeats(jobs.parquet_arrivals(spark, src, schema), "ts", ["id"]), out, str(tmp_path / "c1"))
    assert rows(spark.read.parquet(out), "id") == [("1",), ("2",)]
    daily = str(tmp_path / "daily")

    def count():
        jobs.store_updates(jobs.daily_activity(jobs.parquet_arrivals(spark, src, schema), "ts", ["kind"]), daily, str(tmp_path / "c2"))
        return rows(jobs.current(spark, daily, ["day", "kind"]), "day", "n")

    assert count() == [("2026-03-01", "2"), ("2026-03-02", "1")]
    spark.createDataFrame([(3, datetime(2026, 3, 2, 5), "x")], schema).write.mode("append").parquet(src)
    assert count() == [("2026-03-01", "2"), ("2026-03-02", "2")]


def test_all_layers_twice(spark, rows):
    """The second run over the same sources changes nothing."""
    sources = Sources(*[fixtures.raw(spark, SMALLEST, n) for n in ("raw_cad", "raw_revisions", "raw_bom", "raw_cost")])
    lake = Lake(spark, shared_dir(spark, "plant"))
    counts, pointers = [], []
    for run in ("d1", "d2"):
        Run(spark, lake, RunContext(run, datetime(2002, 1, 1, 6))).all(sources)
        counts.append({t: lake.read(t).count() for t in TABLES})
    assert counts[0] == counts[1] and min(counts[0].values()) > 0
    for t, spec in TABLES.items():
        if spec.keys and spec.layer != "star":
            assert lake.read(t).groupBy(*spec.keys).count().where("count > 1").isEmpty(), t
    rejected = lake.read_appended("silver.erp_cost_quarantine").groupBy("run").count().collect()
    assert {r.run for r in rejected} == {"d1", "d2"} and len({r["count"] for r in rejected}) == 1
    summary = lake.read("govern.daily_summary")
    assert summary.where("layer = 'gold' and num_files is null").isEmpty() and summary.count() >= len(TABLES)
    assert spark.table("vw_part_catalogue").count() == counts[0]["gold.dim_part"]
    log = lake.read("govern.pipeline_run_log")
    assert log.where("status <> 'success'").isEmpty() and not log.where("table_name = 'erp_cost' and rows_quarantined > 0").isEmpty()
    assert lake.read("govern.dq_metrics").where("metric_name = 'schema_drift' and not passed").isEmpty()
    assert not lake.read("govern.quality_log").isEmpty()
    # Nothing arrives: nothing is written.
    nothing = Sources(*[df.limit(0) for df in (sources.cad, sources.revisions, sources.bom, sources.cost)])
    before = {t: lake.state(t) for t in TABLES}
    run = Run(spark, lake, RunContext("d3", datetime(2002, 1, 1, 9)))
    run.bronze(nothing)
    run.silver()
    run.gold()
    run.serving()
    assert {t: lake.state(t) for t in TABLES} == before


def test_load_that_dies_between_data_and_commit(spark, rows, tmp_path, monkeypatch):
    lake, control = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "watermarks.json")
    schema = "part_id string, supplier_name string, cost string, currency string, last_updated date"
    prices = spark.createDataFrame([("P1", "a", "1", "USD", datetime(2026, 1, 1).date()), ("P1", "a", "2", "USD", datetime(2026, 1, 5).date()),
                                    ("P2", "a", "x", "USD", datetime(2026, 1, 5).date())], schema)
    upto = datetime(2026, 1, 6)

    def load(run_id):
        Run(spark, lake, RunContext(run_id, upto)).load({"erp_cost": (prices, "last_updated")}, control, upto)

    with monkeypatch.context() as m:
        m.setattr("partledger.plans.run.incremental.commit_watermarks", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("r1")
    for run_id in ("r1", "r2"):
        load(run_id)
        assert rows(lake.read("bronze.erp_cost"), "part_id", "cost") == [("P1", "2")]
    assert rows(lake.read("silver.erp_cost_quarantine"), "part_id", "run") == [("P2", "r1")]


def test_repeat_after_the_commit_keeps_rejects(spark, rows, tmp_path, monkeypatch):
    lake, control = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "watermarks.json")
    schema = "part_id string, supplier_name string, cost string, currency string, last_updated date"
    day = lambda d: datetime(2026, 1, d).date()
    prices = spark.createDataFrame([("P1", "a", "1", "USD", day(1)), ("P2", "a", "x", "USD", day(5)), ("P3", "a", "y", "USD", day(8))], schema)

    def load(run_id, d):
        run = Run(spark, lake, RunContext(run_id, datetime(2026, 1, d)))
        run.load({"erp_cost": (prices, "last_updated")}, control, datetime(2026, 1, d))
        return run.arrived["erp_cost"]

    with monkeypatch.context() as m:
        m.setattr("partledger.plans.run.incremental.commit_watermarks", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("r1", 5)
    assert load("r1", 6) == (2, 1)
    assert load("r1", 6) == (0, 0)
    found = lambda: rows(lake.read("silver.erp_cost_quarantine"), "part_id", "run")
    assert found() == [("P2", "r1")] == rows(spark.table("silver.erp_cost_quarantine"), "part_id", "run")
    assert load("r1", 9) == (1, 1)
    assert found() == [("P2", "r1"), ("P3", "r1")]
    landed = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{lake.root}/landing/erp_cost")
    assert rows(landed, "part_id") == [("P1",), ("P2",), ("P3",)]


@pytest.mark.parametrize("dies_at", ["silver", "gold", "serving"])
def test_layers_after_a_run_that_dies(spark, rows, tmp_path, monkeypatch, dies_at):
    """A retry, which reads no rows any more, builds what the dead run left stale."""
    raw = {n: fixtures.raw(spark, SMALLEST, f"raw_{n}") for n in ("cad", "revisions", "bom", "cost")}
    lake, control, upto = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "watermarks.json"), datetime(1996, 1, 1)
    old = raw["cost"].where("last_updated <= timestamp '1996-01-01'")
    first = Run(spark, lake, RunContext("d1", datetime(2002, 1, 1, 6)))
    first.bronze(Sources(raw["cad"], raw["revisions"], raw["bom"], old))
    first.silver(), first.gold(), first.serving()
    before = {t: lake.state(t)["path"] for t in TABLES}
    late = {"erp_cost": (raw["cost"], "last_updated")}
    last = datetime(2002, 1, 1, 6)
    with monkeypatch.context() as m:
        m.setattr(Run, dies_at, lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            Run(spark, lake, RunContext("d2", last)).incremental(late, control, last)
    retry = Run(spark, lake, RunContext("d2", last))
    retry.load(late, control, last)
    retry.silver(), retry.gold(), retry.serving()
    whole = Lake(spark, str(tmp_path / "whole"))
    at_once = Run(spark, whole, RunContext("d2", last))
    at_once.bronze(Sources(*raw.values()))
    at_once.silver(), at_once.gold(), at_once.serving()
    for t in ("silver.erp_cost", "gold.dim_supplier", "gold.agg_supplier_cost", "star.fact_cost", "serving.vw_supplier_scorecard"):
        assert lake.state(t)["path"] != before[t], t
        columns = [c for c in lake.read(t).columns if not c.startswith("_")]
        assert rows(lake.read(t), *columns) == rows(whole.read(t), *columns), t
    assert lake.state("gold.agg_cad_activity")["path"] == before["gold.agg_cad_activity"]


def test_a_failing_step_is_logged(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    bad = spark.createDataFrame([("P1",)], "part_id string")
    with pytest.raises(Exception):
        Run(spark, lake, RunContext("f1", datetime(2026, 1, 1))).arrive("erp_cost", bad)
    entry = lake.read("govern.pipeline_run_log").first()
    assert entry.status == "failed" and entry.error_message and entry.table_name == "erp_cost"
