import json
from datetime import date, datetime

from pyspark.sql import functions as F

from partledger import schemas
from partledger.context import RunContext
from partledger.operators import policy
from partledger.plans import governance
from partledger.session import shared_dir
from partledger.sources import files, incremental


# Sources

def test_csv_tree_reads_only_csv_files_of_all_folders(spark, tmp_path, rows):
    deep = tmp_path / "2026" / "03"
    deep.mkdir(parents=True)
    head = "part_id,part_name,material,weight_kg,designer,created_date\n"
    (deep / "cad_metadata_2026-03-10.csv").write_text(head + 'P1,"bolt, long",steel,1.5,ann,2026-03-01\n')
    (tmp_path / "cad_metadata_2026_03_01.csv").write_text(head + "P2,nut,,x,bob,2026-02-01\n")
    (tmp_path / "notes.txt").write_text("not data")
    df = files.csv_tree(spark, str(tmp_path), schemas.CAD_CSV)
    assert rows(df, "part_id", "part_name", "material") == [("P1", "bolt, long", "steel"), ("P2", "nut", "None")]
    listed = files.listing(spark, str(tmp_path))
    assert rows(listed, "file_name") == [("cad_metadata_2026-03-10.csv",), ("cad_metadata_2026_03_01.csv",)]
    assert rows(files.newer_than(df, "_source_file", "2026-03-01"), "part_id") == [("P1",)]
    assert files.last_loaded(files.newer_than(df, "_source_file", None)).first()[0] == date(2026, 3, 10)
    ledger = spark.createDataFrame([("cad_metadata_2026-03-10.csv", "PROCESSED", None), ("cad_metadata_2026_03_01.csv", "FAILED", None)],
                                   schemas.FILE_LEDGER)
    assert rows(files.unprocessed(listed, ledger), "file_name") == [("cad_metadata_2026_03_01.csv",)]


def test_month_snapshots(spark, tmp_path, rows):
    df = spark.createDataFrame([("P1", date(2026, 1, 5)), ("P2", date(2026, 1, 9)), ("P3", date(2026, 2, 1))], "part_id string, d date")
    path = str(tmp_path / "out")
    files.write_snapshots(df, path, files.month_snapshot(F.col("d")))
    got = spark.read.option("header", True).csv(path)
    assert rows(got, "snapshot", "part_id") == [
        ("cad_metadata_2026_01_01", "P1"), ("cad_metadata_2026_01_01", "P2"), ("cad_metadata_2026_02_01", "P3")]


def test_watermarks_are_committed_as_read(spark, tmp_path, rows):
    path = tmp_path / "wm.json"
    path.write_text(json.dumps([{"table_name": "erp_cost", "last_watermark": "2026-03-01 00:00:00", "merge_key": ["part_id"],
                                 "adls_path": "erp"}, {"table_name": "plm_bom", "last_watermark": "2026-03-05 00:00:00"}]))
    control = incremental.read_watermarks(spark, str(path))
    after = incremental.watermark_of(control, "erp_cost")
    assert incremental.watermark_of(control, "never_loaded") == "1900-01-01"
    upto = datetime(2026, 3, 10, 9, 0)
    src = spark.createDataFrame([("old", datetime(2026, 3, 1)), ("new", datetime(2026, 3, 10, 9)), ("later", datetime(2026, 3, 10, 9, 0, 1))],
                                "v string, t timestamp")
    taken = incremental.changed_between(src, "t", after, upto)
    assert rows(taken, "v", "_ingestion_ts") == [("new", "2026-03-10 09:00:00")]
    for _ in range(2):
        incremental.commit_watermarks(control, ["erp_cost", "added"], upto, str(path))
    again = incremental.read_watermarks(spark, str(path))
    assert rows(again, "table_name", "last_watermark") == [
        ("added", "2026-03-10 09:00:00"), ("erp_cost", "2026-03-10 09:00:00"), ("plm_bom", "2026-03-05 00:00:00")]
    assert incremental.read_watermarks(spark, str(tmp_path / "none")).isEmpty()
    assert rows(incremental.changed_between(src, "t", incremental.watermark_of(again, "erp_cost"), "2026-03-11"), "v") == [("later",)]


def test_watermark_filter_reaches_the_scan(spark):
    path = shared_dir(spark, "wm")
    spark.range(10).select("id", F.current_timestamp().alias("t"), F.lit("x").alias("wide")).write.parquet(path)
    df = incremental.changed_between(spark.read.parquet(path).select("id", "t"), "t", "2026-01-01", "2026-02-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t," in plan and "LessThanOrEqual(t," in plan and "wide" not in plan


def test_change_position(spark, rows):
    feed = spark.createDataFrame([(1, "a"), (2, "b")], "lsn long, v string")
    positions = spark.createDataFrame([("plm_bom", 1)], schemas.CDC_POSITION)
    assert rows(incremental.changes_after(feed, positions, "plm_bom", "lsn"), "v") == [("b",)]
    assert incremental.changes_after(feed, positions, "other", "lsn").count() == 2


def test_staleness_flags_what_it_cannot_read(spark):
    marks = spark.createDataFrame([("fresh", "2026-03-31 06:00:00"), ("stale", "2026-03-30 00:00:00"), ("broken", "soon"),
                                   ("none", None)], "table_name string, last_watermark string")
    now = F.lit("2026-04-01 06:00:00").cast("timestamp")
    got = {r.table_name: (r.age_hours, r.unreadable, r.passed) for r in incremental.staleness(marks, now, 25).collect()}
    assert got == {"fresh": (24.0, False, True), "stale": (54.0, False, False), "broken": (None, True, False), "none": (None, True, False)}


def test_gate(spark):
    runs = spark.createDataFrame([("CAD", "r1", "FAILED", None, None, datetime(2026, 3, 1)), ("CAD", "r2", "SUCCESS", None, None, datetime(2026, 3, 2)),
                                  ("ERP", "r3", "RUNNING", None, None, datetime(2026, 3, 2))], schemas.RUN_STATUS)
    assert tuple(incremental.all_succeeded(runs).first()) == (2, 1, False)
    assert tuple(incremental.all_succeeded(runs.where("pipeline_name = 'CAD'")).first()) == (1, 1, True)
    assert tuple(incremental.all_succeeded(runs.limit(0)).first()) == (0, 0, False)


# Governance

def test_metrics_alerts_and_summary(spark, ctx, rows):
    df = spark.createDataFrame([("P1", "a"), (None, "b"), ("P3", None)], "part_id string, supplier_name string")
    profile = governance.key_profile([("silver", "erp_cost", df, ["part_id", "supplier_name"]), ("gold", "dim_part", df.where("part_id is not null"), ["part_id"]),
                                      ("gold", "empty", df.limit(0), ["part_id"])])
    assert rows(profile, "table_name", "row_count", "null_key_pct") == [("dim_part", "2", "0.0"), ("empty", "0", "None"), ("erp_cost", "3", "66.67")]
    rates = governance.quarantine_rate([("erp_cost", df, df.limit(1)), ("plm_bom", df, df.limit(0))])
    metrics = governance.dq_metrics(ctx, profile, rates)
    assert metrics.count() == 8 and metrics.where("not passed").count() == 2
    assert rows(governance.alerts(metrics), "alert_type", "severity", "message") == [
        ("DataQuality", "Warning", "erp_cost: null key rate 66.67% exceeds threshold 2.0%"),
        ("Quarantine", "Critical", "erp_cost: 25.0% rows quarantined — exceeds 5.0% threshold")]
    health = spark.createDataFrame([(ctx.run_date, "silver", "erp_cost", 3, 100, 2, None, None), (ctx.run_date, "bronze", "erp_cost", 9, 900, 9, None, None)],
                                   schemas.TABLE_HEALTH)
    summary = governance.daily_summary(metrics, health)
    assert rows(summary.where("table_name = 'erp_cost'"), "layer", "row_count", "quarantine_pct", "all_checks_passed", "failed_checks", "num_files") == [
        ("silver", "3.0", "25.0", "False", "2", "2")]


def test_schema_and_content_drift(spark, ctx):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, w double")
    now = spark.createDataFrame([(1, "a", "x", None), (2, "z", "y", None)], "k long, name string, extra string, _tech string")
    schema = governance.drift(governance.schema_baseline(spark, {"t": now}, ctx), governance.schema_baseline(spark, {"t": base}, ctx))
    assert {r.column_name: r.drift for r in schema.collect()} == {"k": "changed", "name": "same", "extra": "added", "w": "dropped"}
    content = governance.drift(governance.column_profile({"t": now}), governance.column_profile({"t": base}))
    assert {r.column_name: r.drift for r in content.collect()}["name"] == "shifted"


def test_quality_log(spark, rows):
    bom = spark.createDataFrame([("A1", "P1"), ("A1", "P1"), ("A2", "P9"), ("A3", None)], "assembly_id string, part_id string")
    parts = spark.createDataFrame([("P1",), ("P1",)], "part_id string")
    log = governance.quality_log([("bom", bom, ["part_id"])], [("bom", bom, ["assembly_id", "part_id"])], [("bom", bom, "parts", parts, ["part_id"])])
    assert rows(log) == [("bom", "not null part_id", "4", "1", "25.0", "False"), ("bom", "part_id in parts", "4", "2", "50.0", "False"),
                         ("bom", "unique assembly_id,part_id", "4", "1", "25.0", "False")]
    assert governance.orphans(bom, parts, ["part_id"]).count() == 2 and governance.covered(bom, parts, ["part_id"]).count() == 2


def test_run_log_and_sla(spark, ctx, rows):
    log = governance.run_log(spark, ctx, [{"layer": "gold", "table_name": "a", "seconds": 3601.0}, {"layer": "gold", "table_name": "b", "seconds": 3600.0, "error": "x"}])
    assert rows(governance.sla_breaches(log, ctx), "table_name", "duration_minutes") == [("a", "60.0")]


def test_access_report(spark, rows):
    def event(user, action, table, service="tables", day=date(2026, 3, 1)):
        return (day, datetime(2026, 3, 1), service, user, action, (table,), (200,))

    audit = spark.createDataFrame(
        [event("u1", "getTable", "plant.gold.a"), event("u2", "getTable", "plant.gold.a"), event("u1", "createTable", "plant.gold.b"),
         event("u1", "getTable", "other.gold.a"), event("u1", "login", "plant.gold.a"), event("u1", "getTable", "plant.gold.a", "jobs"),
         event("u1", "getTable", "plant.gold.a", day=date(2026, 3, 2))],
        "event_date date, event_time timestamp, service_name string, user_identity string, action_name string, "
        "request_params struct<full_name_arg: string>, response struct<status_code: int>")
    access = governance.table_access(audit, F.lit("2026-03-01").cast("date"), "tables", "plant")
    assert rows(governance.top_tables(access)) == [("plant.gold.a", "getTable", "2"), ("plant.gold.b", "createTable", "1")]
    assert [tuple(r) for r in governance.access_by_user(access).collect()] == [("u1", 2), ("u2", 1)]


def test_file_stats(spark, ctx):
    path = shared_dir(spark, "stats")
    spark.range(100).repartition(3).write.parquet(path)
    row = governance.table_health([("gold", "t", spark.read.parquet(path))], ctx).first()
    assert (row.row_count, row.num_files, row.size_bytes > 0, row.last_modified is not None) == (100, 3, True, True)


# Policies

def test_reader_policies(spark, rows):
    mart = spark.createDataFrame([("A1", 10, "plm"), (None, 20, "erp")], "assembly_id string, unit_cost int, domain string")
    hide = {"unit_cost": policy.COST_READERS}
    assert rows(policy.mask_columns(mart, hide, ["plm_engineers"]), "unit_cost") == [("None",), ("None",)]
    assert rows(policy.mask_columns(mart, hide, []), "unit_cost") == [("None",), ("None",)]
    assert rows(policy.mask_columns(mart, hide, ["plm_engineers", "management"]), "unit_cost") == [("10",), ("20",)]
    assert [policy.filter_rows(mart, "assembly_id", g).count() for g in (["management"], ["plm_engineers"], ["guests"], [])] == [2, 1, 0, 0]
    assert [policy.filter_domains(mart, "domain", g).count() for g in ("engineering", "management", "guests")] == [1, 2, 0]


def test_contexts_carry_their_own_clock(ctx, spark):
    assert isinstance(ctx, RunContext) and spark.range(1).select(ctx.today).first()[0] == date(2026, 4, 1)
