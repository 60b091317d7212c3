from datetime import datetime

from partledger import fixtures
from partledger.context import RunContext
from partledger.plans import governance
from partledger.plans.run import Run, Sources
from partledger.schemas import TABLES, TableSpec
from partledger.session import shared_dir
from partledger.sinks import Lake

SMALLEST = "/root/testdata/sf0.001"
KEYED = [t for t in TABLES.values() if t.keys]


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_profile_of_a_run_reads_no_table(spark, rows):
    sources = Sources(*[fixtures.raw(spark, SMALLEST, n) for n in ("raw_cad", "raw_revisions", "raw_bom", "raw_cost")])
    run = Run(spark, Lake(spark, shared_dir(spark, "plant")), RunContext("c1", datetime(2002, 1, 1, 6)))
    run.all(sources)
    found, want = run.profile(KEYED), governance.key_profile([(t.layer, t.name, run.lake.read(t.id), t.required) for t in KEYED])
    assert rows(found) == rows(want)
    assert scans(found) == 0 and scans(want) == len(KEYED)
    logged = {(e["layer"], e["table_name"]): e["rows_written"] for e in run.entries}
    assert all(logged[t.layer, t.name] == run.lake.read(t.id).count() for t in KEYED)


def test_counts_of_buckets_are_kept_and_added(spark):
    lake, spec = Lake(spark, shared_dir(spark, "lake")), TableSpec("counted", "rows", ("k", "currency"), buckets=4)
    run = Run(spark, lake, RunContext("c", datetime(2026, 1, 1)))
    schema = "k string, currency string, v int"
    lake.upsert(spark.createDataFrame([(f"k{i}", None, i) for i in range(30)] + [(None, "EUR", 0)], schema), spec, run.ctx)
    assert lake.counts(spec.id) == {"row_count": 31, "null_key_rows": 1}
    lake.upsert(spark.createDataFrame([("k1", None, -1), ("new", "EUR", 0), (None, "USD", 0)], schema), spec, run.ctx)
    assert lake.counts(spec.id) == {"row_count": 33, "null_key_rows": 2}
    lake.upsert(spark.createDataFrame([], schema), spec, run.ctx)
    assert [tuple(r) for r in run.profile([spec]).collect()] == [("counted", "rows", 33, 2, 6.06)]


def test_tables_without_counts_are_read(spark, monkeypatch):
    lake, spec = Lake(spark, shared_dir(spark, "lake")), TableSpec("counted", "old", ("k",))
    run = Run(spark, lake, RunContext("c", datetime(2026, 1, 1)))
    lake.upsert(spark.createDataFrame([("a",), (None,)], "k string"), spec, run.ctx)
    assert lake.counts(spec.id) == {"row_count": 2, "null_key_rows": 1}
    monkeypatch.setattr(Lake, "counts", lambda self, table: None)
    assert [tuple(r) for r in run.profile([spec]).collect()] == [("counted", "old", 2, 1, 50.0)]


def test_counts_on_the_way_that_the_files_deny_are_taken_again(spark, monkeypatch):
    lake = Lake(spark, shared_dir(spark, "lake"))
    monkeypatch.setattr("partledger.sinks.Observation.get", property(lambda self: {"row_count": 5, "null_key_rows": 4}))
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert lake.publish(rows, "counted.again", RunContext("c", datetime(2026, 1, 1)), required=["k"]) == {"rows_written": 3}
    assert lake.counts("counted.again") == {"row_count": 3, "null_key_rows": 1}
