"""Merges of large tables go bucket by bucket, and what was written on the way is let go."""

import os
from datetime import datetime

import pytest

from test_slices import plant

from partledger import sinks
from partledger.context import RunContext
from partledger.operators import slices
from partledger.plans import gold
from partledger.plans.run import Run
from partledger.queries import QUERIES
from partledger.session import shared_dir
from partledger.sinks import Lake

DAY = datetime(2002, 1, 1)
PRICES = "part_id string, supplier_name string, cost string, currency string, last_updated timestamp"
STAGED = ("arrivals-", "arriving-", "changes-", "unclustered-")


def staged(spark):
    return {f for f in os.listdir(os.path.dirname(shared_dir(spark, "x"))) if f.startswith(STAGED)}


def prices(spark, year, n):
    return spark.createDataFrame([(f"P{i % 17}" if i % 13 else None, f"s{i % 3}", str(i + year), ("usd", "eur")[i % 2], datetime(year, 1, 1 + i % 20))
                                  for i in range(n)], PRICES)


def loads(spark):
    lake = Lake(spark, shared_dir(spark, "plant"))
    for run_id, rows in (("a", prices(spark, 2000, 60)), ("b", prices(spark, 2001, 40)), ("c", prices(spark, 1999, 50))):
        run = Run(spark, lake, RunContext(run_id, DAY))
        run.arrive("erp_cost", rows)
        run.cleaned("erp_cost")
        run.totals("suppliers", "silver.erp_cost", gold.SUPPLIER_TOTALS)
    return lake


def test_what_was_staged_is_let_go(spark):
    before = staged(spark)
    lake = loads(spark)
    lake.publish(lake.read("bronze.erp_cost"), "let.go", RunContext("a", DAY), cluster_by=["part_id"])
    assert lake.read("let.go").count() == lake.read("bronze.erp_cost").count() > 0
    assert not staged(spark) - before


def test_merge_by_bucket_equals_merge_of_all(spark, rows, monkeypatch):
    whole = loads(spark)
    want, counts = rows(whole.read("bronze.erp_cost")), whole.counts("bronze.erp_cost")
    merged = []
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(sinks, "upsert_in_one", lambda *a, kept=sinks.upsert_in_one: merged.append(a) or kept(*a))
    found = loads(spark)
    assert len(merged) > 8 and rows(found.read("bronze.erp_cost")) == want and found.counts("bronze.erp_cost") == counts


def test_rows_are_not_moved_to_few_codes(spark, rows, monkeypatch):
    lake, kept = Lake(spark, shared_dir(spark, "plant")), []
    monkeypatch.setattr(sinks, "write_partitioned", lambda *a, write=sinks.write_partitioned, **k: kept.append(k.get("rebalance")) or write(*a, **k))
    df = prices(spark, 2000, 60).withColumn("day", sinks.F.to_date("last_updated"))
    for by in ("currency", "day"):
        lake.publish(df, f"moved.{by}", RunContext("a", DAY), [by])
        assert rows(lake.read(f"moved.{by}"), *df.columns) == rows(df)
    assert kept == [False, True]


@pytest.mark.parametrize("after,once", [("gold_after_second_run", "agg_assembly_cost"),
                                        ("open_revisions_after_second_run", "mart_open_revisions")])
def test_second_run_in_slices_equals_one_computation(spark, rows, monkeypatch, after, once):
    first = QUERIES[once](plant(spark))
    want = rows(first, *sorted(first.columns))
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(slices, "MOST_SLICES", 2)
    assert want and rows(QUERIES[after](plant(spark)), *sorted(first.columns)) == want
