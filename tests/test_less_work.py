"""Work that is done once: key counts, judging, merging by key, reading of sources."""

from datetime import datetime
from itertools import product

import pytest

from partledger.context import RunContext
from partledger.operators import merge, skew
from partledger.plans import governance, silver
from partledger.plans.run import Run
from partledger.queries import QUERIES, Plant
from partledger.session import shared_dir
from partledger.sinks import Lake

FOLDER = "/root/testdata/sf0.001"


def leaves(df, name="Relation ["):
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def test_keys_are_counted_only_in_bands_above_the_limit(spark, monkeypatch):
    df = spark.createDataFrame([(f"k{i % 50}", None) for i in range(200)], "a string, b string")
    found = skew.find_each(df, ["a", "b"], 100)
    assert found["a"] is None and [tuple(r) for r in found["b"].rows.collect()] == [(None, 200)]
    monkeypatch.setattr(skew, "shared_dir", lambda *a: pytest.fail("a table of key counts was written"))
    assert skew.find(df, ["a"], 100) is None and skew.find_each(df, ["a"], 4) == {"a": None}


def test_keys_of_one_band_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(skew, "BANDS", 1)
    df = spark.createDataFrame([("x",)] * 9 + [("y",)] * 5 + [(None,)] * 8, "a string")
    assert sorted((str(k), n) for k, n in skew.find(df, ["a"], 7).rows.collect()) == [("None", 8), ("x", 9)]


def test_merge_in_one_equals_upsert(spark, rows):
    # Every mix of up to two stored and two arriving rows of a key, days null, older, equal and newer; null keys too.
    days, target, source = [None, 1, 2, 3], [], []
    for n, (stored, came) in enumerate(product([(), *product(days), *product(days, days)], repeat=2)):
        key = None if n == 0 else f"k{n}"
        target += [(key, d, f"old{i}") for i, d in enumerate(stored)]
        source += [(key, d, f"new{i}", i) for i, d in enumerate(came)]
    target += [(None, 2, "old")]
    source += [(None, 3, "new", 0)]
    t = spark.createDataFrame(target, "k string, day int, v string")
    s = spark.createDataFrame(source, "k string, day int, v string, more int")
    want, found = merge.upsert(t, s, ["k"], "day"), merge.upsert_in_one(t, s, ["k"], "day")
    assert found.columns == want.columns and rows(found) == rows(want)


def test_arriving_rows_are_judged_once_and_not_checked_again(spark, rows, monkeypatch):
    lake = Lake(spark, shared_dir(spark, "plant"))
    raw = spark.createDataFrame(
        [("P1", "s1", "1.5", "eur", datetime(2001, 1, 1)), ("P1", "s1", "2.5", "eur", datetime(2001, 1, 2)),
         ("P2", "s1", "x", "eur", datetime(2001, 1, 1)), (None, "s2", "3", "inr", None), ("P3", None, "3", None, None)],
        "part_id string, supplier_name string, cost string, currency string, last_updated timestamp")
    want = silver.judge_arrivals("erp_cost", raw)
    checked = []
    monkeypatch.setattr("partledger.sinks.reject_duplicates", lambda *a: checked.append(a))
    for run_id in ("a", "b"):
        run = Run(spark, lake, RunContext(run_id, datetime(2002, 1, 1)))
        run.arrive("erp_cost", raw)
        assert run.arrived["erp_cost"] == (5, 2)
    assert not checked
    assert rows(lake.read("bronze.erp_cost"), *raw.columns) == [
        ("None", "s2", "3", "inr", "None"), ("P1", "s1", "2.5", "eur", "2001-01-02 00:00:00")]
    kept = lake.read_run("silver.erp_cost_quarantine", "b")
    assert rows(kept, *want.rejected.columns) == rows(want.rejected)


def test_rates_judge_each_table_once(spark, rows):
    p = Plant(spark, FOLDER)
    verdict = silver.judge_bom(p.raw("raw_bom"))
    once, twice = governance.judged_rate([("plm_bom", verdict.judged)]), governance.quarantine_rate([("plm_bom", verdict.clean, verdict.rejected)])
    assert rows(once) == rows(twice) and (leaves(once), leaves(twice)) == (1, 2)


def test_loads_derive_their_source_once(spark, monkeypatch):
    p = Plant(spark, FOLDER)
    read = []
    monkeypatch.setattr(Plant, "stored", lambda self, name, df, kept=Plant.stored: read.append(name) or kept(self, name, df))
    for name in ("profile_of_writes", "incremental_run"):
        QUERIES[name](p)
    assert read == ["raw_cost"]
