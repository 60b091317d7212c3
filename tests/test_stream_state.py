from datetime import datetime

import pytest

from partledger.context import RunContext
from partledger.operators.merge import apply_change_feed
from partledger.schemas import TableSpec
from partledger.session import shared_dir
from partledger.sinks import Lake
from partledger.streaming import jobs, state

FEED = "k string, v string, lsn long, op string"
CTX = RunContext("r", datetime(2026, 1, 1))
SPEC = TableSpec("fed", "rows", ("k",), buckets=4)
LOADS = [
    [("a", "1", 10, "insert"), ("b", "1", 11, "insert"), ("a", "2", 14, "update"), (None, "1", 12, "insert")],
    [("a", "old", 9, "update"), ("a", "1", 10, "insert"), ("b", None, 15, "delete"), ("c", None, 16, "delete"), ("d", "x", None, "insert")],
    [("b", "late", 13, "update"), ("c", "late", 2, "insert"), ("b", None, 15, "delete"), ("e", "", 17, "insert"), ("e", "", 17, "insert")],
    [],
    [("b", "back", 20, "insert"), (None, None, 21, "delete"), ("e", None, 18, None)],
]


@pytest.fixture
def lake(spark):
    return Lake(spark, shared_dir(spark, "lake"))


@pytest.fixture
def load(spark, lake):
    arrivals, checkpoint = shared_dir(spark, "feed"), shared_dir(spark, "checkpoint")

    def run(data, **more):
        spark.createDataFrame(data, FEED).write.mode("append").parquet(arrivals)
        state.apply_changes(jobs.parquet_arrivals(spark, arrivals, FEED), lake, SPEC, CTX, checkpoint, "lsn", "op", **more)

    return run


def test_late_and_repeated_changes_give_the_batch_result(spark, rows, lake, load, monkeypatch):
    seen, passed, apply = [], [], Lake.apply
    monkeypatch.setattr(Lake, "apply", lambda self, batch, *a: (passed.append(batch.count()), apply(self, batch, *a)))
    nothing = spark.createDataFrame([], "k string, v string, lsn long")
    for data in LOADS:
        load(data)
        seen += [r for r in data if r[2] is not None]
        want = apply_change_feed(nothing, spark.createDataFrame(seen, FEED), ["k"], "lsn", "op")
        assert rows(lake.read(SPEC.id), "k", "v", "lsn") == rows(want, "k", "v", "lsn")
    # What was old, came twice or deleted nothing did not reach the table.
    assert [n for n in passed if n] == [3, 1, 1, 3]


def test_a_load_writes_only_the_buckets_it_hits(rows, lake, load):
    load([(f"k{i}", "1", i, "insert") for i in range(40)])
    then = lake.places(SPEC.id)
    load([("k3", "2", 100, "update"), ("k4", "0", 1, "update")])
    now = lake.places(SPEC.id)
    assert set(now) == set(then) and sum(now[b] != then[b] for b in now) == 1
    assert lake.read(SPEC.id).count() == 40
    assert rows(lake.read(SPEC.id).where("k in ('k3', 'k4')"), "v") == [("1",), ("2",)]


def test_tombstones_expire(lake, load):
    """A deletion is forgotten after its time, so the state does not grow with the keys that ever were."""
    forget = {"tombstone_days": 1e-8}
    load([("a", "1", 5, "insert")], **forget)
    load([("a", None, 6, "delete")], **forget)
    assert lake.read(SPEC.id).isEmpty()
    load([("a", "late", 4, "update")], **forget)
    assert lake.read(SPEC.id).count() == 1


def test_a_table_without_buckets_is_refused(spark, lake):
    with pytest.raises(ValueError):
        state.apply_changes(spark.createDataFrame([], FEED), lake, TableSpec("fed", "plain", ("k",)), CTX, "", "lsn", "op")
