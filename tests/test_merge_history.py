import os
import random
import subprocess
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from partledger import sinks

from partledger.operators import history, merge, skew
from partledger.operators.dedup import duplicate_keys
from partledger.schemas import TableSpec
from partledger.session import shared_dir
from partledger.sinks import Lake, cached, clustered, compact, upsert_partitions, write_partitioned

COST = "part_id string, supplier_name string, cost int"


def test_next_day_prices(spark, rows):
    day1 = spark.createDataFrame([("P1001", "Tata", 1500), ("P1002", "Bosch", 800)], COST)
    day2 = spark.createDataFrame([("P1001", "Tata", 1550), ("P1006", "New", 900)], COST)
    once = merge.upsert(day1, day2, ["part_id", "supplier_name"])
    assert rows(once) == [("P1001", "Tata", "1550"), ("P1002", "Bosch", "800"), ("P1006", "New", "900")]
    assert rows(merge.upsert(once, day2, ["part_id", "supplier_name"])) == rows(once)


def test_null_keys_match(spark, rows):
    target = spark.createDataFrame([("P1", None, 1)], COST)
    source = spark.createDataFrame([("P1", None, 2)], COST)
    assert rows(merge.upsert(target, source, ["part_id", "supplier_name"])) == [("P1", "None", "2")]


def test_columns_may_come_and_go(spark, rows):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep2")], "k int, v string, old string")
    source = spark.createDataFrame([(1, "A", "n1"), (3, "C", "n3")], "k int, v string, new string")
    got = merge.upsert(target, source, ["k"])
    assert rows(got, "k", "v", "old", "new") == [
        ("1", "A", "keep", "n1"), ("2", "b", "keep2", "None"), ("3", "C", "None", "n3")]


def test_change_feed(spark, rows):
    state = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, lsn long")
    feed = spark.createDataFrame([(1, "x", 3, "update"), (1, None, 5, "delete"), (2, "B", 4, "update"),
                                  (3, "c", 6, "insert"), (2, "stale", 1, "update")], "k int, v string, lsn long, op string")
    got = merge.apply_change_feed(state, feed, ["k"], "lsn", "op", after=2)
    assert rows(got, "k", "v", "lsn") == [("2", "B", "4"), ("3", "c", "6")]
    assert rows(merge.apply_change_feed(got, feed, ["k"], "lsn", "op", after=2), "k", "v", "lsn") == rows(got, "k", "v", "lsn")


def test_rows_move_between_partitions(spark, rows):
    path = shared_dir(spark, "test")
    old = spark.createDataFrame([(1, "Draft"), (2, "Released"), (3, "Released"), (4, None)], "k int, status string")
    write_partitioned(old, path, ["status"])
    new = spark.createDataFrame([(1, "Released"), (5, "Approved"), (4, "Released")], "k int, status string")
    for _ in range(2):
        upsert_partitions(spark, path, new, ["k"], ["status"])
        assert rows(spark.read.parquet(path)) == [
            ("1", "Released"), ("2", "Released"), ("3", "Released"), ("4", "Released"), ("5", "Approved")]


def test_tables_are_swapped_whole(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "lake"))
    spec = TableSpec("lab", "prices", ("part_id", "supplier_name"))
    first = spark.createDataFrame([("P1", "a", 1)], COST)
    assert lake.upsert(first, spec, ctx) == {"rows_written": 1}
    later = type(ctx)("t2", ctx.run_ts)
    assert lake.upsert(spark.createDataFrame([("P1", "a", 2), ("P2", None, 3)], COST), spec, later) == {"rows_written": 2}
    assert rows(lake.read("lab.prices")) == [("P1", "a", "2"), ("P2", "None", "3")]
    twice = spark.createDataFrame([("P1", "a", 2), ("P1", "a", 3)], COST)
    with pytest.raises(ValueError):
        lake.upsert(twice, spec, type(ctx)("t3", ctx.run_ts))
    assert lake.read("lab.prices").count() == 2
    assert duplicate_keys(twice, ["part_id", "supplier_name"]).first().copies == 2


def test_older_rows_do_not_replace_newer_ones(spark, rows):
    schema = "k int, v string, t int"
    target = spark.createDataFrame([(1, "new", 5), (2, "old", 1), (3, "x", None)], schema)
    source = spark.createDataFrame([(1, "late", 4), (2, "newer", 2), (3, "y", 1), (4, "z", None)], schema)
    assert rows(merge.upsert(target, source, ["k"], "t"), "k", "v") == [("1", "new"), ("2", "newer"), ("3", "y"), ("4", "z")]


IN_A_NEW_PROCESS = """
import sys
from datetime import datetime
from partledger.context import RunContext
from partledger.schemas import TableSpec
from partledger.session import build_session
from partledger.sinks import Lake
spark = build_session("second", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
lake = Lake(spark, sys.argv[1])
lake.upsert(spark.createDataFrame([("D", "s", 4)], "part_id string, supplier_name string, cost int"),
            TableSpec("shop", "prices", ("part_id", "supplier_name")), RunContext("t9", datetime(2026, 4, 2)))
lake.open()
print("ROWS", spark.table("shop.prices").count())
"""


def test_tables_outlive_the_process(spark, ctx, rows, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    spec = TableSpec("shop", "prices", ("part_id", "supplier_name"))
    lake.upsert(spark.createDataFrame([(k, "s", 1) for k in "ABC"], COST), spec, ctx)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", IN_A_NEW_PROCESS, lake.root], capture_output=True, text=True, timeout=300,
                         cwd=root, env=os.environ | {"PYTHONPATH": root})
    assert "ROWS 4" in out.stdout, out.stderr[-2000:]
    assert rows(lake.read("shop.prices"), "part_id") == [("A",), ("B",), ("C",), ("D",)]


def test_a_run_id_may_be_repeated_on_a_large_table(spark, ctx):
    lake = Lake(spark, shared_dir(spark, "lake"))
    spec = TableSpec("large", "t", ("id",))
    lake.upsert(spark.range(1_000_000).withColumn("v", F.lit(1)), spec, ctx)
    for _ in range(2):
        lake.upsert(spark.range(900_000, 1_100_000).withColumn("v", F.lit(2)), spec, ctx)
    got = lake.read("large.t").agg(F.count(F.lit(1)), F.count_distinct("id"), F.sum("v")).first()
    assert tuple(got) == (1_100_000, 1_100_000, 1_300_000)


def test_nothing_arriving_writes_nothing(spark, ctx):
    lake = Lake(spark, shared_dir(spark, "lake"))
    spec = TableSpec("still", "t", ("id",))
    lake.upsert(spark.range(3), spec, ctx)
    before = lake.state("still.t")
    lake.upsert(spark.range(0), spec, type(ctx)("t2", ctx.run_ts))
    assert lake.state("still.t") == before


def test_partition_upsert_reads_only_its_partitions(spark):
    path = shared_dir(spark, "test")
    write_partitioned(spark.range(9).select("id", (F.col("id") % 3).cast("string").alias("part")), path, ["part"])
    target = spark.read.parquet(path)
    plan = target.where(sinks._in_places(target, [Row(part="1"), Row(part=None)], ["part"]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_repeated_appends_add_nothing(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "lake"))
    df = spark.createDataFrame([(1,), (1,)], "v int")
    lake.append(df, "lab2.log", ctx)
    lake.append(df, "lab2.log", ctx)
    lake.append(df, "lab2.log", type(ctx)("t2", ctx.run_ts))
    assert rows(lake.read("lab2.log")) == [("1", "t1"), ("1", "t1"), ("1", "t2"), ("1", "t2")]


def test_clustering_keeps_rows_and_narrows_files(spark, rows):
    df = spark.range(4000).select((F.col("id") % 64).alias("a"), (F.col("id") % 61).alias("b"), "id").repartition(4)
    path = shared_dir(spark, "z")
    compact(df, path, ["a", "b"], files=16, numeric=True)
    got = spark.read.parquet(path)
    assert rows(got) == rows(df)
    per_file = got.groupBy("_metadata.file_path").agg(F.count_distinct("a").alias("x"), F.count_distinct("b").alias("y"))
    spans = per_file.agg(F.avg("x"), F.avg("y")).first()
    assert spans[0] < 40 and spans[1] < 40
    assert rows(clustered(df, ["a"], 4)) == rows(df)


def test_cached_frames_are_released(spark):
    df = spark.range(5)
    with cached(df):
        assert df.is_cached
    assert not df.is_cached


# History

def versions(spark, seed, n=200):
    pick = random.Random(seed)
    day = datetime(2026, 1, 1)
    data = [("hot" if pick.random() < 0.4 else f"p{pick.randrange(8)}", f"r{i:03}", pick.choice(["Draft", "Released"]),
             day + timedelta(days=pick.randrange(60))) for i in range(n)]
    return spark.createDataFrame(data, "part_id string, revision string, status string, effective_from timestamp")


def brute_chain(data, tracked):
    out = []
    for key in {r.part_id for r in data}:
        last, kept = None, []
        for r in sorted((r for r in data if r.part_id == key), key=lambda r: (r.effective_from, r.revision)):
            state = tuple(r[c] for c in tracked)
            if state != last:
                kept.append((key, *state, r.effective_from))
            last = state
        for i, k in enumerate(kept):
            end = kept[i + 1][-1] if i + 1 < len(kept) else None
            out.append((*k, end, end is None))
    return sorted(tuple(str(v) for v in r) for r in out)


@pytest.mark.parametrize("tracked", [["status"], ["revision", "status"]])
def test_version_chain(spark, rows, tracked):
    df = versions(spark, 1)
    want = brute_chain(df.collect(), tracked)
    args = ("part_id", "effective_from", tracked, ["revision"])
    assert rows(history.version_chain(df, *args)) == want
    hot = skew.find(df, ["part_id"], group_rows=30)
    assert hot is not None
    assert rows(history.version_chain(df, *args, hot=hot)) == want
    chain = history.version_chain(df, *args)
    assert chain.where("is_current").groupBy("part_id").count().where("count <> 1").isEmpty()


def test_as_of_against_brute_force(spark, rows):
    df = versions(spark, 2)
    chain = history.version_chain(df, "part_id", "effective_from", ["revision", "status"], ["revision"])
    pick = random.Random(3)
    facts = spark.createDataFrame(
        [(f"f{i}", pick.choice(["hot", "p1", "p2", "nobody"]), datetime(2025, 12, 25) + timedelta(days=pick.randrange(80)))
         for i in range(150)] + [("f-null", "hot", None)], "id string, part_id string, at timestamp")
    intervals = chain.collect()
    want = []
    for f in facts.collect():
        found = [v for v in intervals if f.at and v.part_id == f.part_id and v.valid_from <= f.at
                 and (v.valid_to is None or f.at < v.valid_to)]
        assert len(found) <= 1
        want.append((f.id, found[0].revision if found else "None"))
    for hot in (None, skew.find(facts, ["part_id"], group_rows=20)):
        got = history.as_of(facts, chain, "part_id", "at", "valid_from", ["revision"], end="valid_to", tie=["revision"], hot=hot)
        assert rows(got, "id", "revision") == sorted(want)


def test_changes_rebuild_only_their_keys(spark, rows):
    df = versions(spark, 4)
    early, late = df.where("revision < 'r120'"), df.where("revision >= 'r120'")
    tracked = ["revision", "status"]
    dim = history.version_chain(early, "part_id", "effective_from", tracked, ["revision"])
    points, changes = (x.withColumnRenamed("effective_from", "valid_from") for x in (early, late))
    got, points = history.apply_changes(dim, points, changes, "part_id", tracked)
    assert rows(got) == rows(history.version_chain(df, "part_id", "effective_from", tracked, ["revision"]))
    again, same = history.apply_changes(got, points, changes, "part_id", tracked)
    assert rows(again) == rows(got) and rows(same) == rows(points)


def test_late_version_between_equal_states(spark, rows):
    schema = "k string, state string, valid_from int"
    points = spark.createDataFrame([("x", "A", 1), ("x", "A", 5)], schema)
    late = spark.createDataFrame([("x", "B", 3)], schema)
    dim = history.version_chain(points.withColumnRenamed("valid_from", "start"), "k", "start", ["state"])
    assert rows(dim, "state", "valid_from") == [("A", "1")]
    got, _ = history.apply_changes(dim, points, late, "k", ["state"])
    assert rows(got, "state", "valid_from", "valid_to", "is_current") == [
        ("A", "1", "3", "False"), ("A", "5", "None", "True"), ("B", "3", "5", "False")]


def test_active_on_is_half_open(spark, rows):
    df = spark.createDataFrame([("a", "2026-01-01", "2026-02-01"), ("b", "2026-02-01", None)], "v string, f string, t string")
    df = df.select("v", F.to_date("f").alias("f"), F.to_date("t").alias("t"))
    assert rows(history.active_on(df, F.lit("2026-02-01").cast("date"), "f", "t"), "v") == [("b",)]
