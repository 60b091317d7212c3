import os
import random
from dataclasses import replace

from pyspark.sql import functions as F

from partledger.context import RunContext
from partledger.operators.maintain import Totals
from partledger.operators.merge import upsert
from partledger.plans.run import Run
from partledger.schemas import TableSpec
from partledger.session import shared_dir
from partledger.sinks import Lake, by_bucket, moved

SPEC = TableSpec("plant", "offers", ("part", "supplier"), buckets=64)
COLUMNS = "part string, supplier string, cost decimal(18,4), day int"
TOTALS = Totals(["supplier"], sums={"n": "1", "total": "coalesce(cost, 0)"}, lows={"low": "cost"}, highs={"high": "cost", "last": "day"})


def offers(spark, seed, parts, day):
    pick = random.Random(seed)
    rows = [(p, s, None if pick.random() < 0.1 else str(pick.randrange(1, 50)), day) for p in parts for s in ("A", "B", None) if pick.random() < 0.8]
    return spark.createDataFrame(rows, "part string, supplier string, cost string, day int").withColumn("cost", F.col("cost").cast("decimal(18,4)"))


def files(lake, table):
    """Modification time and size of every file a table's pointer names."""
    out = {}
    for b, path in lake.places(table).items():
        folder = f"{path}/_bucket={b}"
        out[b] = {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")}
    return out


def test_a_few_keys_rewrite_their_buckets_only(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "buckets"))
    first = offers(spark, 1, [f"P{i}" for i in range(300)], 1)
    lake.upsert(first, SPEC, ctx, "day")
    before, was = files(lake, SPEC.id), lake.places(SPEC.id)
    second = offers(spark, 2, ["P7", "P8", " p7 ", "NEW"], 2)
    lake.upsert(second, SPEC, ctx, "day")
    assert rows(lake.read(SPEC.id)) == rows(upsert(first, second, SPEC.keys, "day"))
    hit, after = moved(lake.places(SPEC.id), was), files(lake, SPEC.id)
    assert 0 < len(hit) <= second.count()
    assert {b: f for b, f in after.items() if b not in hit} == {b: f for b, f in before.items() if b not in hit}
    # Spellings of one key lie in one bucket; the view reads what the table reads.
    assert rows(spark.table("plant.offers"), *first.columns) == rows(lake.read(SPEC.id))
    changed = lake.changes(SPEC.id, was, first.columns)
    want = second.join(first, [second[c].eqNullSafe(first[c]) for c in first.columns], "left_anti").select("*", F.lit(1).alias("_n"))
    assert rows(changed.where("_n > 0")) == rows(want)


def test_new_columns_late_and_empty_arrivals(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "buckets"))
    lake.upsert(offers(spark, 1, ["P1", "P2", "P3"], 5), SPEC, ctx, "day")
    one = rows(lake.read(SPEC.id))
    lake.upsert(offers(spark, 3, ["P1", "P2"], 4), SPEC, ctx, "day")
    older = {tuple(r[:2]) for r in one}
    assert [r for r in rows(lake.read(SPEC.id)) if tuple(r[:2]) in older] == one
    was = lake.state(SPEC.id)
    assert lake.upsert(offers(spark, 3, [], 6), SPEC, ctx, "day") == {"rows_written": 0} and lake.state(SPEC.id) == was
    late = offers(spark, 4, ["P9"], 6).withColumn("site", F.lit("x"))
    lake.upsert(late, SPEC, ctx, "day")
    assert lake.read(SPEC.id).where("part = 'P9'").select("site").distinct().collect() == [("x",)]
    assert lake.read(SPEC.id).where("part <> 'P9' AND site IS NOT NULL").isEmpty()


def test_totals_from_changes_equal_a_recompute(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "totals"))
    spec, kept, then = replace(SPEC, buckets=8), None, None
    for wave, parts in enumerate([range(60), range(50, 70), [3], [], range(10)]):
        arriving = offers(spark, wave, [f"P{i}" for i in parts], wave)
        lake.upsert(arriving, spec, ctx, "day")
        now = lake.read(SPEC.id)
        if kept is None:
            after = TOTALS.compute(now)
        else:
            after = TOTALS.refresh(kept, lake.changes(SPEC.id, then, now.columns), now)
        path = shared_dir(spark, "kept")
        after.write.parquet(path)
        kept, then = spark.read.schema(after.schema).parquet(path), lake.places(SPEC.id)
        assert rows(kept) == rows(TOTALS.compute(now))


def test_groups_vanish_and_lost_extremes_are_read_again(spark, rows):
    schema = "supplier string, cost decimal(18,4), day int"
    now = [("A", 2, 1), ("A", 9, 1), (None, 5, 2)]
    make = lambda data, s=schema: spark.createDataFrame([(r[0], *r[1:]) for r in data], s.replace("decimal(18,4)", "int")).withColumn(
        "cost", F.col("cost").cast("decimal(18,4)"))
    kept = TOTALS.compute(make([("A", 1, 1), ("A", 9, 1), ("B", 4, 3), (None, 7, 2)]))
    changes = make([("A", 1, 1, -1), ("A", 2, 1, 1), ("B", 4, 3, -1), (None, 7, 2, -1), (None, 5, 2, 1)], schema + ", _n int")
    assert rows(TOTALS.refresh(kept, changes, make(now))) == rows(TOTALS.compute(make(now)))
    # A lost its least, the unnamed one its greatest; a value as good as the lost one leaves the group alone.
    assert rows(TOTALS.stale(kept, changes)) == [("A",), ("None",)]
    swapped = make([("A", 1, 1, -1), ("A", 1, 2, 1)], schema + ", _n int")
    assert TOTALS.stale(kept, swapped).isEmpty()


def test_run_ids_stay_text_and_runs_are_read_alone(spark, ctx, rows):
    lake = Lake(spark, shared_dir(spark, "runs"))
    for run_id in ("007", "008", "a+b c"):
        lake.append(spark.createDataFrame([(run_id,)], "v string"), "logs.seen", RunContext(run_id, ctx.run_ts))
    lake.append(spark.createDataFrame([("later", 1)], "v string, extra int"), "logs.seen", RunContext("007", ctx.run_ts), "2026-01-01")
    assert rows(lake.read("logs.seen"), "run", "v") == [("007", "007"), ("007", "later"), ("008", "008"), ("a+b c", "a+b c")]
    assert rows(lake.read_run("logs.seen", "007"), "run", "v", "extra") == [("007", "007", "None"), ("007", "later", "1")]
    assert all("/run=007" in f for f in lake.read_run("logs.seen", "007").inputFiles())
    assert lake.read_run("logs.seen", "00").isEmpty()


def test_hot_keys_are_known_to_any_layer(spark, ctx):
    from partledger.operators.skew import EVEN
    assert Run(spark, Lake(spark, shared_dir(spark, "none")), ctx).hot is EVEN
    assert by_bucket({"a": [1, 2]}) == {1: "a", 2: "a"}
