import random

from pyspark.sql import functions as F

from partledger.operators import history, sketches
from partledger.operators.skew import find

LEFT = "part string, rev string, start int, stop int"
RIGHT = "part string, cost int, start int, stop int"


def in_force(versions, part, at):
    """The version that began last, if it has not ended."""
    begun = [v for v in versions if v[0] == part and v[2] is not None and v[2] <= at]
    if not begun:
        return None
    start = max(v[2] for v in begun)
    last = max((v for v in begun if v[2] == start), key=lambda v: v[1])
    return last[1] if last[3] is None or at < last[3] else None


def spans(left, right, horizon):
    """Day by day: (part, from, to, revision, cost) with both in force; to is null beyond the horizon."""
    out = []
    for part in sorted({v[0] for v in left}, key=str):
        now = None
        for at in range(horizon + 1):
            both = (in_force(left, part, at), in_force(right, part, at))
            both = both if None not in both else None
            if now and both != now[1]:
                out.append((part, now[0], at, *now[1]))
                now = None
            if both and now is None:
                now = (at, both)
        if now:
            out.append((part, now[0], None, *now[1]))
    return sorted(tuple(str(x) for x in r) for r in out)


def histories(seed):
    pick = random.Random(seed)
    side = lambda names: [(p, pick.choice(names), pick.randrange(30), pick.choice([None, pick.randrange(35)]))
                          for p in ("P", "Q", "R") for _ in range(pick.randrange(1, 12))]
    return side(["A", "B", "C"]), side([1, 2, 3])


def found(spark, left, right, hot=None):
    return history.overlaps(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["part"], ("start", "stop"),
                            ("start", "stop"), ["rev"], ["cost"], ["rev"], ["cost"], hot)


def test_overlaps_against_every_day(spark, rows):
    for seed in range(6):
        left, right = histories(seed)
        left += [("P", "Z", None, 9), ("Q", "Z", 5, 5), ("Q", "Z", 7, 3)]
        assert rows(found(spark, left, right), "part", "valid_from", "valid_to", "rev", "cost") == spans(left, right, 40)


def test_overlaps_of_hot_keys(spark, rows):
    left = [("P", f"{i % 3}", i, i + 2 if i % 5 else None) for i in range(60)]
    right = [("P", i % 2, i * 2, None) for i in range(40)]
    hot = find(spark.createDataFrame(left, LEFT), ["part"], 10)
    assert hot and rows(found(spark, left, right, hot)) == rows(found(spark, left, right))


def test_no_versions_no_spans(spark):
    left, right = histories(1)
    assert found(spark, [], right).isEmpty() and found(spark, left, []).isEmpty()


def test_states_merge_to_those_of_all_rows(spark):
    df = spark.range(30_000).select(F.col("id").alias("n"), (F.col("id") % 700).cast("string").alias("s"),
                                    F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.col("id"))).alias("t"))
    parts = [sketches.summarise("x", df.where(F.col("n") % 3 == i), f"r{i}") for i in range(3)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = {r.column_name: r for r in sketches.merge(states).withColumn("d", sketches.distinct_values(F.col("distinct_state"))).withColumn(
        "median", F.kll_sketch_get_quantile_double("rank_state", F.lit(0.5))).collect()}
    for name, want in {"n": 30_000, "s": 700, "t": 27_000}.items():
        assert abs(merged[name].d - want) <= want * sketches.HLL_ERROR and merged[name].row_count == 30_000
    assert merged["t"].nulls == 3000 and merged["s"].nulls == 0
    assert abs(merged["n"].median - 15_000) <= 30_000 * sketches.KLL_ERROR and merged["s"].median is None
    one = sketches.summarise("x", df, "all").where("column_name = 't'").first()
    assert (one.low, one.high) == ("1970-01-01 00:00:01", "1970-01-01 08:19:59")


def test_shift_between_runs(spark):
    a = spark.range(10_000).select((F.col("id") % 1000).alias("same"), F.col("id").alias("moved"), F.lit(None).cast("int").alias("none"))
    b = a.select("same", (F.col("moved") + 2500).alias("moved"), "none")
    states = sketches.summarise("x", a, "r1").unionByName(sketches.summarise("x", b, "r2"))
    got = {r.column_name: r.distance for r in sketches.shift(states, "r1", "r2").collect()}
    assert set(got) == {"same", "moved"} and got["same"] <= 2 * sketches.KLL_ERROR + 0.01 and abs(got["moved"] - 0.25) <= 0.07
