import random

from pyspark.sql import functions as F

from partledger.operators import skew


def lines(spark, n=600, seed=7):
    """One key holds a third of the rows; times repeat, so ranks tie across ranges."""
    pick = random.Random(seed)
    data = [("hot" if i % 3 == 0 else f"k{pick.randrange(40)}", pick.randrange(25), i,
             None if pick.random() < 0.4 else f"v{i}") for i in range(n)]
    data += [(None, 1, n + i, "x") for i in range(30)]
    return spark.createDataFrame(data, "k string, t int, id int, v string")


def test_no_key_above_the_limit(spark):
    assert skew.find(lines(spark), ["k"]) is None


def test_hot_null_keys_are_spread_and_match_nothing(spark, rows):
    left = spark.range(90).select(F.when(F.col("id") < 10, F.lit("a")).alias("k"), "id")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, w int")
    hot = skew.find(left, ["k"], group_rows=30)
    assert [(r.k, r["_rows"]) for r in hot.rows.collect()] == [(None, 80)]
    for how in ("left", "inner", "left_anti", "left_semi"):
        assert rows(skew.join(left, right, ["k"], how, hot)) == rows(left.join(right, "k", how))


def test_hot_keys_are_found(spark):
    hot = skew.find(lines(spark), ["k"], group_rows=50)
    assert [(r.k, r["_rows"]) for r in hot.rows.collect()] == [("hot", 200)]


def test_salted_join_equals_plain_join(spark, rows):
    left = lines(spark)
    right = spark.createDataFrame([("hot", f"a{i}") for i in range(3)] + [("k1", "b"), ("k2", "c")], "k string, w string")
    hot = skew.find(left, ["k"], group_rows=25)
    for how in ("left", "inner"):
        assert rows(skew.join(left, right, ["k"], how, hot)) == rows(left.join(right, "k", how))


def test_salt_on_part_of_the_join_keys(spark, rows):
    left = lines(spark)
    right = left.groupBy("k", "t").agg(F.min("id").alias("low"))
    hot = skew.find(left, ["k"], group_rows=25)
    assert rows(skew.join(left, right, ["k", "t"], hot=hot)) == rows(left.join(right, ["k", "t"], "left"))


def test_ordered_windows_over_hot_keys_equal_plain_windows(spark, rows):
    wanted = dict(lead={"next_v": "v", "next_t": "t"}, lag={"prev_v": "v"}, carry={"known": "v"}, rank=("place", ["t"]))
    for seed in (1, 2, 3):
        df = lines(spark, seed=seed)
        plain = skew.ordered(df, ["k"], ["t", "id"], **wanted)
        for limit in (40, 90):
            hot = skew.find(df, ["k"], group_rows=limit)
            assert hot is not None
            cut = skew.ordered(df, ["k"], ["t", "id"], **wanted, hot=hot)
            assert cut.columns == plain.columns
            assert rows(cut) == rows(plain)


def test_rank_of_one_long_run_of_ties(spark, rows):
    df = spark.range(300).select(F.lit("a").alias("k"), F.when(F.col("id") < 20, 0).otherwise(1).alias("t"), "id")
    hot = skew.find(df, ["k"], group_rows=30)
    got = skew.ordered(df, ["k"], ["t", "id"], rank=("place", ["t"]), hot=hot)
    assert rows(got.groupBy("t", "place").count()) == [("0", "1", "20"), ("1", "21", "280")]
