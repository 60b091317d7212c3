from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from partledger.operators import policy, rights
from partledger.plans import serving
from partledger.session import shared_dir
from partledger.sources import drift

KNOWN = "part_id string, cost decimal(18,4), currency string"


@pytest.fixture
def guard(spark):
    """A view of a small mart, whose readers' groups can be changed."""
    spark.createDataFrame([("a1", "p1", 3), (None, "p2", 4)], "assembly_id string, part_id string, `unit cost` int").createOrReplaceTempView("small_mart")
    rights.standard_rights(spark, "small_mart", {"unit cost": policy.COST_READERS}).createOrReplaceTempView("granted")

    def members(*rows):
        spark.createDataFrame(list(rows), rights.MEMBERSHIPS).createOrReplaceTempView("members")

    def read(reader="current_user()"):
        rights.guarded_view(spark, "guarded", "small_mart", "assembly_id", ("unit cost",), "members", "granted", reader)
        return sorted(map(tuple, spark.table("guarded").collect()), key=str)

    members()
    return members, read


def test_readers_see_what_their_groups_may(guard):
    members, read = guard
    everything, keyed, hidden = [("a1", "p1", 3), (None, "p2", 4)], [("a1", "p1", 3)], [("a1", "p1", None)]
    members(("ines", "buyers"), ("buyers", "procurement_team"), ("procurement_team", "buyers"), ("otto", "management"),
            ("tom", "plm_engineers"), ("ann", "plm_engineers"), ("ann", "management"), (None, "management"), ("eve", None), ("eve", "eve"))
    assert read("'ines'") == keyed and read("'otto'") == everything and read("'ann'") == everything
    assert read("'tom'") == hidden
    assert read("'eve'") == read("'nobody'") == read("cast(null as string)") == []


def test_a_membership_counts_from_the_next_read(spark, guard, tmp_path):
    members, read = guard
    me = spark.sql("SELECT current_user()").first()[0]
    path = str(tmp_path / "members")
    spark.createDataFrame([], rights.MEMBERSHIPS).write.parquet(path)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW members AS SELECT * FROM parquet.`{path}`")
    assert read() == []
    spark.createDataFrame([(me, "plm_engineers")], rights.MEMBERSHIPS).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.table("guarded").collect()), key=str) == [("a1", "p1", None)]  # the same view


def test_the_table_is_scanned_once_without_a_join(spark, guard):
    members, read = guard
    read()
    above = spark.table("guarded")._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    assert "Join" not in above


def test_unknown_columns_are_kept_reported_and_promoted(spark):
    came = spark.createDataFrame(
        [("p1", "12", "x", 1, None), ("p2", "oops", None, 2, 2.5), ("p3", None, 'z"', 3, None)],
        "Part_ID string, cost string, terms string, `min order` int, `it's` double")
    path = shared_dir(spark, "landed")
    drift.fit(came, KNOWN).write.parquet(path)
    landed = spark.read.parquet(path)
    assert [(r.part_id, r.cost, r.currency) for r in landed.orderBy("part_id").collect()] == [
        ("p1", Decimal("12.0000"), None), ("p2", None, None), ("p3", None, None)]
    found = {r.column_name: (r.row_count, r.null_count, r.column_type) for r in drift.unknown_columns(landed).collect()}
    assert found == {"cost": (1, 0, "STRING"), "terms": (3, 1, "STRING"), "min order": (3, 0, "BIGINT"), "it's": (3, 2, "DOUBLE")}
    rows = drift.promote(drift.promote(drift.promote(landed, "min order", "int"), "it's", "double"), "terms", "string")
    assert [(r["min order"], r["it's"], r["terms"]) for r in rows.orderBy("part_id").collect()] == [
        (1, None, "x"), (2, 2.5, None), (3, None, 'z"')]
    wrong = drift.promote(landed, "terms", "date")
    assert [r.terms for r in wrong.collect()] == [None] * 3
    with pytest.raises(ValueError):
        drift.promote(landed, "a\"'b", "int")


@pytest.mark.parametrize("columns", ["part_id string, cost decimal(18,4), currency string", "part_id string", "other int"])
def test_rows_fit_whatever_columns_they_have(spark, columns):
    none = drift.fit(spark.createDataFrame([], columns), KNOWN)
    assert none.columns == ["part_id", "cost", "currency", "_unknown"] and none.count() == 0
    some = drift.fit(spark.createDataFrame([(None,) * len(none.sparkSession.createDataFrame([], columns).columns)], columns), KNOWN)
    assert some.select("part_id", "cost", "currency").first() == (None, None, None)
    assert {r.column_name for r in drift.unknown_columns(some).collect()} == ({"other"} if "other" in columns else set())


def test_lookup_from_sql(spark, ctx):
    parts = spark.createDataFrame([("p1", "B", "Released", "EUR"), ("p2", "A", "Draft", None)],
                                  "part_id string, current_revision string, current_status string, currency string")
    cost = spark.createDataFrame([("p1", s, Decimal(c), "EUR", datetime(2026, 1, 1)) for s, c in (("S", "2"), ("T", "1"), ("U", "1"))],
                                 "part_id string, supplier_name string, cost decimal(18,4), currency string, last_updated timestamp")
    serving.api_part_cost_lookup(parts, cost, ctx, page_rows=2).createOrReplaceTempView("answers")
    serving.register_lookup(spark, "answers", "lookup_part")
    one = spark.sql("SELECT * FROM lookup_part('p1')").collect()
    assert [(r.cheapest_supplier, r.supplier_pages) for r in one] == [("T", 2)]
    pages = spark.sql("SELECT size(a.all_suppliers) AS n FROM VALUES (0), (1), (2) AS p(page), LATERAL lookup_part('p1', p.page) a").collect()
    assert sum(r.n for r in pages) == 3
    asked = spark.sql("SELECT v.part, a.current_revision FROM VALUES ('p1'), ('p2'), ('p9'), (NULL) AS v(part), LATERAL lookup_part(v.part) a")
    assert sorted(map(tuple, asked.collect())) == [("p1", "B"), ("p2", "A")]
    # A constant part is a filter on the table.
    assert spark.sql("SELECT * FROM lookup_part('p9')").where(F.lit(True)).isEmpty()
