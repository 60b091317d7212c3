"""What queries move between tasks, read off their plans."""

import re

from partledger.plans import serving
from partledger.queries import QUERIES, Plant
from partledger.session import FIRST_PARTITIONS, PARTITION_BYTES, fit_partitions

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_spans_are_moved_by_part_alone(spark):
    keys = re.findall(r"hashpartitioning\(([^()]*)\)", plan(QUERIES["revision_price_spans"](Plant(spark, FOLDER))))
    assert keys and not [k for k in keys if "supplier_name" in k]


def test_revisions_are_not_moved_by_assembly(spark):
    text = plan(QUERIES["mart_assembly_cost"](Plant(spark, FOLDER)))
    joins = re.findall(r"Join \[assembly_id#\d+\].*", text)
    assert joins
    project = re.findall(r"Project \[assembly_id#\d+, part_id#\d+, quantity#\d+, total_parts_count#\d+L, .*", text)
    assert project and not any("effective_from" in line for line in project[-1:])


def test_lines_keep_the_totals_they_need(spark):
    lines = spark.createDataFrame([("A", "P1"), ("A", "P2"), ("A", "P3")], "assembly_id string, part_id string")
    cost = spark.createDataFrame([("P1", "USD"), ("P1", "EUR"), ("P2", "INR")], "part_id string, currency string")
    one = "struct<low decimal(38,4), mean decimal(38,4)>".replace("low ", "low:").replace("mean ", "mean:")
    rollup = spark.createDataFrame(
        [("A", 3, 66.67, "Incomplete", "GBP", {c: None for c in ("USD", "EUR", "INR", "GBP")})],
        f"assembly_id string, total_parts_count long, parts_coverage_pct double, cost_data_completeness string, "
        f"main_currency string, totals map<string, {one}>")
    found = {r.part_id: sorted(r.totals) for r in serving.with_needed_totals(lines, cost, rollup).collect()}
    assert found == {"P1": ["EUR", "USD"], "P2": ["INR"], "P3": ["GBP"]}


def test_shuffles_begin_with_more_partitions_for_more_input(spark):
    fit_partitions(spark, 500 * PARTITION_BYTES)
    assert spark.conf.get(FIRST_PARTITIONS) == "500"
    Plant(spark, FOLDER)
    assert spark.conf.get(FIRST_PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
