"""Every query against its SQL on the smallest data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from partledger.operators.skew import Hot  # noqa: E402
from partledger.queries import QUERIES, Plant  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check.TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, _, same = check.compare(spark, con, FOLDER, name, ORACLE[name])
    assert same, message


@pytest.mark.parametrize("name", ["agg_assembly_cost", "agg_supplier_cost", "mart_assembly_cost", "mart_open_revisions",
                                  "agg_part_revision_history", "bom_revision_as_of", "api_part_cost_lookup", "cost_vs_cheapest",
                                  "bom_enriched", "part_cost_view", "referential_orphans", "covered_lines", "revision_impact",
                                  "scd2_status_incremental", "star_fact_cost", "star_fact_design"])
def test_query_with_hot_keys(spark, rows, name):
    """Treating the larger keys as hot changes the plan, not the rows."""
    even, uneven = Plant(spark, FOLDER), Plant(spark, FOLDER)
    uneven.hot = Hot.measure(even.raw("raw_bom"), even.raw("raw_cost"), even.raw("raw_revisions"), group_rows=4,
                             cad=even.raw("raw_cad"))
    assert uneven.hot.bom_parts and uneven.hot.assemblies and uneven.hot.cost_parts and uneven.hot.revision_parts
    assert rows(QUERIES[name](uneven)) == rows(QUERIES[name](even))
