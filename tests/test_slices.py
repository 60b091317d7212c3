"""Large tables go slice by slice: the same rows, with no slice's shuffles kept."""

import re
import time
from datetime import date, datetime

import pytest

from partledger import schemas
from partledger.operators import slices
from partledger.queries import QUERIES, Plant
from partledger.session import shared_dir

MARTS = ["vw_assembly_cost_dashboard", "mart_assembly_cost", "guarded_mart", "masked_mart", "row_filtered_mart"]


def plant(spark):
    def day(year):
        return date(year, 5, 1)

    bom = [(f"A{i % 7}" if i % 11 else None, f" P{i % 13}" if i % 10 else None, i % 5, datetime(1990 + i % 9, 5, 1)) for i in range(90)]
    cost = [(f"P{i % 13}" if i % 9 else None, f" s{i % 4} ", str(i % 6 * 1.5), ("usd", " eur", "gbp ", "xxx", None)[i % 5], day(1990 + i % 9))
            for i in range(120)]
    revisions = [(f"P{i % 11}" if i % 8 else None, f" r{i % 3}", "released", day(1990 + i % 9), None if i % 4 else day(2000), None)
                 for i in range(60)]
    rows = {"raw_bom": (schemas.PLM_BOM, bom), "raw_cost": (schemas.ERP_COST, cost), "raw_revisions": (schemas.PLM_REVISIONS, revisions),
            "raw_cad": (schemas.CAD_CSV + ", _source_file string", [])}
    found = Plant(spark, "none")
    found._raw = {name: spark.createDataFrame(data, schema) for name, (schema, data) in rows.items()}
    return found


@pytest.mark.parametrize("name", MARTS)
def test_slices_give_the_rows_of_the_whole(spark, rows, monkeypatch, name):
    whole = rows(QUERIES[name](plant(spark)))
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(slices, "MOST_SLICES", 3)
    sliced = QUERIES[name](plant(spark))
    # Nothing is left to be moved, or held, while the result is read.
    assert not re.search(r"hashpartitioning\((part|assembly)_id", sliced._jdf.queryExecution().executedPlan().toString())
    assert whole and rows(sliced) == whole


def test_a_key_is_in_one_slice(spark):
    df = spark.createDataFrame([(f"k{i % 40}" if i % 6 else None,) for i in range(300)], "k string")
    parts = [[r[0] for r in slices.of(df, "k", 5, i).collect()] for i in range(5)]
    assert sum(map(len, parts)) == 300 and sum(len({*p}) for p in parts) == df.distinct().count()
    assert slices.how_many(0) == 1 and slices.how_many(slices.SLICE_BYTES + 1) == 2 and slices.how_many(10**15) == slices.MOST_SLICES


def test_shuffles_of_a_written_table_are_let_go(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}

    plant(spark)  # a session of someone else gets the settings here
    before = shuffled()
    spark.range(1000).groupBy("id").count().write.parquet(shared_dir(spark, "let-go"))
    for _ in range(50):
        if not shuffled() - before:
            return
        time.sleep(0.2)
    pytest.fail("shuffle files of a written table are still there")
