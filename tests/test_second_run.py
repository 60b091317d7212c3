"""What a second run with the whole sources leaves equals one computation from them."""

from datetime import date

import pytest

from partledger import schemas
from partledger.queries import QUERIES, Plant


@pytest.fixture
def plant(spark):
    """Notices whose newest one before 1996 has no accepted currency: an older one counts, or none."""
    def day(year):
        return date(year, 5, 1)

    rows = {
        "raw_cost": (schemas.ERP_COST, [
            ("P1", " s1 ", "10.00", "usd", day(1993)), ("P1", " s1 ", "11.00", None, day(1995)),
            ("P1", " s2 ", "12.00", "xxx", day(1994)), ("P2", " s1 ", "20.00", "eur", day(1995)),
            ("P2", " s2 ", "21.00", " eur", day(1994)), ("P2", " s2 ", "22.00", "xxx", day(1999))]),
        "raw_bom": (schemas.PLM_BOM, [("A1", " P1", 2, None), ("A1", " P2", 3, None), ("A2", " P1", 1, None)]),
        "raw_revisions": (schemas.PLM_REVISIONS, [
            ("P1", " r1", "released", day(1993), None, None), ("P2", " r1", "draft", day(1993), day(1995), None),
            ("P2", " r2", "released", day(1995), None, None)]),
        "raw_cad": (schemas.CAD_CSV + ", _source_file string", []),
    }
    found = Plant(spark, "none")
    found._raw = {name: spark.createDataFrame(data, schema) for name, (schema, data) in rows.items()}
    return found


@pytest.mark.parametrize("after,once", [("gold_after_second_run", "agg_assembly_cost"),
                                        ("open_revisions_after_second_run", "mart_open_revisions")])
def test_as_one_computation(plant, rows, after, once):
    twice, first = QUERIES[after](plant), QUERIES[once](plant)
    assert first.count() >= 2
    assert rows(twice, *sorted(first.columns)) == rows(first, *sorted(first.columns))
