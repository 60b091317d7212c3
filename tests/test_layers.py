from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from partledger.context import REASON_COST, REASON_CURRENCY, REASON_NO_START, REASON_STATUS
from partledger.functions import columns
from partledger.operators import rules
from partledger.plans import gold, serving, silver

REV = "part_id string, revision string, status string, effective_from string, effective_to string, last_modified string"
BOM = "assembly_id string, part_id string, quantity string, last_modified string"
COST = "part_id string, supplier_name string, cost string, currency string, last_updated string"
CAD = ("part_id string, part_name string, material string, weight_kg string, designer string, created_date string, "
       "_source_file string")


def price(spark, *data):
    return silver.erp_cost(spark.createDataFrame([(*d, "2026-03-01") for d in data], COST))


@pytest.fixture
def small(spark, ctx):
    """The sample sources: one part per assembly, five priced parts, two revisions of one part."""
    revisions = silver.plm_revisions(spark.createDataFrame([
        ("P1001", "R1", "Released", "2026-02-01", "2026-03-01", "2026-03-01 09:00:00"),
        ("P1001", "R2", "Released", "2026-03-01", None, "2026-03-05 10:00:00"),
        ("P1002", "R1", "Released", "2026-02-15", None, "2026-03-02 08:30:00"),
        ("P1003", "R1", "In Review", "2026-03-01", None, "2026-03-06 07:45:00"),
        ("P1004", "R1", "Released", "2026-03-02", None, "2026-03-07 06:30:00")], REV), ctx)
    quantities = [3, 3, 5, 5, 2, 4, 2, 4, 2, 4, 4, 2, 5, 4, 1, 4, 1, 5, 2]
    bom = silver.plm_bom(spark.createDataFrame(
        [(f"A{2001 + i}", f"P{1001 + i}", str(q), "2026-03-01") for i, q in enumerate(quantities)], BOM), revisions)
    cost = silver.erp_cost(spark.createDataFrame([
        ("P1001", "Tata Components", "1500", "INR", "2026-03-10 09:00:00"),
        ("P1002", "Bosch India", "800", "INR", "2026-03-10 09:30:00"),
        ("P1003", "Mahindra Parts", "1200", "INR", "2026-03-11 10:00:00"),
        ("P1004", "L&T Supplies", "2000", "INR", "2026-03-11 10:30:00"),
        ("P1005", "Sundaram Fasteners", "1800", "INR", "2026-03-12 11:00:00")], COST))
    return revisions, bom, cost


# Expressions

def test_file_date_takes_both_separators(spark, rows):
    df = spark.createDataFrame([("x/cad_metadata_2026-03-10.csv",), ("x/cad_metadata_2026_03_01.csv",),
                                ("x/cad_metadata_adhoc.csv",), ("x/cad_metadata_2026-13-40.csv",)], "p string")
    assert [r[0] for r in df.select(columns.file_date(F.col("p"))).collect()] == [
        date(2026, 3, 10), date(2026, 3, 1), None, None]


def test_percent_is_exact_at_halves(spark):
    df = spark.createDataFrame([(1, 16), (23, 4000), (2, 3), (0, 5), (5, 0)], "a long, b long")
    got = [r[0] for r in df.select(columns.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [6.25, 0.58, 66.67, 0.0, None]


def test_null_key_test_takes_one_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert df.where(columns.any_null(["a"])).count() == 1


# Quarantine

def test_unknown_counts_as_failed_and_no_row_is_lost(spark, rows):
    raw = spark.createDataFrame([
        ("P1", "r1", " released ", "2026-01-01", None, "2026-01-01"),
        ("P2", "r1", None, "2026-01-01", None, "2026-01-01"),
        ("P3", "r1", "scrapped", "2026-01-01", None, "2026-01-01"),
        ("P4", "r1", "in review", None, None, "2026-01-01"),
        ("P5", "r1", None, "not a date", None, "2026-01-01")], REV)
    verdict = silver.judge_revisions(raw)
    assert rows(verdict.clean, "part_id", "status") == [("P1", "Released")]
    assert rows(verdict.rejected, "part_id", "_rejection_reason") == [
        ("P2", REASON_STATUS), ("P3", REASON_STATUS), ("P4", REASON_NO_START), ("P5", REASON_NO_START)]


def test_cost_rules(spark, rows):
    raw = spark.createDataFrame([
        ("P1", "s", "10.5", "usd ", "2026-01-01"), ("P2", "s", "abc", "USD", "2026-01-01"),
        ("P3", "s", "0", "USD", "2026-01-01"), ("P4", "s", "-1", "USD", "2026-01-01"),
        ("P5", "s", "5", None, "2026-01-01"), ("P6", "s", "5", "XXX", "2026-01-01"),
        ("P7", "s", None, None, "2026-01-01")], COST)
    verdict = silver.judge_cost(raw)
    assert rows(verdict.clean, "part_id", "cost", "currency") == [("P1", "10.5000", "USD")]
    assert rows(verdict.rejected, "part_id", "_rejection_reason") == [
        ("P2", REASON_COST), ("P3", REASON_COST), ("P4", REASON_COST), ("P5", REASON_CURRENCY),
        ("P6", REASON_CURRENCY), ("P7", REASON_COST)]


def test_reject_ledger_repeats_to_the_same_rows(spark, ctx, rows):
    bad = silver.judge_cost(spark.createDataFrame([("P2", "s", "abc", "USD", "2026-01-01")], COST)).rejected
    assert rows(rules.reject_ledger(bad, ctx)) == rows(rules.reject_ledger(bad, ctx))


# Silver

def test_newest_price_wins_and_ties_are_settled_by_content(spark, rows):
    raw = spark.createDataFrame([
        ("P1", "a", "10", "USD", "2026-01-01"), ("P1", " A ", "11", "usd", "2026-01-02"),
        ("P1", "a", "12", "usd", "2026-01-02"), ("P2", "a", "5", "USD", None)], COST)
    wanted = [("P1", "A", "12.0000"), ("P2", "A", "5.0000")]
    assert rows(silver.erp_cost(raw), "part_id", "supplier_name", "cost") == wanted
    shuffled = raw.orderBy(F.desc("cost")).repartition(3)
    assert rows(silver.erp_cost(shuffled), "part_id", "supplier_name", "cost") == wanted


def test_one_current_revision_where_two_are_open(spark, ctx, rows):
    raw = spark.createDataFrame([
        ("P1", "r1", "released", "2026-01-01", None, "2026-01-01"),
        ("P1", "r3", "draft", "2026-02-01", None, "2026-01-01"),
        ("P1", "r2", "released", "2026-02-01", None, "2026-01-01")], REV)
    revisions = silver.plm_revisions(raw, ctx)
    assert rows(silver.current_revision(revisions), "part_id", "revision") == [("P1", "R3")]
    bom = silver.plm_bom(spark.createDataFrame([("A1", "P1", "2", "2026-01-01")], BOM), revisions)
    assert bom.count() == 1
    assert revisions.where("revision = 'R1'").first().revision_duration_days == 90


def test_bom_keeps_positive_quantities(spark, rows):
    raw = spark.createDataFrame([("A1", " P1", "2", "2026-01-01"), ("A1", "P2", "0", "2026-01-01"),
                                 ("A1", "P3", None, "2026-01-01"), ("A1", "P4", "x", "2026-01-01")], BOM)
    assert rows(silver.bom_lines(raw), "assembly_id", "part_id", "quantity") == [("A1", "P1", "2")]
    assert silver.judge_bom(raw).rejected.count() == 3


def test_cad_rows(spark, rows):
    raw = spark.createDataFrame([
        (" P1 ", "bolt ", "steel", "1.5", "d", "2026-03-01", "x/cad_metadata_2026-03-10.csv"),
        ("P1", "bolt", "iron", "heavy", "d", "bad", "x/cad_metadata_2026_03_11.csv"),
        (None, "nut", "steel", "1", "d", "2026-03-01", "x/cad_metadata_2026-03-10.csv")], CAD)
    assert rows(silver.cad_metadata(raw)) == [("P1", "bolt", "iron", "None", "d", "None", "2026-03-11")]
    assert silver.judge_cad(raw).rejected.count() == 1


# Gold

def test_assembly_costs_of_the_sample(small, rows):
    _, bom, cost = small
    got = {r.assembly_id: r for r in gold.agg_assembly_cost(bom, cost).collect()}
    assert len(got) == 19
    costs = {"A2001": 4500, "A2002": 2400, "A2003": 6000, "A2004": 10000, "A2005": 3600}
    for assembly, amount in costs.items():
        assert got[assembly].min_total_assembly_cost == got[assembly].avg_total_assembly_cost == Decimal(amount)
        assert (got[assembly].currency, got[assembly].cost_data_completeness) == ("INR", "Complete")
    assert got["A2006"].min_total_assembly_cost is None and got["A2006"].currency is None
    assert (got["A2006"].parts_coverage_pct, got["A2006"].cost_data_completeness) == (0.0, "Incomplete")


def test_part_dimension_of_the_sample(small, rows):
    revisions, _, cost = small
    assert rows(gold.dim_part(revisions, cost), "part_id", "current_revision", "total_revision_count", "supplier_count",
                "min_cost", "has_multi_supplier", "cost_spread") == [
        ("P1001", "R2", "2", "1", "1500.0000", "False", "0.0000"), ("P1002", "R1", "1", "1", "800.0000", "False", "0.0000"),
        ("P1003", "R1", "1", "1", "1200.0000", "False", "0.0000"), ("P1004", "R1", "1", "1", "2000.0000", "False", "0.0000")]


def test_cheapest_ties_and_currencies(spark, rows):
    cost = price(spark, ("P1", "a", "10", "USD"), ("P1", "b", "10", "USD"), ("P1", "c", "12", "USD"), ("P1", "d", "3", "EUR"))
    assert rows(gold.price_position(cost), "supplier_name", "is_lowest_cost_supplier", "cost_vs_cheapest") == [
        ("A", "True", "0.0000"), ("B", "True", "0.0000"), ("C", "False", "2.0000"), ("D", "True", "0.0000")]
    assert rows(gold.supplier_stats(cost)) == [("P1", "4", "10.0000", "12.0000", "USD")]


def test_lines_without_price_are_not_cheapest(spark, ctx, small, rows):
    revisions, bom, cost = small
    fact = gold.fact_bom_cost(bom, revisions, cost)
    assert fact.where("supplier_name is null and is_lowest_cost_supplier").count() == 0
    assert fact.where("supplier_name is null").count() == 14


def test_tied_cheapest_suppliers_do_not_inflate_the_assembly(spark, ctx, rows):
    revisions = silver.plm_revisions(spark.createDataFrame([], REV), ctx)
    bom = silver.plm_bom(spark.createDataFrame([("A1", "P1", "2", "2026-01-01"), ("A1", "P2", "1", "2026-01-01")], BOM), revisions)
    cost = price(spark, ("P1", "a", "10", "USD"), ("P1", "b", "10", "USD"), ("P1", "c", "40", "USD"), ("P2", "a", "5", "EUR"))
    assert rows(gold.agg_assembly_cost(bom, cost), "currency", "min_total_assembly_cost", "avg_total_assembly_cost",
                "total_parts_count", "parts_with_cost", "is_main_currency") == [
        ("EUR", "5.0000", "5.0000", "2", "2", "True"), ("USD", "20.0000", "40.0000", "2", "2", "False")]


@pytest.mark.parametrize("parts,priced,pct,band", [
    (10000, 7999, 79.99, "Incomplete"), (5, 4, 80.0, "Mostly Complete"), (25000, 24999, 100.0, "Mostly Complete"),
    (3, 3, 100.0, "Complete")])
def test_coverage_bands_go_by_counts(spark, ctx, parts, priced, pct, band):
    bom = spark.range(parts).select(F.lit("A").alias("assembly_id"), F.concat(F.lit("P"), "id").alias("part_id"),
                                    F.lit(1).alias("quantity"), F.lit(True).alias("has_active_revision"))
    cost = spark.range(priced).select(F.concat(F.lit("P"), "id").alias("part_id"), F.lit("S").alias("supplier_name"),
                                      F.lit(1).cast("decimal(18,4)").alias("cost"), F.lit("INR").alias("currency"))
    row = gold.agg_assembly_cost(bom, cost).first()
    assert (row.parts_coverage_pct, row.cost_data_completeness) == (pct, band)


def test_supplier_shares_are_per_currency(spark, ctx):
    revisions = silver.plm_revisions(spark.createDataFrame([], REV), ctx)
    bom = silver.plm_bom(spark.createDataFrame([
        ("A1", "P1", "1", "2026-01-01"), ("A2", "P1", "3", "2026-01-01"), ("A1", "P2", "1", "2026-01-01"),
        ("A1", "P9", "1", "2026-01-01")], BOM), revisions)
    cost = price(spark, ("P1", "a", "10", "USD"), ("P1", "b", "30", "USD"), ("P2", "b", "10", "USD"), ("P2", "a", "1", "EUR"))
    got = {(r.supplier_name, r.currency): r for r in gold.agg_supplier_cost(bom, cost).collect()}
    a, b, none = got["A", "USD"], got["B", "USD"], got[None, None]
    assert (a.parts_supplied, a.assemblies_covered, a.lowest_cost_spend, a.spend_share_pct) == (2, 2, Decimal(40), 80.0)
    assert (b.parts_supplied, b.total_extended_cost, b.avg_unit_cost) == (3, Decimal(130), Decimal("23.3333"))
    assert (b.spend_share_pct, b.supplier_tier, got["A", "EUR"].spend_share_pct) == (20.0, "Preferred", 100.0)
    assert (none.parts_supplied, none.total_extended_cost, none.spend_share_pct) == (1, None, 0.0)


def test_revision_history_ties(spark, ctx, rows):
    raw = spark.createDataFrame([
        ("P1", "r1", "released", "2026-01-01", "2026-02-01", "2026-01-01"),
        ("P1", "r2", "released", "2026-02-01", None, "2026-01-01"),
        ("P1", "r3", "released", "2026-02-01", None, "2026-01-01"),
        ("P1", "r4", "released", "2026-03-01", "2026-03-09", "2026-01-01")], REV)
    assert rows(gold.agg_part_revision_history(silver.plm_revisions(raw, ctx)), "revision", "revision_sequence",
                "next_revision", "days_to_next_revision", "revision_stage") == [
        ("R1", "1", "R2", "31", "Initial Release"), ("R2", "2", "R3", "None", "Current"),
        ("R3", "2", "R4", "None", "Current"), ("R4", "4", "None", "8", "Superseded")]


def test_cad_lag_bands(spark, rows):
    days = [date(2026, 3, 10), date(2026, 3, 9), date(2026, 3, 7), date(2026, 3, 1), date(2026, 3, 12), None]
    cad = spark.createDataFrame([(f"P{i}", d, datetime(2026, 3, 10, 5)) for i, d in enumerate(days)],
                                "part_id string, file_date date, _silver_processed_at timestamp")
    assert rows(gold.agg_cad_activity(cad), "file_date", "lag_status") == [
        ("2026-03-01", "Delayed"), ("2026-03-07", "Within 3 Days"), ("2026-03-09", "Next Day"),
        ("2026-03-10", "Same Day"), ("2026-03-12", "Next Day"), ("None", "Unknown")]


# Serving

def test_lines_without_price_show_the_main_currency_totals(spark, ctx, rows):
    revisions = silver.plm_revisions(spark.createDataFrame([], REV), ctx)
    bom = silver.plm_bom(spark.createDataFrame([("A1", "P1", "2", "2026-01-01"), ("A1", "P9", "1", "2026-01-01")], BOM), revisions)
    cost = price(spark, ("P1", "a", "10", "USD"))
    rollup = gold.assembly_rollup(bom, cost)
    before = serving.assembly_cost_dashboard(gold.fact_bom_cost(serving.with_assembly(bom, rollup), revisions, cost))
    after = serving.assembly_cost_dashboard(serving.with_assembly(gold.fact_bom_cost(bom, revisions, cost), rollup))
    assert rows(before, "Part ID", "Assembly Min Cost", "Cost Coverage %") == [("P1", "20.0000", "50.0"), ("P9", "20.0000", "50.0")]
    assert rows(before) == rows(after)


def test_lookup_lists_every_supplier_over_pages(spark, ctx, small):
    revisions, _, _ = small
    offers = [("P1001", f"s{i:03}", str(100 + i), "USD") for i in range(50)] + [("P1002", "z", "5", "INR")]
    cost = price(spark, *offers)
    dim = gold.dim_part(revisions, cost)
    one = {r.part_id: r for r in serving.api_part_cost_lookup(dim, cost, ctx).collect()}
    assert (one["P1001"].cheapest_supplier, len(one["P1001"].all_suppliers), one["P1001"].supplier_page) == ("S000", 50, 0)
    assert one["P1003"].all_suppliers is None and one["P1003"].is_available is False
    assert one["P1002"].api_response_json.startswith('{"part_id":"P1002","current_revision":"R1"')
    paged = serving.api_part_cost_lookup(dim, cost, ctx, page_rows=10).where("part_id = 'P1001'").collect()
    assert len(paged) > 3
    assert sorted(s.supplier for r in paged for s in r.all_suppliers) == [f"S{i:03}" for i in range(50)]


def test_scorecard_advice(spark, ctx, rows):
    agg = spark.createDataFrame([
        ("a", "USD", 3, 1, None, None, None, None, None, 50.0, "Strategic"),
        ("b", "USD", 3, 1, None, None, None, None, None, 50.0, "Strategic"),
        ("c", "USD", 1, 1, None, None, None, None, None, 12.0, "Preferred"),
        ("d", "USD", 2, 1, None, None, None, None, None, 12.0, "Preferred"),
        ("e", "USD", 2, 1, None, None, None, None, None, 1.0, "Tactical")],
        "supplier_name string, currency string, parts_supplied long, assemblies_covered long, avg_unit_cost double, "
        "min_unit_cost double, max_unit_cost double, total_extended_cost double, lowest_cost_spend double, "
        "spend_share_pct double, supplier_tier string")
    dim = spark.createDataFrame([("a", "USD", datetime(2026, 3, 15), True), ("b", "USD", datetime(2026, 1, 15), True),
                                 ("b", "EUR", datetime(2026, 1, 15), True), ("c", "USD", None, False)],
                                "supplier_name string, currency string, last_price_update_at timestamp, is_multi_part_supplier boolean")
    got = {r.supplier_name: (r.price_freshness, r.recommended_action.split(" ")[0])
           for r in serving.mart_supplier_scorecard(agg, dim, ctx).collect()}
    assert got == {"a": ("Current", "Maintain"), "b": ("Stale", "Urgent"), "c": ("Outdated", "Review"),
                   "d": ("Outdated", "Review"), "e": ("Outdated", "Monitor")}


def test_open_revision_review(spark, ctx, rows):
    raw = spark.createDataFrame([
        ("P1", "r1", "released", "2025-03-01", None, "2026-01-01"), ("P2", "r1", "released", "2025-09-01", None, "2026-01-01"),
        ("P3", "r1", "released", "2026-03-01", None, "2026-01-01"), ("P4", "r1", "released", "2026-01-01", "2026-02-01", "2026-01-01")], REV)
    revisions = silver.plm_revisions(raw, ctx)
    dim = gold.dim_part(revisions, price(spark, ("P1", "a", "1", "USD")))
    mart = serving.mart_open_revisions(gold.agg_part_revision_history(revisions), dim, ctx)
    got = {r.part_id: (r.review_status.split(" ")[0], r.days_until_review_due, r.has_cost_data) for r in mart.collect()}
    assert got == {"P1": ("Escalate", 0, True), "P2": ("Review", 0, False), "P3": ("On", 149, False)}
