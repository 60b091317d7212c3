"""Serving: labelled views, marts and the point-lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.context import RunContext
from partledger.functions.columns import banded
from partledger.operators import skew
from partledger.operators.skew import EVEN, Hot

# Suppliers listed in one row of the lookup table.
SUPPLIERS_PER_PAGE = 1000

# Column labels of the reporting views.
DASHBOARD_LABELS = {
    "assembly_id": "Assembly ID", "part_id": "Part ID", "revision": "Revision", "status": "Part Status",
    "supplier_name": "Supplier", "quantity": "Qty", "cost": "Unit Cost", "currency": "Currency",
    "total_assembly_cost": "Line Cost", "is_lowest_cost_supplier": "Is Cheapest Supplier",
    "cost_vs_cheapest": "Cost Premium vs Cheapest", "assembly_min_cost": "Assembly Min Cost",
    "assembly_avg_cost": "Assembly Avg Cost", "total_parts_count": "Total Parts",
    "parts_coverage_pct": "Cost Coverage %", "cost_data_completeness": "Data Completeness",
    "is_current_revision": "Is Current Revision", "has_active_revision": "Has Active Revision",
}
CATALOGUE_LABELS = {
    "part_id": "Part ID", "current_revision": "Current Revision", "current_status": "Status",
    "current_effective_from": "Active Since", "current_revision_age_days": "Days Active",
    "total_revision_count": "Total Revisions", "first_released_at": "First Released",
    "last_revision_change_at": "Last Changed", "supplier_count": "Supplier Count", "min_cost": "Lowest Cost",
    "max_cost": "Highest Cost", "cost_spread": "Cost Spread", "currency": "Currency",
    "has_multi_supplier": "Multi-Supplier",
}
SCORECARD_LABELS = {
    "supplier_name": "Supplier", "currency": "Currency", "parts_supplied": "Parts Supplied",
    "assemblies_covered": "Assemblies Covered", "avg_unit_cost": "Avg Unit Cost", "min_unit_cost": "Min Unit Cost",
    "max_unit_cost": "Max Unit Cost", "total_extended_cost": "Total Extended Cost",
    "lowest_cost_spend": "Spend (Cheapest Option)", "spend_share_pct": "Spend Share %", "supplier_tier": "Tier",
    "last_price_update_at": "Last Price Update", "is_multi_part_supplier": "Supplies Multiple Parts",
}
TRACKER_LABELS = {
    "part_id": "Part ID", "revision": "Revision", "revision_sequence": "Rev #", "revision_stage": "Stage",
    "status": "Status", "effective_from": "Effective From", "effective_to": "Effective To",
    "is_current_revision": "Is Current", "revision_duration_days": "Duration (Days)",
    "days_to_next_revision": "Days Until Superseded", "next_revision": "Superseded By",
}
CAD_HEALTH_LABELS = {
    "file_date": "File Date", "files_processed": "Files Processed", "unique_files": "Unique Files",
    "first_processed_at": "First Processed At", "last_processed_at": "Last Processed At",
    "processing_lag_days": "Lag (Days)", "lag_status": "Lag Status", "health_status": "Health Status",
}


def labelled(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.select([F.col(c).alias(label) for c, label in labels.items()])


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


# Summaries --------------------------------------------------------------------------------------------

def assembly_cost_summary(agg_assembly: DataFrame) -> DataFrame:
    """One row per assembly: its totals in its main currency, and its coverage."""
    return agg_assembly.where("is_main_currency").drop("is_main_currency")


def supplier_performance(agg_supplier: DataFrame) -> DataFrame:
    """Coverage, price level, spend and tier of every supplier that prices something."""
    return agg_supplier.where("supplier_name is not null").select(
        "supplier_name", "currency", "parts_supplied", "assemblies_covered", "avg_unit_cost", "lowest_cost_spend",
        "spend_share_pct", "supplier_tier")


# Views ------------------------------------------------------------------------------------------------

# The assembly's and the part's figures can be joined to stored fact rows, or to BOM lines before
# ``gold.fact_bom_cost`` fans them out: the second moves one row per line instead of one per supplier.

def with_assembly(rows: DataFrame, rollup: DataFrame, hot: Hot = EVEN) -> DataFrame:
    figures = rollup.select("assembly_id", "total_parts_count", "parts_coverage_pct", "cost_data_completeness",
                            "main_currency", "totals")
    return skew.join(rows, figures, ["assembly_id"], hot=hot.assemblies)


def with_needed_totals(rows: DataFrame, cost: DataFrame, rollup: DataFrame, hot: Hot = EVEN) -> DataFrame:
    """``with_assembly`` for lines that are to meet their part's prices: of the assembly's totals a line keeps those in
    the currencies its part is quoted in, or in the main one where it is in none. It can need no other."""
    quoted = cost.groupBy("part_id").agg(F.collect_set("currency").alias("_quoted"))
    figured = with_assembly(skew.join(rows, quoted, ["part_id"], hot=hot.bom_parts), rollup, hot)
    wanted = F.when(F.size("_quoted") > 0, F.col("_quoted")).otherwise(F.array("main_currency"))
    return figured.withColumn("totals", F.map_filter("totals", lambda currency, _: F.array_contains(wanted, currency))).drop("_quoted")


def with_part(rows: DataFrame, dim_part: DataFrame, hot: Hot = EVEN) -> DataFrame:
    part = dim_part.select("part_id", F.col("total_revision_count").alias("part_revision_count"),
                           F.col("first_released_at").alias("part_first_released_at"))
    return skew.join(rows, part, ["part_id"], hot=hot.bom_parts)


def in_line_currency(rows: DataFrame) -> DataFrame:
    """The assembly's totals in the currency of the line; a line without a price takes the main currency."""
    totals = F.try_element_at("totals", F.coalesce("currency", "main_currency"))
    return rows.select("*", totals["low"].alias("assembly_min_cost"), totals["mean"].alias("assembly_avg_cost"))


def assembly_cost_dashboard(fact: DataFrame) -> DataFrame:
    """From fact rows that carry their assembly's figures."""
    return labelled(in_line_currency(fact), DASHBOARD_LABELS)


def part_catalogue(dim_part: DataFrame) -> DataFrame:
    return labelled(dim_part, CATALOGUE_LABELS).orderBy("Part ID")


def _with_supplier_dim(agg: DataFrame, dim: DataFrame) -> DataFrame:
    extra = dim.select("supplier_name", "currency", "last_price_update_at", "is_multi_part_supplier")
    return agg.join(extra, ["supplier_name", "currency"], "left")


def supplier_scorecard(agg_supplier: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    view = labelled(_with_supplier_dim(agg_supplier, dim_supplier), SCORECARD_LABELS)
    return view.orderBy(F.desc("Spend Share %"), "Supplier", "Currency")


def revision_tracker(rev_history: DataFrame) -> DataFrame:
    return labelled(rev_history, TRACKER_LABELS).orderBy("Part ID", "Rev #", "Revision")


def cad_pipeline_health(cad_activity: DataFrame) -> DataFrame:
    lag = F.col("lag_status")
    health = banded([(lag == "Same Day", "On Time"), (lag == "Next Day", "Acceptable")], "At Risk")
    return labelled(cad_activity.withColumn("health_status", health), CAD_HEALTH_LABELS).orderBy(F.desc("File Date"))


# Marts ------------------------------------------------------------------------------------------------

def mart_assembly_cost(fact: DataFrame, ctx: RunContext) -> DataFrame:
    """From fact rows that carry their assembly's and their part's figures."""
    renamed = {
        "revision": "part_revision", "status": "part_status", "cost": "unit_cost", "total_assembly_cost": "line_cost",
        "is_lowest_cost_supplier": "is_cheapest_supplier", "cost_vs_cheapest": "cost_premium",
        "cost_data_available": "has_erp_cost", "total_parts_count": "assembly_total_parts",
        "parts_coverage_pct": "assembly_cost_coverage_pct", "cost_data_completeness": "assembly_data_completeness",
    }
    return in_line_currency(fact).withColumnsRenamed(renamed).select(
        "assembly_id", "part_id", "part_revision", "part_status", "supplier_name", "quantity", "unit_cost", "currency",
        "line_cost", "is_cheapest_supplier", "cost_premium", "is_current_revision", "has_active_revision",
        "has_erp_cost", "assembly_min_cost", "assembly_avg_cost", "assembly_total_parts",
        "assembly_cost_coverage_pct", "assembly_data_completeness", "part_revision_count", "part_first_released_at",
        ctx.today.alias("report_date"))


def mart_supplier_scorecard(agg_supplier: DataFrame, dim_supplier: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _with_supplier_dim(agg_supplier, dim_supplier)
    age = F.datediff(ctx.today, F.col("last_price_update_at").cast("date"))
    aged = rows.withColumn("days_since_price_update", age)
    days = F.col("days_since_price_update")
    fresh = aged.withColumn("price_freshness", banded([(days <= 30, "Current"), (days <= 90, "Stale")],
                                                      "Outdated"))
    tier, current = F.col("supplier_tier"), F.col("price_freshness") == "Current"
    # Advice per tier, price age and number of parts.
    advice = banded([
        ((tier == "Strategic") & current, "Maintain — key supplier, pricing current"),
        (tier == "Strategic", "Urgent — renegotiate pricing with strategic supplier"),
        ((tier == "Preferred") & (F.col("parts_supplied") == 1),
         "Review — single-part preferred supplier, consider consolidation"),
        (tier == "Tactical", "Monitor — low spend share, evaluate if needed"),
    ], "Review")
    return fresh.select(
        "supplier_name", "currency", "parts_supplied", "assemblies_covered", "avg_unit_cost", "min_unit_cost",
        "max_unit_cost", "total_extended_cost", "lowest_cost_spend", "spend_share_pct", "supplier_tier",
        "last_price_update_at", "days_since_price_update", "price_freshness", advice.alias("recommended_action"),
        "is_multi_part_supplier", ctx.today.alias("report_date"))


def mart_open_revisions(rev_history: DataFrame, dim_part: DataFrame, ctx: RunContext, hot: Hot = EVEN) -> DataFrame:
    """Open revisions with their review state. Sort by ``days_active`` when reading."""
    costs = dim_part.select("part_id", "supplier_count", "min_cost", "currency")
    rows = skew.join(rev_history.where("is_current_revision"), costs, ["part_id"], hot=hot.revision_parts)
    days = F.col("revision_duration_days")
    review, escalate = ctx.limits.review_days, ctx.limits.escalation_days
    state = banded([
        (days >= escalate, "Escalate — overdue for revision"),
        (days >= review, "Review — approaching revision threshold"),
    ], "On Track")
    return rows.select(
        "part_id", "revision", "status", "effective_from", days.alias("days_active"),
        F.greatest(F.lit(review) - days, F.lit(0)).alias("days_until_review_due"), state.alias("review_status"),
        "revision_sequence", "supplier_count", F.col("min_cost").alias("current_min_cost"), "currency",
        F.col("min_cost").isNotNull().alias("has_cost_data"), ctx.today.alias("report_date"))


def api_part_cost_lookup(dim_part: DataFrame, cost: DataFrame, ctx: RunContext,
                         page_rows: int = SUPPLIERS_PER_PAGE, hot: Hot = EVEN) -> DataFrame:
    """One row per part for point lookups: revision, cheapest supplier, all suppliers, and the JSON answer.

    The key is (part_id, supplier_page). The cheapest supplier is taken in the part's main currency (that
    of ``dim_part``), ties by name. A part's suppliers are listed on as many pages as ``page_rows`` asks
    for, so that no list outgrows a task, and every answer states its page and the number of pages:
    whoever wants the whole list reads pages 0 to pages - 1. Prices are read from the price list: the fact
    only repeats them per assembly.
    """
    offer = F.struct(F.col("supplier_name").alias("supplier"), F.col("cost").alias("unit_cost"), F.col("currency"))
    pages = cost.groupBy("part_id").agg(F.ceil(F.count(F.lit(1)) / page_rows).alias("_pages"))
    paged = skew.join(cost, pages, ["part_id"], hot=hot.cost_parts).withColumn(
        "supplier_page", F.pmod(F.xxhash64("supplier_name"), F.col("_pages")).cast("int"))
    lists = paged.groupBy("part_id", "supplier_page").agg(
        F.array_sort(F.collect_set(offer)).alias("all_suppliers"), F.max("_pages").alias("_pages"))

    main = dim_part.select("part_id", "currency")
    in_main = skew.join(cost.select("part_id", "currency", "supplier_name", "cost"), main, ["part_id", "currency"],
                        "inner", hot.cost_parts)
    best = in_main.groupBy("part_id").agg(
        F.min(F.struct("cost", "supplier_name", "currency")).alias("b")).select(
        "part_id", F.col("b.supplier_name").alias("cheapest_supplier"), F.col("b.cost").alias("cheapest_unit_cost"),
        F.col("b.currency").alias("cost_currency"))

    parts = dim_part.select("part_id", "current_revision", "current_status")
    rows = parts.join(best, "part_id", "left").join(lists, "part_id", "left").select(
        "part_id", "current_revision", "current_status", F.col("current_status").isin("Released").alias("is_available"),
        "cheapest_supplier", "cheapest_unit_cost", "cost_currency", "all_suppliers",
        F.coalesce("supplier_page", F.lit(0)).alias("supplier_page"),
        F.coalesce("_pages", F.lit(1)).cast("int").alias("supplier_pages"))
    answer = F.struct("part_id", "current_revision", "current_status", "is_available", "cheapest_supplier",
                      "cheapest_unit_cost", "cost_currency", "all_suppliers", F.col("supplier_page").alias("page"),
                      F.col("supplier_pages").alias("pages"))
    return rows.select("*", F.to_json(answer).alias("api_response_json"), ctx.ts.alias("cache_refreshed_at"))


def register_lookup(spark: SparkSession, table: str, name: str = "part_cost_lookup") -> None:
    """Make the lookup table callable from SQL: ``part_cost_lookup(part [, page])`` gives a part's row, or none.

    The body is plain SQL, so Spark plans a call with a constant as a filter on the table, and a lateral call for
    every row of another table as a join with it.
    """
    columns = [f for f in spark.table(table).schema.fields if f.name not in ("part_id", "supplier_page")]
    returned = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(part STRING, page INT DEFAULT 0)
RETURNS TABLE ({returned})
RETURN SELECT {", ".join(f.name for f in columns)} FROM {table} WHERE part_id = {name}.part AND supplier_page = {name}.page""")


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.select("*", ctx.ts.alias("_refreshed_at"))
