"""Gold: dimensions, the BOM cost fact and its aggregates.

Costs are compared within one currency. Ranks and minima are taken on the price list, before it
fans out over the BOM, and by aggregation, so no window ever holds one part's fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.context import CURRENCIES, RunContext
from partledger.functions.columns import banded, mean, money, percent
from partledger.operators import skew
from partledger.operators.maintain import Totals
from partledger.operators.skew import EVEN, Hot
from partledger.plans.silver import VIEW_COLUMNS, current_revision, part_cost_view


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.select("*", ctx.today.alias("_gold_run_date"), ctx.ts.alias("_gold_processed_at"),
                     F.lit(ctx.run_id).alias("_gold_pipeline_run"))


# Dimensions -----------------------------------------------------------------------------------------

# Aggregates in the form that is kept between runs; figures and dimensions are read off them.
REVISION_TOTALS = Totals(["part_id"], sums={"revisions": "int(revision IS NOT NULL)"}, lows={"first": "effective_from"},
                         highs={"last": "last_modified"})
OFFER_TOTALS = Totals(["part_id", "currency"], sums={"n": "int(supplier_name IS NOT NULL)"}, lows={"low": "cost"}, highs={"high": "cost"})
SUPPLIER_TOTALS = Totals(["supplier_name", "currency"], lows={"low": "cost"}, highs={"high": "cost", "last": "last_updated"},
                         sums={"parts": "int(part_id IS NOT NULL)", "prices": "int(cost IS NOT NULL)", "total": "coalesce(cost, 0)"})


def revision_figures(totals: DataFrame) -> DataFrame:
    return totals.select("part_id", F.col("revisions").alias("total_revision_count"), F.col("first").alias("first_released_at"),
                         F.col("last").alias("last_revision_change_at"))


def revision_stats(revisions: DataFrame) -> DataFrame:
    return revision_figures(REVISION_TOTALS.compute(revisions))


def supplier_figures(totals: DataFrame) -> DataFrame:
    """Per part: number of suppliers, and lowest and highest price in its main currency.

    The main currency is the one most suppliers quote in; ties go to the first by name.
    """
    main = F.min_by(F.struct("low", "high", "currency"), F.struct(-F.col("n"), F.col("currency")))
    return totals.groupBy("part_id").agg(F.sum("n").alias("supplier_count"), main.alias("m")).select(
        "part_id", "supplier_count", F.col("m.low").alias("min_cost"), F.col("m.high").alias("max_cost"),
        F.col("m.currency").alias("currency"))


def supplier_stats(cost: DataFrame) -> DataFrame:
    return supplier_figures(OFFER_TOTALS.compute(cost))


def dim_part(revisions: DataFrame, cost: DataFrame, history: DataFrame | None = None, offers: DataFrame | None = None) -> DataFrame:
    """Parts with an open revision. ``history`` and ``offers`` are the figures per part where they are known already."""
    now = current_revision(revisions).select(
        "part_id", F.col("revision").alias("current_revision"), F.col("status").alias("current_status"),
        F.col("effective_from").alias("current_effective_from"),
        F.col("revision_duration_days").alias("current_revision_age_days"))
    history = revision_stats(revisions) if history is None else history
    offers = supplier_stats(cost) if offers is None else offers
    joined = now.join(history, "part_id", "left").join(offers, "part_id", "left")
    return joined.select(
        "*", (F.col("supplier_count") > 1).alias("has_multi_supplier"),
        F.round(F.col("max_cost") - F.col("min_cost"), 4).cast("decimal(18,4)").alias("cost_spread"))


def supplier_dimension(totals: DataFrame) -> DataFrame:
    return totals.select(
        "supplier_name", "currency", F.col("parts").alias("parts_supplied"), money(F.when(F.col("prices") > 0, F.col("total"))).alias("total_listed_cost"),
        mean(F.when(F.col("prices") > 0, F.col("total")), F.col("prices")).alias("avg_cost_per_part"), F.col("low").alias("min_part_cost"),
        F.col("high").alias("max_part_cost"), F.col("last").alias("last_price_update_at"),
    ).withColumn("is_multi_part_supplier", F.col("parts_supplied") > 1)


def dim_supplier(cost: DataFrame) -> DataFrame:
    return supplier_dimension(SUPPLIER_TOTALS.compute(cost))


# Fact -----------------------------------------------------------------------------------------------

def price_position(cost: DataFrame, hot: Hot = EVEN) -> DataFrame:
    """Price list with each price set against the cheapest of its part and currency (ties are all cheapest)."""
    floor = cost.groupBy("part_id", "currency").agg(F.min("cost").alias("_floor"))
    return skew.join(cost, floor, ["part_id", "currency"], hot=hot.cost_parts).select(
        *cost.columns, (F.col("cost") == F.col("_floor")).alias("is_lowest_cost_supplier"),
        (F.col("cost") - F.col("_floor")).cast("decimal(18,4)").alias("cost_vs_cheapest"))


def fact_bom_cost(bom: DataFrame, revisions: DataFrame | None, cost: DataFrame, hot: Hot = EVEN, together: bool = False) -> DataFrame:
    """One row per (assembly, part, supplier); one row without supplier where a part has no price.

    Further columns of ``bom`` are passed through. ``together`` as in ``part_cost_view``.
    """
    rows = part_cost_view(bom, revisions, price_position(cost, hot), hot, together)
    more = rows.columns[len(VIEW_COLUMNS) + 3:-2]
    return rows.select(
        "assembly_id", "part_id", "supplier_name", "revision", "status", "quantity", "cost", "currency",
        "total_assembly_cost", "effective_from", "effective_to",
        F.col("has_active_revision").alias("is_current_revision"), "has_active_revision",
        "cost_data_available", "revision_data_available",
        F.coalesce("is_lowest_cost_supplier", F.lit(False)).alias("is_lowest_cost_supplier"), "cost_vs_cheapest", *more)


# Assembly totals ------------------------------------------------------------------------------------

def part_rates(cost: DataFrame, currencies: list[str]) -> DataFrame:
    """Per part: lowest and average price in every accepted currency, as one wide row."""
    aggregates = []
    for cur in currencies:
        price = F.when(F.col("currency") == cur, F.col("cost"))
        aggregates += [F.min(price).alias(f"low_{cur}"), F.avg(price).alias(f"mean_{cur}")]
    return cost.groupBy("part_id").agg(*aggregates)


def assembly_rollup(bom: DataFrame, cost: DataFrame, currencies: list[str] = CURRENCIES, hot: Hot = EVEN) -> DataFrame:
    """Per assembly: part counts, and totals per currency as a map keyed by currency.

    Prices are reduced to one row per part before they meet the BOM, so the join adds columns, not
    rows, and one combined aggregate on the assembly follows it.
    """
    lines = skew.join(bom.select("assembly_id", "part_id", "quantity", "has_active_revision"),
                      part_rates(cost, currencies), ["part_id"], hot=hot.bom_parts)
    qty = F.col("quantity")
    priced = F.coalesce(*[F.col(f"low_{cur}") for cur in currencies]).isNotNull()
    aggregates = [
        F.count("part_id").alias("total_parts_count"),
        F.count_if(priced).alias("parts_with_cost"),
        F.count_if("has_active_revision").alias("parts_with_current_revision"),
    ]
    for cur in currencies:
        aggregates += [
            F.sum(F.col(f"low_{cur}") * qty).alias(f"low_{cur}"),
            F.sum(F.col(f"mean_{cur}") * qty).alias(f"mean_{cur}"),
            F.count(f"low_{cur}").alias(f"n_{cur}"),
        ]
    sums = lines.groupBy("assembly_id").agg(*aggregates)
    totals = F.array(*[
        F.struct(F.lit(cur).alias("currency"), money(F.col(f"low_{cur}")).alias("low"),
                 money(F.col(f"mean_{cur}")).alias("mean"), F.col(f"n_{cur}").alias("n"))
        for cur in currencies])
    totals = F.filter(totals, lambda t: t["n"] > 0)
    # Main currency: most priced parts, ties by name.
    ranked = F.array_sort(F.transform(totals, lambda t: F.struct((-t["n"]).alias("k"), t["currency"].alias("c"))))
    total, with_cost = F.col("total_parts_count"), F.col("parts_with_cost")
    return sums.select(
        "assembly_id", "total_parts_count", "parts_with_cost", "parts_with_current_revision",
        percent(with_cost, total).alias("parts_coverage_pct"),
        percent(F.col("parts_with_current_revision"), total).alias("revision_coverage_pct"),
        banded([(with_cost == total, "Complete"), (with_cost * 100 >= total * 80, "Mostly Complete")],
               "Incomplete").alias("cost_data_completeness"),
        F.try_element_at(ranked, F.lit(1))["c"].alias("main_currency"),
        F.map_from_entries(F.transform(totals, lambda t: F.struct(
            t["currency"], F.struct(t["low"].alias("low"), t["mean"].alias("mean"))))).alias("totals"))


def agg_assembly_cost(bom: DataFrame, cost: DataFrame, hot: Hot = EVEN) -> DataFrame:
    """One row per (assembly, currency); an assembly without any price keeps one row."""
    rollup = assembly_rollup(bom, cost, hot=hot)
    return rollup.select("*", F.explode_outer("totals").alias("currency", "t")).select(
        "assembly_id", "currency", F.col("t.low").alias("min_total_assembly_cost"),
        F.col("t.mean").alias("avg_total_assembly_cost"), "total_parts_count", "parts_with_cost",
        "parts_with_current_revision", "parts_coverage_pct", "revision_coverage_pct", "cost_data_completeness",
        F.col("currency").eqNullSafe(F.col("main_currency")).alias("is_main_currency"))


# Supplier totals ------------------------------------------------------------------------------------

def agg_supplier_cost(bom: DataFrame, cost: DataFrame, hot: Hot = EVEN) -> DataFrame:
    """Spend and coverage per (supplier, currency), and one row for lines no supplier prices.

    Sums need only the BOM totals per part; the BOM × supplier rows are formed for the distinct count
    of assemblies alone, as two narrow columns.
    """
    per_part = bom.groupBy("part_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("qty"))
    offers = price_position(cost, hot).select("part_id", "supplier_name", "currency", "cost", "is_lowest_cost_supplier")
    # Offers are the larger side; parts without any keep one row.
    offered = skew.join(offers, per_part, ["part_id"], "inner", hot.cost_parts)
    bare = per_part.join(offers.select("part_id").distinct(), "part_id", "left_anti")
    used = offered.unionByName(bare, allowMissingColumns=True)
    spend = F.col("cost") * F.col("qty")
    lines = F.sum("lines")
    sums = used.groupBy("supplier_name", "currency").agg(
        lines.alias("parts_supplied"),
        money(F.sum(spend)).alias("total_extended_cost"),
        mean(F.sum(F.col("cost") * F.col("lines")), lines).alias("avg_unit_cost"),
        F.min("cost").alias("min_unit_cost"),
        F.max("cost").alias("max_unit_cost"),
        money(F.sum(F.when(F.col("is_lowest_cost_supplier"), spend).otherwise(0))).alias("lowest_cost_spend"))
    covered = skew.join(bom.select("part_id", "assembly_id"),
                        offers.select("part_id", "supplier_name", "currency"), ["part_id"], hot=hot.bom_parts)
    reach = covered.groupBy("supplier_name", "currency").agg(
        F.count_distinct("assembly_id").alias("assemblies_covered"))
    same = sums["supplier_name"].eqNullSafe(reach["supplier_name"]) & sums["currency"].eqNullSafe(reach["currency"])
    both = sums.join(reach, same, "left").select(sums["*"], reach["assemblies_covered"])
    # One row per accepted currency, plus one for null.
    grand = sums.groupBy(F.col("currency").alias("_cur")).agg(F.sum("lowest_cost_spend").alias("_total"))
    shared = both.join(F.broadcast(grand), both["currency"].eqNullSafe(grand["_cur"]), "left")
    base = F.coalesce(F.nullif(F.col("_total"), F.lit(0)), F.lit(1)).cast("double")
    share = F.round(F.col("lowest_cost_spend").cast("double") / base * 100, 2)
    return shared.select(
        "supplier_name", "currency", "parts_supplied", "assemblies_covered", "total_extended_cost", "avg_unit_cost",
        "min_unit_cost", "max_unit_cost", "lowest_cost_spend", share.alias("spend_share_pct"),
        banded([(share >= 30, "Strategic"), (share >= 10, "Preferred")], "Tactical").alias("supplier_tier"))


# Revision history and CAD activity --------------------------------------------------------------------

def agg_part_revision_history(revisions: DataFrame, hot: Hot = EVEN) -> DataFrame:
    rows = revisions.select(
        "part_id", "revision", "status", "effective_from", "effective_to", "is_current_revision",
        "revision_duration_days", "last_modified")
    chained = skew.ordered(
        rows, ["part_id"], ["effective_from", "revision"], lead={"next_revision": "revision"},
        rank=("revision_sequence", ["effective_from"]), hot=hot.revision_parts)
    return chained.select(
        "*", F.datediff("effective_to", "effective_from").alias("days_to_next_revision"),
        banded([
            (F.col("revision_sequence") == 1, "Initial Release"),
            (F.col("is_current_revision"), "Current"),
        ], "Superseded").alias("revision_stage"))


def agg_cad_activity(cad: DataFrame, processed_at: str = "_silver_processed_at") -> DataFrame:
    daily = cad.groupBy("file_date").agg(
        F.count("part_id").alias("files_processed"),
        F.count_distinct("part_id").alias("unique_files"),
        F.min(processed_at).alias("first_processed_at"),
        F.max(processed_at).alias("last_processed_at"))
    lag = F.datediff("first_processed_at", "file_date")
    return daily.select("*", lag.alias("processing_lag_days")).select("*", banded([
        (F.col("file_date").isNull(), "Unknown"),
        (F.col("processing_lag_days") == 0, "Same Day"),
        (F.col("processing_lag_days") <= 1, "Next Day"),
        (F.col("processing_lag_days") <= 3, "Within 3 Days"),
    ], "Delayed").alias("lag_status"))


# Impact ---------------------------------------------------------------------------------------------

def revision_impact(revisions: DataFrame, bom: DataFrame, cost: DataFrame, since: str, hot: Hot = EVEN) -> DataFrame:
    """Assemblies touched by parts revised after a date: how many parts, how many pieces, at what cost."""
    changed = revisions.where(F.col("last_modified") > F.lit(since).cast("timestamp")).groupBy("part_id").agg(
        F.max("last_modified").alias("revised_at"))
    main = supplier_stats(cost).select("part_id", "min_cost", "currency")
    parts = changed.join(main, "part_id", "left")
    lines = skew.join(bom.select("assembly_id", "part_id", "quantity"), parts, ["part_id"], "inner", hot.bom_parts)
    return lines.groupBy("assembly_id", "currency").agg(
        F.count("part_id").alias("revised_parts"), F.sum("quantity").alias("pieces"),
        money(F.sum(F.col("min_cost") * F.col("quantity"))).alias("cost_at_lowest_price"),
        F.max("revised_at").alias("last_revised_at"))
