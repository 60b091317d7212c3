"""Silver: typed, normalised, validated, deduplicated, joined to the current revision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger import context as c
from partledger.context import RunContext
from partledger.functions.columns import code, drop_prefixed, file_date, money, title_case, trimmed_strings
from partledger.operators import skew
from partledger.operators.dedup import latest_per_key
from partledger.operators.skew import EVEN, Hot
from partledger.operators.rules import REASON, Rule, Verdict, quarantine


def stamp(df: DataFrame, source_table: str, ctx: RunContext) -> DataFrame:
    return df.select(
        "*", F.lit(source_table).alias("_silver_source_table"), ctx.ts.alias("_silver_processed_at"),
        F.lit(ctx.run_id).alias("_silver_pipeline_run"))


# Rules, in the order they are tried -----------------------------------------------------------------

CAD_RULES = lambda: [Rule(c.REASON_NO_PART, F.col("part_id").isNotNull())]
REVISION_RULES = lambda: [
    Rule(c.REASON_NO_START, F.col("effective_from").isNotNull()),
    Rule(c.REASON_STATUS, F.col("status").isin(c.STATUSES)),
]
BOM_RULES = lambda: [Rule(c.REASON_QUANTITY, F.col("quantity") > 0)]
COST_RULES = lambda: [
    Rule(c.REASON_COST, F.col("cost") > 0),
    Rule(c.REASON_CURRENCY, F.col("currency").isin(c.CURRENCIES)),
]


# CAD ------------------------------------------------------------------------------------------------

def judge_cad(bronze: DataFrame) -> Verdict:
    typed = trimmed_strings(bronze).withColumns({
        "weight_kg": F.col("weight_kg").try_cast("decimal(18,4)"),
        "created_date": F.col("created_date").try_cast("date"),
        "file_date": file_date(F.col("_source_file")),
    })
    return quarantine(typed, CAD_RULES())


def cad_metadata(bronze: DataFrame) -> DataFrame:
    """Newest row per part by file date, then file."""
    rows = judge_cad(bronze).clean
    return drop_prefixed(latest_per_key(rows, ["part_id"], ["file_date", "_source_file"]))


# Revisions ------------------------------------------------------------------------------------------

def judge_revisions(bronze: DataFrame) -> Verdict:
    typed = bronze.withColumns({
        "part_id": F.trim("part_id"),
        "revision": code(F.col("revision")),
        "status": title_case(F.col("status")),
        **{t: F.col(t).try_cast("timestamp") for t in ("effective_from", "effective_to", "last_modified")},
    })
    return quarantine(typed, REVISION_RULES())


def plm_revisions(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    rows = drop_prefixed(judge_revisions(bronze).clean)
    newest = latest_per_key(rows, ["part_id", "revision"], ["last_modified"])
    end = F.coalesce(F.col("effective_to").cast("date"), ctx.today)
    return newest.select(
        "*", F.col("effective_to").isNull().alias("is_current_revision"),
        F.datediff(end, "effective_from").alias("revision_duration_days"))


def current_revision(revisions: DataFrame) -> DataFrame:
    """One open revision per part: the one that started last, ties by revision name."""
    open_rows = revisions.where("is_current_revision")
    fields = ["revision", "status", "effective_from", "effective_to", "revision_duration_days"]
    newest = F.max_by(F.struct(*fields), F.struct("effective_from", "revision"))
    return open_rows.groupBy("part_id").agg(newest.alias("r")).select("part_id", "r.*")


# Bill of materials ----------------------------------------------------------------------------------

def judge_bom(bronze: DataFrame) -> Verdict:
    typed = bronze.withColumns({
        "assembly_id": F.trim("assembly_id"),
        "part_id": F.trim("part_id"),
        "quantity": F.col("quantity").try_cast("int"),
        "last_modified": F.col("last_modified").try_cast("timestamp"),
    })
    return quarantine(typed, BOM_RULES())


def bom_lines(bronze: DataFrame) -> DataFrame:
    """Valid lines, newest per (assembly, part)."""
    return latest_per_key(drop_prefixed(judge_bom(bronze).clean), ["assembly_id", "part_id"], ["last_modified"])


def plm_bom(bronze: DataFrame, revisions: DataFrame, hot: Hot = EVEN) -> DataFrame:
    return with_current_revision(bom_lines(bronze), revisions, hot)


def with_current_revision(lines: DataFrame, revisions: DataFrame, hot: Hot = EVEN) -> DataFrame:
    now = current_revision(revisions).select(
        "part_id", F.col("revision").alias("current_revision"), F.col("status").alias("current_status"))
    return skew.join(lines, now, ["part_id"], hot=hot.bom_parts).select("*", F.col("current_revision").isNotNull().alias("has_active_revision"))


def with_open_revision(lines: DataFrame, revisions: DataFrame, hot: Hot = EVEN, together: bool = False) -> DataFrame:
    """Lines with all columns of their part's current revision, from one join: what ``part_cost_view`` can take as it is.
    ``together`` puts the lines of a part one after another: columns of the part then take next to no room in files."""
    return skew.join(lines, _merged(current_revision(revisions), together), ["part_id"], hot=hot.bom_parts).select(
        "*", F.col("revision").alias("current_revision"), F.col("status").alias("current_status"),
        F.col("revision").isNotNull().alias("has_active_revision"))


def _merged(right: DataFrame, together: bool) -> DataFrame:
    return right.hint("merge") if together else right


# Supplier cost --------------------------------------------------------------------------------------

def judge_cost(bronze: DataFrame) -> Verdict:
    typed = bronze.withColumns({
        "part_id": F.trim("part_id"),
        "supplier_name": code(F.col("supplier_name")),
        "currency": code(F.col("currency")),
        "cost": F.col("cost").try_cast("decimal(18,4)"),
        "last_updated": F.col("last_updated").try_cast("timestamp"),
    })
    return quarantine(typed, COST_RULES())


def erp_cost(bronze: DataFrame) -> DataFrame:
    return latest_per_key(drop_prefixed(judge_cost(bronze).clean), ["part_id", "supplier_name"], ["last_updated"])


JUDGES = {"cad_metadata": judge_cad, "plm_revisions": judge_revisions, "plm_bom": judge_bom, "erp_cost": judge_cost}


def judge_arrivals(name: str, raw: DataFrame) -> Verdict:
    """Judge rows as they arrive: the clean ones unchanged, the rejected ones typed, with their reason."""
    verdict = JUDGES[name](raw.withColumn("_raw", F.struct(*raw.columns)))
    return Verdict(verdict.clean.select("_raw.*"), verdict.rejected.drop("_raw"), verdict.judged.select("_raw.*", REASON))


# Conformed ------------------------------------------------------------------------------------------

VIEW_COLUMNS = [
    "part_id", "assembly_id", "quantity", "current_revision", "has_active_revision", "revision", "status",
    "effective_from", "effective_to", "revision_duration_days", "supplier_name", "cost", "currency", "last_updated",
]


LINE_COLUMNS = ["assembly_id", "part_id", "quantity", "current_revision", "has_active_revision"]
REVISION_COLUMNS = ["revision", "status", "effective_from", "effective_to", "revision_duration_days"]


def part_cost_view(bom: DataFrame, revisions: DataFrame | None, cost: DataFrame, hot: Hot = EVEN, together: bool = False) -> DataFrame:
    """Every BOM line with its current revision and every supplier's price for the part. Without ``revisions``
    the lines carry their revision already (``with_open_revision``).

    Columns of ``bom`` and ``cost`` beyond the usual ones are passed through, so figures of the
    assembly or the part can be joined to the lines before they fan out over the suppliers. ``together`` as in
    ``with_open_revision``.
    """
    known = [*LINE_COLUMNS, *VIEW_COLUMNS, "last_modified", "current_status"]
    more = [x for x in bom.columns if x not in known and not x.startswith("_")]
    if revisions is None:
        with_revision = bom.select(*LINE_COLUMNS, *REVISION_COLUMNS, *more)
    else:
        now = _merged(current_revision(revisions), together)
        with_revision = skew.join(bom.select(*LINE_COLUMNS, *more), now, ["part_id"], hot=hot.bom_parts)
    priced = skew.join(with_revision, _merged(cost, together), ["part_id"], hot=hot.bom_parts)
    extra = more + [x for x in cost.columns if x not in VIEW_COLUMNS]
    return priced.select(
        *VIEW_COLUMNS,
        money(F.col("cost") * F.col("quantity")).alias("total_assembly_cost"),
        F.col("cost").isNotNull().alias("cost_data_available"),
        F.col("revision").isNotNull().alias("revision_data_available"),
        *extra)
