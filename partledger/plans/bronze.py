"""Bronze: source rows as they came, stamped, newest per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.context import RunContext
from partledger.functions.columns import file_date
from partledger.operators.dedup import latest_per_key


def stamp(df: DataFrame, path: str, domain: str, ctx: RunContext) -> DataFrame:
    """Where a row came from and which run brought it."""
    return df.select(
        "*", F.lit(path).alias("_source_path"), F.lit(domain).alias("_source_domain"),
        ctx.ts.alias("_bronze_ingested_at"), F.lit(ctx.run_id).alias("_bronze_pipeline_run"))


def cad_metadata(raw: DataFrame) -> DataFrame:
    """Newest row per part by the date in its file's name, then by the file; undated files come first.
    Repeats within a file are ordered as silver orders them, weights as numbers."""
    dated = raw.withColumns({"_file_date": file_date(F.col("_source_file")),
                             "_weight": F.col("weight_kg").try_cast("decimal(18,4)")})
    order = ["_file_date", "_source_file", "created_date", "designer", "material", "part_name", "_weight"]
    return latest_per_key(dated, ["part_id"], order).drop("_file_date", "_weight")


def plm_revisions(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["part_id", "revision"], ["last_modified"])


def plm_bom(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["assembly_id", "part_id"], ["last_modified"])


def erp_cost(raw: DataFrame) -> DataFrame:
    priced = raw.withColumn("_cost", F.col("cost").try_cast("decimal(18,4)"))
    return latest_per_key(priced, ["part_id", "supplier_name"], ["last_updated", "_cost"]).drop("_cost")
