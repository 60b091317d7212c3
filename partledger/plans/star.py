"""Star schema with hashed keys: dimensions and the three facts that point at them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.functions.columns import surrogate_key
from partledger.operators import history, skew
from partledger.operators.skew import EVEN, Hot, HotKeys

UNKNOWN = "unknown"


def key(name: str):
    return surrogate_key(F.col(name))


def dim_part(cad: DataFrame, *mentions: DataFrame) -> DataFrame:
    """Every part any source mentions, with its design data where there is some."""
    ids = reduce(DataFrame.union, [m.select("part_id") for m in (cad, *mentions)]).where("part_id is not null")
    design = cad.select("part_id", "part_name", "material", "weight_kg", "designer")
    return ids.distinct().join(design, "part_id", "left").select(
        key("part_id").alias("part_key"), "part_id", "part_name", "material", "weight_kg", "designer")


def dim_assembly(bom: DataFrame) -> DataFrame:
    ids = bom.select("assembly_id").where("assembly_id is not null").distinct()
    return ids.select(key("assembly_id").alias("assembly_key"), "assembly_id",
                      F.concat(F.lit("Assembly "), "assembly_id").alias("assembly_name"))


def dim_supplier(cost: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """Suppliers with their location, where a directory (supplier_name, location) is given."""
    names = cost.select("supplier_name").where("supplier_name is not null").distinct()
    if locations is None:
        located = names.withColumn("location", F.lit(None).cast("string"))
    else:
        located = names.join(locations.select("supplier_name", "location"), "supplier_name", "left")
    return located.select(key("supplier_name").alias("supplier_key"), "supplier_name", "location")


def dim_revision(revisions: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Type-2 revision dimension: the validity ends where the next revision starts."""
    chain = history.version_chain(revisions, "part_id", "effective_from", ["revision", "status"], tie=["revision"],
                                  hot=hot)
    return chain.select(
        surrogate_key(F.col("part_id"), F.col("revision"), F.col("valid_from").cast("date")).alias("revision_key"),
        "part_id", "revision", "status", F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"), "is_current")


def lookup_key(fact: DataFrame, dim: DataFrame, natural: str, surrogate: str, hot: HotKeys | None = None) -> DataFrame:
    """Add the dimension's key to the fact; rows the dimension lacks point at the unknown member."""
    found = skew.join(fact, dim.select(natural, surrogate), [natural], hot=hot)
    return found.withColumn(surrogate, F.coalesce(F.col(surrogate), F.lit(UNKNOWN)))


def fact_bom(bom: DataFrame) -> DataFrame:
    """Keys come from the natural keys by hash, so no dimension has to be joined."""
    return bom.select(key("assembly_id").alias("assembly_key"), key("part_id").alias("part_key"), "quantity")


def fact_cost(cost: DataFrame, parts: DataFrame, suppliers: DataFrame, hot: Hot = EVEN) -> DataFrame:
    with_part = lookup_key(cost, parts, "part_id", "part_key", hot.cost_parts)
    keyed = lookup_key(with_part, suppliers, "supplier_name", "supplier_key", hot.suppliers)
    return keyed.select("part_key", "supplier_key", "cost", "currency")


def fact_design(cad: DataFrame, revisions_dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Design rows with the revision in force when the design was created."""
    timed = cad.withColumn("_created", F.col("created_date").cast("timestamp"))
    matched = history.as_of(timed, revisions_dim, "part_id", "_created", "effective_from", ["revision_key"],
                            end="effective_to", tie=["revision"], hot=hot)
    return matched.select(key("part_id").alias("part_key"), "revision_key", "created_date", "weight_kg")
