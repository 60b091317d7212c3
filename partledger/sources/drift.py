"""Landing rows whose columns are not those that the schema has.

Columns the schema does not know are kept, with their values and nulls, in one variant column, so a source
that grows a column still loads. What came that way is reported with its type, and can be promoted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UNKNOWN = "_unknown"


def fit(df: DataFrame, schema: str | StructType) -> DataFrame:
    """The rows with the schema's columns, then ``_unknown``.

    Columns that the rows lack are null; a value that is not of the schema's type is null in its column and kept as it
    came in ``_unknown``, as are all columns that the schema lacks. ``_unknown`` is null where nothing is left over.
    Names are compared without case, as Spark does.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = {c.lower(): c for c in df.columns}

    def col(name: str):
        return F.col("`" + name.replace("`", "``") + "`")

    columns, left = [], []
    for f in wanted.fields:
        came = have.get(f.name.lower())
        if came is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        fitting = col(came) if df.schema[came].dataType == f.dataType else col(came).try_cast(f.dataType)
        columns.append(fitting.alias(f.name))
        if df.schema[came].dataType != f.dataType:
            left.append((came, col(came).isNotNull() & fitting.isNull()))
    known = {f.name.lower() for f in wanted.fields}
    extra = [c for c in df.columns if c.lower() not in known]
    if not extra and not left:
        return df.select(*columns, F.lit(None).cast("variant").alias(UNKNOWN))
    # An object for each row: all unknown columns, and those of the schema whose value did not fit.
    parts = [F.map_from_arrays(F.array(F.lit(c)), F.array(F.to_variant_object(F.struct(col(c).alias("v"))))) for c in extra]
    parts += [F.when(bad, F.map_from_arrays(F.array(F.lit(c)), F.array(F.to_variant_object(F.struct(col(c).alias("v")))))) for c, bad in left]
    nothing = F.create_map().cast("map<string,variant>")
    held = F.map_concat(*[F.coalesce(p, nothing) for p in parts]) if len(parts) > 1 else F.coalesce(parts[0], nothing)
    values = F.transform_values(held, lambda _, v: F.variant_get(v, "$.v", "variant"))
    return df.select(*columns, F.when(F.size(held) > 0, F.to_variant_object(values)).alias(UNKNOWN))


def unknown_columns(landed: DataFrame) -> DataFrame:
    """``column_name, row_count, null_count, column_type`` of what lies in ``_unknown``: one pass, grouped by name."""
    each = landed.select(UNKNOWN).lateralJoin(landed.sparkSession.tvf.variant_explode(F.col(UNKNOWN).outer()))
    return each.groupBy(F.col("key").alias("column_name")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.is_variant_null("value")).alias("null_count"),
        F.schema_of_variant_agg("value").alias("column_type"))


def promote(landed: DataFrame, column: str, kind: str) -> DataFrame:
    """The rows with an unknown column as a column of its own: null where it was not there, or is not of this type.

    Paths into a variant have no escapes, so a name with both kinds of quotes cannot be promoted.
    """
    if '"' in column and "'" in column:
        raise ValueError(f"no path names the column {column}")
    path = f"$['{column}']" if '"' in column else f'$["{column}"]'
    return landed.withColumn(column, F.try_variant_get(UNKNOWN, path, kind))
