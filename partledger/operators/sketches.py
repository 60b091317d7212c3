"""Small summaries of columns that are stored per run and merged, instead of reading the rows again.

A state row holds, for one column of one table and run, its counts, its extremes, a HyperLogLog sketch of its
values and, for numbers and times, a KLL sketch of their distribution. States merge exactly: the HyperLogLog
sketch of all rows is the union of the parts', the KLL sketch keeps its stated rank error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12          # 4,096 registers
HLL_ERROR = 0.05       # three standard errors, 1.04 / sqrt(4,096) each
KLL_SIZE = 400
KLL_ERROR = 0.01       # of ranks, at this size
ORDERED = (T.NumericType, T.DateType, T.TimestampType)


def _number(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    return column.cast("double")


def summarise(table: str, rows: DataFrame, run: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``table_name, column_name, run, row_count, nulls, low, high, distinct_state, rank_state``: one pass over the
    columns, whose partial sketches meet as one row a task."""
    fields = [f for f in rows.schema.fields if columns is None or f.name in columns]
    cells = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        ordered = isinstance(f.dataType, ORDERED)
        number = _number(c, f.dataType) if ordered else F.lit(None).cast("double")
        cells.append(F.struct(
            F.count(F.lit(1)).alias("row_count"), F.count_if(c.isNull()).alias("nulls"), F.min(c.cast("string") if not ordered else c).cast("string").alias("low"),
            F.max(c.cast("string") if not ordered else c).cast("string").alias("high"),
            F.hll_sketch_agg(c.cast("string"), F.lit(HLL_BITS)).alias("distinct_state"),
            (F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)) if ordered else F.lit(None).cast("binary")).alias("rank_state"),
            F.lit(ordered).alias("ordered")).alias(f.name))
    one = rows.agg(*cells)
    each = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("s")) for f in fields]))
    return one.select(each.alias("e")).select(F.lit(table).alias("table_name"), "e.column_name", F.lit(run).alias("run"), "e.s.*")


def merge(states: DataFrame, by: Sequence[str] = ("table_name", "column_name")) -> DataFrame:
    """States of several runs as one for each column. Extremes are left out: they are kept as text, by run."""
    return states.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_state").alias("distinct_state"), F.when(F.max("ordered"), F.kll_merge_agg_double("rank_state")).alias("rank_state"),
        F.max("ordered").alias("ordered"))


def distinct_values(state: Column) -> Column:
    """Estimated number of distinct values other than null."""
    return F.hll_sketch_estimate(state)


def shift(states: DataFrame, before: str, after: str, points: int = 100) -> DataFrame:
    """``table_name, column_name, distance``: how far apart a column's distributions in two runs are, as the
    largest difference of ranks (0 alike, 1 apart) at quantiles of the first. Computed from the stored states
    alone; the error is that of both sketches and of the step between two quantiles."""
    own = states.where("ordered AND row_count > nulls")
    at = F.array(*[F.lit(i / points) for i in range(points + 1)])
    cuts = own.select("table_name", "column_name", "run", F.kll_sketch_get_quantile_double("rank_state", at).alias("q"))
    a = cuts.where(F.col("run") == before).select("table_name", "column_name", F.col("q").alias("a"))
    b = cuts.where(F.col("run") == after).select("table_name", "column_name", F.col("q").alias("b"))

    def rank(q: str, v: Column) -> Column:
        return F.size(F.filter(q, lambda x: x <= v)) / F.lit(points + 1)

    gaps = F.transform("a", lambda v: F.abs(rank("a", v) - rank("b", v)))
    return a.join(b, ["table_name", "column_name"]).select("table_name", "column_name", F.array_max(gaps).alias("distance"))
