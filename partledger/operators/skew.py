"""Joins and ordered windows that hold when one key owns a large share of the rows.

Catalyst splits skewed join sides only where both sides arrive straight from an exchange, and it
never splits a window group. The operators here treat the few keys above a row limit on their own
and leave every other key to the ordinary plan. No row is dropped on either path.

Hot keys are found once per table (``find``), on one column of the stored table, and handed to every
operator that joins or orders by that key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from partledger.functions.columns import code, content_hash
from partledger.session import shared_dir

# A group of up to this many rows is ordinary work for one task.
GROUP_ROWS = 2_000_000
# Hash bands that rows are counted in before any key is: a key above the limit makes its band larger than the limit.
BANDS = 4096


@dataclass(frozen=True)
class HotKeys:
    """The keys above the limit: ``rows`` is a written table of the key columns and ``_rows``, their row
    counts. It has at most as many rows as the limit goes into the table, and is joined, not broadcast:
    Spark broadcasts it where its size allows that."""

    rows: DataFrame
    keys: tuple[str, ...]
    limit: int

    @property
    def total(self) -> int:
        return self.rows.agg(F.sum("_rows")).first()[0]


def _bands(df: DataFrame, keys: Sequence[Sequence[str]], group_rows: int) -> list[list[int]]:
    """For each set of key columns, the hash bands with more rows than the limit. One pass that moves a number per band."""
    numbers = F.array(*[F.pmod(F.xxhash64(*ks), F.lit(BANDS)).cast("int") + i * BANDS for i, ks in enumerate(keys)])
    counts = df.select(F.explode(numbers).alias("_band")).groupBy("_band").agg(F.count(F.lit(1)).alias("_rows"))
    full = sorted(r[0] for r in counts.where(F.col("_rows") > group_rows).collect())  # at most the number of bands
    return [[b % BANDS for b in full if b // BANDS == i] for i in range(len(keys))]


def _in_bands(keys: Sequence[str], bands: Sequence[int]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BANDS)).cast("int").isin(list(bands))


def find(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> HotKeys | None:
    """Keys (null included) with more rows than the limit; None when there are none.

    Rows are counted by hash band first; only keys of bands above the limit are counted one by one. Tables
    of every size are counted, against the same limit.
    """
    return _find_in(df, keys, _bands(df, [keys], group_rows)[0], group_rows)


def _find_in(df: DataFrame, keys: Sequence[str], bands: Sequence[int], group_rows: int) -> HotKeys | None:
    if not bands:
        return None
    counts = df.where(_in_bands(keys, bands)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > group_rows)
    path = shared_dir(df.sparkSession, "hot-keys")
    counts.write.parquet(path)
    found = df.sparkSession.read.schema(counts.schema).parquet(path)
    return None if found.isEmpty() else HotKeys(found, tuple(keys), group_rows)


def find_each(df: DataFrame, columns: Sequence[str], group_rows: int = GROUP_ROWS) -> dict[str, HotKeys | None]:
    """Hot values of each of some text columns, from one pass over the bands of all of them."""
    bands = dict(zip(columns, _bands(df, [[c] for c in columns], group_rows)))
    return {c: _find_in(df, [c], bands[c], group_rows) for c in columns}


class Hot:
    """Hot keys of the source tables. A table is read when an operator first asks for one of its keys, once for
    all of them."""

    KEYS = {"bom": ("part_id", "assembly_id"), "cost": ("part_id", "supplier_name"), "revisions": ("part_id",), "cad": ("part_id",)}

    def __init__(self, tables: Mapping[str, Callable[[], DataFrame]] | None = None, group_rows: int = GROUP_ROWS):
        self.tables, self.group_rows = tables or {}, group_rows
        self._found: dict[str, dict[str, HotKeys | None]] = {}

    @staticmethod
    def measure(bom: DataFrame, cost: DataFrame, revisions: DataFrame, group_rows: int = GROUP_ROWS,
                cad: DataFrame | None = None) -> Hot:
        tables = {"bom": bom, "cost": cost, "revisions": revisions} | ({} if cad is None else {"cad": cad})
        return Hot({name: lambda df=df: df for name, df in tables.items()}, group_rows)

    def _of(self, table: str, column: str) -> HotKeys | None:
        if table not in self.tables:
            return None
        if table not in self._found:
            # Keys as they are after cleaning.
            df, plain = self.tables[table](), {"supplier_name": code}
            self._found[table] = find_each(
                df.select(*[plain.get(c, F.trim)(F.col(c)).alias(c) for c in self.KEYS[table]]), self.KEYS[table], self.group_rows)
        return self._found[table][column]

    @cached_property
    def bom_parts(self) -> HotKeys | None:
        return self._of("bom", "part_id")

    @cached_property
    def assemblies(self) -> HotKeys | None:
        return self._of("bom", "assembly_id")

    @cached_property
    def cost_parts(self) -> HotKeys | None:
        return self._of("cost", "part_id")

    @cached_property
    def suppliers(self) -> HotKeys | None:
        return self._of("cost", "supplier_name")

    @cached_property
    def revision_parts(self) -> HotKeys | None:
        return self._of("revisions", "part_id")

    @cached_property
    def cad_parts(self) -> HotKeys | None:
        return self._of("cad", "part_id")


EVEN = Hot()


def _matches(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & df[k].eqNullSafe(small[k])
    return test


def join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
         hot: HotKeys | None = None) -> DataFrame:
    """Equi-join whose hot left keys (all or some of the join columns) are spread over several tasks.

    Rows of a hot key get a salt from their content; the matching right rows are repeated once per
    salt. All other rows carry salt 0, so the result equals the plain join. Null is a key like others
    here: where it is hot its rows are spread, though they match nothing.
    """
    if hot is None:
        return left.join(right, list(keys), how)
    ways = F.ceil(F.col("_rows") / hot.limit).cast("int").alias("_ways")

    def with_ways(df: DataFrame) -> DataFrame:
        spread = hot.rows.select(*[F.col(k).alias(f"_hot_{k}") for k in hot.keys], ways)
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(spread[f"_hot_{k}"]) for k in hot.keys])
        return df.join(spread, same, "left").drop(*[f"_hot_{k}" for k in hot.keys])

    n = F.coalesce(F.col("_ways"), F.lit(1))
    salt = F.pmod(content_hash(left), n).cast("int")
    salted_left = with_ways(left).withColumn("_salt", salt).drop("_ways")
    salted_right = with_ways(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_ways")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    carry: Mapping[str, str] | None = None,
    rank: tuple[str, Sequence[str]] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ordered-window columns per key: next value, previous value, last known value, rank.

    ``lead``/``lag``/``carry`` map a new column to its source; ``rank`` is (new column, leading part
    of ``order`` that decides it; ties share a number). ``order`` must be total within a key.

    Hot keys are cut into ranges of that order, solved range by range, and the seams are closed from
    one small row per range.
    """
    lead, lag, carry = dict(lead or {}), dict(lag or {}), dict(carry or {})
    if hot is None:
        return _plain(df, keys, order, lead, lag, carry, rank)
    hot_only = hot.rows.select(*keys)
    cold = df.join(hot_only, _matches(df, hot_only, keys), "left_anti")
    picked = df.join(hot_only, _matches(df, hot_only, keys), "left_semi")
    ranged = _cut_into_ranges(picked, keys, order, max(2, -(-hot.total // hot.limit) * 2))
    return _plain(cold, keys, order, lead, lag, carry, rank).unionByName(
        _by_range(ranged, keys, order, lead, lag, carry, rank)
    )


def _plain(df, keys, order, lead, lag, carry, rank):
    w = Window.partitionBy(*keys).orderBy(*order)
    new = {n: F.lead(c).over(w) for n, c in lead.items()}
    new |= {n: F.lag(c).over(w) for n, c in lag.items()}
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new |= {n: F.last(c, ignorenulls=True).over(running) for n, c in carry.items()}
    if rank:
        new[rank[0]] = F.rank().over(Window.partitionBy(*keys).orderBy(*rank[1]))
    return df.withColumns(new)


def _cut_into_ranges(df, keys, order, ranges):
    """Write the rows range-partitioned by key and order, numbered by range.

    The range bounds come from a sample, so they are settled once, in a written table; every reader
    of the table, and every retry, then sees the same ranges.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "ordered-ranges")
    df.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(StructType([*df.schema.fields, StructField("_range", IntegerType())])).parquet(path)


def _by_range(ranged, keys, order, lead, lag, carry, rank):
    columns = [c for c in ranged.columns if c != "_range"]
    place = [*keys, "_range"]
    local = _plain(ranged, place, order, lead, lag, carry, None)
    w = Window.partitionBy(*place).orderBy(*order)
    local = local.withColumn("_at_end", F.lead(F.lit(1)).over(w).isNull()).withColumn(
        "_at_start", F.lag(F.lit(1)).over(w).isNull())

    at = F.struct(*order)
    edge = [F.count(F.lit(1)).alias("_n")]
    edge += [F.min_by(c, at).alias(f"_first_{n}") for n, c in lead.items()]
    edge += [F.max_by(c, at).alias(f"_last_{n}") for n, c in lag.items()]
    edge += [F.max(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v"))))["v"].alias(f"_known_{n}")
             for n, c in carry.items()]
    if rank:
        by = F.struct(*rank[1])
        local = local.withColumn("_rank", F.rank().over(Window.partitionBy(*place).orderBy(*rank[1])))
        local = local.withColumn("_by", by)
        edge += [F.min(by).alias("_first_by"), F.max(by).alias("_last_by"), F.max("_rank").alias("_last_rank")]

    # One row per (key, range): as many as there are ranges, plus one per hot key.
    over_ranges = Window.partitionBy(*keys).orderBy("_range")
    before = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    seams = local.groupBy(*place).agg(*edge)
    seams = seams.withColumns(
        {f"_next_{n}": F.lead(f"_first_{n}").over(over_ranges) for n in lead}
        | {f"_prev_{n}": F.lag(f"_last_{n}").over(over_ranges) for n in lag}
        | {f"_past_{n}": F.last(f"_known_{n}", ignorenulls=True).over(before) for n in carry}
        | {"_rows_before": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    )
    if rank:
        # A run of equal values may span ranges; it takes the rank it has where it begins.
        opening = F.min(F.col("_rows_before") + F.col("_last_rank")).over(Window.partitionBy(*keys, "_last_by"))
        seams = seams.withColumn("_run_rank", opening)
        continues = F.lag("_last_by").over(over_ranges).eqNullSafe(F.col("_first_by"))
        seams = seams.withColumn(
            "_start_rank",
            F.when(continues, F.lag("_run_rank").over(over_ranges)).otherwise(F.col("_rows_before") + 1))
        seams = seams.withColumnRenamed("_first_by", "_opening_by")
    keep = place + [c for c in seams.columns
                    if c.startswith(("_next_", "_prev_", "_past_", "_rows_before", "_start_rank", "_opening_by"))]
    seams = seams.select(*keep).withColumnsRenamed({k: f"_k_{k}" for k in place})
    same = F.lit(True)
    for k in place:
        same = same & local[k].eqNullSafe(seams[f"_k_{k}"])
    joined = local.join(seams, same, "left")

    out = [F.col(c) for c in columns]
    out += [F.when(F.col("_at_end"), F.col(f"_next_{n}")).otherwise(F.col(n)).alias(n) for n in lead]
    out += [F.when(F.col("_at_start"), F.col(f"_prev_{n}")).otherwise(F.col(n)).alias(n) for n in lag]
    out += [F.coalesce(F.col(n), F.col(f"_past_{n}")).alias(n) for n in carry]
    if rank:
        in_opening_run = F.col("_by").eqNullSafe(F.col("_opening_by"))
        value = F.when(in_opening_run, F.col("_start_rank")).otherwise(F.col("_rows_before") + F.col("_rank"))
        out.append(value.cast("int").alias(rank[0]))
    return joined.select(*out)
