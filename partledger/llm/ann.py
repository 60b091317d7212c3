"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by pseudo-random rotations, each three rounds of random signs and a fast
Hadamard transform, and falls into the cell of the nearest signed axis. Each of several tables has
its own rotations. A query looks into the cells of its nearest axes in every table, and all vectors
found there are ranked by their exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partledger.llm.common import stored

TABLES = 8
PROBES = 16           # cells a query looks into, in each table, at first
SEED = 11
CELL_VECTORS = None   # a cell with more is split by the nearest axis of a second rotation; None: no cell is
SPLIT_SHARE = 4       # a query looks into one in so many parts of a split cell, the nearest ones
ENOUGH = 256          # vectors a query must meet in one table; those that meet fewer look into more cells
PART_ROWS = 4096      # vectors, or queries, of a cell that one group holds at most, about


def hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def axis_scores(unit: np.ndarray, table: int, number: int) -> np.ndarray:
    """How near each vector is to each of the 2d signed axes after one rotation."""
    d = 1 << max(0, unit.shape[1] - 1).bit_length()
    x = np.pad(unit, ((0, 0), (0, d - unit.shape[1])))
    signs = np.random.Generator(np.random.Philox(key=[SEED, table * 64 + number])).integers(0, 2, (3, d)) * 2 - 1
    for s in signs:
        x = hadamard(x * s)
    return np.concatenate([x, -x], axis=1)


def nearest_axes(unit: np.ndarray, table: int, number: int, count: int) -> np.ndarray:
    """The ``count`` signed axes nearest to each vector after one rotation, nearest first."""
    return np.argsort(-axis_scores(unit, table, number), axis=1, kind="stable")[:, :count]


def _rows(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _hasher(tables: int, probes: int | None, splits: int):
    """Cells of each vector: the ``probes`` nearest (None: all) and, of a split cell, one in ``splits`` parts
    (0: the vector's own one, 1: all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            for size in sorted(set(pa.compute.list_value_length(vectors).to_pylist())):
                keep = pa.compute.equal(pa.compute.list_value_length(vectors), size)
                some = pa.RecordBatch.from_arrays([ids, vectors], ["a", "b"]).filter(keep)
                x = _rows(some.column(1))
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                axes = 2 << max(0, size - 1).bit_length()
                for t in range(tables):
                    cell = nearest_axes(unit, t, 0, probes or axes)
                    parts = nearest_axes(unit, t, 1, -(-axes // splits) if splits else 1)
                    again = np.repeat(np.arange(len(x)), cell.shape[1])
                    bounds = np.arange(len(again) + 1, dtype=np.int32) * parts.shape[1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(again), size, np.int32)), pa.array(np.full(len(again), t, np.int32)),
                        pa.array(cell.ravel()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(parts[again].ravel())),
                        some.column(0).take(pa.array(again)), some.column(1).take(pa.array(again))],
                        ["size", "table", "cell", "parts", "id", "vector"])
    return run


def _best(own: np.ndarray, q: np.ndarray, ids: list[np.ndarray], v: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of the vectors of a cell for each query that looks into it."""
    score, out = q @ v.T, []
    # A vector may stand for its query's own row only, so one more than k can matter.
    n = min(k + 1, score.shape[1])
    least = -np.sort(-score, axis=1)[:, n - 1] if n < score.shape[1] else np.full(len(q), -np.inf)
    for i in range(len(q)):
        best = np.flatnonzero(score[i] >= least[i])  # with all that tie with the last of them
        vec, s = np.concatenate([ids[b] for b in best]), np.repeat(score[i, best], [len(ids[b]) for b in best])
        other = vec != own[i]
        vec, s = vec[other], s[other]
        top = np.lexsort((vec, -s))[:k]
        out.append((np.full(len(top), own[i]), vec[top], s[top]))
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(x) for x in zip(*out)))))


def _rank(k: int):
    def rank(key, found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        seekers = dict(list(asked.groupby(["size", "table", "cell"], sort=False)))
        for cell, held in found.groupby(["size", "table", "cell"], sort=False):
            if cell in seekers:
                some = seekers[cell]
                out.append(_best(some["id"].to_numpy(np.int64), np.stack(some["vector"].to_numpy()).astype(np.float64),
                                 [np.asarray(i, np.int64) for i in held["id"]], np.stack(held["vector"].to_numpy()).astype(np.float64), k))
        return pd.concat(out[1:] or out)
    return rank


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, crowded: int | None = CELL_VECTORS, enough: int = ENOUGH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows found nearest to each query, by inner product.

    Every row is indexed and every row is a candidate but those with the query's own id. Equal scores go
    to the smaller id. Vectors that are null, zero or hold null or non-finite components take no part,
    nor do rows without id; vectors of another length are no candidates. Repeated rows count once. An empty
    table, of rows or of queries, gives no rows. Other columns, texts among them, are not read.
    Equal vectors are indexed once, with the k + 1 smallest of their ids: their scores are the same, so
    no other of them can be among a query's k.

    What a query looks into follows from the density round it, not from the size of the table. With ``crowded``, cells
    of more vectors are split by a second rotation, and a query looks into the nearest quarter of the parts. A query that meets fewer than
    ``enough`` vectors in every table looks into four times as many cells, and so on up to all of one table,
    which hold every vector of its length: few candidates are all found.
    """
    def sound(df: DataFrame) -> DataFrame:
        x = F.col("vector")
        finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        return df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
            F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0)).distinct()

    # The row-number filter keeps k + 1 rows of a key in every task before the shuffle.
    smallest = Window.partitionBy("vector").orderBy("id")
    few = sound(rows).withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    distinct = stored(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("id")).select("id", "vector"), "vectors")
    asked = stored(sound(queries), "queries")
    longest = distinct.agg(F.max(F.size("vector"))).first()[0] or 1
    axes = 2 << max(0, longest - 1).bit_length()
    kind = "size int, `table` int, cell long, parts array<long>, id {}, vector array<double>"
    place = ["size", "table", "cell"]

    # Split cells have a number of their own for each part.
    whole = distinct.mapInArrow(_hasher(tables, 1, 0), kind.format("array<long>"))
    cells = stored(whole.groupBy(*place).agg(F.count(F.lit(1)).alias("vectors")), "cells")  # as many as axes, at most
    part_of = F.array(F.lit(-1).cast("long"))
    if crowded is not None:
        part_of = F.when(F.col("vectors") > crowded, F.col("parts")).otherwise(part_of)

    def parted(df: DataFrame) -> DataFrame:
        each = df.join(cells, place).withColumn("part", F.explode(part_of))
        return each.withColumn("cell", F.col("cell") * (2 * axes) + F.col("part") + 1).drop("vectors", "parts", "part")

    index = stored(parted(whole), "index")
    held_in = stored(index.groupBy(*place).agg(F.count(F.lit(1)).alias("vectors")), "filled")
    same_query = ["id", "query"]
    pending, looks = asked, None
    while True:
        last = probes >= axes
        hasher = _hasher(1, None, 1) if last else _hasher(tables, probes, SPLIT_SHARE)
        now = stored(parted(pending.mapInArrow(hasher, kind.format("long"))).withColumn("query", F.xxhash64("vector")), "looks")
        if not last:
            met = now.join(held_in, place).groupBy(*same_query, "table").agg(F.sum("vectors").alias("met"))
            sated = stored(met.groupBy(*same_query).agg(F.max("met").alias("met")).where(F.col("met") >= enough).drop("met"), "sated")
            now = now.join(sated, same_query, "left_semi")
            pending = stored(pending.withColumn("query", F.xxhash64("vector")).join(sated, same_query, "left_anti").drop("query"), "queries")
        looks = now.drop("query") if looks is None else looks.unionByName(now.drop("query"))
        if last or pending.isEmpty():
            break
        probes *= 4

    # Large cells are cut into a grid of parts of vectors and parts of queries.
    ways = lambda df, name: df.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias(name))
    grid = held_in.withColumn("v_ways", F.ceil(F.col("vectors") / PART_ROWS).cast("int")).join(ways(looks, "q_ways"), place)
    # Small cells are ranked several in a group: the bundle holds PART_ROWS vectors, about.
    bundles, together = held_in.agg(F.ceil(F.sum("vectors") / PART_ROWS).cast("int"), F.count(F.lit(1))).first()
    grid, bundle = stored(grid, "grid"), F.pmod(F.xxhash64(*place), F.lit(max(1, min(bundles or 1, together))))
    part = lambda name: F.pmod(F.xxhash64("id"), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    group = ["bundle", "v_part", "q_part"]
    held = index.join(grid, place).withColumn("v_part", part("v_ways")).withColumn("q_part", every("q_ways")).withColumn("bundle", bundle)
    sought = looks.join(grid, place).withColumn("q_part", part("q_ways")).withColumn("v_part", every("v_ways")).withColumn("bundle", bundle)
    found = held.select(*group, *place, "id", "vector").groupBy(*group).cogroup(
        sought.select(*group, *place, "id", "vector").groupBy(*group)).applyInPandas(
            _rank(k), "query_id long, vec_id long, score double")
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
