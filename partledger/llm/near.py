"""Similarity join on word n-grams: MinHash bands find candidates, full n-gram sets decide.

Equal texts are one text. Texts that share a band hash are tied to the least text of that band, and
the components of these ties are the candidates of each other: linear in the rows, whatever the size of
a band's group. Within a component every pair is verified on its n-gram sets, block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partledger.llm.common import Words, components, fresh, mix, stored

NGRAM, THRESHOLD = 5, 0.8
ROWS, RECALL = 7, 0.9995   # rows of a band; share of pairs at the threshold that meet in a band
BLOCK = 400                # texts of a component in one block
GROUP = 1000               # texts of small components that are verified together
COLUMNS = 4096             # n-grams multiplied at once
LAST = (1 << 63) - 1


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands needed so that a pair at the threshold shares one of them with the given probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def text_key(text: Column) -> Column:
    """128 bits of a text; equal texts have equal keys."""
    return F.unhex(F.md5(text))


def ngrams(texts: list[str], n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every run of n words, and the text each is from, ascending by text. A text of
    fewer words is one run of all its words; one without words has none."""
    words = Words(texts)
    hashes, text = words.windows(n)
    short = np.flatnonzero((words.per_text > 0) & (words.per_text < n))
    if len(short):
        own = words.hashes()
        whole = np.array([mix(np.array([sum((int(h) * (2 * i + 3) for i, h in enumerate(
            own[words.first[t]:words.first[t + 1]])), int(words.per_text[t])) % (1 << 64)], np.uint64))[0] for t in short])
        hashes, text = np.concatenate([hashes, whole]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    return hashes, text


def _signer(n: int, rows: int, bands: int):
    random = np.random.Generator(np.random.Philox(key=[5, 0]))
    factors = random.integers(0, 1 << 32, rows * bands, dtype=np.uint32) | np.uint32(1)
    shifts = random.integers(0, 1 << 32, rows * bands, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            hashes, text = ngrams(texts, n)
            having, first, size = np.unique(text, return_index=True, return_counts=True)
            signed = np.zeros((len(having), bands), np.uint64)
            if len(having):
                h = (hashes >> np.uint64(32)).astype(np.uint32)
                moved = np.empty_like(h)
                for p in range(rows * bands):
                    np.multiply(h, factors[p], out=moved)
                    np.add(moved, shifts[p], out=moved)
                    signed[:, p // rows] = mix(signed[:, p // rows] + np.minimum.reduceat(moved, first) + np.uint64(p + 1))
            sizes = np.zeros(len(texts), np.int64)
            sizes[having] = size
            offsets = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed.ravel().view(np.int64)))],
                ["doc_id", "key", "n_grams", "bands"])
    return run


def _linked(texts: list[str], left: np.ndarray, right: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (one of left, one of right) whose n-gram sets have at least the threshold's Jaccard."""
    hashes, text = ngrams(texts, n)
    grams, column = np.unique(hashes, return_inverse=True)
    cell = np.unique(text * len(grams) + column)  # each n-gram of a text once
    text, column = cell // len(grams), cell % len(grams)
    size = np.bincount(text, minlength=len(texts))
    shared = np.bincount(column, minlength=len(grams)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    text, column = text[keep], place[column[keep]]
    by = np.argsort(column, kind="stable")
    text, column = text[by], column[by]
    common = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(shared.sum()), COLUMNS):
        some = slice(*np.searchsorted(column, [a, a + COLUMNS]))
        has = np.zeros((len(texts), COLUMNS), np.float32)
        has[text[some], column[some] - a] = 1
        common += has[left] @ has[right].T
    union = size[left][:, None] + size[right][None, :] - common
    return np.nonzero((common > 0) & (common >= threshold * union - 1e-6))


def _verify(n: int, threshold: float):
    def roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least member of each one's component."""
        root = np.arange(count)
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                return root
            root = new

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), part in rows.groupby(["component", "i", "j"], sort=False):
            part = part.sort_values("key", ignore_index=True)
            block, copies = part["block"].to_numpy(), part["copies"].to_numpy()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            a, b = _linked(list(part["text"]), left, right, n, threshold)
            a, b = left[a], right[b]
            if i == j:
                a, b = a[a != b], b[a != b]  # both directions are there
            else:
                a, b = np.concatenate([a, b]), np.concatenate([b, a])
            if not len(a):
                continue
            links = np.bincount(a, weights=copies[b], minlength=len(part)).astype(np.int64)
            root = roots(len(part), a, b)
            seen = np.flatnonzero(links)
            out.append(pd.DataFrame({"key": part["key"].to_numpy()[seen], "root": part["key"].to_numpy()[root[seen]],
                                     "links": links[seen]}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "root": [], "links": []})
    return run


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = NGRAM, threshold: float = THRESHOLD,
            rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """``doc_id, key, class_id, n_links, keeper`` for every row of ``docs``.

    ``n_links`` counts the other rows whose n-gram set has at least the threshold's Jaccard with this
    row's, equal texts included. ``class_id`` is the smallest id that links lead to, over any number of
    steps. ``keeper`` marks one (id, text) of each class: the smallest id, of equal ids the least key.
    ``key`` is the text's 128-bit key.

    Words are runs of characters other than ASCII white space, n-grams runs of n words; a text of fewer
    words is one n-gram. A text without words, null included, has no links and is a class and a keeper
    by itself. Rows with a null id take part; a class of such rows only has a null class_id. Repeated
    rows are copies of each other. Other columns are not read.
    """
    bands = bands_for(threshold, rows, recall)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(F.coalesce(F.col(text), F.lit(""))).alias("key"),
                       F.col(text).alias("text"))
    signed = stored(base.mapInArrow(_signer(n, rows, bands), "doc_id long, key binary, n_grams long, bands array<long>"),
                    "signatures")
    order = F.coalesce("doc_id", F.lit(LAST))
    texts = stored(signed.where("n_grams > 0").groupBy("key", "bands").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")), "texts")
    banded = texts.select("key", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("key").alias("hub"), F.max("key").alias("other")).where("hub < other")
    ties = banded.join(hubs.select("band", "hub"), "band").where("key <> hub").select(
        F.col("key").alias("a"), F.col("hub").alias("b")).distinct()
    found = stored(components(ties).select(F.col("node").alias("key"), F.col("root").alias("component")), "candidates")

    # Members of a component are dealt into blocks, and every pair of blocks is one piece of work.
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ways"))
    groups = max(1, found.count() // GROUP)
    members = found.join(sizes, "component").join(texts.select("key", "first", "copies"), "key").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("ways")).cast("int"))
    same_text = base.withColumn("first", order).join(members, ["key", "first"]).dropDuplicates(["key"])
    paired = same_text.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("ways") - 1))).withColumn(
        "i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))
    work = paired.withColumn("work", F.when(F.col("ways") == 1, F.pmod(F.xxhash64("component"), F.lit(groups)))
                             .otherwise(F.xxhash64("component", "i", "j")))
    verified = stored(work.select("work", "component", "i", "j", "block", "key", "copies", "text").groupBy("work").applyInPandas(
        _verify(n, threshold), "key binary, root binary, links long"), "links")
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("key").alias("a"), F.col("root").alias("b")).where("a <> b"))

    placed = texts.select("key", "first", "copies").join(links, "key", "left").join(
        roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    keepers = placed.groupBy("root").agg(F.min(F.struct("first", "key")).alias("least"))
    classed = placed.join(keepers, "root").select(
        "key", F.col("least.first").alias("class"), F.col("least.key").alias("keeper_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("doc_id", "key", (F.col("n_grams") == 0).alias("bare")).join(classed, "key", "left")
    return out.select(
        "doc_id", "key",
        F.when(F.col("bare"), F.col("doc_id")).when(F.col("class") != LAST, F.col("class")).alias("class_id"),
        F.when(F.col("bare"), 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (F.col("bare") | ((F.coalesce("doc_id", F.lit(LAST)) == F.col("class")) & (F.col("key") == F.col("keeper_key")))).alias("keeper"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each class does, with all their columns."""
    id_, key, n = fresh(docs, "_id", "_key", "_n")
    kept = similar(docs, doc_id, text, **settings).where("keeper").select(
        F.coalesce("doc_id", F.lit(LAST)).alias(id_), F.col("key").alias(key)).distinct()
    rows = docs.withColumn(id_, F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))).withColumn(
        key, text_key(F.coalesce(F.col(text), F.lit(""))))
    same = rows.join(kept, [id_, key])
    first = F.row_number().over(Window.partitionBy(id_, key).orderBy(id_))
    bare = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return same.withColumn(n, first).where((F.col(n) == 1) | bare).select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
