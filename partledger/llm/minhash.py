"""Near-duplicate classes by circulant MinHash.

Two permutations of the 32-bit numbers give every signature coordinate: the first places a shingle, the
second, shifted circularly by the coordinate's number, orders the places, and the least is kept. Runs of
coordinates are bands. Equal shingle sets are one set. Each set is compared with the least set of each of its
bands, on the full shingle sets; what this leaves in several classes within one band is compared block against
block, again on the full sets, and only links that join classes leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import Words, components, mix, stored
from partledger.llm.near import LAST, bands_for, text_key

SHINGLE, THRESHOLD = 4, 80    # words; percent of the union that a link shares at least
ROWS, RECALL = 7, 0.9995      # coordinates of a band; share of pairs at the threshold that meet in a band
BLOCK = 2048                  # sets of a band that are compared with as many others at once,
BLOCK_SHINGLES = 1 << 20      # or fewer, so that they have about so many shingles
GROUP = 400                   # sets compared with one other set in one piece of work
WORDS = 1 << 16               # words of texts that are hashed together


def permute(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers: odd factors and folded shifts can all be undone."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(first)
    return (x ^ (x >> np.uint32(15))) * np.uint32(second)


def signature(hashes: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of coordinates for every run of hashes that starts at ``first``."""
    place = permute((hashes >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    out = np.empty((len(first), coordinates), np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(permute(place + np.uint32(k), 0x21F0AAAD, 0xD35A2D97), first)
    return out


def _parts(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about ``WORDS`` words together, a longer text by itself."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > WORDS * 6:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    yield slice(start, len(texts))


def shingles(texts: list[str], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the runs of n words of each text, A-Z in lower case, and the text each is
    of, ascending by both. A text of fewer words is one run of all its words; one without has none."""
    words = Words(texts)
    words.data = np.frombuffer(words.data.tobytes().lower(), np.uint8)  # bytes lower A-Z only
    hashes, text = words.windows(n)
    short = np.flatnonzero((words.per_text > 0) & (words.per_text < n))
    if len(short):
        own, start, count = words.hashes(), words.first[short], words.per_text[short]
        whole = count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(n - 1):
            has = count > i
            whole[has] = mix(whole[has] + own[start[has] + i])
        hashes, text = np.concatenate([hashes, whole]), np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]


def _keys(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits of each set, whatever the order of its members."""
    one = np.add.reduceat(mix(hashes + np.uint64(0x51)), first)
    two = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
    flat = np.stack([one, two], axis=1).astype(">u8").tobytes()
    return [flat[i:i + 16] for i in range(0, len(flat), 16)]


def _signer(n: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for part in _parts(texts):
                some = texts[part]
                hashes, text = shingles(some, n)
                having, first, size = np.unique(text, return_index=True, return_counts=True)
                sizes, keys = np.zeros(len(some), np.int64), [None] * len(some)
                lists = np.zeros((0, bands), np.uint64)
                if len(having):
                    sizes[having] = size
                    signed = signature(hashes, first, rows * bands)
                    lists = np.zeros((len(having), bands), np.uint64)
                    for p in range(rows * bands):
                        lists[:, p // rows] = mix(lists[:, p // rows] + signed[:, p] + np.uint64(p + 1))
                    for i, key in zip(having, _keys(hashes, first)):
                        keys[i] = key
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(part.start, len(some)) for c in (0, 1)), pa.array(keys, pa.binary()), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists.ravel().view(np.int64)))],
                    ["doc_id", "digest", "key", "n_shingles", "bands"])
    return run


_NONE = pd.DataFrame({"a": [], "b": []}, dtype=object)


def _linked(n: int, percent: int):
    """Of pieces of work, rows (head, piece, key, text), the keys whose set is similar to the head's."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [_NONE]
        for (head, _), part in rows.groupby(["head", "piece"], sort=False):
            keys = part["key"].to_numpy()
            at = next(i for i, key in enumerate(keys) if key == head)
            hashes, text = shingles(list(part["text"]), n)
            size = np.bincount(text, minlength=len(part))
            own = hashes[text == at]
            place = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
            common = np.bincount(text[own[place] == hashes], minlength=len(part))
            close = 100 * common >= percent * (size + len(own) - common)
            close[at] = False
            out.append(pd.DataFrame({"a": keys[close], "b": [head] * int(close.sum())}))
        return pd.concat(out[1:] or out)
    return run


def _confirm(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar. A set that many are compared with is dealt to
    several pieces of work; small pieces are done together."""
    sizes = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("ways"))
    piece = F.pmod(F.xxhash64("a"), F.col("ways")).cast("int")
    members = pairs.join(sizes, "b").select(F.col("a").alias("key"), F.col("b").alias("head"), piece.alias("piece"))
    heads = sizes.select(F.col("b").alias("key"), F.col("b").alias("head"),
                         F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("piece"))
    asked = stored(members.union(heads), "comparisons")
    together = max(1, asked.count() // (2 * GROUP))
    work = asked.join(texts, "key").withColumn("work", F.pmod(F.xxhash64("head", "piece"), F.lit(together)))
    return stored(work.groupBy("work").applyInPandas(_linked(n, percent), "a binary, b binary"), "links")


def _spanning(n: int, percent: int):
    """Links between classes in one block of a band, or between two blocks: as few as join the classes that any
    link joins.

    Sets of which neither has a shingle of the other among its rarest, as many as a link may leave unshared and
    one more, are no link; the others are compared unless they are of one class by then.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [_NONE]
        for _, part in rows.groupby(["band", "i", "j"], sort=False):
            keys, number = part["key"].to_numpy(), pd.factorize(part["root"])[0]
            hashes, text = shingles(list(part["text"]), n)
            size = np.bincount(text, minlength=len(part))
            start = np.concatenate([[0], np.cumsum(size)])
            _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
            rarest = np.lexsort((column, count[column], text))
            place = np.arange(len(text)) - start[text]
            early = place < (size - (percent * size + 99) // 100 + 1)[text]
            column, text = column[rarest][early], text[early]
            by = np.argsort(column, kind="stable")
            column, text = column[by], text[by]
            # Only shingles that members of several classes have.
            bounds = np.flatnonzero(np.diff(column, prepend=-1, append=-1)) if len(column) else np.zeros(0, int)
            several = np.maximum.reduceat(number[text], bounds[:-1]) > np.minimum.reduceat(number[text], bounds[:-1]) if len(column) else []
            compared = np.zeros((len(part), len(part)), bool)
            a, b = [], []
            for k in np.flatnonzero(several):
                members = text[bounds[k]:bounds[k + 1]]
                for p, one in enumerate(members):
                    rest = members[p + 1:]
                    rest = rest[(number[rest] != number[one]) & ~compared[one, rest]]
                    rest = rest[(100 * size[rest] >= percent * size[one]) & (100 * size[one] >= percent * size[rest])]
                    if not len(rest):
                        continue
                    compared[one, rest] = compared[rest, one] = True
                    own = hashes[start[one]:start[one + 1]]
                    theirs = np.concatenate([hashes[start[r]:start[r + 1]] for r in rest])
                    same = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                    common = np.add.reduceat(same, np.cumsum(size[rest]) - size[rest], dtype=np.int64)
                    for r in rest[100 * common >= percent * (size[rest] + len(own) - common)]:
                        if number[r] != number[one]:
                            number[number == number[r]] = number[one]
                            a.append(keys[r])
                            b.append(keys[one])
            out.append(pd.DataFrame({"a": a, "b": b}, dtype=object))
        return pd.concat(out[1:] or out)
    return run


def _across(banded: DataFrame, sets: DataFrame, texts: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between sets that share a band but not a class so far.

    The members of a band outside its largest class meet all its members, block against block.
    """
    members = banded.join(classes, "key", "left").withColumn("root", F.coalesce("root", "key")).join(
        sets.select("key", "n_shingles"), "key")
    rows, size = F.count(F.lit(1)), F.sum("n_shingles")
    per_class = members.groupBy("band", "root").agg(rows.alias("n"), size.alias("size"))
    ways = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    open_bands = per_class.groupBy("band").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.struct("n", "size", "root")).alias("most"), F.sum("n").alias("n"),
        F.sum("size").alias("size")).where("classes > 1").select(
        "band", F.col("most.root").alias("largest"), (F.col("n") - F.col("most.n")).alias("left"),
        (F.col("size") - F.col("most.size")).alias("left_size"), F.col("most.n").alias("n"), F.col("most.size").alias("size")).select(
        "band", "largest", ways.alias("ways"),
        F.greatest(F.ceil(F.col("left") / BLOCK), F.ceil(F.col("left_size") / BLOCK_SHINGLES)).cast("int").alias("left_ways"))
    here = stored(members.join(open_bands, "band"), "unsettled")
    count, total = here.agg(rows, F.coalesce(size, F.lit(0))).first()
    # Blocks of left-over members come before those of the largest class: i is always a block of left-overs.
    left = F.col("root") != F.col("largest")
    block = F.when(left, F.pmod(F.xxhash64("key"), F.col("left_ways"))).otherwise(
        F.col("left_ways") + F.pmod(F.xxhash64("key"), F.col("ways"))).cast("int")
    others = F.when(left, F.sequence(F.lit(0), F.col("left_ways") + F.col("ways") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("left_ways") - 1))
    dealt = here.withColumn("block", block).withColumn("other", F.explode(others)).select(
        "band", "key", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    together = max(1, count // BLOCK, total // BLOCK_SHINGLES)
    work = dealt.join(texts, "key").withColumn("work", F.pmod(F.xxhash64("band", "i", "j"), F.lit(together)))
    return stored(work.groupBy("work").applyInPandas(_spanning(n, percent), "a binary, b binary"), "links")


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = THRESHOLD,
            rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, keeper`` for every row of ``docs``.

    Rows are linked if their sets of n-word shingles share ``percent`` of their union at least; words are runs
    of characters other than ASCII white space, A-Z in lower case, and a text of fewer words is one shingle.
    ``component_id`` is the smallest id that links lead to, over any number of steps, and ``keeper`` marks one
    (id, set) of each component: the smallest id, of equal ids the least key. ``key`` is 128 bits of the set.

    A text without words, null included, is linked with nothing: its component is its own id, and it is a
    keeper with a null key. Rows with a null id take part; a component of such rows only has a null id. Repeated
    rows are alike in all columns. Texts are read whole, however long. An empty table gives no rows. Other
    columns are not read.
    """
    bands = bands_for(percent / 100, rows, recall)
    order = F.coalesce("doc_id", F.lit(LAST))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
                       F.col(text).alias("text"))
    signed = stored(base.mapInArrow(_signer(n, rows, bands), "doc_id long, digest binary, key binary, n_shingles long, "
                                    "bands array<long>"), "signatures")
    # Rows of equal sets have equal sizes and bands; the first of them lends its text.
    sets = stored(signed.where("n_shingles > 0").groupBy("key").agg(
        F.min(F.struct(order.alias("first"), "digest")).alias("row"), F.min("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands")).select("key", "row.*", "n_shingles", "bands"), "sets")
    banded = sets.select("key", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("key").alias("head"), F.max("key").alias("other")).where("head < other")
    shared = stored(banded.join(heads.select("band", "head"), "band"), "bands")
    candidates = sets.join(shared.select("key").distinct(), "key").select("key", "first", "digest")
    texts = stored(base.withColumn("first", order).join(candidates, ["first", "digest"]).dropDuplicates(["key"]).select("key", "text"), "texts")
    ties = shared.where("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b")).distinct()
    links = _confirm(ties, texts, n, percent)
    classes = components(links).select(F.col("node").alias("key"), "root")
    more = _across(shared.select("band", "key"), sets, texts, classes, n, percent)
    roots = components(links.union(more)).select(F.col("node").alias("key"), "root")

    placed = sets.select("key", "first").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    keepers = placed.groupBy("root").agg(F.min(F.struct("first", "key")).alias("least"))
    classed = placed.join(keepers, "root").select("key", F.col("least.first").alias("class"), F.col("least.key").alias("keeper_key"))
    bare = F.col("n_shingles") == 0
    return signed.select("doc_id", "key", "n_shingles").join(classed, "key", "left").select(
        "doc_id", "key", "n_shingles",
        F.when(bare, F.col("doc_id")).when(F.col("class") != LAST, F.col("class")).alias("component_id"),
        (bare | ((order == F.col("class")) & (F.col("key") == F.col("keeper_key")))).alias("keeper"))
