"""Line deduplication by log templates: a tree of fixed depth, token count first, then leading tokens.

A line's leaf is its number of tokens and its first tokens, with tokens that hold a digit replaced by
``<*>``. In each leaf the most frequent line is the seed of the leaf's template. A line that agrees
with the seed in enough constant tokens belongs to that template, its other tokens being variable
fields; any other line belongs to the template of its masked text, or, without any constant, is one by
itself: a line of numbers alone is data. A template seen in several documents stays in the first
of them (smallest id) and is dropped from the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import fresh, stored

DEPTH = 4             # leading tokens that a leaf fixes
AGREEMENT = 0.7       # share of a line's tokens that must be constants of the template
FIELD = "<*>"
FILTER_BITS = 1 << 23  # bits of the filter that spares lines of unshared leaves the shuffle: 1 MB, always
LAST = (1 << 63) - 1

_OTHERS = "\t\x0b\x0c\r"
_SPACES = str.maketrans("\t\x0b\x0c\r", "    ")
_DIGIT, _HAS_DIGIT = re.compile("[0-9]"), re.compile("[^ ]*[0-9][^ ]*")


def normal_lines(text: str) -> list[str]:
    """Lines whose tokens are what single spaces separate: other white space becomes spaces."""
    if any(c in text for c in _OTHERS):
        text = text.translate(_SPACES)
    return [line.strip(" ") for line in text.split("\n")]


def masked(line: str) -> str:
    return _HAS_DIGIT.sub(FIELD, line) if _DIGIT.search(line) else line


def leaf(line: str) -> int:
    """64-bit id of a line's leaf in the tree. Masking leaves tokens where they are, so only the first ones need it."""
    head = masked(" ".join(line.split(" ", DEPTH)[:DEPTH]))
    return xxhash.xxh64_intdigest(f"{line.count(' ') + 1} {head}") - (1 << 63)


def line_id(line: str) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple[int, str]]]]:
    """Per document: its order, the hash of its text, and its lines that are not blank."""
    for batch in batches:
        for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            yield doc, key, [(i, n) for i, n in enumerate(normal_lines(text)) if n]


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("_doc", pa.int64()), ("_hash", pa.int64()), ("_line", pa.int32()), ("_leaf", pa.int64()), ("_id", pa.int64())])
    yield from _batches(((doc, key, i, leaf(n), line_id(n)) for doc, key, lines in _lines(batches) for i, n in lines), schema)


def _shared_lines(bits):
    """Lines in leaves that pass the filter, each distinct one of a batch once."""
    schema = pa.schema([("_leaf", pa.int64()), ("_norm", pa.string()), ("n", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = bits.value
        for batch in batches:
            seen: dict[tuple[int, str], list[int]] = {}
            for doc, _, lines in _lines(iter([batch])):
                for _, n in lines:
                    place = leaf(n)
                    slot = place & (FILTER_BITS - 1)
                    if passing[slot >> 6] >> (slot & 63) & 1:
                        found = seen.setdefault((place, n), [0, doc, doc])
                        found[0] += 1
                        found[1], found[2] = min(found[1], doc), max(found[2], doc)
            yield from _batches(((*k, *v) for k, v in seen.items()), schema)
    return run


def constants_shared(a: Column, b: Column) -> Column:
    """Positions where two lines of one leaf have the same token and it is no field."""
    return F.size(F.filter(F.arrays_zip(F.split(a, " ").alias("x"), F.split(b, " ").alias("y")),
                           lambda t: (t["x"] == t["y"]) & (t["x"] != FIELD)))


def masked_column(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_doc, _hash, dropped``: the line numbers (from 0, ascending) to drop from a document."""
    texts = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("_doc"), F.xxhash64(text).alias("_hash"), F.col(text))
    narrow = stored(texts.mapInArrow(_index, "_doc long, _hash long, _line int, _leaf long, _id long"), "lines")
    # Only leaves with lines of two documents can hold a shared template. The filter has a fixed size;
    # lines that it lets through in vain do no harm.
    shared = narrow.groupBy("_leaf").agg(F.min("_doc").alias("a"), F.max("_doc").alias("b")).where("a < b")
    slot = F.col("_leaf").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = shared.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast((_leaf & {FILTER_BITS - 1}) % 64 as int))").alias("bit")
                          ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for word, value in words.toLocalIterator():
        bits[word] = value
    passing = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64).tolist())
    distinct = stored(texts.mapInArrow(_shared_lines(passing), "_leaf long, _norm string, n long, first long, last long").groupBy(
        "_leaf", "_norm").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")), "distinct-lines")
    # The seed of a leaf: its most frequent masked line, ties by the larger string.
    own = masked_column(F.col("_norm"))
    seeds = distinct.groupBy("_leaf", own.alias("m")).agg(F.sum("n").alias("n")).groupBy("_leaf").agg(
        F.max(F.struct("n", "m"))["m"].alias("seed"))
    fits = constants_shared(own, F.col("seed")) >= F.lit(AGREEMENT) * F.size(F.split(own, " "))
    named = distinct.join(seeds, "_leaf").select("_leaf", "_norm", "first", "last", fits.alias("fits"))
    # The seed's template is named by its leaf, any other by its masked text.
    judged = stored(named.mapInArrow(_name_lines, "_leaf long, _id long, first long, last long, fits boolean, _own long").withColumn(
        "template", F.when(F.col("fits"), F.lit(0)).otherwise(F.col("_own"))).drop("_own"), "line-templates")
    spread = judged.groupBy("_leaf", "fits", "template").agg(
        F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
    repeated = judged.select("_leaf", "_id", "fits", "template").join(
        spread.drop("last"), ["_leaf", "fits", "template"]).select("_leaf", "_id", "first")
    return narrow.join(repeated, ["_leaf", "_id"]).where("_doc > first").groupBy("_doc", "_hash").agg(
        F.sort_array(F.collect_set("_line")).alias("dropped"))


def _name_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The id of each line instead of its text, and that of the template it is when it fits no seed."""
    for batch in batches:
        lines = batch.column(1).to_pylist()
        ids, own = (pa.array([line_id(f(n)) for n in lines], pa.int64()) for f in (str, _template))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, *batch.columns[2:], own], ["_leaf", "_id", "first", "last", "fits", "_own"])


def _template(line: str) -> str:
    """A line with its fields masked; the line itself if it has no constant."""
    own = masked(line)
    return line if set(own.split(" ")) <= {FIELD, ""} else own


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``kept_text, n_lines, dropped``.

    ``kept_text`` is the text without its dropped lines, joined by newlines again; null stays null and
    has no lines. Blank lines are never dropped. Rows with one id are one document, so they do not
    drop each other's lines; rows with a null id are one document, the last. Repeated rows get equal
    results. Columns of ``docs`` named ``kept_text``, ``n_lines`` or ``dropped`` are replaced.
    """
    found = dropped_lines(docs, doc_id, text)
    doc, key = fresh(docs, "_doc", "_hash")
    rows = docs.drop("kept_text", "n_lines", "dropped").withColumn(
        doc, F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))).withColumn(key, F.xxhash64(text))
    out = rows.join(found.withColumnsRenamed({"_doc": doc, "_hash": key}), [doc, key], "left").drop(doc, key)
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("dropped"), i)), "\n")
    return out.withColumn("kept_text", F.when(F.col("dropped").isNull(), F.col(text)).otherwise(kept)).withColumn(
        "n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines))).withColumn(
        "dropped", F.coalesce("dropped", F.array().cast("array<int>")))
