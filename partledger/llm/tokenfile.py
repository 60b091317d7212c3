"""Token files: ids in canonical length-limited Huffman codes, in blocks that decode independently.

A file set is two Parquet tables below one folder: ``codes`` (id, length), from which the canonical
codes follow, and ``blocks``. A block holds whole documents in ascending id order: their ids and
sizes, the code bits of each document from a byte boundary on, and the bit length of every run of
``RUN`` tokens, which gives a decoder a bit offset to start from at every run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.llm.bpe import _byte_letters, _tokenizer
from partledger.llm.common import running_start, stored

LIMIT = 16            # longest code; also the width of the decoding table
RUN = 128             # tokens between two checkpoints
BLOCK_BYTES = 1 << 20  # code bits of one block, about; a longer document is a block by itself
LAST = (1 << 63) - 1

# Characters that every Unicode version puts in the same class: ASCII and the Latin letters.
_ODD = re.compile("[^\t\n\r -~À-ɏ]")
_DOUBLE_SPACE = re.compile(r"\s\s")
_BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TextEncoder:
    """Ids of whole texts as the tokenizers library gives them, special strings included.

    For byte-level BPE the same merges run in tiktoken, which is several times faster; texts with
    special strings or characters out of the common ranges go through the library itself.
    """

    def __init__(self, definition: str):
        import tiktoken

        self.tok, spec = _tokenizer(definition), json.loads(definition)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        step = spec.get("pre_tokenizer") or {}
        self.short = (spec.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex")
                      and not step.get("add_prefix_space") and not spec["model"].get("continuing_subword_prefix"))
        if self.short:
            byte = {c: b for b, c in enumerate(_byte_letters())}
            ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                     if piece not in self.special}
            make = lambda split: tiktoken.Encoding("bpe", pat_str=split, mergeable_ranks=ranks, special_tokens={})
            # Without two white-space characters in a row, the split needs no look-ahead.
            self.whole, self.single = make(_BYTE_SPLIT), make(_BYTE_SPLIT.replace(r"\s+(?!\S)|", ""))

    def __call__(self, text: str) -> list[int]:
        if not self.short or _ODD.search(text) or any(s in text for s in self.special):
            return self.tok.encode(text, add_special_tokens=False).ids
        return (self.whole if _DOUBLE_SPACE.search(text) else self.single).encode_ordinary(text)


@lru_cache(maxsize=2)
def _encoder(definition: str) -> TextEncoder:
    return TextEncoder(definition)


def _squeeze(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _stretch(b: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def tokenize(docs: DataFrame, definition: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` with packed ids: each whole text, then the end id. Null is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            ids = [np.array([*encoder(t or ""), end_id], np.uint32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([_squeeze(x) for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            n = np.bincount(_stretch(packed), minlength=len(total))
            n[:len(total)] += total
            total = n
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; counts are all above zero."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    row, levels = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        row = np.concatenate([leaves, packages])
        by = np.argsort(row, kind="stable")
        row = row[by]
        levels.append(by < n)
    # The first 2n - 2 items of the last level, and what they are packages of, level by level.
    take, sorted_lengths = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        sorted_lengths[:own] += 1
        take = 2 * (take - own)
    lengths = np.empty(n, np.int64)
    lengths[order] = sorted_lengths
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By id: code and length. Codes ascend with length, then id."""
    size = int(ids.max()) + 1 if len(ids) else 1
    code_of, length_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
    order = np.lexsort((ids, lengths))
    width = lengths[order]
    # In units of the longest code, each code begins where the one before it ends.
    units = np.int64(1) << (LIMIT - width)
    code_of[ids[order]] = (np.cumsum(units) - units) >> (LIMIT - width)
    length_of[ids] = lengths
    return code_of, length_of


def _coder(code_of: np.ndarray, length_of: np.ndarray, block_bytes: int):
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("n_tokens", pa.int64()),
                        ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("runs", pa.binary()), ("bits", pa.binary())])

    def block(part: int, seq: int, docs: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids).astype(np.int64)
        width = length_of[flat]
        first = np.cumsum(sizes) - sizes
        bits = np.add.reduceat(width, first)
        base = np.cumsum((bits + 7) // 8) - (bits + 7) // 8
        before = np.cumsum(width) - width
        at = before - np.repeat(before[first] - 8 * base, sizes)
        value = code_of[flat] << (32 - width - (at & 15))
        words = int((at[-1] + width[-1] + 15) // 16) + 1
        out = np.bincount(at >> 4, value >> 16, words) + np.bincount((at >> 4) + 1, value & 0xFFFF, words + 1)[:words]
        runs = (sizes + RUN - 1) // RUN
        step = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        run_bits = np.add.reduceat(width, np.repeat(first, runs) + step * RUN)
        payload = out.astype(">u2").tobytes()[:int(base[-1] + (bits[-1] + 7) // 8)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (part, seq, int(sizes.sum()), docs, sizes, run_bits.astype("<u2").tobytes(), payload), schema.types)],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, docs, ids, size, part = 0, [], [], 0, 0
        for batch in batches:
            for place, doc, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x = _stretch(packed)
                part = place
                docs.append(doc)
                ids.append(x)
                size += int(length_of[x.astype(np.int64)].sum()) // 8
                if size >= block_bytes:
                    yield block(part, seq, docs, ids)
                    seq, docs, ids, size = seq + 1, [], [], 0
        if docs:
            yield block(part, seq, docs, ids)

    return run


def write_tokens(docs: DataFrame, path: str, definition: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> None:
    """Encode every whole text and write the file set, documents ascending by id.

    A null id comes last and stays null; documents with one id are ordered by size, then by their
    ids, so repeated rows are written once each. An empty table gives a file set without blocks.
    """
    spark = docs.sparkSession
    tokens = stored(tokenize(docs, definition, end_id, doc_id, text), "tokens")
    counts = tokens.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # As many rows as the vocabulary has, at most.
    rows = sorted(tuple(r) for r in counts.collect())
    ids, n = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    lengths = code_lengths(n)
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id long, length int").coalesce(1).write.parquet(f"{path}/codes")
    key = F.coalesce("doc_id", F.lit(LAST))
    ranged = tokens.withColumn("key", key).withColumn("tie", F.xxhash64("ids")).repartitionByRange(
        "key", "n_tokens", "tie").sortWithinPartitions("key", "n_tokens", "tie")
    laid = ranged.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "ids")
    laid.mapInArrow(_coder(*canonical_codes(ids, lengths), block_bytes),
                    "part long, seq long, n_tokens long, docs array<long>, sizes array<long>, runs binary, bits binary"
                    ).write.parquet(f"{path}/blocks")


def _decoder(ids: np.ndarray, lengths: np.ndarray):
    by = np.lexsort((ids, lengths))
    span = np.int64(1) << (LIMIT - lengths[by])
    id_at = np.zeros(1 << LIMIT, np.int64)
    step_at = np.ones(1 << LIMIT, np.int64)
    id_at[:span.sum()] = np.repeat(ids[by], span)
    step_at[:span.sum()] = np.repeat(lengths[by], span)

    def block(sizes: np.ndarray, runs: bytes, bits: bytes) -> np.ndarray:
        run_bits = np.frombuffer(runs, "<u2").astype(np.int64)
        per_doc = (sizes + RUN - 1) // RUN
        first = np.cumsum(per_doc) - per_doc
        doc_bits = np.add.reduceat(run_bits, first)
        base = np.cumsum((doc_bits + 7) // 8) - (doc_bits + 7) // 8
        before = np.cumsum(run_bits) - run_bits
        at = before - np.repeat(before[first] - 8 * base, per_doc)
        raw = np.frombuffer(bits + bytes(RUN * LIMIT // 8 + 8), np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.empty((RUN, len(at)), np.int32)
        for i in range(RUN):  # every run moves on by one token at a time
            head = (window[at >> 3] >> (32 - LIMIT - (at & 7)).astype(np.uint32)) & ((1 << LIMIT) - 1)
            out[i] = id_at[head]
            at = at + step_at[head]
        step = np.arange(len(at)) - np.repeat(first, per_doc)
        filled = np.minimum(RUN, np.repeat(sizes, per_doc) - step * RUN)
        return out.T[np.arange(RUN) < filled[:, None]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                flat = block(sizes, row["runs"], row["bits"]).astype("<u4")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(sizes), pa.int64()), pa.array([row["seq"]] * len(sizes), pa.int64()),
                    pa.array(row["docs"], pa.int64()), pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([flat[a:b].tobytes() for a, b in zip(ends - sizes, ends)], pa.binary())],
                    ["part", "seq", "doc_id", "offset", "n_tokens", "ids"])

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, doc_id, offset, n_tokens, ids``: every document of a file set, decoded block by block.

    ``ids`` are little-endian unsigned 32-bit integers; (part, seq) is the block, in ascending order of
    documents, and ``offset`` the tokens before the document in it.
    """
    rows = spark.read.parquet(f"{path}/codes").collect()  # as many as the vocabulary has, at most
    ids, lengths = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    return spark.read.parquet(f"{path}/blocks").select("part", "seq", "docs", "sizes", "runs", "bits").mapInArrow(
        _decoder(ids, lengths), "part long, seq long, doc_id long, offset long, n_tokens long, ids binary")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, start``: the tokens of all blocks before a block."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "seq", "n_tokens").withColumn("all", F.lit(0))
    return running_start(blocks, "all", "part", ["seq"], "n_tokens", "start").select("part", "seq", "start")
