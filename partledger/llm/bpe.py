"""BPE encoding by distinct words, and decoding by an id-to-piece join.

Texts are split into words at ASCII white space. Blocks of documents keep each text as positions in
the block's own word list; word lists meet in buckets by word hash, where every distinct word is
encoded once, and its ids go back to the blocks by position.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.llm.common import Words
from partledger.session import shared_dir

BLOCK_CHARS = 8 << 20      # text of one block; a longer document is a block by itself
BUCKET_WORDS = 300_000     # (block, word) pairs of one bucket, about
BLOCK_IDS = 1 << 18        # ids of one block in decoding; a longer document is a block with those before it

ENCODED, WANTED = "doc_id long, ids array<int>", "id int, n_wanted int, block binary"

_WORD = re.compile("[^\x20\x09-\x0d]+")
# Printable ASCII and the Latin-1 letters: one code point each after NFC and lower-casing, and of
# the same class in every Unicode version. Words of other characters take the library's whole path.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def pack(a: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, which compress better than whole numbers do."""
    a = a.astype("<u4")
    return zstandard.compress(a.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), np.uint8)
    return raw.reshape(4, -1).T.copy().view("<u4").ravel()


@lru_cache(maxsize=2)
def _tokenizer(definition: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(definition)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=2)
def _byte_letters(_: None = None) -> list[str]:
    """The letter by which byte-level BPE writes each byte: printable ones as they are, the others,
    in order, from code point 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordEncoder:
    """Ids of single words, as the tokenizers library encodes them."""

    def __init__(self, definition: str):
        self.tok, spec = _tokenizer(definition), json.loads(definition)
        self.model = self.tok.model
        self.letters = _byte_letters()
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        # The short way holds for this kind of tokenizer only: lower case, and these pieces.
        self.short = kinds == ["NFC", "Replace", "Lowercase"] and splits[:1] == [
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def __call__(self, word: str) -> list[int]:
        if not self.short or not _PLAIN.fullmatch(word) or any(s in word for s in self.special):
            return self.tok.encode(word, add_special_tokens=False).ids
        found = []
        for piece in _PIECES.findall(word.lower()):
            if not piece.isascii():
                piece = "".join(self.letters[b] for b in piece.encode())
            found += [t.id for t in self.model.tokenize(piece)]
        return found


def check_words_stand_alone(definition: str) -> None:
    """Refuse a tokenizer whose ids of a text are not those of its words, one after the other."""
    tok = _tokenizer(definition)
    for probe in ("a b", "It's one, two.", "x\ty\n\nz", "café 12"):
        whole = tok.encode(probe, add_special_tokens=False).ids
        if whole != [i for w in _WORD.findall(probe) for i in tok.encode(w, add_special_tokens=False).ids]:
            raise ValueError("this tokenizer does not encode words independently of white space")


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to blocks: per block its documents, words per document, word numbers, and words.
    A block's words are numbered by falling count, then by text: small numbers and like neighbours pack well."""
    schema = pa.schema([("block", pa.string()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("codes", pa.binary()), ("words", pa.binary()), ("n_words", pa.int64())])
    docs, sizes, codes, chars = [], [], [], 0
    number: dict[str, int] = {}

    def block() -> pa.RecordBatch:
        words = list(number)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        often = np.bincount(flat, minlength=len(words)).tolist()
        order = sorted(range(len(words)), key=lambda i: (-often[i], words[i]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (uuid.uuid4().hex, docs, sizes, pack(rank[flat]), _pack_words([words[i] for i in order]), len(words)),
            schema.types)], schema=schema)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = _WORD.findall(text or "")
            codes.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
            docs.append(doc)
            sizes.append(len(found))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield block()
                docs, sizes, codes, chars, number = [], [], [], 0, {}
    if docs:
        yield block()


def _pack_words(words: list[str]) -> bytes:
    return zstandard.compress("\n".join(words).encode(), 3)


def _words_of(packed: bytes) -> list[str]:
    text = zstandard.decompress(packed).decode()
    return text.split("\n") if text else []


def _by_bucket(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers in the order of their buckets, and the bucket of each in that order."""
    bucket = (Words(["\n".join(words)]).hashes() >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _deal(bits: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words_of(packed)
                if not words:
                    continue
                order, bucket = _by_bucket(words, bits)
                at = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(words)]])
                yield pa.RecordBatch.from_pydict({
                    "bucket": bucket[at[:-1]], "block": pa.array([block] * (len(at) - 1)),
                    "words": pa.array([_pack_words([words[i] for i in order[a:b]])
                                       for a, b in zip(at[:-1], at[1:])], pa.binary())})
    return deal


def _encode_bucket(definition):
    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        encoder, table = WordEncoder(definition.value), {}
        out = []
        for packed in rows["words"]:
            words = _words_of(packed)
            for w in words:
                if w not in table:
                    table[w] = np.array(encoder(w), np.uint32)
            ids = [table[w] for w in words]
            out.append((pack(np.fromiter(map(len, ids), np.int64, len(ids))), pack(np.concatenate(ids))))
        return pd.DataFrame({"bucket": rows["bucket"], "block": rows["block"],
                             "lengths": [a for a, _ in out], "ids": [b for _, b in out]})
    return encode


def _place(bits: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Join the ids back by position: a block's word numbers become the ids of its words."""
        for batch in batches:
            for row in batch.to_pylist():
                words, parts = _words_of(row["words"]), sorted(row["parts"] or [], key=lambda p: p["bucket"])
                order = _by_bucket(words, bits)[0] if words else np.zeros(0, np.int64)
                dealt = np.concatenate([unpack(p["lengths"]) for p in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
                ids = np.concatenate([unpack(p["ids"]) for p in parts] or [np.zeros(0, np.uint32)])
                lengths, starts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
                lengths[order], starts[order] = dealt, np.cumsum(dealt) - dealt
                codes, at = unpack(row["codes"]), 0
                for doc, size in zip(row["docs"], row["sizes"]):
                    own = codes[at:at + size]
                    at += size
                    n = lengths[own]
                    before = np.cumsum(n) - n
                    picked = ids[np.repeat(starts[own] - before, n) + np.arange(n.sum())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc], pa.int64()), pa.ListArray.from_arrays(
                            pa.array([0, len(picked)], pa.int32()), pa.array(picked.astype(np.int32)))], ["doc_id", "ids"])
    return place


def _merged(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        held.append(batch)
        if len(held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row of ``docs``, each whole text encoded.

    Null and empty texts have no ids. Null and repeated ids and repeated rows are kept as they are;
    other columns are not read. The tokenizer must encode words independently of the white space
    between them; one that does not is refused.
    """
    blocks, place = _coded(docs, definition, doc_id, text)
    return blocks.mapInArrow(place, ENCODED)


def round_trip(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, text``: ``encode``, then ``decode``, for every row of ``docs``, with the ids kept.

    Rows and edge cases are those of the two; a null text comes back empty. Ids are put in their places and gathered
    for decoding by one Python worker, which takes less memory than one after the other.
    """
    blocks, place = _coded(docs, definition, doc_id, text)
    gather = _wanted("ids")
    return _joined(blocks.mapInArrow(lambda batches: gather(place(batches)), WANTED), definition, "ids", ["doc_id", "ids"], ENCODED)


def _coded(docs: DataFrame, definition: str, doc_id: str, text: str):
    """Blocks of documents with the ids of their words, and the function that makes encoded rows of them."""
    check_words_stand_alone(definition)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    blocks = _bucketed(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        _split, "block string, docs array<long>, sizes array<long>, codes binary, words binary, n_words long"), "block")
    pairs = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(3, int(np.ceil(np.log2(max(1, pairs / BUCKET_WORDS)))))
    dealt = blocks.select("block", "words").mapInArrow(_deal(bits), "bucket long, block string, words binary")
    coded = dealt.groupBy("bucket").applyInPandas(
        _encode_bucket(shared), "bucket long, block string, lengths binary, ids binary")
    parts = coded.groupBy("block").agg(F.collect_list(F.struct("bucket", "lengths", "ids")).alias("parts"))
    place = _place(bits)
    coded_blocks = blocks.select("block", "docs", "sizes", "codes", "words").join(parts.hint("merge"), "block", "left")
    return coded_blocks, lambda batches: _merged(place(batches))


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """Write a table to the shared folder in buckets of a key, so that a join on it moves only the other side."""
    spark, name = df.sparkSession, f"partledger_{uuid.uuid4().hex}"
    ways = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(ways, key).option("path", shared_dir(spark, "blocks")).format("parquet").saveAsTable(name)
    table = spark.table(name).select("*")
    spark.sql(f"DROP TABLE {name}")  # only the name goes: the files are at a path of their own
    return table


def piece_table(spark: SparkSession, definition: str) -> DataFrame:
    """``id, piece``: as many rows as the vocabulary has."""
    if json.loads(definition).get("decoder") is not None:
        raise ValueError("only tokenizers whose pieces are joined by spaces are decoded here")
    tok = _tokenizer(definition)
    return spark.createDataFrame(sorted((i, p) for p, i in tok.get_vocab(True).items()), "id int, piece string")


def decode(encoded: DataFrame, definition: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``text`` instead of ``ids``: an id-to-piece join, special tokens included.

    Documents are gathered in blocks. A block becomes one row for each distinct id that it has, after one row with
    the block itself; the join with the piece table, which the vocabulary bounds and is broadcast, leaves these rows
    where and in the order they are, and the pieces go back to the positions of their ids. Nothing is shuffled.
    Ids that the table lacks are left out, as the tokenizers library does. Null ids give null, no ids the empty text;
    an empty table gives an empty one. A text of any length is in one block. A column ``text`` that ``encoded`` has is
    replaced; other columns stay, whatever their names.
    """
    encoded = encoded.drop(*[c for c in encoded.columns if c.lower() == "text" != ids])
    others = [f for f in encoded.schema.fields if f.name != ids]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return _joined(encoded.mapInArrow(_wanted(ids), WANTED), definition, ids, [f.name for f in others], names)


def _joined(wanted: DataFrame, definition: str, ids: str, others: list[str], names: str) -> DataFrame:
    """The columns ``others`` of the blocks, then ``text``."""
    found = wanted.join(F.broadcast(piece_table(wanted.sparkSession, definition)), "id", "left")
    return found.select("id", "piece", "n_wanted", "block").mapInArrow(
        _with_pieces(ids, others), f"{names}, text string" if others else "text string")


def _wanted(ids: str, block_ids: int = BLOCK_IDS):
    """Rows ``id, n_wanted, block``: for each block first a row with the block, then one for each id in it."""
    def rows(block: pa.Table) -> pa.RecordBatch:
        block = block.combine_chunks()
        has = np.zeros(0, np.int32)
        if block.num_rows:
            flat = np.concatenate([x for b in block.to_batches() for x in _arrays(b, ids) if x is not None] or [has])
            has = np.unique(flat).astype(np.int32)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, block.schema) as out:
            out.write_table(block)
        n = len(has)
        return pa.RecordBatch.from_arrays([
            pa.array([None, *has.tolist()], pa.int32()), pa.array([n] + [None] * n, pa.int32()),
            pa.array([sink.getvalue().to_pybytes()] + [None] * n, pa.binary())], ["id", "n_wanted", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += sum(len(x) for x in _arrays(batch, ids) if x is not None)
            if size >= block_ids:
                yield rows(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield rows(pa.Table.from_batches(held))
    return run


def _with_pieces(ids: str, others: list[str]):
    """Puts the pieces that follow a block where their ids are in it."""
    def texts(block: bytes, n: int, pieces: dict[int, str | None]) -> Iterator[pa.RecordBatch]:
        if len(pieces) != n:
            raise ValueError("the ids of a block have not come behind it")
        known = None not in pieces.values()
        for batch in pa.ipc.open_stream(block).read_all().to_batches():
            found = ([pieces[i] for i in x.tolist()] if x is not None else None for x in _arrays(batch, ids))
            text = [None if f is None else " ".join(f if known else [p for p in f if p is not None]) for f in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in others), pa.array(text, pa.string())],
                                             [*others, "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, pieces = None, 0, {}
        for batch in batches:
            found_ids, found, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = 0
            for start in [i for i, c in enumerate(counts) if c is not None] + [len(counts)]:
                pieces.update(zip(found_ids[at:start], found[at:start]))
                if start < len(counts):
                    if block is not None:
                        yield from texts(block, n, pieces)
                    block, n, pieces = batch.column(3)[start].as_py(), counts[start], {}
                at = start + 1
        if block is not None:
            yield from texts(block, n, pieces)
    return run


def _arrays(batch: pa.RecordBatch, name: str) -> list[np.ndarray | None]:
    """The rows of a list column as arrays."""
    column = batch.column(batch.schema.names.index(name))
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] if ok else None for a, b, ok in zip(at[:-1], at[1:], column.is_valid().to_pylist())]
