import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import vocabulary
from partledger.llm import bpe, tokenfile
from partledger.session import shared_dir

WORDS, BYTES = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
LIBRARY = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def wanted(name, text):
    return LIBRARY[name].encode(text or "", add_special_tokens=False).ids


def test_words_and_texts_encode_as_in_the_library():
    pick = random.Random(1)
    texts = ["".join(pick.choice("aZ'sée<|> ́ \n\t\x1c9½ÀÿßİΣ中́  ") for _ in range(80)) for _ in range(300)]
    texts += ["x<|endoftext|>y <|startoftext|> It'S 'll's", "a  b\n\n c ", "  ", "\u0085  x"]
    word, whole = bpe.WordEncoder(WORDS), tokenfile.TextEncoder(BYTES)
    assert word.short and whole.short
    for t in texts:
        assert [i for w in bpe._WORD.findall(t) for i in word(w)] == wanted("word_bpe_49k.json", t), repr(t)
        assert list(whole(t)) == wanted("byte_bpe_50k.json", t), repr(t)


def test_every_common_character_encodes_as_in_the_library():
    word, whole = bpe.WordEncoder(WORDS), tokenfile.TextEncoder(BYTES)
    for c in map(chr, [*range(1, 0x250), *range(0x370, 0x500, 7), *range(0x4e00, 0x4f00, 17)]):
        t = f"a{c}b {c}{c} 1{c}"
        assert [i for w in bpe._WORD.findall(t) for i in word(w)] == wanted("word_bpe_49k.json", t), hex(ord(c))
        assert list(whole(t)) == wanted("byte_bpe_50k.json", t), hex(ord(c))


@pytest.mark.parametrize("table", ["odd", "clashing", "corpus", "none"])
def test_bpe_round_trip(table, request, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 30_000)
    docs = request.getfixturevalue(table)
    encoded = bpe.encode(docs, WORDS)
    got = sorted((str(r.doc_id), r.ids) for r in encoded.collect())
    assert got == sorted((str(r.doc_id), wanted("word_bpe_49k.json", r.text)) for r in docs.collect())
    texts = sorted((str(r.doc_id), r.text) for r in bpe.decode(encoded, WORDS).collect())
    both = sorted((str(r.doc_id), r.ids, r.text) for r in bpe.round_trip(docs, WORDS).collect())
    assert sorted((d, t) for d, _, t in both) == texts and sorted((d, ids) for d, ids, _ in both) == got
    assert texts == sorted((d, LIBRARY["word_bpe_49k.json"].decode(ids, skip_special_tokens=False)) for d, ids in got)


def test_tokenizer_that_needs_white_space_is_refused(odd):
    with pytest.raises(ValueError):
        bpe.encode(odd, BYTES)


@pytest.mark.parametrize("table", ["odd", "clashing", "corpus", "none"])
def test_token_files_round_trip(spark, table, request):
    docs, path = request.getfixturevalue(table), shared_dir(spark, "tokens")
    tokenfile.write_tokens(docs, path, BYTES, end_id=0, block_bytes=2000)
    read = tokenfile.read_tokens(spark, path).join(tokenfile.block_starts(spark, path), ["part", "seq"])
    got = [(r.doc_id, r.start + r.offset, np.frombuffer(r.ids, "<u4").tolist(), r.crc)
           for r in read.withColumn("crc", F.crc32("ids")).collect()]
    got.sort(key=lambda r: r[1])
    want = sorted((r.doc_id is None, r.doc_id or 0, wanted("byte_bpe_50k.json", r.text) + [0]) for r in docs.collect())
    assert sorted((d is None, d or 0, ids) for d, _, ids, _ in got) == want
    assert [d for d, *_ in got] == [d for d in sorted((d for d, *_ in got), key=lambda d: (d is None, d))]
    at = 0
    for _, start, ids, crc in got:
        assert start == at and crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


@pytest.mark.parametrize("seed", range(6))
def test_code_lengths_are_optimal_within_the_limit(seed):
    pick = np.random.default_rng(seed)
    counts = np.sort(pick.integers(1, 10 ** pick.integers(1, 6), pick.integers(2, 60)))
    assert (2.0 ** -tokenfile.code_lengths(counts, 16)).sum() <= 1
    # Without a tight limit the cost is that of plain Huffman coding.
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        a, b = heap[0], heap[1]
        cost += a + b
        heap = sorted([*heap[2:], a + b])
    assert (counts * tokenfile.code_lengths(counts, 40)).sum() == cost
    tight = tokenfile.code_lengths(counts, 6)
    assert tight.max() <= 6 and (2.0 ** -tight).sum() <= 1
    assert tokenfile.code_lengths(np.array([5])).tolist() == [1] and not len(tokenfile.code_lengths(np.array([], np.int64)))
