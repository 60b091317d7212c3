"""The registered queries without SQL, on the smallest tables, against what their contracts say in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import vocabulary
from partledger.llm import bpe, linededup, near
from partledger.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
HELPERS = ["_id", "_KEY", "_n", "_doc", "_hash", "_id_", "_name", "_copies", "_row", "_rows", "_time", "key_", "hub", "class"]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for d, t in texts.items():
        ids = tok.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
    got = QUERIES["op1_bpe_round_trip"](spark, FOLDER).collect()
    assert len(got) == len(want) and {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_op4(spark, texts):
    words = {d: WORD.findall(t) for d, t in texts.items()}
    grams = {d: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, w in words.items()}
    links = {d: {e for e in grams if e != d and grams[d] and 5 * len(grams[d] & grams[e]) >= 4 * len(grams[d] | grams[e])} for d in grams}
    want = {}
    for d in grams:
        seen, todo = {d}, [d]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        want[d] = (min(seen), len(links[d]))
    got = QUERIES["op4_similar_texts"](spark, FOLDER).collect()
    assert len(got) == len(want) and {r.doc_id: (r.class_id, r.n_links) for r in got} == want


def test_op5(spark, texts):
    tok, at, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, {}
    for d in sorted(texts):
        ids = np.array([*tok.encode(texts[d], add_special_tokens=False).ids, 0], "<u4")
        want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = QUERIES["op5_token_files"](spark, FOLDER).collect()
    assert len(got) == len(want) and {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want


def test_op6(spark, texts):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op6_language_id"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    learned = {lang for d, lang in langs.items() if lang is not None and zlib.crc32(str(d).encode()) % 4 != 2}
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in learned or not any(map(str.isalpha, texts[r.doc_id]))
        right += [r.lang_pred == langs[r.doc_id]] if r.held_out and len(texts[r.doc_id]) > 200 else []
    assert sum(right) >= 0.9 * len(right) > 0


def test_op9(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        words, lines, seen, dup = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)], set(), 0
        for line in lines:
            dup += line in seen
            seen.add(line)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        twice = {w for w in set(windows) if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
        repeated = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated), failed), d
        assert not (failed and r.kept)


def test_op10(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got, hits = {}, 0
    for r in QUERIES["op10_nearest_vectors"](spark, FOLDER).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(got) == sorted(queries)
    for q in queries:
        scores = m @ m[ids == q][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        found = [got[q][k] for k in range(1, 21)]
        assert len(got[q]) == 20 and all(abs(s - scores[ids == v][0]) < 1e-9 for v, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len({int(ids[i]) for i in order} & {v for v, _ in found})
    assert hits >= 0.9 * 20 * len(queries)


def test_columns_named_like_helpers_stay(odd):
    docs = odd.withColumns({n: F.lit("mine") for n in HELPERS})
    kept, cut = near.keep_one(docs), linededup.dedup_lines(docs)
    assert kept.columns == docs.columns and sorted(cut.columns) == sorted([*docs.columns, "kept_text", "n_lines", "dropped"])
    for out in (kept, cut):
        assert {v for r in out.select(*HELPERS).collect() for v in r} == {"mine"}
    plain = near.keep_one(odd)
    assert sorted(map(str, kept.select(*odd.columns).collect())) == sorted(map(str, plain.collect()))


def test_decoded_text_replaces_a_text(odd):
    words = vocabulary("word_bpe_49k.json")
    encoded = bpe.encode(odd, words)
    clashing = encoded.withColumns({"Text": F.lit("mine"), "other": F.lit(1)})
    got = bpe.decode(clashing, words)
    assert got.columns == ["doc_id", "other", "text"]
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, bpe.decode(encoded, words).collect()))


def test_pieces_go_to_the_positions_of_their_ids():
    """Blocks and the rows behind them, in batches of any size; ids without a piece are left out."""
    pick, pieces = random.Random(5), {i: f"w{i}" for i in range(50) if i != 13}
    lists = [None if k % 7 == 3 else [pick.randrange(50) for _ in range(pick.choice([0, 1, 5, 40]))] for k in range(60)]
    table = pa.table({"name": pa.array(range(60)), "ids": pa.array(lists, pa.list_(pa.int32()))})
    want = [(k, None if x is None else " ".join(pieces[i] for i in x if i != 13)) for k, x in enumerate(lists)]
    for block_ids, rows, joined_rows in ((1, 1, 1), (30, 7, 3), (10**6, 60, 1000), (100, 4, 256)):
        asked = pa.Table.from_batches(list(bpe._wanted("ids", block_ids)(iter(table.to_batches(rows)))))
        found = pa.table([asked["id"], pa.array([pieces.get(i) for i in asked["id"].to_pylist()]), asked["n_wanted"], asked["block"]],
                         ["id", "piece", "n_wanted", "block"]).combine_chunks()
        out = pa.Table.from_batches(list(bpe._with_pieces("ids", ["name"])(iter(found.to_batches(joined_rows)))))
        assert list(zip(out["name"].to_pylist(), out["text"].to_pylist())) == want
        lost = max(k for k, i in enumerate(found["id"].to_pylist()) if i is not None)
        left = found.take([k for k in range(found.num_rows) if k != lost]).combine_chunks()
        with pytest.raises(ValueError):
            list(bpe._with_pieces("ids", ["name"])(iter(left.to_batches(joined_rows))))


def test_decoding_is_a_join_without_a_shuffle(spark):
    words = vocabulary("word_bpe_49k.json")
    encoded = spark.createDataFrame([(1, [5, 5, 10**6]), (2, None), (3, [])], "doc_id long, ids array<int>")
    text = bpe.decode(encoded, words)
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    got = {r.doc_id: r.text for r in text.collect()}
    piece = Tokenizer.from_str(words).id_to_token(5)
    assert got == {1: f"{piece} {piece}", 2: None, 3: ""}
    assert bpe.decode(encoded.where("false"), words).count() == 0
