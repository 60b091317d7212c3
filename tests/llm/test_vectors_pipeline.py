import importlib

import numpy as np
import pytest

from partledger.llm import ann
from partledger.llm.queries import ORACLE_SQL, QUERIES

VECTORS = "vec_id long, embedding array<float>"


def sound(rows):
    """Per vector length: ids and vectors that take part."""
    by_size = {}
    for i, v in rows:
        if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            by_size.setdefault(len(v), ([], []))
            by_size[len(v)][0].append(i)
            by_size[len(v)][1].append(v)
    return {d: (np.array(i), np.array(v, np.float64)) for d, (i, v) in by_size.items()}


def exact(table, k, query):
    """Brute force: the k best (id, score) of a query."""
    ids, vectors = table.get(len(query[1]), (np.zeros(0, int), np.zeros((0, len(query[1])))))
    scores, best = vectors @ np.array(query[1], np.float64), {}
    for i, s in zip(ids.tolist(), scores.tolist()):
        if i != query[0]:
            best[i] = max(best.get(i, -np.inf), s)
    return sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]


def compare(spark, rows, k, **settings):
    df = spark.createDataFrame(rows, VECTORS)
    asked = [(i, v) for i, v in rows if i is not None and i % 20 == 0]
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), k, **settings).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    hits = total = 0
    table = sound(rows)
    for query in asked:
        if not query[1] or any(x is None or not np.isfinite(x) for x in query[1]) or not any(query[1]):
            assert query[0] not in got
            continue
        want = exact(table, k, query)
        have = got.get(query[0], [])
        hits += len({i for i, _ in want} & {i for i, _ in have})
        total += len(want)
        scores = dict(exact(table, len(rows), query))
        assert all(abs(scores[i] - s) < 1e-9 for i, s in have)
        assert have == sorted(have, key=lambda x: (-x[1], x[0]))
    return hits / max(1, total)


def unit(n, seed, d=64):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return [(i, v) for i, v in enumerate((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).tolist())]


def test_recall_on_random_vectors(spark):
    assert compare(spark, unit(1500, 1), 20) >= 0.9


def test_recall_with_split_cells(spark):
    # As many vectors as a test can hold; with fewer, the nearest ones are hardly nearer than the rest.
    assert compare(spark, unit(3000, 2), 10, crowded=4, enough=64) >= 0.9


@pytest.mark.parametrize("n", [3, 10, 21, 40, 200])
def test_small_tables_are_searched_whole(spark, n):
    rows = [(i * 20, v) for i, v in unit(n, 12)]
    df = spark.createDataFrame(rows, VECTORS)
    found = ann.nearest(df, df, 20).groupBy("query_id").count().collect()
    assert {r["count"] for r in found} == {min(20, n - 1)} and len(found) == n
    assert compare(spark, rows, 20) == 1


@pytest.mark.parametrize("crowded", [ann.CELL_VECTORS, 200])
def test_outliers_beside_a_cluster(spark, crowded):
    """A dense cluster splits cells; vectors far from it, and those of another length, keep their neighbours."""
    random = np.random.default_rng(13)
    centre = random.normal(size=64)
    cluster = centre + random.normal(size=(3000, 64)) * 0.1
    rows = [(i * 7 + 1, v) for i, v in enumerate((cluster / np.linalg.norm(cluster, axis=1, keepdims=True)).astype(np.float32).tolist())]
    rows = [(i, v) for i, v in rows if i % 20]
    rows += [(100_000 + 20 * i, v) for i, v in unit(300, 14)] + [(200_000 + 20 * i, v) for i, v in unit(25, 15, d=8)]
    assert compare(spark, rows, 20, crowded=crowded) >= 0.9


def test_large_cells_are_searched_whole(spark):
    """What is found in a cell does not change when the table has grown past some number of vectors."""
    random = np.random.default_rng(17)
    assert ann.CELL_VECTORS is None  # no cell is split by its number of vectors
    centre = random.normal(size=16)
    cluster = centre + random.normal(size=(4800, 16)) * 0.25
    vectors = (cluster / np.linalg.norm(cluster, axis=1, keepdims=True)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors) if i % 20 or i < 400]
    assert compare(spark, rows, 20) >= 0.99


def test_hot_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 40)
    rows = unit(600, 3)
    near = [(i, (np.array(rows[0][1]) + 0.01 * np.array(rows[i][1])).astype(np.float32).tolist()) for i in range(0, 600, 3)]
    assert compare(spark, [*near, *(r for r in rows if r[0] % 3)], 5) >= 0.9


def test_ties_repeats_and_unsound_vectors(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(i, same) for i in range(0, 90)] + [(3, same), (200, [2.0, 0.0, 0.0]), (201, [0.0, 0.0, 0.0]), (202, None), (203, [1.0, None, 1.0]),
            (220, [float("nan"), 1.0, 0.0]), (240, [float("inf"), 1.0, 0.0]), (None, same), (260, [1.0, 1.0]), (261, [0.5, 0.5])]
    assert compare(spark, rows, 5) == 1.0


def test_few_and_no_vectors(spark):
    assert compare(spark, unit(3, 4), 20) == 1.0
    empty = spark.createDataFrame([], VECTORS)
    assert ann.nearest(empty, empty).isEmpty()


def test_rotations_keep_lengths_and_angles():
    x = np.array([v for _, v in unit(50, 5)])
    turned = ann.axis_scores(x, 1, 0)[:, :64]
    assert np.allclose(turned @ turned.T, x @ x.T)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import os
    import sys

    import duckdb

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    import check

    con, folder = duckdb.connect(), "/root/testdata/sf0.001"
    for t in check.TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    message, _, same = check.compare(spark, con, folder, name, ORACLE_SQL[name])
    assert same, message


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("unknown", ["de", "en", "es", "fr"])
def test_documents_of_a_language_not_learned_go(spark, unknown):
    from pyspark.sql import functions as F

    from partledger.llm.common import prepare

    pipeline, folder = importlib.import_module("corpus_pipeline"), "/root/testdata/sf0.01"
    clean = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    docs = prepare(spark).read.parquet(f"{folder}/documents.parquet")
    # A language without a label is not learned.
    own = F.coalesce(F.col("lang") != unknown, F.lit(True))
    judged = docs.withColumn("source", F.when(own, F.lit("learned"))).withColumn("lang", F.when(own, F.col("lang")))
    kept = pipeline.identify_language(spark, judged, "")
    foreign = docs.where(~own & (F.length("text") >= 50)).count()
    # Some hold lines of a learned language.
    assert kept.where("source is null and length(text) >= 50").count() <= 0.03 * foreign
    want = judged.join(clean, "doc_id").where("source is not null")
    assert kept.join(clean, "doc_id").where("source is not null").count() == want.count()


def test_pipeline_stages(spark, corpus, odd):
    pipeline = importlib.import_module("corpus_pipeline")
    for docs in (corpus, odd.select(corpus.columns)):
        kept, counts = docs, [docs.count()]
        for name, stage in pipeline.STAGES[:-1]:
            before = kept
            kept = stage(spark, kept, "")
            assert kept.columns == docs.columns, name
            if name != "mixing sources to target weights":
                assert kept.count() <= before.count()
            counts.append(kept.count())
        last = pipeline.STAGES[-1][1](spark, kept, "")
        assert last.count() == counts[-1]
        texts = {(r.doc_id) for r in docs.collect()}
        assert {r.doc_id for r in last.collect()} <= texts
    for name, stage in pipeline.STAGES:
        assert stage(spark, corpus.limit(0), "").isEmpty()
