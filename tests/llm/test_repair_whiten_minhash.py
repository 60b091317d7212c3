import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from partledger.llm import minhash, repair, whiten
from partledger.llm.common import prepare
from partledger.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


# Conversations ---------------------------------------------------------------------------------------------

def kinds(rows):
    """(role, text, fault) of the rows of one conversation, ordered."""
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    for _, role, text in order:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not words else "duplicate" if (role, text) in seen else
                 "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """Least (cost, audit) and its repaired rows, by trying every sequence of edits with at most three insertions
    in a row, cheapest first."""
    heap, best = [(0, "", 0, ())], None
    done = set()
    import heapq
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        initials = "".join(r[:1] or "?" for r, _ in out)
        if (i, initials, audit) in done or not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        done.add((i, initials, audit))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, out)
        if not audit.endswith("III"):
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 5, audit + "I", i, (*out, (r, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out))
            if fault not in ("blank", "duplicate"):
                stay = 5 if fault else 0
                heapq.heappush(heap, (cost + stay, audit + "K", i + 1, (*out, (role, text))))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + stay + 1, audit + "R", i + 1, (*out, (r, text))))
    return best


def expected(rows):
    found = kinds(rows)
    cost, audit, out = cheapest(found)
    turns = [t for t, _, _ in rows if t is not None]
    count = lambda f: sum(x[2] == f for x in found)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(found))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    edits, conversations = repair.repair(df)
    read = {r.conv_id: r for r in repair.digests(edits).collect()}
    return {r.conv_id: tuple(getattr(r, c, None) if c in r else read[r.conv_id][c] for c in COLUMNS) for r in conversations.collect()}


def test_repair_against_search(spark):
    prepare(spark)
    random = np.random.default_rng(3)
    roles, texts = ["user", "assistant", "system", "tool", "user", "assistant"], ["One.", "Two!", "Three", " ", "", "Four?", "Five"]
    rows = [(c, int(random.integers(0, 6)) if random.random() < 0.9 else None, roles[random.integers(6)], texts[random.integers(7)])
            for c in range(60) for _ in range(random.integers(1, 7))]
    got = repaired(spark.createDataFrame(rows, TURNS))
    want = {c: expected([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_repair_across_blocks(spark, monkeypatch):
    """A conversation longer than a block of backpointers is repaired as a whole."""
    prepare(spark)
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(1, 2000)]
    rows += [(1, 100, "user", "again"), (2, 0, "user", "Hello."), (2, 1, "assistant", "Hello.")]
    rows += [(1, 700, "user", "Copied.")] * 50
    df = spark.createDataFrame(rows, TURNS)
    whole = repaired(df)
    monkeypatch.setattr(repair, "BLOCK", 7)
    assert repaired(df) == whole
    assert whole[1][COLUMNS.index("cost")] >= 2 * 49 and len(whole[1][COLUMNS.index("audit")]) == 2050
    assert whole[2][:7] == (0, 0, 0, 0, 0, 0, "KK")


def test_repair_odd_rows(spark):
    prepare(spark)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (None, 2, "assistant", "So."), (3, None, "", "x."),
            (4, 0, "user", "a" * 200_000 + "."), (4, 1, "assistant", "end.\u0085")]
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows], TURNS + ", digest string, seq string")
    got = repaired(df)
    assert got[None][:7] == (0, 1, 1, 0, 2, 4, "DKDK")
    assert got[3][5:7] == (2, "D")
    assert got[4][3] == 1 and got[4][5:7] == (4, "DD")
    assert repaired(spark.createDataFrame([], TURNS)) == {}


def test_registered_repair(spark):
    turns = prepare(spark).read.parquet(f"{FOLDER}/conversations.parquet").collect()
    after = {r.conv_id: [] for r in turns}
    for r in turns:
        role, text = (" " if x is None else x for x in (r.role, r.text))
        fate = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        after[r.conv_id] += [(r.turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = QUERIES["op11_conversation_repair"](spark, FOLDER).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == {c: expected(v) if v else empty for c, v in after.items()}
    assert len(got) == len(after)


# Whitening ---------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>"


def check_whitened(rows, vectors):
    """Rows of whiten() against a plain eigendecomposition."""
    x = np.floor(np.array([v for _, v in vectors], np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    far = n * x - sums
    cov = (far / n).T @ (far / n) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(32, int((values > 1e-9 * values[0]).sum()))
    place = {i: p for p, (i, _) in enumerate(vectors)}
    white = np.empty((n, k))
    for r in rows:
        assert r.n == n and r.deviation == int((far[place[r.vec_id]].astype(object) ** 2).sum()) and r.identity_error < 1e-9
        assert np.allclose(r.explained, values[:k] / np.trace(cov), rtol=1e-9)
        white[place[r.vec_id]] = r.whitened
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
    want = far / n @ axes[:, :k] / np.sqrt(values[:k])
    apart = np.abs(np.diff(values[:k + 1])) > 1e-6 * values[0]
    sure = [j for j in range(k) if (j == 0 or apart[j - 1]) and (j == len(apart) or apart[j])]
    assert sure
    for j in sure:
        assert np.allclose(white[:, j] * np.sign(white[0, j] * want[0, j]), want[:, j], atol=1e-8)


def test_whitening(spark):
    prepare(spark)
    random = np.random.default_rng(5)
    base = random.normal(size=(900, 40)) * np.geomspace(1, 300, 40)
    plain = [(i, v.tolist()) for i, v in enumerate(base.astype(np.float32))]
    check_whitened(whiten.whiten(spark.createDataFrame(plain, VECTORS)).collect(), plain)
    # Constant, repeated and dependent dimensions: fewer components than dimensions.
    flat = np.concatenate([base[:, 30:36].round(), base[:, 30:32].round(), np.full((900, 3), 2.0)], axis=1)
    plain = [(i, v.tolist()) for i, v in enumerate(flat.astype(np.float32))]
    rows = whiten.whiten(spark.createDataFrame(plain, VECTORS)).collect()
    assert {len(r.whitened) for r in rows} == {6}
    check_whitened(rows, plain)
    # Fewer vectors than dimensions.
    few = [(i, v.tolist()) for i, v in enumerate(base[:5].astype(np.float32))]
    rows = whiten.whiten(spark.createDataFrame(few, VECTORS)).collect()
    assert {len(r.whitened) for r in rows} == {4}
    check_whitened(rows, few)


def test_whitening_of_odd_vectors(spark):
    prepare(spark)
    rows = [(1, [0.5, 1.0]), (2, [1.5, -1.0]), (2, [1.5, -1.0]), (None, [0.25, 0.5]), (3, None), (4, []), (5, [1.0, None]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (9, [3e38, 0.0])]
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], VECTORS + ", x string, n int")
    got = whiten.whiten(df).collect()
    assert sorted(r.vec_id or 0 for r in got) == [0, 1, 2, 2] and {r.n for r in got} == {4}
    assert {len(r.whitened) for r in got} == {2}
    same = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS)).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in same] == [(0, [], [])] * 2
    assert whiten.whiten(spark.createDataFrame([], VECTORS)).collect() == []


def test_deviation_beyond_a_long(spark):
    prepare(spark)
    rows = whiten.whiten(spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>"))
    assert {r.vec_id: r.deviation for r in rows.collect()}[1] is None


def test_registered_whitening(spark):
    vectors = [(r.vec_id, r.embedding) for r in prepare(spark).read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    out = QUERIES["op12_whitened_vectors"](spark, FOLDER)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    rows = {}
    for r in out.orderBy("vec_id", "component").collect():
        rows.setdefault(r.vec_id, []).append(r)
        assert r.component == len(rows[r.vec_id])

    class Row:
        def __init__(self, parts):
            self.vec_id, self.n, self.deviation, self.identity_error = parts[0].vec_id, parts[0].n, parts[0].deviation, parts[0].identity_error
            self.whitened, self.explained = [p.whitened for p in parts], [p.explained for p in parts]
    assert len(rows) == len(vectors)
    check_whitened([Row(p) for p in rows.values()], vectors)


# Near duplicates -----------------------------------------------------------------------------------------------

def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def brute_classes(rows):
    """Per row: (id, size, smallest id reachable), by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted((str(d), len(s), str(least.get(top(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def classes(df):
    rows = minhash.similar(df).collect()
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows), rows


def test_registered_near_duplicates(spark):
    docs = [(r.doc_id, r.text) for r in prepare(spark).read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op13_near_duplicates"](spark, FOLDER).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and any(not r.kept for r in got)


def test_chains_and_shared_passages(spark):
    """Copies that differ a little more at each step, and texts that share two fifths of their words."""
    prepare(spark)
    random = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    text = random.choice(words, 160).tolist()
    rows = []
    for i in range(40):
        at = random.integers(0, 150)
        text[at:at + 3] = random.choice(words, 3).tolist()
        rows.append((1000 - i, " ".join(text)))
    passage = random.choice(words, 60).tolist()
    rows += [(i, " ".join([*passage, *random.choice(words, 90)])) for i in range(300)]
    rows += [(2000 + i, " ".join([*passage[:50], *random.choice(words, 6)])) for i in range(60)]
    assert classes(spark.createDataFrame(rows, "doc_id long, text string"))[0] == brute_classes(rows)


def test_second_look_within_bands(spark, monkeypatch):
    """With one coordinate a band nearly all texts share bands with unlike ones: links found beside the least."""
    prepare(spark)
    random = np.random.default_rng(9)
    words = [f"w{i}" for i in range(400)]
    passage = random.choice(words, 40).tolist()
    rows = []
    for i in range(50):
        own = random.choice(words, 60).tolist()
        rows += [(i * 2, " ".join(passage + own)), (i * 2 + 1, " ".join(passage + own[:-1] + ["other"]))]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.similar(df, rows=1).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(rows)


def test_near_duplicates_of_odd_rows(spark, odd, none):
    names = ["key", "bands", "n_shingles", "digest", "first", "head", "root", "marks", "component_id", "keeper"]
    from pyspark.sql import functions as F
    got, rows = classes(odd.withColumns({n: F.lit("mine") for n in names}))
    want = brute_classes([(r.doc_id, r.text) for r in odd.collect()])
    bare = [g for g in got if g[1] == 0]
    assert [g for g in got if g[1]] == [w for w in want if w[1]] and all(d == c for d, _, c in bare)
    assert all(r.keeper for r in rows if r.n_shingles == 0)
    assert minhash.similar(none).collect() == []


def test_cases_and_spaces_are_one_set(spark):
    prepare(spark)
    rows = [(5, "A b C d E"), (4, "a  b\tc d\ne"), (3, "Ä b c d e"), (2, "ä b c d e"), (1, "x"), (7, "X "), (8, "x y")]
    assert classes(spark.createDataFrame(rows, "doc_id long, text string"))[0] == brute_classes(rows)


def test_permutation_is_one(spark):
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(minhash.permute(x, 0x7FEB352D, 0x846CA68B))) == 1 << 16


def test_signatures_estimate_similarity(spark):
    random = np.random.default_rng(4)
    values = random.integers(0, 1 << 63, 300, dtype=np.uint64)
    a, b = values[:250], values[50:]
    sign = minhash.signature(np.concatenate([a, b]), np.array([0, 250]), 2000)
    assert abs((sign[0] == sign[1]).mean() - 200 / 300) < 0.05
