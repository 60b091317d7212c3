import base64
import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from partledger.llm import langid, linededup, near, quality
from partledger.llm.common import components

import public_tokenizers

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
SPACE = "[^\x20\x09-\x0d]+"


# Language ID

def test_languages_are_told_apart(corpus):
    spark = corpus.sparkSession
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = langid.prototypes(docs.where(~held))
    got = langid.identify(docs.where(held), *learned).where("length(text) > 100").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    some = langid.prototypes(docs.where(~held), train_rows=20)
    assert some[0] == learned[0]
    assert (np.sum(some[1] * learned[1], axis=1) > 0.9).all()


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_language_of_odd_rows(table, request, corpus):
    docs, learned = request.getfixturevalue(table), langid.prototypes(corpus)
    got = langid.identify(docs, *learned)
    assert got.count() == docs.count() and set(got.columns) == {*docs.columns, "lang_pred", "score"}
    for r in got.collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    nothing = langid.prototypes(docs.limit(0))
    assert nothing[0] == [] and {r.lang_pred for r in langid.identify(docs, *nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), *learned).isEmpty()


def test_slices_of_long_texts_add_up(monkeypatch):
    text = "Über den Wolken, 99 mal!  naïve façade " * 40
    whole = langid.bundle([text, "kurz"])
    monkeypatch.setattr(langid, "SLICE_CHARS", 97)
    assert np.array_equal(langid.bundle([text, "kurz"]), whole)
    monkeypatch.setattr(langid, "DENSE", 0)
    assert np.array_equal(langid.bundle([text, "kurz"]), whole)


def test_bundle_is_the_sum_of_bound_triples():
    roll = lambda c, n: np.roll(langid.letter_vector(ord(c) if c else 0).astype(int), n)
    want = roll("", 2) * roll("a", 1) * roll("b", 0) + roll("a", 2) * roll("b", 1) * roll("", 0)
    assert np.array_equal(langid.bundle(["  Ab!"])[0], want)


# Quality rules

def brute_counts(text):
    words = re.findall(SPACE, text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("table", ["odd", "clashing", "corpus"])
def test_quality_counts(table, request):
    docs = request.getfixturevalue(table)
    got = quality.measure(docs, MODEL).collect()
    assert len(got) == docs.count()
    for r in got:
        have = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert have == brute_counts(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.measure(docs.limit(0), MODEL).isEmpty()


def test_clean_documents_are_kept(corpus):
    spark, folder = corpus.sparkSession, "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    got = quality.measure(docs.where("quality = 1").select("doc_id", "text"), MODEL).where("not base_failed")
    assert got.where("not kept").isEmpty()


def test_noise_leaves_its_band():
    assert quality.script("Привет, мир") == "cyrillic" and quality.script("123") == "other" and quality.script("中文字 ab") == "han"


def test_noise_is_rejected(spark):
    pick = random.Random(2)
    noise = " ".join("".join(chr(pick.randrange(0x1200, 0x1300)) if i % 2 else "q" for i in range(6)) for _ in range(60))
    few = " ".join(f"z{'y' * (i % 4)}" for i in range(400))
    prose = "The plant ships pumps and valves to forty customers, who install them in water works across the whole country."
    df = spark.createDataFrame([(1, noise), (2, few), (3, prose)], "doc_id long, text string")
    latin = {**quality.BANDS, "other": quality.Band(1.0, 12.0, 0.2)}
    assert {r.doc_id: r.kept for r in quality.measure(df, MODEL, bands=latin).collect()} == {1: False, 2: False, 3: True}


def test_noise_is_rejected_by_the_production_bands(spark):
    pick = random.Random(4)
    words = lambda letters, n=200: " ".join("".join(pick.choices(letters, k=pick.randint(3, 9))) for _ in range(n))
    span = lambda a, b: [c for c in map(chr, range(a, b)) if c.isalpha()]
    noise = {
        "letters": words("abcdefghijklmnopqrstuvwxyz"), "base64": " ".join(base64.b64encode(pick.randbytes(48)).decode() for _ in range(30)),
        "short base64": " ".join(base64.b64encode(pick.randbytes(4)).decode()[:5] for _ in range(20)),
        "symbols": words("*#$%&|<>=~"), "runs": " ".join(pick.choice("*#=-~_") * pick.randint(3, 20) for _ in range(200)),
        "private": words([chr(c) for c in range(0xE000, 0xE200)]), "emoji": words([chr(c) for c in range(0x1F600, 0x1F640)]),
        "Latin": words(span(0x180, 0x250)), "Greek": words(span(0x370, 0x400)), "Cyrillic": words(span(0x430, 0x450)),
        "Arabic": words(span(0x620, 0x700)), "Devanagari": words(span(0x904, 0x93A)), "Thai": words(span(0xE01, 0xE46)),
        "kana": words(span(0x3041, 0x30FF)), "Han": words(span(0x4E00, 0x9FFF)), "Hangul": words(span(0xAC00, 0xD7A3))}
    clean = {
        "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
        "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hoá ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình bằng hữu.",
        "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
        "kk": "Барлық адамдар тумысынан азат және қадір-қасиеті мен құқықтары тең болып дүниеге келеді. Адамдарға ақыл-парасат, ар-ождан берілген.",
        "gu": "પ્રતિષ્ઠા અને અધિકારોની દૃષ્ટિએ સર્વ માનવો જન્મથી સ્વતંત્ર અને સમાન હોય છે. તેમનામાં વિચારશક્તિ અને અંતઃકરણ હોય છે અને તેમણે પરસ્પર બંધુત્વની ભાવનાથી વર્તવું જોઇએ.",
        "am": "የሰው ልጅ ሁሉ ሲወለድ ነጻና በክብርና በመብትም እኩልነት ያለው ነው። የተፈጥሮ ማስተዋልና ሕሊና ስላለው አንዱ ሌላውን በወንድማማችነት መንፈስ መመልከት ይገባዋል።",
        "table": " ".join(f"{pick.random() * 1000:.2f}" for _ in range(200))}
    df = spark.createDataFrame([*noise.items(), *clean.items()], "doc_id string, text string")
    got = {r.doc_id: r for r in quality.measure(df, MODEL).collect()}
    assert not any(got[n].base_failed for n in got)
    assert {n for n in got if got[n].kept} == set(clean)


# Line dedup

def test_templates_with_fields_are_dropped(spark):
    lines = ["Posted by user{} on 2024-01-{:02} in the general section", "unique line about {} and {}th things only here"]
    docs = [(i, "\n".join([lines[0].format(i, i + 1), "", lines[1].format("abcdefgh"[i], i), "Own words of number " + "abcdefgh"[i]]))
            for i in range(8)]
    got = {r.doc_id: r for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0].dropped == [] and got[0].kept_text == docs[0][1] and got[0].n_lines == 4
    for i in range(1, 8):
        assert 0 in got[i].dropped and 1 not in got[i].dropped
        assert got[i].kept_text == "\n".join(x for k, x in enumerate(docs[i][1].split("\n")) if k not in got[i].dropped)


def test_templates_beside_the_seed_are_dropped(spark):
    lines = ["Page {} of {}",                                                  # half of it fields
             "The press was stopped after part {} left its track today",       # the seed of its leaf
             "The press was stopped because of alarm {} near gate {}",         # a second template of that leaf
             "{} {}"]                                                          # no constant: data
    docs = [(i, "\n".join([lines[0].format(i, i + 10), lines[1].format(i), *([lines[2].format(i, 9 - i)] if i % 2 else []),
                           lines[3].format(i, i + 1)])) for i in range(8)]
    got = {r.doc_id: r.dropped for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {0: [], 1: [0, 1], **{i: [0, 1, 2] if i % 2 else [0, 1] for i in range(2, 8)}}


def test_line_templates_in_sql(spark, tmp_path):
    """The query and its SQL on lines that differ in digits, beside the seed and as data, and in odd white space."""
    import duckdb

    from partledger.llm.queries import ORACLE_SQL, QUERIES

    docs = [(i, "\n".join([f"Page {i} of {i + 10}", f"The press was stopped after part {i} left its track today", f"{i} {i + 1}", "\r a\tb 7 ",
                           f"The press was stopped because of alarm {i} near gate {9 - i}", "1  2", "plain words here"])) for i in range(8)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([*docs, (None, "1  2\n3 4"), (9, None), (10, "")], "doc_id long, text string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    result = con.execute(ORACLE_SQL["op7_line_dedup"])
    names = [c[0] for c in result.description]
    want = sorted(tuple(str(v) for v in r) for r in result.fetchall())
    got = sorted(tuple(str(r[n]) for n in names) for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect())
    assert got == want and any(r[names.index("n_dropped")] not in ("0",) for r in got)


def test_lines_of_other_wording_stay(spark):
    docs = [(1, "The cat sat on a mat near doors"), (2, "The cat sat on red chairs behind us"), (3, "The cat sat on a mat near doors"),
            (3, "tail\nThe cat sat on a mat near doors"), (None, "tail"), (4, "x 1"), (5, "y 1")]
    got = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text, r.dropped) for r in got) == [
        ("1", docs[0][1], []), ("2", docs[1][1], []), ("3", docs[0][1], [0]), ("3", docs[3][1], [1]), ("4", "x 1", []),
        ("5", "y 1", []), ("None", "tail", [0])]


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_line_dedup_of_odd_rows(table, request):
    docs = request.getfixturevalue(table)
    got = linededup.dedup_lines(docs)
    assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
    assert got.where("text is null and (kept_text is not null or n_lines <> 0)").isEmpty()
    assert all(r.dropped == [] for r in got.collect())
    assert linededup.dedup_lines(docs.limit(0)).isEmpty()


# N-gram join

def grams(text, n=5):
    words = re.findall(SPACE, text or "")
    return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[i:i + n]) for i in range(len(words) - n + 1)])


def brute_links(rows):
    sets = [grams(t) for _, t in rows]
    links = [[j for j in range(len(rows)) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
             for i in range(len(rows))]
    group = list(range(len(rows)))
    for _ in rows:
        for i, own in enumerate(links):
            for j in own:
                group[i] = group[j] = min(group[i], group[j])
    ids = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return sorted(((str(rows[i][0]), str(ids[group[i]]) if sets[i] else str(rows[i][0]), len(links[i])) for i in range(len(rows))))


def edited(seed, n=70):
    """Near copies of a few texts, some of them chained, in a table of others."""
    pick, out = random.Random(seed), []
    for base in range(6):
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.choice([3, 30, 120, 400]))]
        for _ in range(n // 6):
            copy = list(words)
            for _ in range(pick.randrange(4)):
                copy[pick.randrange(len(copy))] = f"e{pick.randrange(50)}"
            out.append((len(out), " ".join(copy)))
            if pick.random() < 0.2:
                words = copy
    return out


@pytest.mark.parametrize("block", [400, 3])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = edited(4)
    got = near.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == brute_links(rows)
    assert collections.Counter(r.class_id for r in got if r.keeper) == collections.Counter({r.class_id for r in got})


@pytest.mark.parametrize("table", ["odd", "clashing", "corpus"])
def test_links_of_given_rows(table, request):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near.similar(docs)
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got.collect()) == brute_links(rows)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns and near.similar(kept).where("n_links > 0").isEmpty()
    assert near.similar(docs.limit(0)).isEmpty() and near.keep_one(docs.limit(0)).isEmpty()


def test_bands_reach_their_recall():
    for rows in (3, 5, 7):
        bands = near.bands_for(0.8, rows, 0.9995)
        assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995 > 1 - (1 - 0.8 ** rows) ** (bands - 1)


def test_components(spark):
    pick = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(40)] + [(pick.randrange(300, 400), pick.randrange(300, 400)) for _ in range(70)]
    parent = {v: v for e in edges for v in e}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in parent if any(find(u) == find(v) for u in parent if u != v)}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
