import hashlib
import math

import pytest
from pyspark.sql import functions as F

from partledger.llm import chat, mixing


def mixed(docs, **settings):
    lined, out = mixing.mix(docs, mixing.word_count(F.col("text")), **settings)
    return lined, out, mixing.taken_words(lined, out)


@pytest.mark.parametrize("table", ["odd", "clashing", "corpus"])
def test_mix_meets_its_targets(table, request):
    docs = request.getfixturevalue(table)
    lined, out, taken = mixed(docs, block_words=50)
    rows = taken.join(lined.select("line_start", "doc_id", "size", "source").distinct(), ["doc_id", "size"]).collect()
    assert taken.count() == docs.count()
    got = lined.groupBy("source", "source_size", "target").count().collect()
    # Water filling by repeated resharing, as the contract words it.
    names = sorted((r.source for r in got if r.source is not None)) + [None] * any(r.source is None for r in got)
    size = {r.source: r.source_size for r in got}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(size.values()), set(names)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s]
            if target[s] > 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2.0 * size[s]
        open_ = {s for s in open_ if target[s] < 2 * size[s]}
    for r in got:
        assert math.isclose(r.target, target[r.source], abs_tol=1e-6)
    assert all(r.taken <= 2 * r.size for r in rows)
    sums = {r.place: r.w for r in out.groupBy("place").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("w")).collect()}
    for i, s in enumerate(names):
        assert abs(sums.get(i, 0) - target[s]) <= 0.5
    again = mixed(docs, block_words=50)[2]
    assert sorted(map(str, again.collect())) == sorted(map(str, taken.collect()))


def test_schedule_interleaves_sources(corpus):
    """In any run of slots, a source's share is near its share of all slots."""
    lined, out, _ = mixed(corpus, block_words=20)
    slots = [r.place for r in out.groupBy("slot").agg(F.min("place").alias("place")).orderBy("slot").collect()]
    total = len(slots)
    for place in set(slots):
        share = slots.count(place) / total
        for a in range(0, total - 100, 100):
            assert abs(slots[a:a + 100].count(place) - 100 * share) <= 8
    # Whole blocks come round equally often before any comes once more.
    per_slot = out.groupBy("slot", "place").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("w")).collect()
    sizes = {r.place: r.source_size for r in lined.select("place", "source_size").distinct().collect()}
    blocks = {p: max(1, round(n / 20)) for p, n in sizes.items() if n}
    assert all(r.w <= sizes[r.place] / blocks[r.place] + 1 for r in per_slot)


def test_empty_and_wordless_tables(none, odd):
    assert mixed(none)[2].isEmpty()
    bare = odd.where("text is null or trim(text) = ''")
    assert [r.taken for r in mixed(bare)[2].collect()] == [0] * bare.count()


TURNS = "conv_id long, turn long, role string, text string"


def read_back(spark, rows):
    chats = chat.format_chats(spark.createDataFrame(rows, TURNS))
    return {r.conv_id: r for r in chats.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                                              chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_sep|>", "<", "|x", "<\\\\|", "", None, "a\nb<|", "ü" * 70_000]
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "user\n<|im_end|>", "q"), (2, 0, None, "tie"), (2, None, "assistant", "first"), (None, 1, "assistant", "x"),
             (None, 1, "assistant", "x")]
    got = read_back(spark, rows)
    for conv in (1, 2, None):
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert [(t.role, t.text) for t in got[conv].turns] == [(role, text) for _, _, role, text in own]
        assert got[conv].loss == "".join(text for _, _, role, text in own if role == "assistant")
    assert got[1].formatted.count("<|im_start|>") == 6  # adjacent turns of one role are one block
    assert chat.format_chats(spark.createDataFrame([], TURNS)).isEmpty()


def test_chat_ignores_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], TURNS).withColumns({"turns": F.lit(9), "blocks": F.lit(1), "formatted": F.lit("z")})
    assert chat.format_chats(df).first().formatted == "<|im_start|>user\nhi<|im_end|>\n"
    assert hashlib.sha256(b"").hexdigest()  # digests are taken of text, never of null


# URL filters

ENTRY = "list string, pattern string, change string, at timestamp"


def test_lists_as_of_fetch_time(spark):
    from datetime import datetime

    from partledger.llm import urls

    def day(n):
        return None if n is None else datetime(2024, 1, n)

    entries = [("spam", "d:bad.org", "add", day(5)), ("spam", "d:bad.org", "remove", day(10)), ("spam", "d:bad.org", "add", day(20)),
               ("spam", "d:bad.org", "add", day(21)), ("spam", "p:ok.org/dir", "add", day(1)), ("other", "u:ok.org/dir/x?q=1", "add", day(2)),
               (None, "d:bad.org", "add", day(6)), ("spam", "d:never.org", "remove", day(1)), ("spam", "d:late.org", "add", None),
               ("tie", "d:tie.org", "remove", day(3)), ("tie", "d:tie.org", "add", day(3)), ("spam", None, "add", day(1)), ("spam", "d:odd.org", "??", day(1))]
    captures = [(1, "http://www.BAD.org./a", day(4)), (1, "http://www.BAD.org./a", day(4)), (2, "https://u:p@bad.org:443/", day(5)), (3, "http://bad.org", day(10)),
                (4, "//x.bad.org?z", day(25)), (5, "http://notbad.org/bad.org", day(25)), (6, "http://ok.org/dir/x?q=1#top", day(9)),
                (7, "http://ok.org/dirx", day(9)), (8, None, day(9)), (9, "not a url", day(9)), (10, "http://bad.org", None),
                (None, "http://tie.org/a//b/", day(3)), (11, "http://never.org", day(9)), (12, "http://odd.org/" + "s/" * 300, day(9))]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").withColumns({"keys": F.lit(1), "pattern": F.lit("mine")})
    got = urls.filter_captures(df, spark.createDataFrame(entries, ENTRY))
    have = sorted((str(r.page_id), r.n_active, r.blocked, r.list, r.pattern) for r in got.collect())
    want = {1: (0, None, None), 2: (1, "spam", "d:bad.org"), 3: (1, None, "d:bad.org"), 4: (2, "spam", "d:bad.org"),
            6: (2, "other", "u:ok.org/dir/x?q=1"), None: (1, "tie", "d:tie.org")}
    assert have == sorted((str(i), *(lambda w: (w[0], w[0] > 0, *w[1:]))(want.get(i, (0, None, None)))) for i, _, _ in captures)
    spans = urls.validity(spark.createDataFrame(entries, ENTRY)).where("pattern = 'd:bad.org' and list = 'spam'").orderBy("valid_from").collect()
    assert [(r.valid_from, r.valid_to) for r in spans] == [(day(5), day(10)), (day(20), None)]
    assert urls.filter_captures(df.limit(0), spark.createDataFrame(entries, ENTRY)).isEmpty()
    assert not urls.filter_captures(df, spark.createDataFrame([], ENTRY)).where("blocked").count()


def test_hot_patterns_are_cut(spark, monkeypatch):
    """With every pattern treated as hot the answers stay."""
    from partledger.llm import urls
    from partledger.operators import skew

    captures = spark.range(400).selectExpr("id AS page_id", "concat('http://a', id % 2, '.net/', id % 7) AS url",
                                           "timestamp_seconds(id * 7919 % 5000) AS fetched_at")
    entries = spark.range(300).selectExpr("concat('l', id % 3) AS list", "if(id % 2 = 0, 'd:net', concat('p:a1.net/', id % 7)) AS pattern",
                                          "if(id % 5 < 3, 'add', 'remove') AS change", "timestamp_seconds(id * 104729 % 5000) AS at")
    plain = sorted(map(str, urls.filter_captures(captures, entries).collect()))
    find = skew.find
    monkeypatch.setattr(skew, "find", lambda df, keys, group_rows=10: find(df, keys, 10))
    assert sorted(map(str, urls.filter_captures(captures, entries).collect())) == plain
