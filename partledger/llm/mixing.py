"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Slots of the mix are numbered 0, 1, 2 ...; the golden-ratio point frac(i * phi) of slot i falls into
one source's share of [0, 1). The r-th slot of a source takes the source's r-th block, counted round
its shuffled token line, until the source has met its target; the last block is cut there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partledger.llm.common import running_start, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5          # size of the mix, as a multiple of all words
CAP = 2.0            # most epochs of a source
BLOCK_WORDS = 2048   # tokens of a block
ROWS_PER_BUCKET = 1000
GOLDEN = 2654435769  # 2**32 / phi, odd: i * GOLDEN mod 2**32 is the golden-ratio point in 32 bits


def word_count(text: Column) -> Column:
    """Runs of characters other than the six ASCII white-space characters; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` from rows of (source, size).

    Sources take the weights in turn, ordered by code point, null last. Raising every source by its
    weight until it meets its cap is what resharing the excess again and again ends in; the common
    level is found where the sources, ordered by cap per weight, stop being capped. One row per
    source: the two ordered windows go over sources, not over documents.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = rows.withColumn("place", place).withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights)))
    every = Window.partitionBy(F.lit(0))
    ratio = F.col("source_size") / F.col("weight")
    before = Window.orderBy(ratio, "place").rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(every) - F.coalesce(cap * F.sum("source_size").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = left / open_weight  # the level if all sources before this one are capped and this one is not
    rows = rows.withColumn("level", level)
    uncapped = F.min(F.when(F.col("level") * F.col("weight") <= cap * F.col("source_size"),
                            F.struct(ratio, "place", "level"))).over(every)["level"]
    target = F.least(cap * F.col("source_size"), F.col("weight") * F.coalesce(uncapped, F.lit(float("inf"))))
    return rows.select("source", "place", "source_size", "n_docs", target.alias("target"))


def schedule(need: DataFrame) -> DataFrame:
    """``place, rank, slot``: the slots of each source, from rows of (place, slots).

    Slots in all are the sum of the needs. A source's count under golden-ratio points differs from its
    need by a few; slots beyond a source's need go, in order, to the sources that lack some, so each
    source has exactly its need. A slot finds its source by a join on a cell of [0, 1), so neither
    side is collected: cells are as many as sources, and a source takes part in the cells it covers.
    """
    spark = need.sparkSession
    total, sources = need.agg(F.sum("slots"), F.count(F.lit(1))).first()
    total, cells = total or 0, max(1, sources)
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    share = need.where("slots > 0").withColumn("high", F.sum("slots").over(upto)).withColumn(
        "low", F.col("high") - F.col("slots"))
    # A point u belongs to the source with low <= u * total < high.
    covers = share.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells / total), F.least(F.lit(cells - 1).cast("long"), F.floor(F.col("high") * cells / total)))))
    # i * GOLDEN mod 2**32 from the 16-bit halves of i, so nothing overflows.
    low, high = (F.shiftright("id", n).bitwiseAND(F.lit(0xFFFF)) * F.lit(GOLDEN) for n in (0, 16))
    bits = (low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(0xFFFFFFFF))
    slots = spark.range(total).select(F.col("id").alias("slot"), (bits / F.lit(float(1 << 32))).alias("u"))
    slots = slots.withColumn("cell", F.least(F.lit(cells - 1).cast("long"), F.floor(F.col("u") * cells)))
    at = F.col("u") * total
    chosen = slots.join(covers.select("cell", "place", "low", "high"), "cell").where(
        (at >= F.col("low")) & (at < F.col("high"))).select(
        "place", "slot", F.floor(F.col("slot") / (ROWS_PER_BUCKET * cells)).alias("bucket"), F.lit(1).alias("one"))
    ranked = stored(running_start(chosen, "place", "bucket", ["slot"], "one", "rank"), "slots")
    needs = need.select("place", "slots")
    inside = ranked.join(needs, "place").where("rank < slots").select("place", "rank", "slot")
    # A few rows a source: what fell beyond a need, and the ranks that got no slot.
    spare = ranked.join(needs, "place").where("rank >= slots").select(
        "slot", F.row_number().over(Window.orderBy("slot")).alias("k"))
    counts = ranked.groupBy("place").agg(F.count(F.lit(1)).alias("got"))
    lacking = needs.join(counts, "place", "left").where("slots > coalesce(got, 0)").select(
        "place", F.explode(F.sequence(F.coalesce("got", F.lit(0)).cast("long"), F.col("slots") - 1)).alias("rank"))
    lacking = lacking.withColumn("k", F.row_number().over(Window.orderBy("rank", "place")))
    return inside.unionByName(lacking.join(spare, "k").select("place", "rank", "slot"))


def mix(docs: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents with their place on their source's token line, and the mix.

    First table: one row per row of ``docs`` with ``doc_id, source, size, source_size, target, n_docs,
    place, line_start``. Second table, the mix: ``slot, place, epoch, doc_id, line_start, size,
    from_word, to_word``, the words of a document that a slot takes; sorted by slot and line_start it is
    the mixed stream.

    The token line of a source is its documents ordered by md5 of the id, so reruns agree. A row
    without words has no place in the mix and is kept in the first table. Null ids, repeated ids and
    repeated rows are documents like any other; a null source is a source, the last one. An empty
    table gives two empty tables. Columns of ``docs`` besides those named are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
    rows = stored(rows, "sizes")
    targets = stored(source_targets(rows, weights, share, cap), "targets")
    sized = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # Buckets ascend with the order key, and a source has as many as its rows ask for.
    share_of = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    sized = sized.withColumn("key", key).withColumn(
        "bucket", F.floor(share_of * F.ceil(F.col("n_docs") / ROWS_PER_BUCKET)))
    # Documents without words are equal on the line, so their order does not matter.
    lined = stored(running_start(sized, "place", "bucket", ["key", "doc_id", "size"], "size", "line_start").drop(
        "key", "bucket"), "lines")

    # Blocks of a source are equal to a word: the first `extra` of them hold base + 1 words, others base.
    blocks = F.greatest(F.lit(1), F.round(F.col("source_size") / block_words)).cast("long")
    plan = targets.select("place", "source_size", F.round("target").cast("long").alias("goal"), blocks.alias("blocks"))
    plan = plan.where("goal > 0").selectExpr(
        "*", "source_size div blocks AS base", "source_size % blocks AS extra", "goal div source_size AS rounds",
        "goal % source_size AS rest")
    block_of = lambda word: (
        f"if({word} < extra * (base + 1), {word} div (base + 1), extra + ({word} - extra * (base + 1)) div base)")
    begin = lambda block: f"({block}) * base + least({block}, extra)"
    plan = plan.withColumn("slots", F.expr(f"rounds * blocks + if(rest > 0, {block_of('(rest - 1)')} + 1, 0)"))
    slots = schedule(plan.select("place", "slots"))
    taken = slots.join(plan, "place").selectExpr("*", "rank div blocks AS epoch", "rank % blocks AS block").selectExpr(
        "place", "slot", "epoch", "block", f"{begin('block')} AS block_from",
        f"if(epoch < rounds, {begin('block + 1')}, least({begin('block + 1')}, rest)) AS block_to")
    # A document lies in the blocks from its first to its last word.
    pieces = lined.where("size > 0").select("place", "doc_id", "line_start", "size").join(
        plan.select("place", "base", "extra"), "place").withColumn("block", F.explode(F.expr(
            f"sequence({block_of('line_start')}, {block_of('(line_start + size - 1)')})")))
    both = pieces.join(taken, ["place", "block"])
    start = F.greatest("line_start", "block_from")
    end = F.least(F.col("line_start") + F.col("size"), F.col("block_to"))
    out = both.where(end > start).select(
        "slot", "place", "epoch", "doc_id", "line_start", "size",
        (start - F.col("line_start")).alias("from_word"), (end - F.col("line_start")).alias("to_word"))
    return lined, out


def taken_words(lined: DataFrame, mixed: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: what the mix takes of each document in all."""
    sums = mixed.groupBy("place", "line_start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    sums = sums.withColumnsRenamed({"place": "_p", "line_start": "_l"})
    hit = (lined["place"] == sums["_p"]) & (lined["line_start"] == sums["_l"]) & (lined["size"] > 0)
    return lined.join(sums, hit, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def copies(lined: DataFrame, mixed: DataFrame) -> DataFrame:
    """``doc_id, size, copies``: how often the mix takes a document's first word, for mixes of whole
    documents. Rows without words are not in it."""
    firsts = mixed.where("from_word = 0").groupBy("place", "line_start", "doc_id", "size").agg(
        F.count(F.lit(1)).alias("copies"))
    return firsts.select("doc_id", "size", "copies")
