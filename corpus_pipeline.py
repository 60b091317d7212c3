"""A training corpus from documents: five stages, each on what the one before it kept.

Language ID drops texts of no learned language, line dedup cuts lines that earlier documents have,
the n-gram join keeps one document of each group of near copies, mixing takes documents by the target
weights of their sources, and BPE turns the mix into ids.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partledger.llm import bpe, langid, linededup, mixing, near
from partledger.llm.common import prepare, stored
from partledger.llm.queries import held_out

# Parameters: a text of at least so many characters whose cosine with every language is below the least one
# is of none of them. At sf0.1 held-out documents score at least 0.35, 0.46 and 0.40 in these length classes
# with their own language, but for those that repeat single words, and in 99 of 100 cases 0.30 at most with
# any other. Shorter texts give too few letter triples to tell.
LEAST_SCORES = [(50, 0.25), (100, 0.3), (200, 0.35)]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, which ``lang`` then names; learned as in op6 from ``docs``."""
    prepare(spark)
    languages, vectors = langid.prototypes(docs.where(~held_out(F.col("doc_id"))))
    judged = langid.identify(docs, languages, vectors)
    least = F.lit(0.0)
    for chars, score in LEAST_SCORES:
        least = F.when(F.length("text") >= chars, F.lit(score)).otherwise(least)
    rejected = (F.col("lang_pred") == "und") | (F.col("score") < least)
    return judged.where(~rejected).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; those left without a word go."""
    prepare(spark)
    kept = linededup.dedup_lines(docs).withColumn("text", F.col("kept_text")).where(
        (F.size("dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts: that with the smallest id."""
    prepare(spark)
    return near.keep_one(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in whole documents: a document is there as often as the mix takes its first word, so
    not at all, once or twice. Rows without words are not in the mix."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    name = F.concat_ws("-", "doc_id", F.md5(F.coalesce("text", F.lit(""))))
    named = docs.withColumn("_name", name)
    taken = mixing.copies(*mixing.mix(named, mixing.word_count(F.col("text")), doc_id="_name")).groupBy(
        F.col("doc_id").alias("_name")).agg(F.sum("copies").alias("_copies"))
    # Repeated rows share their copies out among themselves.
    same = Window.partitionBy("_name")
    row = F.row_number().over(same.orderBy("_name")) - 1
    rows = F.count(F.lit(1)).over(same)
    shared = named.join(taken, "_name").withColumn("_row", row).withColumn("_rows", rows)
    times = F.expr("_copies div _rows + if(_row < _copies % _rows, 1, 0)")
    return shared.withColumn("_time", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*COLUMNS)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every document of the mix."""
    prepare(spark)
    words = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    return bpe.encode(docs, words).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language ID", identify_language), ("line dedup", dedup_lines), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("BPE encoding", encode_bpe)]
ORACLE_SQL = None  # SQL can say neither the language profiles nor BPE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
