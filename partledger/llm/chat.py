"""Chat formatting as relational work: turns are collected per conversation and become one string.

A block of adjacent turns of one role is written ``<|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n``.
Control strings inside texts and roles are escaped by one more backslash between ``<`` and ``|``, which
can always be undone, so the turns can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template. All begin with "<|", which no escaped text holds.
START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    Turns go by number, then role, then text, so ties and repeated rows have one order and all stay.
    Null texts and roles are empty; a null turn number comes first; rows with a null conversation id
    are one conversation. ``loss_spans`` holds start (from 1) and length, in code points of
    ``formatted``, of every text of the assistant: the mask that training loss is taken under.
    Columns besides the four named ones are not read.
    """
    empty = F.lit("")
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"),
                   F.coalesce(F.col(text), empty).alias("text"))
    chats = turns.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    # Positions where the role changes begin a block; a block is a slice up to the next of them.
    begins = F.filter(F.transform("turns", lambda t, i: F.when(
        (i == 0) | (F.get(F.col("turns"), i - 1)["role"] != t["role"]), i)), lambda i: i.isNotNull())
    chats = chats.withColumn("begins", begins)
    until = lambda k: F.coalesce(F.get(F.col("begins"), k + 1), F.size("turns"))
    chats = chats.withColumn("blocks", F.transform("begins", lambda b, k: F.struct(
        F.get(F.col("turns"), b)["role"].alias("role"),
        F.transform(F.slice(F.col("turns"), b + 1, until(k) - b), lambda t: escape(t["text"])).alias("texts"))))
    head = lambda b: F.concat(F.lit(START), F.replace(escape(b["role"]), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        head(b), F.array_join(b["texts"], SEP), F.lit(END))), "")
    # Lengths of what stands before each text and of the text, in the order of the string.
    parts = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, i: F.struct(
        F.when(i == 0, F.length(head(b))).otherwise(len(SEP)).alias("lead"), F.length(t).alias("size"),
        F.when(i == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("tail"),
        (b["role"] == LOSS_ROLE).alias("loss")))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate(parts, zero, lambda s, p: F.struct(
        (s["at"] + p["lead"] + p["size"] + p["tail"]).alias("at"),
        F.when(p["loss"], F.concat(s["spans"], F.array(F.struct(
            (s["at"] + p["lead"] + 1).alias("start"), p["size"].alias("length"))))).otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    return chats.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), as they were before."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    def turns(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        role = unescape(F.replace(F.substring(head, len(START) + 1, 1 << 30), F.lit(NEWLINE), F.lit("\n")))
        body = F.substring(b, F.length(head) + 2, F.length(b))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(
            role.alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), "")
