"""Repair of conversation structure, as a stream of turns sorted within their conversation.

Faults are found by aggregation. Then turns, without their texts, run backwards through each
conversation: a Python worker carries, across Arrow batches, the cheapest cost of completing the conversation from
every state of the role grammar, and gives back one byte a turn, the first edit of the best completion from each
state. These backpointers are written in blocks to a table, so no conversation, however long, is held in memory. A
second run, forwards, meets each block just before its turns and follows the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
SOUND, TRUNCATED, FORCED = 0, 1, 2          # what faults mean for the cost; a blank or repeated turn must go
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
BLOCK = 1 << 16                             # backpointers, one byte a turn, in one row
# States of s?(ua)+ or nothing: nothing yet, after s, after u, after a. STEP is the state a role leads to.
STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
NEEDED = "uuau"                             # role that a rerole or an insertion gives in each state
FINAL = (0, 3)
EDITS = "DIKR"                              # by code, in the order that decides ties
ROLES = {"u": "user", "a": "assistant"}
FAR = 1 << 60
EDGES = ("su", "ua", "au")                  # roles that may follow each other


def faults(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, digest, copies, blank, duplicate, truncated, kind``: one row for turns equal in all four
    columns, with their number. Null roles and texts are one space. ``duplicate`` says that an earlier turn of the
    conversation has this role and text; of several copies the second and later ones are duplicates in any case.
    """
    return _faults(_named(turns, conv_id, turn, role, text))


def _named(turns, conv_id, turn, role, text) -> DataFrame:
    words = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        words.alias("text")).withColumn("digest", F.unhex(F.md5("text")))


def _faults(named: DataFrame) -> DataFrame:
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    each = named.select("conv_id", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    once = each.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    # Nulls come first among turns, as they do in a struct.
    earliest = once.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("earliest")).alias("e")
    o = once.alias("o")
    same = F.col("o.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("o.role") == F.col("e.role")) & (F.col("o.digest") == F.col("e.digest"))
    later = ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
    found = o.join(earliest, same).select("o.*", "earliest").withColumn("duplicate", ~F.col("blank") & later).withColumn(
        "truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("truncated")).drop("earliest")
    kind = F.when(F.col("blank") | F.col("duplicate"), FORCED).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    return found.withColumn("kind", kind)


def fault_counts(found: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated`` from the rows of ``faults``."""
    n = F.col("copies")
    again = F.when(F.col("blank"), 0).when(F.col("duplicate"), n).otherwise(n - 1)
    by_turn = found.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"), F.sum(again).alias("duplicate"),
        F.count_if("truncated").alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def _inserted(costs: list[int], edits: list[int]) -> None:
    """Let insertions lower the costs of states, until none does."""
    for _ in range(3):
        for s in (3, 2, 1, 0):
            cost = INSERT + costs[STEP[NEEDED[s], s]]
            if cost < costs[s] or (cost == costs[s] and edits[s] > 1):
                costs[s], edits[s] = cost, 1


def _before(costs: list[int], initial: str, kind: int) -> tuple[list[int], int]:
    """Costs from each state before a turn, given those after it, and the turn's backpointers."""
    new, edits = [], []
    for s in range(4):
        choices = [(DELETE + costs[s], 0)]
        if kind != FORCED:
            stay = LEFT_TRUNCATED if kind == TRUNCATED else 0
            if (initial, s) in STEP:
                choices.append((stay + costs[STEP[initial, s]], 2))
            choices.append((REROLE + stay + costs[STEP[NEEDED[s], s]], 3))
        cost, edit = min(choices)
        new.append(cost)
        edits.append(edit)
    _inserted(new, edits)
    return new, sum(e << 2 * s for s, e in enumerate(edits))


def _at_end() -> tuple[list[int], list[int]]:
    costs, edits = [0 if s in FINAL else FAR for s in range(4)], [0] * 4
    _inserted(costs, edits)
    return costs, edits


def _backwards():
    """Rows (conv_id, turn, initial, role, digest, copies, kind), last turn first: blocks of backpointers, and
    with a conversation's last block its cost and its illegal neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ready, kind = None, [], None

        def block(done: bool) -> None:
            conv, turn, role, digest = now["first"]
            ready.append((conv, turn, role, digest, now["number"], bytes(reversed(now["bytes"])), now["costs"][0] if done else None,
                          now["illegal"] if done else None))
            now["bytes"], now["number"] = bytearray(), now["number"] + 1

        def flush():
            rows = list(zip(*ready)) or [()] * 8
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kind)],
                                              ["conv_id", "turn", "role", "digest", "block", "choices", "cost", "illegal"])

        for batch in batches:
            kind = [batch.schema.field(i).type for i in (0, 1)] + [pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            for conv, turn, initial, role, digest, copies, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now["conv"]:
                    if now:
                        block(True)
                    now = {"conv": conv, "costs": _at_end()[0], "bytes": bytearray(), "number": 0, "illegal": 0, "next": None}
                elif len(now["bytes"]) >= BLOCK:
                    block(False)
                # Copies follow their first turn and go; they have its role.
                after = [c + DELETE * (copies - 1) for c in now["costs"]]
                now["costs"], byte = _before(after, initial, fault)
                now["bytes"].append(byte)
                now["first"] = (conv, turn, role, digest)
                if now["next"] is not None and initial + now["next"] not in EDGES:
                    now["illegal"] += 1
                now["illegal"] += copies - 1
                now["next"] = initial
            if ready:
                yield flush()
        if now:
            block(True)
            yield flush()
    return run


def _forwards():
    """Rows (conv_id, turn, role, digest, block, choices, text), blocks before their turns: one row an edit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = _at_end()[1]
        conv = state = None
        choices, at, seq, before, started, out, kind = [], 0, 0, None, False, [], None

        def edit(code: int, role: str, text: str) -> None:
            nonlocal seq
            out.append((conv, seq, EDITS[code], role, text))
            seq += 1

        def insert() -> None:
            nonlocal state
            edit(1, ROLES[NEEDED[state]], "")
            state = STEP[NEEDED[state], state]

        def finish() -> None:
            while started and end[state] == 1:
                insert()

        def flush():
            rows = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kind)], ["conv_id", "seq", "edit", "role", "text"])

        for batch in batches:
            kind = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            for own, turn, role, digest, number, block, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or own != conv:
                    finish()
                    conv, state, choices, at, seq, before, started = own, 0, [], 0, 0, None, True
                if block is not None:
                    # Turns equal in all columns share one byte, so the block before is used up.
                    choices, at = block, 0
                    continue
                if (turn, role, digest) == before:
                    edit(0, role, text)
                    continue
                before = (turn, role, digest)
                byte = choices[at]
                at += 1
                while byte >> 2 * state & 3 == 1:
                    insert()
                code = byte >> 2 * state & 3
                if code == 0:
                    edit(0, role, text)
                    continue
                initial = role[:1] if code == 2 else NEEDED[state]
                edit(code, role if code == 2 else ROLES[initial], text)
                state = STEP[initial, state]
            if out:
                yield flush()
        finish()
        if out:
            yield flush()
    return run


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The cheapest edits that give every conversation the roles ``(s?(ua)+)?``: (edits, conversations).

    ``edits`` has ``conv_id, seq, edit, role, text``, a row for every turn and every insertion in order: K keeps a turn,
    R gives it the role named, D deletes it (role and text are those deleted), I inserts an empty turn. ``conversations``
    has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost``.

    Roles count by their first character. Keeping costs 0, a rerole to user or assistant 1, deletion 2, an insertion 5,
    and a truncated turn that stays 5 more; blank turns and repeats of an earlier role and text must go. Of equally cheap
    edits those whose initials come first in ASCII are taken. Turns go by ``turn``, nulls first, ties by role, then by the
    MD5 of the text, which brings repeated rows together. A null or empty role fits nowhere: its turn is reroled or goes.
    Null conversation ids are one conversation. Texts are read whole, however long, but no more than one at a time is
    held beside its batch. An empty table gives no rows; other columns, whatever their names, are not read.
    """
    named = _named(turns, conv_id, turn, role, text)
    found = stored(_faults(named), "faults")
    types = dict(named.dtypes)
    # Lost tasks run again from written tables, and each conversation is whole in one task's sorted stream.
    backwards = found.select("conv_id", "turn", _initial(F.col("role")).alias("initial"), "role", "digest", "copies", "kind").repartition(
        "conv_id").sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"))
    blocks = stored(backwards.mapInArrow(
        _backwards(), f"conv_id {types['conv_id']}, turn {types['turn']}, role string, digest binary, block long, choices binary, "
        "cost long, illegal long"), "backpointers")
    line = blocks.select("conv_id", "turn", "role", "digest", "block", "choices", F.lit(None).cast("string").alias("text")).unionByName(
        named, allowMissingColumns=True)
    # A block lies before its first turn; blocks are numbered from the end.
    forwards = line.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "digest", F.col("choices").isNull(), F.desc("block")).select(
        "conv_id", "turn", "role", "digest", "block", "choices", "text")
    edits = stored(forwards.mapInArrow(_forwards(), f"conv_id {types['conv_id']}, seq long, edit string, role string, text string"), "edits")
    whole = blocks.where(F.col("cost").isNotNull()).select("conv_id", "illegal", "cost").alias("w")
    counts = fault_counts(found).alias("c")
    conversations = counts.join(whole, F.col("c.conv_id").eqNullSafe(F.col("w.conv_id"))).select(
        "c.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return edits, conversations


def digests(edits: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256``: the edits' initials, and the hash of the turns that stand, ``role:text``
    joined by newlines, taken as the sorted edits stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, sha, any_turn, started, kind = None, [], None, False, False, None
        out = []

        def close() -> None:
            if started:
                out.append((conv, "".join(audit), sha.hexdigest()))

        def flush():
            rows = list(zip(*out)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kind)], ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            kind = [batch.schema.field(0).type, pa.string(), pa.string()]
            for own, edit, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if not started or own != conv:
                    close()
                    conv, audit, sha, any_turn, started = own, [], hashlib.sha256(), False, True
                audit.append(edit)
                if edit != "D":
                    sha.update((("\n" if any_turn else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    any_turn = True
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    kind = dict(edits.dtypes)["conv_id"]
    return edits.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(
        run, f"conv_id {kind}, audit string, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the crc32 of ``conv_id:turn``, modulo 20: 0 drops a turn,
    1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(spaced("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.withColumn("fate", fate).where("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times")).select(
        "conv_id", "turn", "role", "text", F.explode("times").alias("time")).drop("time")
