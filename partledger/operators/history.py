"""Slowly changing dimensions and as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions.columns import content_hash
from partledger.operators import skew
from partledger.operators.skew import HotKeys


def version_chain(df: DataFrame, key: str, start: str, tracked: Sequence[str], tie: Sequence[str] = (),
                  hot: HotKeys | None = None) -> DataFrame:
    """Type-2 history: one row per change of ``tracked``, valid from ``start`` until the next change.

    Consecutive rows with the same tracked values become one version. Output: key, tracked…,
    valid_from, valid_to (open = null), is_current.
    """
    order = [start, *tie]
    marked = df.withColumn("_state", F.struct(*tracked))
    seen = skew.ordered(marked, [key], order, lag={"_before": "_state"}, hot=hot)
    changes = seen.where(~F.col("_state").eqNullSafe(F.col("_before")))
    closed = skew.ordered(changes, [key], order, lead={"valid_to": start}, hot=hot)
    return closed.select(
        key, *tracked, F.col(start).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def add_points(points: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str],
               order: Sequence[str] = ()) -> DataFrame:
    """Change points (key, tracked…, order…, valid_from) with new ones added; a repeat adds nothing.

    Points are the stored form of a history: unlike versions, which leave out a state that repeats the
    one before it, they stay complete when a late one falls between two equal states.
    """
    cols = list(dict.fromkeys([key, *tracked, *order, "valid_from"]))
    fresh = changes.select(*cols).distinct()
    same = reduce(lambda a, b: a & b, [fresh[c].eqNullSafe(points[c]) for c in cols])
    return points.select(*cols).unionByName(fresh.join(points, same, "left_anti"))


def apply_changes(dim: DataFrame, points: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str],
                  tie: Sequence[str] = (), hot: HotKeys | None = None) -> tuple[DataFrame, DataFrame]:
    """Bring a type-2 dimension and its change points up to date: (dimension, points).

    Only keys that changed are rebuilt, from all their points, so a late version lands in its place, the
    state after it begins again, and an open row is closed by its successor.
    """
    order = list(tie or tracked)
    touched = changes.select(key).distinct()
    every = add_points(points, changes, key, tracked, order)
    kept = skew.join(dim, touched, [key], "left_anti", hot)
    events = skew.join(every, touched, [key], "left_semi", hot)
    rebuilt = version_chain(events, key, "valid_from", tracked, tie=order, hot=hot)
    return kept.unionByName(rebuilt.select(*kept.columns)), every


def active_on(df: DataFrame, day: Column, start: str, end: str) -> DataFrame:
    """Rows whose half-open interval [start, end) holds the day."""
    return df.where((F.col(start) <= day) & (F.col(end).isNull() | (day < F.col(end))))


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, take: Sequence[str],
          end: str | None = None, tie: Sequence[str] = (), hot: HotKeys | None = None) -> DataFrame:
    """For each fact the version in force at its time, as ``take`` columns (null when there is none).

    Facts and versions are laid on one time line per key and the last version seen is carried
    forward: a sort, never pairs of a key's facts and versions.
    """
    body = F.struct(F.col(start).alias("_since"), *([F.col(end).alias("_until")] if end else []),
                    *[F.col(c) for c in take])
    tie_key = F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0).alias("z"))
    fact_body = F.struct(*[F.col(c) for c in facts.columns])
    marks = versions.where(F.col(start).isNotNull()).select(
        F.col(key), F.col(start).alias("_at"), F.lit(0).alias("_kind"), tie_key.alias("_tie"),
        F.lit(0).cast("bigint").alias("_content"), body.alias("_version"))
    probes = facts.select(
        F.col(key), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        content_hash(facts).alias("_content"), fact_body.alias("_fact"))
    line = marks.unionByName(probes, allowMissingColumns=True)
    solved = skew.ordered(line, [key], ["_at", "_kind", "_tie", "_content"], carry={"_found": "_version"},
                          hot=hot).where("_kind = 1")
    found = F.col("_found")
    if end:
        valid = F.col("_at").isNotNull() & (found["_until"].isNull() | (F.col("_at") < found["_until"]))
        found = F.when(valid, found)
    return solved.select("_fact.*", *[found[c].alias(c) for c in take])


def _line(versions: DataFrame, keys: Sequence[str], start: str, end: str, take: Sequence[str], tie: Sequence[str],
          side: str, hot: HotKeys | None) -> DataFrame:
    """Change points (keys, _at, side) of a history; a version ends where the next begins, at the latest."""
    body = F.struct(*take)
    begun = versions.where(F.col(start).isNotNull()).groupBy(*keys, F.col(start).alias("_at")).agg(
        F.max_by(F.struct(F.col(end).alias("end"), body.alias("body")), F.struct(*(tie or take))).alias("_v"))
    closed = skew.ordered(begun, keys, ["_at"], lead={"_next": "_at"}, hot=hot)
    stop = F.least(F.col("_v.end"), F.col("_next"))  # nulls, which are open ends, are passed over
    real = closed.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("_at") < F.col("_stop")))
    event = F.struct(F.lit(1).alias("on"), F.col("_v.body").alias("body")).alias(side)
    gone = F.struct(F.lit(0).alias("on"), F.lit(None).cast(versions.select(body).schema.fields[0].dataType).alias("body")).alias(side)
    ends = real.where(F.col("_stop").isNotNull()).select(*keys, F.col("_stop").alias("_at"), gone)
    return real.select(*keys, "_at", event).unionByName(ends)


def overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str],
             left_take: Sequence[str], right_take: Sequence[str], left_tie: Sequence[str] = (), right_tie: Sequence[str] = (),
             hot: HotKeys | None = None) -> DataFrame:
    """Which version of one history held together with which of another: keys, valid_from, valid_to and both sides' columns.

    Each side's intervals [start, end) are its versions of a key (an open end is null). The change points of both
    are laid on one time line per key, the versions in force are carried along it, and neighbouring spans
    with the same values on both sides are one: as many rows as there are changes, never pairs of
    versions. Where versions of one side overlap, the one that began last holds until its end or the next start; of
    several that begin together the highest ``tie``. Versions without start, or that end before they begin, never hold.
    ``hot`` keys are cut into ranges of time.
    """
    keys = list(keys)
    l = _line(left, keys, *left_span, left_take, left_tie, "_l", hot)  # noqa: E741
    r = _line(right, keys, *right_span, right_take, right_tie, "_r", hot)
    # A version that begins where another ends is the one in force.
    points = l.unionByName(r, allowMissingColumns=True).groupBy(*keys, "_at").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    held = skew.ordered(points, keys, ["_at"], carry={"_hl": "_l", "_hr": "_r"}, hot=hot)
    both = held.withColumn("_state", F.struct(F.col("_hl.body").alias("l"), F.col("_hr.body").alias("r"),
                                              ((F.col("_hl.on") == 1) & (F.col("_hr.on") == 1)).alias("both")))
    seen = skew.ordered(both.select(*keys, "_at", "_state"), keys, ["_at"], lag={"_before": "_state"}, hot=hot)
    changed = seen.where(~F.col("_state").eqNullSafe(F.col("_before")))
    spans = skew.ordered(changed, keys, ["_at"], lead={"valid_to": "_at"}, hot=hot)
    return spans.where("_state.both").select(*keys, F.col("_at").alias("valid_from"), "valid_to", "_state.l.*", "_state.r.*")
