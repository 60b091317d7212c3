"""URL filters against dated lists: what was listed when a page was fetched decides, not what is now.

List entries are dated: a pattern is added to a list or removed from it. They become validity
intervals, and every capture is looked up as of its fetch time. Patterns are keys of a few kinds: a
domain with all its subdomains (``d:example.com``), a path prefix (``p:host/dir``), a whole URL
(``u:host/dir/page?x=1``). A URL has one key for every domain suffix and every path prefix of it, so a
look-up is an equi-join on the key. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import stored
from partledger.operators import skew

ADD, REMOVE = "add", "remove"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _AUTHORITY + r"([^/?#:]*)", 1)
    return F.lower(F.rtrim(host, F.lit(".")))


def path_of(url: Column) -> Column:
    """Path without query, fragment and final slashes."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _AUTHORITY + r"[^/?#]*([^?#]*)", 1)
    return F.rtrim(path, F.lit("/"))


def query_of(url: Column) -> Column:
    """``?`` and the query, or nothing."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*(\?[^#]*)", 1)


def canonical(url: Column) -> Column:
    """Host, path and query: URLs that differ in scheme, user, port, fragment or a final slash are one."""
    return F.concat(host_of(url), path_of(url), query_of(url))


def keys_of(host: Column, path: Column, query: Column) -> Column:
    """All keys under which a URL can be listed."""
    labels, steps = F.split(host, r"\."), F.split(path, "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(
        F.lit("p:"), host, F.array_join(F.slice(steps, F.lit(1), i), "/")))
    keys = F.concat(domains, prefixes, F.array(F.concat(F.lit("u:"), host, path, query)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(keys))


def validity(entries: DataFrame) -> DataFrame:
    """``list, pattern, valid_from, valid_to`` from entries (list, pattern, change, at).

    An interval begins when a pattern is added and ends (null: not yet) when it is next removed. Adding
    what is listed and removing what is not change nothing; of changes at one time, the addition holds.
    Entries with a null pattern, time, or a change that is neither are left out; a null list is a list.
    """
    key = ["list", "pattern"]
    points = entries.where(F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("change").isin(ADD, REMOVE)).groupBy(
        *key, "at").agg(F.bool_or(F.col("change") == ADD).alias("on"))
    points = stored(points, "list-changes")
    hot = skew.find(points, key)
    turns = skew.ordered(points, key, ["at"], lag={"before": "on"}, hot=hot).where(
        F.col("on") != F.coalesce("before", F.lit(False)))
    closed = skew.ordered(turns, key, ["at"], lead={"valid_to": "at"}, hot=hot)
    return closed.where("on").select(*key, F.col("at").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """``_row, list, pattern, valid_from, valid_to``: for every capture (_row, keys, at) the intervals
    that hold its fetch time.

    Captures and intervals of a pattern are laid on one time line, and the last interval begun is
    carried to each capture: a sort, linear in both. Keys that no list names are left out by a join
    first; a pattern that owns a large share of the captures is cut into ranges of time.
    """
    listed = stored(intervals.select("list", "pattern").distinct(), "patterns")
    asked = captures.where(F.col("at").isNotNull()).select("_row", "at", F.explode("keys").alias("pattern")).join(listed, "pattern")
    marks = intervals.select("list", "pattern", F.col("valid_from").alias("at"), F.lit(0).alias("kind"),
                             F.struct("valid_from", "valid_to").alias("span"))
    line = stored(marks.unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True), "time-line")
    key = ["list", "pattern"]
    seen = skew.ordered(line, key, ["at", "kind", "_row"], carry={"last": "span"}, hot=skew.find(line, key)).where("kind = 1")
    held = F.col("last").isNotNull() & (F.col("last.valid_to").isNull() | (F.col("at") < F.col("last.valid_to")))
    return seen.where(held).select("_row", *key, "last.valid_from", "last.valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, page_id: str = "page_id", url: str = "url",
                    at: str = "fetched_at") -> DataFrame:
    """``page_id, fetched_at, url_key, n_active, blocked, list, pattern`` for every row of ``captures``.

    ``n_active`` counts the entries active at fetch time that cover the URL; ``list`` and ``pattern``
    name the most specific of them: whole URL, then longest prefix, then longest domain, ties by list
    (null last) and pattern. A null URL, one without a host, or a null fetch time meets no entry.
    Repeated rows are captures of their own and get equal results. Other columns are not read.
    """
    link = F.col(url)
    # Equal rows meet the lists once: a row is its id, URL and time.
    rows = captures.select(F.col(page_id).alias("page_id"), F.col(at).alias("at"), link.alias("url")).withColumn(
        "_row", F.md5(F.to_json(F.struct("page_id", "url", F.col("at").cast("string").alias("at")))))
    distinct = rows.dropDuplicates(["_row"]).select("_row", "at", keys_of(host_of(F.col("url")), path_of(F.col("url")), query_of(F.col("url"))).alias("keys"))
    active = active_entries(distinct, validity(entries))
    kind = F.when(F.col("pattern").startswith("u"), 1).when(F.col("pattern").startswith("p"), 2).otherwise(3)
    best = F.min(F.struct(kind.alias("kind"), (-F.length("pattern")).alias("size"), F.col("list").isNull().alias("unnamed"), "list", "pattern"))
    found = active.groupBy("_row").agg(F.count(F.lit(1)).alias("n_active"), best.alias("best"))
    return rows.join(found, "_row", "left").select(
        "page_id", F.col("at").alias("fetched_at"), canonical(F.col("url")).alias("url_key"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("n_active").isNotNull().alias("blocked"),
        F.col("best.list").alias("list"), F.col("best.pattern").alias("pattern"))
