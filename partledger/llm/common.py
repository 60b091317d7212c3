"""What the corpus operators share: settings, shared tables, running sums, components, word arrays."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partledger.session import apply_settings, shared_dir

# Arrow batches are kept small: a batch of very long texts must fit a Python worker.
ARROW_ROWS = "256"
SPACES = b" \t\n\x0b\x0c\r"  # the white space between words: [\x20\x09-\x0D]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python functions live in it."""
    context = spark.sparkContext
    if getattr(context, "_partledger_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="partledger-")) / "partledger.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(path))
    context._partledger_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and a lost executor
    costs only its running tasks. Rows that a random or order-dependent step made are fixed."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_start(rows: DataFrame, group: str, bucket: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group.

    Two levels, so that a group with a third of all rows is not one task: rows are summed within
    (group, bucket), and the buckets' totals, one row each, are summed along the group. Buckets must
    ascend with the order columns.
    """
    totals = rows.groupBy(group, bucket).agg(F.sum(value).alias("_in_bucket"))
    along = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(group).alias("_g"), F.col(bucket).alias("_b"),
                            F.coalesce(F.sum("_in_bucket").over(along), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    part = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = part[group].eqNullSafe(offsets["_g"]) & (part[bucket] == offsets["_b"])
    return part.join(offsets, same).withColumn(out, F.col("_before") + F.col("_inside")).drop(
        "_g", "_b", "_before", "_inside")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where a column of the frame has one of them already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table: ``node, root``, root the smallest node.

    Alternating large-star and small-star steps: every round is two joins-free aggregations over at
    most as many edges as before, and the edges end as stars round the roots. Each round is written
    to the shared folder, and rounds stop when no edge moves. A hub's neighbours meet in one group
    only as aggregates: its minimum is joined back, never collected.
    """
    spark = edges.sparkSession
    now = stored(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct(), "edges")
    digest = None
    while True:
        both = now.select("v", "u").union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        # Large star: neighbours above a node are tied to the least of its neighbourhood.
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        # Small star: a node's lower neighbours are tied to the least of them, and so is the node.
        small = large.join(low, "v").select(
            F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("m").alias("u")),
                              F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        now = stored(small.select("e.v", "e.u").where("u < v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if tuple(seen) == digest:
            break
        digest = tuple(seen)
    nodes = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return nodes.union(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


# Arrays of words ---------------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


class Words:
    """Words of a batch of texts as arrays: bytes, word bounds, 64-bit word hashes, words per text."""

    def __init__(self, texts: Sequence[str | None]):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
        self.text_start = np.concatenate([[0], ends])
        space = _IS_SPACE[self.data]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, self.text_start)  # of each text, and one past the last
        self.in_word = ~space

    def __len__(self) -> int:
        return len(self.start)

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        if not len(self):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        at = np.cumsum(length) - length
        offset = np.arange(length.sum(), dtype=np.int64) - np.repeat(at, length)
        value = (self.data[self.in_word].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[offset]
        return mix(np.add.reduceat(value, at) + length.astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text number of every run of n words that lies within one text."""
        h, count = self.hashes(), len(self) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(self.first) - 1), self.per_text)
        run = np.zeros(count, np.uint64)
        for i in range(n):
            run = run * _BASE + h[i:i + count]
        inside = text[:count] == text[n - 1:n - 1 + count]
        self.window_at = np.flatnonzero(inside)
        return mix(run[inside]), text[:count][inside]
