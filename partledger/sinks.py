"""Writing tables: snapshots behind a view, partition upserts, appends, clustering."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from partledger.context import RunContext
from partledger.functions.columns import any_null, null_safe
from partledger.operators.dedup import duplicate_keys
from partledger.operators.merge import upsert, upsert_in_one
from partledger.operators import slices
from partledger.schemas import CODES, TableSpec
from partledger.session import drop_path, shared_dir


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place in one step: readers see the old content or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = hadoop.Path(path)
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    staged = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(staged, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    swap = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    swap[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(files.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration()).rename(
        files.makeQualified(staged), files.makeQualified(final), swap)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not final.getFileSystem(spark._jsc.hadoopConfiguration()).exists(final):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def attempt(run_id: str, after: str | None) -> str:
    """Folder name of what a run read from a watermark. Attempts that die before the watermark is committed
    start from the same one, whatever their upper bound, so each replaces the one before."""
    return run_id if after is None else f"{run_id}~{re.sub('[^0-9A-Za-z]+', '-', after)}"


# The part of a folder's name that ``attempt`` added.
ATTEMPT = "~[0-9A-Za-z-]*$"
BUCKET = "_bucket"
# A file of a compacted table.
FILE_BYTES = 256 * 1024 * 1024


def bucket_of(keys: Sequence[str], n: int) -> Column:
    """Bucket of a row, by its keys. Case and outer blanks make no difference, so rows whose keys a layer above
    takes for one lie together, there as here."""
    plain = [F.upper(F.trim(F.col(k).cast("string"))) for k in keys]
    return F.pmod(F.xxhash64(*plain), F.lit(n)).cast("int")


def by_folder(places: Mapping[int, str]) -> dict[str, list[int]]:
    """Bucket → folder, turned round: the shorter form, in which pointers keep it."""
    found: dict[str, list[int]] = {}
    for bucket, path in sorted(places.items()):
        found.setdefault(path, []).append(bucket)
    return found


def by_bucket(folders: Mapping[str, Sequence[int]]) -> dict[int, str]:
    return {bucket: path for path, buckets in folders.items() for bucket in buckets}


def moved(now: Mapping[int, str], then: Mapping[int, str]) -> set[int]:
    """Buckets that were written in between."""
    return {b for b in {*now, *then} if now.get(b) != then.get(b)}


class Lake:
    """Tables as Parquet folders. A small file ``pointers/layer.table.json`` names the folder that
    holds a table's rows now and their schema.

    A write goes to a fresh folder, and the file is replaced after it: readers see the old table or the
    new one, a write that dies leaves the old one in place, and repeating it is harmless. Everything is
    found from storage, so tables outlive the session. Views ``layer.table`` serve SQL in this session.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def pointer(self, table: str) -> str:
        return f"{self.root}/pointers/{table}.json"

    def state(self, table: str) -> dict | None:
        """What the pointer says: path, schema, run, the day the rows were computed for, and the inputs' paths."""
        text = read_text(self.spark, self.pointer(table))
        return None if text is None else json.loads(text)

    def exists(self, table: str) -> bool:
        return self.state(table) is not None

    def read(self, table: str) -> DataFrame:
        state = self.state(table)
        if state is None:
            raise ValueError(f"there is no table {table} below {self.root}")
        if state.get("appended"):
            return self.read_appended(table)
        if "folders" in state:
            return self.read_buckets(state, by_bucket(state["folders"]))
        return self.spark.read.schema(StructType.fromJson(state["schema"])).parquet(state["path"])

    # A scan that knows each row's file is an ordinary read.
    files = read

    def _point(self, table: str, path: str, schema: StructType, ctx: RunContext | None, **more) -> None:
        state = {"path": path, "schema": schema.jsonValue(), **more}
        if ctx:
            state |= {"run": ctx.run_id, "day": ctx.run_date.isoformat()}
        write_text(self.spark, self.pointer(table), json.dumps(state))
        self._name(table)

    def _name(self, table: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
        state = self.state(table)
        if state.get("appended"):
            run = f"regexp_replace(cast(run AS string), '{ATTEMPT}', '') AS run"
            self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * EXCEPT (run), {run} FROM parquet.`{state['path']}`")
        elif "folders" in state:
            columns = ", ".join(f"`{f['name']}`" for f in state["schema"]["fields"])
            rows = " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{path}/{BUCKET}={{{','.join(map(str, buckets))}}}`"
                                      for path, buckets in state["folders"].items())
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                                for f in StructType.fromJson(state["schema"]).fields)
            self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS {rows or f'SELECT {nothing} WHERE false'}")
        else:
            columns = ", ".join(f"`{f['name']}`" for f in state["schema"]["fields"])
            self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM parquet.`{state['path']}`")

    def open(self) -> None:
        """Name every table below the root in this session, as after a restart."""
        found = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(
            f"{self.root}/pointers").select("path").collect()  # one row per table
        for row in found:
            self._name(row.path.rsplit("/", 1)[-1].removesuffix(".json"))

    def publish(self, df: DataFrame, table: str, ctx: RunContext, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), inputs: Mapping[str, str] | None = None, required: Sequence[str] = (), **more) -> dict:
        """Write the table anew and then switch to it. Returns the row count.

        Rows, and rows without one of the ``required`` columns, are counted on the way and kept in the pointer, as are
        ``inputs``, the folders of the tables that it is made from, and ``more``. Counts on the way take in tasks that
        were run again, so they hold only if the files' footers name as many rows; else the written columns are read.
        Rows to be clustered are written as they come first: a sample for the ranges then reads files, instead of
        computing all rows once more, and what they were computed from is let go before they are moved."""
        path, staged = f"{self.folder(table)}/{ctx.run_id}-{uuid.uuid4().hex[:12]}", None
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("row_count"), _lacking(required).alias("null_key_rows")]
        laid_out = df
        if cluster_by and not partition_by:
            staged = shared_dir(self.spark, "unclustered")
            df.write.parquet(staged)
            laid_out = clustered(self.spark.read.schema(df.schema).parquet(staged), cluster_by)
        write_partitioned(laid_out.observe(seen, *counts), path, partition_by, rebalance=not CODES.issuperset(partition_by))
        if staged:
            drop_path(self.spark, staged)
        order = [*(f for f in df.schema.fields if f.name not in partition_by),
                 *(df.schema[c] for c in partition_by)]
        written = self.spark.read.schema(StructType(order)).parquet(path)
        counted = seen.get
        if counted["row_count"] != written.count():
            counted = written.agg(*counts).first().asDict()
        self._point(table, path, StructType(order), ctx, **({} if inputs is None else {"inputs": dict(inputs)}), counts=counted, **more)
        return {"rows_written": counted["row_count"]}

    def counts(self, table: str) -> dict | None:
        """Rows, and rows without one of the required keys, as counted when they were written; None for append tables."""
        state = self.state(table)
        if state is None or "counts" not in state:
            return None
        if "folders" not in state:
            return state["counts"]
        rows, lacking = (sum(c[i] for c in state["counts"].values()) for i in (0, 1))
        return {"row_count": rows, "null_key_rows": lacking}

    def upsert(self, df: DataFrame, spec: TableSpec, ctx: RunContext, newer_by: str | None = None, unique: bool = False) -> dict:
        """Create the table, or merge the rows into it by the table's keys.

        The arriving rows are computed once, to a written table; their keys are checked there. With
        ``newer_by`` an arriving row that is older than the stored one does not replace it. Rows that
        bring nothing leave the table as it is, unwritten. ``unique`` says that the rows are the newest of
        each of the table's keys, so there is nothing to check.
        """
        if unique and spec.buckets and not self.exists(spec.id):
            return self.write_buckets(df, spec, ctx)
        path = shared_dir(self.spark, "arriving")
        df.write.parquet(path)
        arriving = self.spark.read.schema(df.schema).parquet(path)
        if not unique:
            reject_duplicates(arriving, spec)
        if spec.buckets:
            written = self._upsert_buckets(arriving, spec, ctx, newer_by)
        elif self.exists(spec.id) and arriving.isEmpty():
            written = {"rows_written": 0}
        else:
            merged = upsert(self.read(spec.id), arriving, spec.keys, newer_by) if self.exists(spec.id) else arriving
            written = self.publish(merged, spec.id, ctx, spec.partition_by, spec.cluster_by, required=spec.required)
        drop_path(self.spark, path)
        return written

    # Tables laid out by key: each bucket's rows lie in a folder of their own, and a write replaces some of them ------

    def places(self, table: str) -> dict[int, str]:
        """Where each bucket of a table lies that has rows."""
        return by_bucket(self.state(table)["folders"])

    def read_buckets(self, state: Mapping, places: Mapping[int, str]) -> DataFrame:
        """The rows of some buckets, with the table's columns."""
        schema = StructType.fromJson(state["schema"])
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{path}/{BUCKET}={b}" for b, path in sorted(places.items())])

    def write_buckets(self, rows: DataFrame | Sequence[DataFrame], spec: TableSpec, ctx: RunContext, touched: set[int] | None = None, **more) -> dict:
        """Replace the touched buckets (None: all) by the rows, which must all be of them. Of several frames each holds
        all rows of one bucket, so they need not be moved to it; they are written one after another.

        The rows go to a fresh folder, and then the pointer names it for these buckets; the others are neither read nor written.
        """
        state = self.state(spec.id)
        n = state["buckets"] if state else spec.buckets
        path = f"{self.folder(spec.id)}/{ctx.run_id}-{uuid.uuid4().hex[:12]}"
        apart = not isinstance(rows, DataFrame)
        for part in rows if apart else [rows]:
            write_partitioned(part.withColumn(BUCKET, bucket_of(spec.keys, n)), path, [BUCKET], "append", rebalance=not apart)
        rows = part
        written = self.spark.read.schema(StructType([*rows.schema.fields, StructField(BUCKET, IntegerType())])).parquet(path)
        # n rows at most: counts of the buckets just written, from their key columns.
        filled = {r[0]: [r[1], r[2]] for r in written.groupBy(BUCKET).agg(
            F.count(F.lit(1)), _lacking(spec.required)).collect()}
        kept = {} if touched is None or state is None else {
            b: p for b, p in by_bucket(state["folders"]).items() if b not in touched}
        known = {} if state is None else state.get("counts", {})
        counts = {str(b): known[str(b)] for b in kept if str(b) in known} | {str(b): c for b, c in filled.items()}
        if len(counts) == len(kept) + len(filled):  # else the table was begun before counts were kept
            more["counts"] = counts
        self._point(spec.id, path, rows.schema, ctx, buckets=n, folders=by_folder({**kept, **dict.fromkeys(filled, path)}), **more)
        return {"rows_written": sum(c[0] for c in filled.values())}

    def _upsert_buckets(self, arriving: DataFrame, spec: TableSpec, ctx: RunContext, newer_by: str | None) -> dict:
        """Merge arriving rows into the buckets that they hit. A new column is a change of every bucket."""
        state = self.state(spec.id)
        if state is None:
            return self.write_buckets(arriving, spec, ctx)
        places = by_bucket(state["folders"])
        hit = {r[0] for r in arriving.select(bucket_of(spec.keys, state["buckets"])).distinct().collect()}
        if not hit:
            return {"rows_written": 0}
        known = {f["name"] for f in state["schema"]["fields"]}
        if set(arriving.columns) - known:
            hit |= set(places)
        there = self.read_buckets(state, {b: p for b, p in places.items() if b in hit})
        whole = newer_by and known <= set(arriving.columns)
        if whole and slices.how_many(bytes_of(there) + bytes_of(arriving)) > 1:
            # Large merges go bucket by bucket: what one has moved is gone before the next begins.
            bucket = bucket_of(spec.keys, state["buckets"])
            merged = [upsert_in_one(self.read_buckets(state, {b: places[b]} if b in places else {}), arriving.where(bucket == b),
                                    spec.keys, newer_by) for b in sorted(hit)]
        else:
            merged = upsert_in_one(there, arriving, spec.keys, newer_by) if whole else upsert(there, arriving, spec.keys, newer_by)
        return self.write_buckets(merged, spec, ctx, hit)

    def apply(self, df: DataFrame, spec: TableSpec, ctx: RunContext, deleted: Column, drop: Sequence[str] = ()) -> dict:
        """Apply changes, one of a key, to the buckets they hit: rows marked ``deleted`` take their key out, the
        others replace its row. Columns in ``drop`` are not stored."""
        path = shared_dir(self.spark, "changes")
        marked = df.select("*", deleted.alias("_deleted"))
        marked.write.parquet(path)
        arriving = self.spark.read.schema(marked.schema).parquet(path)
        live = arriving.where(~F.col("_deleted")).drop("_deleted", *drop)
        state = self.state(spec.id)
        if state is None:
            return self.write_buckets(live, spec, ctx)
        places = by_bucket(state["folders"])
        hit = {r[0] for r in arriving.select(bucket_of(spec.keys, state["buckets"])).distinct().collect()}
        if not hit:
            return {"rows_written": 0}
        there = self.read_buckets(state, {b: p for b, p in places.items() if b in hit})
        changed = arriving.select(*spec.keys)
        untouched = there.join(changed, null_safe(there, changed, spec.keys), "left_anti")
        return self.write_buckets(untouched.unionByName(live, allowMissingColumns=True), spec, ctx, hit)

    def changes(self, table: str, then: Mapping[int, str], columns: Sequence[str]) -> DataFrame:
        """What became of a table's rows, in these columns, since its buckets lay at ``then``: every row that there
        are more or fewer of, with the difference ``_n``. Only buckets written since are read; their former folders must still be there."""
        state = self.state(table)
        now = by_bucket(state["folders"])
        which = moved(now, then)

        def side(places: Mapping[int, str], sign: int) -> DataFrame:
            rows = self.read_buckets(state, {b: p for b, p in places.items() if b in which})
            return rows.select(*columns, F.lit(sign).alias("_n"))

        both = side(then, -1).unionByName(side(now, 1))
        return both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")

    def ensure(self, table: str, schema: str | StructType) -> None:
        """Create an empty append table with a fixed schema unless it exists."""
        if not self.exists(table):
            self._append(self.spark.createDataFrame([], schema), table, "created")

    def append(self, df: DataFrame, table: str, ctx: RunContext, after: str | None = None) -> str:
        """Add a run's rows as a folder of their own, which is returned. Repeating the run replaces that
        folder, so a repeat adds nothing, and no earlier row is rewritten. Rows of a run that were read
        from another watermark (``after``) are another folder."""
        return self._append(df, table, attempt(ctx.run_id, after))

    def _append(self, df: DataFrame, table: str, run: str) -> str:
        path = self.folder(table)
        df.write.mode("overwrite").parquet(f"{path}/run={run}")
        if not self.exists(table):
            self._point(table, path, df.schema, None, appended=True)
        return f"{path}/run={run}"

    def read_appended(self, table: str) -> DataFrame:
        """All runs of an append table, with columns that only some runs have."""
        return self._runs([self.folder(table)])

    def read_run(self, table: str, run_id: str) -> DataFrame:
        """The rows of one run of an append table; folders of other runs are not looked into."""
        plain = re.sub(r"([\\*?\[\]{}])", r"\\\1", run_id)
        found = [f for tail in ("", "~*") for f in existing(self.spark, f"{self.folder(table)}/run={plain}{tail}")]
        if not found:
            return self.read_appended(table).limit(0)
        return self._runs(found)

    def _runs(self, folders: Sequence[str]) -> DataFrame:
        # A run id is text even where it looks like a number, so it is taken from the path.
        found = self.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*folders)
        run = F.regexp_extract(F.col("_metadata.file_path"), "/run=([^/]*)/", 1)
        run = F.url_decode(F.replace(run, F.lit("+"), F.lit("%2B")))
        return found.select("*", F.regexp_replace(run, ATTEMPT, "").alias("run"))


def _lacking(required: Sequence[str]) -> Column:
    """How many rows lack a value in one of the columns."""
    return F.count_if(any_null(required)) if required else F.count_if(F.lit(False))


def existing(spark: SparkSession, pattern: str) -> list[str]:
    """Folders whose path fits a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [f.getPath().toString() for f in found]


@contextmanager
def cached(*frames: DataFrame):
    """Keep frames that several writes read, and let them go afterwards."""
    for df in frames:
        df.persist()
    try:
        yield frames
    finally:
        for df in frames:
            df.unpersist()


def reject_duplicates(df: DataFrame, spec: TableSpec) -> None:
    if not duplicate_keys(df, spec.keys).isEmpty():
        raise ValueError(f"{spec.id}: source rows are not unique on {list(spec.keys)}")


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists",
                      rebalance: bool = True) -> None:
    """Parquet (as the session compresses it). Partitioned writes are rebalanced: few files per small partition, and a
    partition with a large share of the rows is written by several tasks. Where partitions are few, that is not worth
    moving every row: without ``rebalance`` each task writes its rows where they are."""
    if partition_by:
        laid_out = df.hint("rebalance", *partition_by) if rebalance else df
        laid_out.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def _in_places(df: DataFrame, places: Sequence[Row], partition_by: Sequence[str]) -> Column:
    """Literal tests on the partition columns, which decide at planning time which folders are read."""
    def is_(c: str, v) -> Column:
        return df[c].isNull() if v is None else df[c] == F.lit(v)

    return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (is_(c, r[c]) for c in partition_by)) for r in places),
                  F.lit(False))


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                      partition_by: Sequence[str]) -> int:
    """Merge rows into a partitioned table and rewrite only the partitions concerned.

    Concerned are the partitions of the source and those where a matched row lies now: a row whose
    partition value changes leaves its old one. To find these, only keys and partition columns of the
    table are read. The merged rows are written to shared storage first, then replace the partitions;
    partitions left empty are removed. Returns the partitions rewritten.
    """
    target = spark.read.parquet(path)
    known = target.select(*{*keys, *partition_by})
    matched = known.join(source.select(*keys), null_safe(known, source, keys), "left_semi")
    # Partition values: as many as there are folders, at most.
    touched = source.select(*partition_by).union(matched.select(*partition_by)).distinct().collect()
    if not touched:
        return 0
    affected = target.where(_in_places(target, touched, partition_by))
    staged = shared_dir(spark, "merge")
    write_partitioned(upsert(affected, source, keys), staged)
    merged = spark.read.schema(target.schema).parquet(staged)
    merged.hint("rebalance", *partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    filled = {tuple(r) for r in merged.select(*partition_by).distinct().collect()}
    for values in touched:
        if tuple(values) not in filled:
            _drop_folder(spark, path, dict(zip(partition_by, values)))
    return len(touched)


def _drop_folder(spark: SparkSession, path: str, values: dict) -> None:
    names = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in values.items())
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{names}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows laid out by the columns in turn, so a point lookup on the first ones reads few files."""
    parted = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    return parted.sortWithinPartitions(*columns)


def interleaved_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """One sort key that keeps several numeric columns close together (a Z-order curve).

    Every column is mapped to 256 bands of equal share by approximate quantiles, found in two steps of
    16, and the bits of the band numbers are interleaved.
    """
    cuts = df.stat.approxQuantile(list(columns), [i / 256 for i in range(1, 256)], 0.001)
    key = F.lit(0).cast("bigint")
    for position, (name, bounds) in enumerate(zip(columns, cuts)):
        bounds = bounds or [0.0] * 255  # a column without values
        value = F.col(name).cast("double")
        coarse = _count_below(F.array(*[F.lit(float(b)) for b in bounds[15::16]]), value)
        groups = F.array(*[F.array(*[F.lit(float(b)) for b in bounds[i * 16:i * 16 + 15]]) for i in range(16)])
        band = (coarse * 16 + _count_below(groups[coarse], value)).cast("bigint")
        for bit in range(8):
            one = F.shiftright(band, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + position))
    return key


def _count_below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e <= value))


def compact(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, numeric: bool = False,
            file_bytes: int = FILE_BYTES) -> None:
    """Rewrite a table into well-filled files clustered on the columns.

    Without a number of files there are as many as its bytes fill.
    """
    files = files or max(1, -(-bytes_of(df) // file_bytes))
    if numeric and len(columns) > 1:
        keyed = df.withColumn("_z", interleaved_key(df, columns))
        # The columns follow the key so that one crowded cell can still be cut.
        laid = keyed.repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")
    else:
        laid = clustered(df, columns, files)
    laid.write.mode("errorifexists").parquet(path)


def bytes_of(df: DataFrame) -> int:
    """Size of what a frame reads, as the optimizer takes it from the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
