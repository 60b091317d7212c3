"""Dated CSV drops as one Spark data source, for batch and stream, with a ledger of what was read.

The ledger is a folder. Before any file of a batch is read, one file in it names them all; after the rows of a
batch are stored, a marker says so. A batch that is read again after a crash therefore has the same files,
whatever has arrived since. A file is new if no batch names it, so one that comes late, with an older date, is
taken in all the same. One reader uses a ledger at a time. Files must be put in place whole.

Listing and ledger work is the driver's and goes with the number of files; content is read in tasks, large
files in ranges of lines.
"""

from __future__ import annotations

import csv
import json
import re
import sys
import uuid
from collections.abc import Iterator, Sequence
from datetime import date
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructType

from partledger.functions.columns import FILE_DATE_PATTERN

NAME = "dated_csv"
SOURCE = "_source_file"
# A task reads ranges of files, about so many bytes of them; one range is in its memory at a time.
TASK_BYTES, RANGE_BYTES, OPEN_BYTES = 128 << 20, 32 << 20, 4 << 20
BATCH_ROWS = 10_000
CLAIMS = "batch long, file_name string, path string, size_bytes long"

# The source is sent to the workers itself, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _open(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what goes before such a path to name it outside."""
    uri = re.sub("^file:/*", "file:///", path).rstrip("/")
    system, inner = fs.FileSystem.from_uri(uri)
    return system, inner, uri[:len(uri) - len(inner)] if uri.endswith(inner) else ""


def drop_date(path: str) -> str:
    """Date in a file's name as text; empty when there is none, or no such day."""
    match = re.search(FILE_DATE_PATTERN, path)
    try:
        return date(*map(int, match.groups())).isoformat() if match else ""
    except ValueError:
        return ""


def found(path: str, pattern: str = "*.csv") -> list[tuple[str, int]]:
    """Path and size of the files below a folder, oldest date first; names that begin with _ or . are not looked at."""
    system, root, before = _open(path)
    files = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    seen = [(before + f.path, f.size) for f in files if f.type == fs.FileType.File and fnmatch(f.base_name, pattern)
            and not any(part[0] in "_." for part in f.path[len(root):].strip("/").split("/"))]
    return sorted(seen, key=lambda f: (drop_date(f[0]), f[0]))


class Ledger:
    """Which batch has which files, and up to which batch all rows are stored."""

    def __init__(self, folder: str):
        self.folder = folder

    def _numbers(self, kind: str) -> list[int]:
        system, root, _ = _open(self.folder)
        names = [f.base_name for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True))]
        return sorted(int(m[1]) for m in (re.fullmatch(kind + r"-(\d+)\.json", n) for n in names) if m)

    def _write(self, name: str, lines: Sequence[dict]) -> None:
        system, root, _ = _open(self.folder)
        system.create_dir(root, recursive=True)
        staged = f"{root}/_{uuid.uuid4().hex}"
        with system.open_output_stream(staged) as out:
            out.write("".join(json.dumps(line) + "\n" for line in lines).encode())
        system.move(staged, f"{root}/{name}")

    def last(self) -> int:
        """Number of the newest batch; 0 when there is none."""
        return max(self._numbers("batch"), default=0)

    def committed(self) -> int:
        """Number of the newest batch whose rows are stored; 0 when there is none."""
        return max(self._numbers("stored"), default=0)

    def files(self, after: int, upto: int) -> list[tuple[str, int]]:
        """Files of the batches in (after, upto]."""
        system, root, _ = _open(self.folder)
        out = []
        for n in self._numbers("batch"):
            if after < n <= upto:
                with system.open_input_stream(f"{root}/batch-{n:08d}.json") as f:
                    out += [(line["path"], line["size_bytes"]) for line in map(json.loads, f.read().decode().splitlines())]
        return out

    def claim(self, files: Sequence[tuple[str, int]]) -> int:
        """Make a batch of the files that no batch has yet, if there are any; the number of the newest batch."""
        last = self.last()
        known = {path for path, _ in self.files(0, last)}
        new = [f for f in files if f[0] not in known]
        if not new:
            return last
        self._write(f"batch-{last + 1:08d}.json", [
            {"batch": last + 1, "file_name": path.rsplit("/", 1)[-1], "path": path, "size_bytes": size} for path, size in new])
        return last + 1

    def commit(self, upto: int) -> None:
        """All rows of the batches up to this one are stored. Said twice, it changes nothing."""
        if upto > self.committed():
            self._write(f"stored-{upto:08d}.json", [{"stored": upto}])

    def table(self, spark: SparkSession) -> DataFrame:
        """``batch, file_name, path, size_bytes, status``: PROCESSED if the file's rows are stored, else PENDING."""
        claims = spark.read.schema(CLAIMS).json(f"{self.folder}/batch-*.json") if self.last() else spark.createDataFrame([], CLAIMS)
        stored = F.col("batch") <= F.lit(self.committed())
        return claims.withColumn("status", F.when(stored, "PROCESSED").otherwise("PENDING"))


# Reading ------------------------------------------------------------------------------------------------

def _packed(files: Sequence[tuple[str, int]]) -> list[InputPartition]:
    """Ranges of files, dealt to tasks of about the same number of bytes."""
    tasks, held = [], TASK_BYTES
    for path, size in files:
        for start in range(0, size, RANGE_BYTES):
            piece = (path, size, start, min(start + RANGE_BYTES, size))
            if held >= TASK_BYTES:
                tasks, held = [*tasks, []], 0
            tasks[-1].append(piece)
            held += piece[3] - start + OPEN_BYTES
    return [InputPartition(task) for task in tasks]


def _line_start(f, at: int, size: int) -> int:
    """First byte of the first line that begins at this byte or after it."""
    if at == 0 or at >= size:
        return min(at, size)
    at -= 1
    f.seek(at)
    while at < size and (block := f.read(1 << 16)):
        end = block.find(b"\n")
        if end >= 0:
            return min(at + end + 1, size)
        at += len(block)
    return size


def _text(column: pa.Array) -> pa.Array:
    """Bytes as text; what is not UTF-8 becomes the replacement character."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if v is None else v.decode("utf-8", "replace") for v in column.to_pylist()], pa.string())


def _range_rows(piece: tuple[str, int, int, int], escape: str) -> tuple[list[str], list[list[pa.Array]]]:
    """The header of a file, and the columns of the lines that begin in a range of it: once for those with as many
    fields as the header, once for the others, whose missing fields are null and whose surplus ones are cut off."""
    path, size, start, stop = piece
    csv.field_size_limit(sys.maxsize)
    system, inner, _ = _open(path)
    with system.open_input_file(inner) as f:
        head = _line_start(f, 1, size)
        f.seek(0)
        header = next(csv.reader([f.read(head).decode("utf-8-sig", "replace").strip("\r\n")]), [])
        begin, end = max(_line_start(f, start, size), head), max(_line_start(f, stop, size), head)
        f.seek(begin)
        content = f.read(end - begin)
    lines = sum(1 for line in content.split(b"\n") if line.strip(b"\r"))
    if not header or not lines:
        return header, []
    odd: list[str] = []

    def put_by(row) -> str:
        odd.append(row.text)
        return "skip"

    names = [str(i) for i in range(len(header))]
    try:
        table = arrow_csv.read_csv(
            pa.BufferReader(content),
            arrow_csv.ReadOptions(use_threads=False, column_names=names, block_size=len(content) + 1),
            arrow_csv.ParseOptions(escape_char=escape or False, invalid_row_handler=put_by),
            arrow_csv.ConvertOptions(column_types={n: pa.binary() for n in names}, strings_can_be_null=True, null_values=[""],
                                     quoted_strings_can_be_null=False, check_utf8=False))
        whole = table.num_rows + len(odd) == lines
    except (pa.ArrowInvalid, UnicodeDecodeError):
        whole = False
    if not whole:  # an open quote has taken in other lines, or a line is no text: each line by itself
        table, odd = None, [v.decode("utf-8", "replace").rstrip("\r") for v in content.split(b"\n") if v.strip(b"\r")]
    out = [[_text(c.combine_chunks()) for c in table.columns]] if table else []
    if odd:
        fields = [next(csv.reader([line.replace("\r", " ")], escapechar=escape or None)) for line in odd]
        full = [([v or None for v in r] + [None] * len(header))[:len(header)] for r in fields]
        out.append([pa.array(c, pa.string()) for c in zip(*full)])
    return header, out


class _Rows:
    """What batch and stream readers share: rows of a list of ranges, as Arrow batches."""

    def __init__(self, options, schema: StructType):
        wrong = [f.name for f in schema.fields if f.dataType != StringType()]
        if wrong:
            raise ValueError(f"{NAME} gives columns as the text that they are, not {', '.join(wrong)}")
        self.names = schema.names
        self.path, self.pattern = options["path"], options.get("pattern", "*.csv")
        self.escape = options.get("escape", "\\")
        self.after, self.first, self.last = options.get("after"), options.get("afterbatch"), options.get("uptobatch")
        self.ledger = Ledger(options["ledger"]) if "ledger" in options else None

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for piece in partition.value:
            header, parts = _range_rows(piece, self.escape)
            place = {name.strip().lower(): i for i, name in reversed(list(enumerate(header)))}
            for columns in parts:
                n = len(columns[0])
                made = [pa.array([piece[0]] * n) if name == SOURCE
                        else columns[place[name.lower()]] if name.lower() in place else pa.nulls(n, pa.string())
                        for name in self.names]
                yield from pa.Table.from_arrays(made, self.names).to_batches(BATCH_ROWS)


class _BatchReader(_Rows, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        if self.ledger and self.last is not None:
            files = self.ledger.files(int(self.first or 0), int(self.last))
        else:
            files = [f for f in found(self.path, self.pattern) if self.after is None or drop_date(f[0]) > self.after]
        return _packed(files) or [InputPartition([])]


class _StreamReader(_Rows, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"batch": self.ledger.committed()}

    def latestOffset(self) -> dict:
        return {"batch": self.ledger.claim(found(self.path, self.pattern))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _packed(self.ledger.files(start["batch"], end["batch"]))

    def commit(self, end: dict) -> None:
        self.ledger.commit(end["batch"])


class DatedCsv(DataSource):
    """Format ``dated_csv``. Columns are found by the names in each file's header, without case; a column that a
    file lacks is null, one that the schema lacks is left out, ``_source_file`` is the file. A line is a row, also one
    with an open quote; of lines of another length the missing fields are null. An empty field is null, a quoted empty one
    is not (in lines of the header's length); ``escape`` takes the character after it as it is."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        raise ValueError(f"{NAME} needs a schema, it is never inferred")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if "ledger" not in self.options:
            raise ValueError(f"a stream of {NAME} needs a ledger")
        return _StreamReader(self.options, schema)


def _with_source(schema: str) -> str:
    return f"{schema}, {SOURCE} string"


def csv_drops(spark: SparkSession, path: str, schema: str, after: str | None = None, pattern: str = "*.csv") -> DataFrame:
    """Rows of all files below a folder, or of those dated after a day."""
    spark.dataSource.register(DatedCsv)
    reader = spark.read.format(NAME).schema(_with_source(schema)).option("pattern", pattern)
    return (reader if after is None else reader.option("after", after)).load(path)


def csv_batches(spark: SparkSession, path: str, schema: str, ledger: Ledger, after: int, upto: int) -> DataFrame:
    """Rows of the ledger's batches in (after, upto], the same at every reading."""
    spark.dataSource.register(DatedCsv)
    return spark.read.format(NAME).schema(_with_source(schema)).options(
        ledger=ledger.folder, afterbatch=str(after), uptobatch=str(upto)).load(path)


def csv_stream(spark: SparkSession, path: str, schema: str, ledger: Ledger, pattern: str = "*.csv") -> DataFrame:
    """Stream of the files below a folder; a micro-batch has the files that no batch had before.

    The ledger belongs to the stream's checkpoint. A stream that starts without one begins after what is stored.
    """
    spark.dataSource.register(DatedCsv)
    return spark.readStream.format(NAME).schema(_with_source(schema)).options(ledger=ledger.folder, pattern=pattern).load(path)
