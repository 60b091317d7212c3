from datetime import datetime

import pytest
from pyspark.errors import PySparkException, StreamingQueryException

from partledger.context import RunContext
from partledger.plans.run import Run
from partledger.session import shared_dir
from partledger.sinks import Lake
from partledger.sources import arrivals, files
from partledger.sources.arrivals import Ledger
from partledger.streaming import jobs

SCHEMA = "part_id string, material string"


def drop(folder, day, *lines, header="part_id,material"):
    path = folder / f"cad_metadata_{day}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join([header, *lines]).encode() if isinstance(header, str) else b"\n".join([header, *lines]))
    return path


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", Ledger(str(tmp_path / "ledger"))


def taken(df):
    return sorted(((r.part_id, r.material) for r in df.collect()), key=str)


def test_fields_of_every_kind(spark, tmp_path):
    drop(tmp_path / "a", "2026-01-01", "p1,steel", 'p2,"a ""b"", c"', 'p3,""', "p4,", "", 'p5,"x \\"y\\" z"', "p6", "p7,zinc,more", ",tin")
    drop(tmp_path / "b", "2026_01_02", "brass,p8,1", "lead,p9,2", header="Material, PART_ID ,surplus")
    drop(tmp_path / "c", "2026-01-03", "p10", header="part_id")
    drop(tmp_path / "d", "2026-01-04", b"p11,\xff\xe9", "p12,ü".encode(), header=b"\xef\xbb\xbfpart_id,material\r")
    drop(tmp_path / "e", "2026-01-05")
    (tmp_path / "empty_2026-01-06.csv").touch()
    (tmp_path / "blank_2026-01-06.csv").write_text("part_id,material\n\n\n")
    drop(tmp_path / "_temporary", "2026-01-07", "hidden,x")
    (tmp_path / "notes_2026-01-07.txt").write_text("part_id,material\nnote,x\n")
    assert taken(arrivals.csv_drops(spark, str(tmp_path), SCHEMA)) == sorted([
        ("p1", "steel"), ("p2", 'a "b", c'), ("p3", ""), ("p4", None), ("p5", 'x "y" z'), ("p6", None), ("p7", "zinc"), (None, "tin"),
        ("p8", "brass"), ("p9", "lead"), ("p10", None), ("p11", "��"), ("p12", "ü")], key=str)
    later = arrivals.csv_drops(spark, f"file:{tmp_path}", SCHEMA, after="2026-01-02")
    assert {r.part_id for r in later.collect()} == {"p10", "p11", "p12"}


def test_open_quotes_and_bytes_that_are_no_text(spark, tmp_path):
    drop(tmp_path / "a", "2026-01-01", 'p1,"open', 'p2,x"', 'p3,"y"', "p4," + "z" * 200_000 + ",more")
    drop(tmp_path / "b", "2026-01-01", b"p5,\xff,more", b'p6,"q\r', b"p7,a\rb", header=b"part_id,material")
    read = taken(arrivals.csv_drops(spark, str(tmp_path), SCHEMA))
    assert read == [("p1", "open"), ("p2", 'x"'), ("p3", "y"), ("p4", "z" * 200_000), ("p5", "\ufffd"), ("p6", "q"), ("p7", "a b")]


def test_no_files(spark, tmp_path):
    for folder in (tmp_path, tmp_path / "none"):
        none = arrivals.csv_drops(spark, str(folder), SCHEMA)
        assert none.columns == ["part_id", "material", "_source_file"] and none.count() == 0
    assert Ledger(str(tmp_path / "none")).table(spark).count() == 0


def test_schema_is_given_as_text(spark, tmp_path):
    with pytest.raises(PySparkException):
        arrivals.csv_drops(spark, str(tmp_path), "part_id int").collect()


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_every_line_is_in_one_range(tmp_path, monkeypatch, size):
    monkeypatch.setattr(arrivals, "RANGE_BYTES", size)
    lines = [f"p{i},{'x' * (i * 7 % 40)}" for i in range(60)] + ["last" + "y" * 300 + ",z"]
    path = drop(tmp_path, "2026-01-01", *lines)
    pieces = [p for task in arrivals._packed(arrivals.found(str(tmp_path))) for p in task.value]
    assert len(pieces) == -(-path.stat().st_size // size)
    read = [v for p in pieces for columns in arrivals._range_rows(p, "\\")[1] for v in columns[0].to_pylist()]
    assert read == [line.split(",")[0] for line in lines]


def test_files_are_dealt_by_bytes():
    tasks = arrivals._packed([("small", 10)] * 100 + [("large", 10 * arrivals.TASK_BYTES)])
    assert sum(len(t.value) for t in tasks) == 100 + 10 * arrivals.TASK_BYTES // arrivals.RANGE_BYTES
    assert max(sum(p[3] - p[2] for p in t.value) for t in tasks) <= arrivals.TASK_BYTES + arrivals.RANGE_BYTES


def test_a_batch_keeps_its_files(spark, place):
    folder, book = place
    drop(folder, "2026-01-05", "p1,a")
    assert book.claim(arrivals.found(str(folder))) == 1 == book.claim(arrivals.found(str(folder)))
    drop(folder, "2026-01-01", "p0,late")  # comes after the claim, dated before it
    first = arrivals.csv_batches(spark, str(folder), SCHEMA, book, 0, 1)
    assert taken(first) == [("p1", "a")] and book.committed() == 0
    # The reader dies here. The next one reads that batch again, and what came since.
    upto = book.claim(arrivals.found(str(folder)))
    assert upto == 2 and taken(arrivals.csv_batches(spark, str(folder), SCHEMA, book, book.committed(), upto)) == [("p0", "late"), ("p1", "a")]
    book.commit(1)
    states = {r.file_name: (r.batch, r.status) for r in book.table(spark).collect()}
    assert states == {"cad_metadata_2026-01-05.csv": (1, "PROCESSED"), "cad_metadata_2026-01-01.csv": (2, "PENDING")}
    waiting = files.unprocessed(book.table(spark).select("file_name"), book.table(spark))
    assert [r.file_name for r in waiting.collect()] == ["cad_metadata_2026-01-01.csv"]
    book.commit(2)
    book.commit(1)
    assert book.committed() == 2 == book.claim(arrivals.found(str(folder)))


def test_stream_that_dies_loses_and_repeats_nothing(spark, place, tmp_path):
    folder, book = place
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    read, dying = [], True

    def store(batch, number):
        rows = taken(batch)
        read.append(rows)
        if dying and len(read) == 2:
            raise RuntimeError("executor lost")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def go():
        stream = arrivals.csv_stream(spark, str(folder), SCHEMA, book)
        jobs.finish(stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start())

    drop(folder, "2026-01-05", "p1,a", "p2,b")
    go()
    drop(folder, "2026-01-06", "p3,c")
    with pytest.raises(StreamingQueryException):
        go()
    drop(folder, "2026-01-02", "p0,late")
    dying = False
    go()
    go()
    assert read[1] == read[2] == [("p3", "c")]  # the same files again, without those that came since
    assert taken(spark.read.parquet(out)) == [("p0", "late"), ("p1", "a"), ("p2", "b"), ("p3", "c")]
    assert book.last() == 3


def test_stream_needs_a_ledger(spark, tmp_path):
    spark.dataSource.register(arrivals.DatedCsv)
    with pytest.raises(PySparkException):
        spark.readStream.format(arrivals.NAME).schema("a string, _source_file string").load(str(tmp_path)).isStreaming
        jobs.finish(spark.readStream.format(arrivals.NAME).schema("a string").load(str(tmp_path)).writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())


def test_run_takes_in_new_files_once(spark, place, monkeypatch):
    folder, book = place
    header = "part_id,part_name,material,weight_kg,designer,created_date"
    lake = Lake(spark, shared_dir(spark, "plant"))

    def run(run_id):
        found = Run(spark, lake, RunContext(run_id, datetime(2026, 2, 1)))
        found.load_files(str(folder), book.folder)
        return found.arrived.get("cad_metadata")

    drop(folder, "2026-01-05", "P1,Bolt,Steel,1.0,Ann,2026-01-01", ",Nut,Steel,1.0,Ann,2026-01-01", header=header)
    assert run("f1") == (2, 1) and run("f2") is None
    drop(folder, "2026-01-03", "P1,Bolt,Tin,1.0,Ann,2026-01-01", "P2,Nut,Tin,1.0,Ann,2026-01-01", header=header)
    commit = Ledger.commit
    monkeypatch.setattr(Ledger, "commit", lambda self, upto: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run("f3")
    monkeypatch.setattr(Ledger, "commit", commit)
    assert run("f3") == (2, 0) and run("f4") is None
    parts = {r.part_id: r.material for r in lake.read("bronze.cad_metadata").collect()}
    assert parts == {"P1": "Steel", "P2": "Tin"}  # the older file came later and does not replace
    assert lake.read_appended("silver.cad_metadata_quarantine").count() == 1
