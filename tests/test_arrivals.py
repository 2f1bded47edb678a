"""Streams that are stopped between write and commit, and files that many tasks read."""

import json

import pytest
from pyspark.sql import functions as F

from omenflow.sources import readers
from omenflow.streaming import arrivals

SCHEMA = "id BIGINT, text STRING"


def arrive(spark, folder, ids):
    spark.createDataFrame([(i, f"t{i}") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def ids(spark, sink):
    return sorted(r.id for r in arrivals.taken(spark, sink, SCHEMA).collect())


def test_a_batch_stopped_before_its_commit_is_there_once(spark, tmp_path, monkeypatch):
    folder, sink, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    arrive(spark, folder, range(10))
    arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint)
    arrive(spark, folder, range(10, 30))

    class Stopped(Exception):
        pass

    def half(rows):
        """Writes a part of the batch into its place, then fails, as a killed driver would have left it."""
        rows.limit(7).write.mode("overwrite").parquet(f"{sink}/{arrivals.BATCH}=1")
        raise Stopped

    with pytest.raises(Exception, match="Stopped"):
        arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint, half)
    assert len(ids(spark, sink)) == 17

    # Whole write, no commit: the function fails after the rows are there.
    from pyspark.sql.readwriter import DataFrameWriter

    write = DataFrameWriter.parquet

    def then_stop(self, path, *args, **more):
        write(self, path, *args, **more)
        raise Stopped

    monkeypatch.setattr(DataFrameWriter, "parquet", then_stop)
    with pytest.raises(Exception, match="Stopped"):
        arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint)
    monkeypatch.undo()
    assert ids(spark, sink) == list(range(30))
    arrive(spark, folder, range(30, 35))
    arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint)
    arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint)
    assert ids(spark, sink) == list(range(35))


def test_batches_of_so_many_files_and_work(spark, tmp_path):
    folder, sink, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    for k in range(3):
        arrive(spark, folder, range(10 * k, 10 * k + 10))
    arrivals.take_in(spark, folder, SCHEMA, sink, checkpoint, lambda df: df.where("id % 2 = 0"), files=1)
    got = arrivals.taken(spark, sink, SCHEMA)
    assert ids(spark, sink) == list(range(0, 30, 2)) and got.select("batch").distinct().count() == 3


@pytest.fixture
def small_cuts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_file_is_numbered_by_many_tasks(spark, tmp_path, small_cuts):
    lines = ["" if i % 7 == 3 else f"{i}\t \t " if i % 11 == 5 else f"{i}\tw{i} é\tT{i % 3}" for i in range(5000)]
    for name, part in (("a.tsv", lines), ("b.tsv", lines[:100]), ("c.tsv", [])):
        (tmp_path / name).write_text("\n".join(part), "utf-8")
    rows = readers.numbered_lines(spark, str(tmp_path))
    assert spark.read.text(f"{tmp_path}/a.tsv").rdd.getNumPartitions() > 10
    got = {(r.file.rsplit("/", 1)[-1], r.line): r.value for r in rows.collect()}
    assert got == {("a.tsv", i): x for i, x in enumerate(lines)} | {("b.tsv", i): x for i, x in enumerate(lines[:100])}
    want, sentence = [], 0
    for i, x in enumerate(lines):
        cells = x.split("\t")
        if len(cells) < 3 or not cells[1].strip():
            sentence += 1
        else:
            want.append((i, sentence, cells[1].strip(), cells[2]))
    found = readers.tagged_tokens(spark, f"{tmp_path}/a.tsv").orderBy("line").collect()
    assert [(r.line, r.sentence, r.term, r.tag) for r in found] == want


def test_an_array_of_records_is_read_by_many_tasks(spark, tmp_path, small_cuts):
    rows = [{"id": i, "text": f"a ]}}, {{ b\n{i} é", "more": [{"x": i}]} for i in range(2000)]
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=1, ensure_ascii=False).replace('{\n  "id":', '{"id":'), "utf-8")
    (tmp_path / "two.json").write_text(json.dumps(rows[:3], separators=(",", ":")), "utf-8")
    (tmp_path / "none.json").write_text("[]", "utf-8")
    got = readers.json_elements(spark, str(tmp_path), "id BIGINT, text STRING, more ARRAY<STRUCT<x: BIGINT>>", '{"id":')
    assert got.rdd.getNumPartitions() > 10
    ids_ = [r.id for r in got.collect()]
    assert sorted(ids_) == sorted([*range(2000), 0, 1, 2])
    assert got.where(F.col("id") == 7).first().text == rows[7]["text"] and got.where("id = 9").first().more[0].x == 9
    (tmp_path / "bad.json").write_text('[{"id": 1, "text": "a"', "utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_elements(spark, f"{tmp_path}/bad.json", "id BIGINT, text STRING", '{"id":').collect()


def test_lines_that_are_compressed_and_bad(spark, tmp_path):
    spark.range(50).selectExpr("id", "concat('n', id) AS name").write.option("sep", "\t").option("header", True).option("compression", "bzip2").csv(f"{tmp_path}/z")
    assert readers.delimited(spark, f"{tmp_path}/z", "id INT, name STRING").count() == 50
    (tmp_path / "bad.tsv").write_text("id\tname\n1\ta\nx\tb\n3\tc\td\n4\te\n", "utf-8")
    assert [r.id for r in readers.delimited(spark, f"{tmp_path}/bad.tsv", "id INT, name STRING", skip_bad=True).orderBy("id").collect()] == [1, 4]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.delimited(spark, f"{tmp_path}/bad.tsv", "id INT, name STRING").collect()


def test_marked_up_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?>\n<doc><p>One\n two</p> <p/>three</doc>", "utf-8")
    (tmp_path / "b.xml").write_text("<doc/>", "utf-8")
    assert [tuple(r) for r in readers.marked_up_text(spark, str(tmp_path)).collect()] == [("a.xml", "One two three")]
