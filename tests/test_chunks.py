import gzip
import os
import random
from urllib.parse import urlparse

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_ordering import exchanges_with

from corpusmill.plans import code, measure
from corpusmill.session import qualified, work_folder
from corpusmill.sinks import append, chunks, jsonl
from corpusmill.sources import files


def records(spark, n=95):
    random.seed(n)
    rows = [(i, "".join(random.choices("aé漢\n", k=random.randint(0, 40)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "pos BIGINT, content STRING").repartition(4)


def python_frames(rows):
    return [len(t.encode()).to_bytes(8, "little") + t.encode() for _, t in rows]


def chunk_bytes(folder):
    root = urlparse(folder).path
    return {f: open(f"{root}/{f}", "rb").read() for f in sorted(os.listdir(root)) if f.startswith("stream_")}


def test_files_hold_the_framed_records(spark):
    rows, frame = records(spark)
    folder = work_folder(spark, "chunks")
    code.build(spark, frame, folder, rows_per_chunk=20)
    framed = python_frames(rows)
    expected = {f"stream_{c:05d}.bin": b"".join(framed[c * 20 : c * 20 + 20]) for c in range(5)}
    assert chunk_bytes(folder) == expected
    back = chunks.read_chunks(spark, folder).orderBy("chunk_file", "row_in_chunk").collect()
    assert [bytes(r.content).decode() for r in back] == [t for _, t in rows]
    manifest = chunks.read_manifest(spark, folder).orderBy("chunk").collect()
    assert [(m.records, m.bytes, m.first_pos, m.last_pos) for m in manifest] == [
        (len(framed[c * 20 : c * 20 + 20]), len(expected[f"stream_{c:05d}.bin"]), c * 20, min(c * 20 + 19, 94)) for c in range(5)
    ]


def test_resuming_gives_the_files_of_one_run(spark):
    rows, frame = records(spark)
    total = sum(map(len, python_frames(rows)))
    once, resumed = work_folder(spark, "once"), work_folder(spark, "resumed")
    code.build(spark, frame, once, total * 2 // 3, rows_per_chunk=20)
    for target in (total // 3, total // 3, total * 2 // 3):
        code.build(spark, frame, resumed, target, rows_per_chunk=20)
    assert chunk_bytes(resumed) == chunk_bytes(once)


def test_a_run_goes_on_inside_a_chunk(spark):
    """Records that are committed are not read again, whatever has become of them."""
    rows, frame = records(spark)
    once, resumed = work_folder(spark, "once"), work_folder(spark, "inside")
    code.build(spark, frame, once, rows_per_chunk=40)
    code.build(spark, frame.where("pos < 55"), resumed, rows_per_chunk=40)
    point = chunks.resume_point(spark, resumed, 40)
    assert (point.pos, point.begun["chunk"], point.begun["records"]) == (55, 1, 15)
    assert point.bytes == sum(map(len, python_frames(rows[:55])))
    gone = frame.withColumn("content", F.when(F.col("pos") < 55, F.raise_error(F.lit("read again"))).otherwise(F.col("content")))
    code.build(spark, gone, resumed, rows_per_chunk=40)
    assert chunk_bytes(resumed) == chunk_bytes(once)
    entries = lambda path: sorted(map(str, chunks.read_manifest(spark, path).collect()))
    assert entries(resumed) == entries(once)
    code.build(spark, frame, resumed, rows_per_chunk=40)  # nothing is left to do
    assert chunk_bytes(resumed) == chunk_bytes(once) and entries(resumed) == entries(once)
    assert [bytes(r.content).decode() for r in chunks.read_chunks(spark, resumed).orderBy("chunk_file", "row_in_chunk").collect()] == [t for _, t in rows]


def test_a_failed_run_commits_nothing(spark):
    rows, frame = records(spark)
    folder = work_folder(spark, "failed")
    broken = frame.withColumn("content", F.when(F.col("pos") == 70, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        chunks.write_chunks(broken.select("pos", F.col("content").cast("binary")), folder, rows_per_chunk=20)
    assert chunks.resume_point(spark, folder, 20) == chunks.ResumePoint(0, 0)
    root = urlparse(folder).path
    left = [f for _, _, names in os.walk(root) for f in names] if os.path.exists(root) else []
    assert left == []
    code.build(spark, frame, folder, rows_per_chunk=20)
    assert b"".join(chunk_bytes(folder).values()) == b"".join(python_frames(rows))


def test_a_commit_removes_what_a_lost_attempt_staged(spark, tmp_path):
    """A task that was run twice: only the attempt whose message Spark kept is put in place."""
    writer = chunks.ChunkWriter(str(tmp_path), "run")
    batch = pa.RecordBatch.from_pydict(
        {"chunk": pa.array([0, 0, 1], pa.int64()), "pos": pa.array([0, 1, 2], pa.int64()), "name": ["stream_00000.bin"] * 2 + ["stream_00001.bin"],
         "frame": pa.array([b"\x01" + bytes(7) + b"a", bytes(8), b"\x02" + bytes(7) + b"bc"], pa.binary())}
    )
    lost = writer.write(iter([batch.slice(0, 1)]))
    assert lost.entries and os.listdir(tmp_path / "_staged" / "run")
    writer.commit([writer.write(iter([batch.slice(0, 1), batch.slice(1)])), None])
    assert chunk_bytes(str(tmp_path)) == {"stream_00000.bin": b"\x01" + bytes(7) + b"a" + bytes(8), "stream_00001.bin": b"\x02" + bytes(7) + b"bc"}
    assert not os.path.exists(tmp_path / "_staged" / "run")
    again = chunks.ChunkWriter(str(tmp_path), "again")
    again.write(iter([batch]))
    again.abort([None])
    assert not os.path.exists(tmp_path / "_staged" / "again")
    manifest = {m.chunk: (m.records, m.bytes, m.first_pos, m.last_pos) for m in chunks.read_manifest(spark, str(tmp_path)).collect()}
    assert manifest == {0: (2, 17, 0, 1), 1: (1, 10, 2, 2)}


def test_one_chunk_is_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(chunks, "MARK_BYTES", 5_000)
    rows = [(i, random.Random(i).choice(["", "é" * 50, "x" * 9_000])) for i in range(60)]
    folder = work_folder(spark, "marked")
    code.build(spark, spark.createDataFrame(rows, "pos BIGINT, content STRING").coalesce(3), folder, rows_per_chunk=50)
    marks = {m.chunk: m.marks for m in chunks.read_manifest(spark, folder).collect()}
    pieces = chunks.chunk_pieces(spark, folder).collect()
    assert len(pieces) == sum(map(len, marks.values())) > 10 and marks[0][0].row == marks[0][0].at == 0
    back = chunks.read_chunks(spark, folder)
    assert back.select(F.spark_partition_id()).where("chunk_file = 'stream_00000.bin'").distinct().count() > 1
    got = back.orderBy("chunk_file", "row_in_chunk").collect()
    assert [bytes(r.content).decode() for r in got] == [t for _, t in rows]
    assert [r.row_in_chunk for r in got] == [*range(50), *range(10)]


def test_a_path_lies_on_the_default_file_system_or_is_refused(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    spark.conf.set("fs.defaultFS", "viewfs://nowhere")
    spark.conf.set("fs.viewfs.mounttable.nowhere.link./a", f"file://{tmp_path}")
    try:
        with pytest.raises(ValueError, match="cannot open viewfs://nowhere/a/chunks"):
            qualified(spark, "/a/chunks")
    finally:
        spark.conf.unset("fs.defaultFS")


def test_truncated_chunk_is_reported(spark):
    _, frame = records(spark, 10)
    folder = work_folder(spark, "cut")
    code.build(spark, frame, folder)
    path = f"{urlparse(folder).path}/stream_00000.bin"
    data = open(path, "rb").read()
    with open(path, "wb") as out:
        out.write(data[:-1])
    with pytest.raises(Exception, match="truncated record"):
        chunks.read_chunks(spark, folder).count()


def test_shards_are_complete_ordered_and_wrap(spark):
    rows = [(str(i), f"t{i}", f"text {i}", i) for i in range(57)]
    frame = spark.createDataFrame(rows, "id STRING, title STRING, text STRING, k BIGINT").repartition(6)
    folder = work_folder(spark, "shards")
    jsonl.write_shards(frame, folder, "k", rows_per_file=4, files_per_folder=3, folders=2)
    back = jsonl.read_shards(spark, folder).collect()
    got = {}
    for r in back:
        got.setdefault((r.dir, r.file), set()).add(int(r.id))
    expected = {}
    for i in range(57):
        key = ("AA" if i < 12 else "BB", f"wiki_{(i // 4) % 3:02d}")
        expected.setdefault(key, set()).add(i)
    assert got == expected
    for found in files.inventory(spark, folder, "*.json").collect():
        assert len(open(urlparse(found.path).path).readlines()) <= 4


def test_shards_move_a_text_once(spark, monkeypatch):
    """Also where keys have gaps, so that their ranks do not follow from the keys alone."""
    written = []
    monkeypatch.setattr(DataFrameWriter, "json", lambda self, path: written.append(self._df))
    rows = [(str(i), f"t{i}", f"text {i}", 3 * i) for i in range(57)]
    frame = spark.createDataFrame(rows, "id STRING, title STRING, text STRING, k BIGINT")
    jsonl.write_shards(frame, "unused", "k", ("id",), rows_per_file=4)
    assert len(written) == 1 and written[0].count() == 57
    assert exchanges_with(written[0]._jdf.queryExecution().executedPlan(), "text") == 1


def test_non_numeric_identifiers_get_a_place(spark):
    frame = spark.createDataFrame([("7",), ("x-1",), ("12",)], "id STRING")
    keys = {r.id: r.k for r in frame.select("id", jsonl.numeric_key("id").alias("k")).collect()}
    assert keys["7"] == 7 and keys["12"] == 12 and 0 <= keys["x-1"] < 2**52


def test_appending_adds_to_what_is_there(spark):
    text, lines = work_folder(spark, "text"), work_folder(spark, "json")
    for value in ("a", "b"):
        frame = spark.createDataFrame([(value,)], "value STRING")
        append.append_text(frame, text)
        append.append_json(frame, lines)
    assert sorted(r.value for r in spark.read.text(text).collect()) == ["a", "b"]
    assert sorted(r.value for r in spark.read.schema("value STRING").json(lines).collect()) == ["a", "b"]


def test_gzip_packs_and_sizes(spark):
    frame = spark.createDataFrame([("a", "x" * 1000), ("b", "y" * 10)], "g STRING, t STRING")
    folder = work_folder(spark, "packs")
    append.write_gzip(frame, "t", "g", folder)
    sizes = {r.grp: r.gz_bytes for r in append.gzip_sizes(frame, folder).collect()}
    assert set(sizes) == {"a", "b", "ALL"} and sizes["a"] < 1000
    assert spark.read.text(f"{folder}/whole").count() == 2


def test_compared_groups_keep_escaped_and_null_names(spark, tmp_path):
    groups = ["plain", "a:b", "sp ace", "a+b", "50%", None, "", "n", "v", "(all)", "__HIVE_DEFAULT_PARTITION__", "é/="]
    rows = spark.createDataFrame([(g, f"text {k}") for k, g in enumerate(groups)], "g string, t string")
    append.write_gzip(rows, "t", "g", str(tmp_path / "out"))
    sizes = append.gzip_sizes(rows, str(tmp_path / "out"), overall="(all)").collect()
    assert len(sizes) == len(groups) + 1 and all(r.gz_bytes > 0 and r.members == 1 for r in sizes)
    assert {(r.grp, r.is_total) for r in sizes} == {*((g, False) for g in groups), ("(all)", True)}
    compared = measure.compare(rows, "g", "t", str(tmp_path / "again")).collect()
    assert len(compared) == len(groups) + 1 and all(r.gz_bytes > 0 and r.raw_bytes > 0 for r in compared)
    assert sum(r.is_total for r in compared) == 1


def test_packs_follow_bytes_not_tasks(spark, tmp_path):
    """Small groups of many tasks have one file each, a group of most rows has several, of bounded length."""
    rows = spark.range(0, 60_000, 1, 24).selectExpr(
        "CASE WHEN id % 3 = 0 THEN concat('s', id % 7) ELSE 'hot' END AS g", "sha2(string(id), 256) AS t"
    )
    # So many partitions that the large group has one for itself.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k", "spark.sql.shuffle.partitions": "200"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    append.write_gzip(rows, "t", "g", str(tmp_path / "packs"), rows_per_member=15_000)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    index = append.read_index(spark, str(tmp_path / "packs")).where("not is_total").collect()
    members = {}
    for entry in index:
        members.setdefault(entry.grp, []).append(entry.gz_bytes)
    assert set(members) == {"hot", *(f"s{k}" for k in range(7))}
    assert all(len(m) <= 2 for g, m in members.items() if g != "hot") and 3 <= len(members["hot"]) < 24
    for entry in index:
        assert len(gzip.open(tmp_path / "packs" / "parts" / entry.member).readlines()) <= 15_000
    assert spark.read.text(f"{tmp_path}/packs/whole").count() == spark.read.text(f"{tmp_path}/packs/parts").count() == 60_000
