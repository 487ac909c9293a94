"""Chunk files of length-prefixed records, written through a data source that Spark commits.

Each chunk is written by one task under a staged name; a task reports what it wrote in its commit message. Spark keeps
one message per task, of the attempt that succeeded, and only when all have it does the commit put the files in place,
write the manifest and remove whatever else was staged: what lost executors or failed attempts left goes with it. A
job that fails removes its staged folder and leaves nothing. Resuming reads the manifest, never a side counter.

The manifest marks a record every ``MARK_BYTES`` of a chunk, so that several tasks can read one chunk. A run that goes on
inside a chunk takes over the bytes that are there and adds to them: no record before its start is read again.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corpusmill.functions import names
from corpusmill.functions.frames import HEADER_BYTES, frame
from corpusmill.operators import ordering
from corpusmill.session import file_system, materialized, qualified, register, ship_package
from corpusmill.sources import files

MANIFEST, STAGED = "_manifest", "_staged"
MANIFEST_SCHEMA = (
    "chunk BIGINT, records BIGINT, bytes BIGINT, first_pos BIGINT, last_pos BIGINT, "
    "marks ARRAY<STRUCT<row: BIGINT, at: BIGINT>>"
)
RECORD_SCHEMA = "chunk_file STRING, row_in_chunk BIGINT, content BINARY"
CHUNK_GLOB = "stream_*.bin"
READ_BATCH_BYTES = 8 << 20
MARK_BYTES = 32 << 20
RENAMES = 16  # files put in place at once


@dataclass
class Written(WriterCommitMessage):
    """The chunks of one task: manifest entries with the staged and the final name of each file."""

    entries: list[dict]


class ChunkSink(DataSource):
    """``df.write.format("corpusmill_chunks")`` for (chunk, pos, name, frame) rows with each chunk's in one partition."""

    @classmethod
    def name(cls) -> str:
        return "corpusmill_chunks"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ChunkWriter(self.options["path"], self.options["run"], json.loads(self.options.get("begun", "null")))


class ChunkWriter(DataSourceArrowWriter):
    """``begun`` is the manifest entry of a chunk that an earlier run left incomplete."""

    def __init__(self, path: str, run: str, begun: dict | None = None):
        self.path, self.run, self.begun = path, run, begun

    def _target(self) -> tuple[pafs.FileSystem, str]:
        return file_system(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        target, root = self._target()
        staged = f"{root}/{STAGED}/{self.run}"
        target.create_dir(staged, recursive=True)
        attempt, out, entries = uuid.uuid4().hex, None, []
        for batch in iterator:
            chunk, pos = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            frames = batch.column(3).cast(pa.large_binary())
            offsets = np.frombuffer(frames.buffers()[1], np.int64)[frames.offset : frames.offset + len(frames) + 1]
            data = frames.buffers()[2]
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for at, to in zip(edges[:-1], edges[1:], strict=True):
                if at == to:
                    continue
                if not entries or entries[-1]["chunk"] != int(chunk[at]):
                    if out is not None:
                        out.close()
                    name = batch.column(2)[at].as_py()
                    entry = {
                        "chunk": int(chunk[at]), "records": 0, "bytes": 0, "first_pos": int(pos[at]), "last_pos": 0,
                        "marks": [], "name": name, "staged": f"{name}.{attempt}",
                    }
                    entries.append(entry)
                    out = target.open_output_stream(f"{staged}/{entry['staged']}", compression=None)
                    if self.begun and self.begun["chunk"] == entry["chunk"]:
                        self._take_over(target, f"{root}/{name}", out)
                        entry |= copy.deepcopy(self.begun)
                # The frames of one chunk lie side by side: one slice for all of them.
                out.write(data[int(offsets[at]) : int(offsets[to])])
                places = entry["bytes"] + offsets[at : to + 1] - offsets[at]
                before = entry["marks"][-1]["at"] // MARK_BYTES if entry["marks"] else -1
                steps = places[:-1] // MARK_BYTES
                for k in np.flatnonzero(np.diff(steps, prepend=before) > 0).tolist():
                    entry["marks"].append({"row": entry["records"] + k, "at": int(places[k])})
                entry |= {"records": entry["records"] + to - at, "bytes": int(places[-1]), "last_pos": int(pos[to - 1])}
        if out is not None:
            out.close()
        return Written(entries)

    def _take_over(self, target: pafs.FileSystem, path: str, out: pa.NativeFile) -> None:
        left = self.begun["bytes"]
        with target.open_input_stream(path, compression=None) as stream:
            while left and (block := stream.read(min(left, READ_BATCH_BYTES))):
                out.write(block)
                left -= len(block)
        if left:
            raise ValueError(f"{path} is shorter than its manifest entry")

    def commit(self, messages: Sequence[Written | None]) -> None:
        target, root = self._target()
        entries = [e for m in messages if m is not None for e in m.entries]

        def place(entry: dict) -> None:
            staged, final = f"{root}/{STAGED}/{self.run}/{entry['staged']}", f"{root}/{entry['name']}"
            try:
                target.move(staged, final)
            except OSError:  # a file system that does not rename over an existing file
                target.delete_file(final)
                target.move(staged, final)

        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(place, entries))
        target.create_dir(f"{root}/{MANIFEST}", recursive=True)
        kept = [{k: v for k, v in e.items() if k not in ("name", "staged")} for e in entries]
        with target.open_output_stream(f"{root}/{MANIFEST}/part-{self.run}.json", compression=None) as out:
            out.write("".join(json.dumps(e) + "\n" for e in kept).encode())
        self._clear()

    def abort(self, messages: Sequence[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        target, root = self._target()
        staged = f"{root}/{STAGED}/{self.run}"
        if target.get_file_info(staged).type != pafs.FileType.NotFound:
            target.delete_dir(staged)


def write_chunks(
    df: DataFrame,
    path: str,
    content: str = "content",
    pos: str = "pos",
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
    begun: dict | None = None,
) -> None:
    """Frame the binary ``content`` and write one file per chunk of consecutive positions.

    ``begun`` is the incomplete chunk of a ``ResumePoint``. A path without a scheme lies on Spark's default file system; one that Python's file systems can't open is refused.
    """
    spark = df.sparkSession
    register(spark, ChunkSink)
    chunk = ordering.chunk_columns(pos, rows_per_chunk)["chunk"]
    framed = (
        df.select(chunk.alias("chunk"), F.col(pos).cast("bigint").alias("pos"), F.col(content).alias("_content"))
        .repartition("chunk")
        .sortWithinPartitions("chunk", "pos")
        .select("chunk", "pos", names.chunk_name(F.col("chunk")).alias("name"), frame(F.col("_content")).alias("frame"))
    )
    sink = framed.write.format(ChunkSink.name()).mode("append").option("run", uuid.uuid4().hex)
    sink = sink.option("begun", json.dumps(begun))
    sink.option("path", qualified(spark, path)).save()


def _read_piece(uri: str, name: str, row: int, start: int, end: int | None) -> Iterator[pa.RecordBatch]:
    """The records between two byte offsets of a chunk, in batches of bounded size."""
    source, location = file_system(uri)
    held, rows = 0, []
    with source.open_input_file(location) as stream:
        stream.seek(start)
        while (end is None or stream.tell() < end) and (header := stream.read(HEADER_BYTES)):
            size = int.from_bytes(header, "little")
            content = stream.read(size) if len(header) == HEADER_BYTES else b""
            if len(header) < HEADER_BYTES or len(content) < size:
                raise ValueError(f"{name}: truncated record {row}")
            rows.append({"chunk_file": name, "row_in_chunk": row, "content": content})
            row, held = row + 1, held + size
            if held >= READ_BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows)
                held, rows = 0, []
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


def chunk_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(uri, name, row, start, end): the stretches of chunk files that tasks read, from the manifests' marks.

    A file that no manifest lists is one piece, whose end is null.
    """
    found = files.inventory(spark, path, CHUNK_GLOB).select(F.col("path").alias("uri"), F.col("inside").alias("name"))
    # Manifests may lie in folders of their own below the path, as streams write them.
    try:
        reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
        entries = reader.option("pathGlobFilter", "part-*.json").json(f"{path}/{MANIFEST}")
        listed = _latest(entries).select(names.chunk_name(F.col("chunk")).alias("name"), "bytes", "marks")
    except AnalysisException:
        return found.select("uri", "name", F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("start"),
                            F.lit(None).cast("bigint").alias("end"))
    ends = F.concat(F.transform(F.slice("marks", 2, F.size("marks")), lambda m: m["at"]), F.array("bytes"))
    zipped = F.transform("marks", lambda m, k: F.struct(m["row"].alias("row"), m["at"].alias("start"), F.get(ends, k).alias("end")))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("start"),
                             F.lit(None).cast("bigint").alias("end")))
    pieces = found.join(listed, "name", "left").select("uri", "name", F.coalesce(zipped, whole).alias("pieces"))
    return pieces.select("uri", "name", F.inline("pieces"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_file, row_in_chunk, content) of all chunks below a folder; a task reads a piece of a file."""
    ship_package()
    pieces = materialized(chunk_pieces(spark, path), "chunk-pieces")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                yield from _read_piece(piece["uri"], piece["name"], piece["row"], piece["start"], piece["end"])

    # A task for every core or MARK_BYTES. By number: Spark would put rows as small as these together by their own size.
    size = pieces.agg(F.count("*").alias("pieces"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-(size["bytes"] or 0) // MARK_BYTES))
    return pieces.repartition(max(min(size["pieces"], tasks), 1), "uri", "row").mapInArrow(read, RECORD_SCHEMA)


def _latest(entries: DataFrame) -> DataFrame:
    """One entry per chunk; a chunk that was completed by a later run counts once."""
    latest = F.max_by(F.struct("records", "bytes", "first_pos", "last_pos", "marks"), "last_pos").alias("e")
    return entries.groupBy("chunk").agg(latest).select("chunk", "e.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed chunk."""
    return _latest(spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}"))


@dataclass(frozen=True)
class ResumePoint:
    """Where to go on: the first row to write, the bytes that stand before it, and the chunk it is to be added to."""

    pos: int
    bytes: int
    begun: dict | None = None


def resume_point(spark: SparkSession, path: str, rows_per_chunk: int = ordering.ROWS_PER_CHUNK) -> ResumePoint:
    """Behind the last record committed, be it inside a chunk or at the end of one."""
    try:
        manifest = read_manifest(spark, path)
    except AnalysisException:  # nothing was committed yet
        return ResumePoint(0, 0)
    last = F.max_by(F.struct(*manifest.columns), "last_pos").alias("last")
    row = manifest.agg(F.sum("bytes").alias("bytes"), last).first()
    if row["last"] is None:
        return ResumePoint(0, 0)
    entry = row["last"].asDict(recursive=True)
    return ResumePoint(entry["last_pos"] + 1, row["bytes"], entry if entry["records"] < rows_per_chunk else None)
