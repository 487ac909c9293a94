"""Text files as spans of bytes that are fixed once, read by a Python data source.

A scan of Spark may split files elsewhere each time it is planned. Here the driver cuts the listed files into spans
(part, path, start, end) once, and every read of them numbers the same lines in the same parts, so a position follows
from the lines of earlier parts and the text is never written down. A line belongs to the span in which it begins; only
``\\n`` ends a line. gzip members are not splittable: one span a file.

A span may be read up to a number of bytes, so the head of a stream costs about its own size. In tolerant reading what
can't be read gives one row with its cause behind the lines before it.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusmill.session import file_system, materialized, qualified, register
from corpusmill.sources import files

SPAN_BYTES = 128 << 20
BLOCK_BYTES = 1 << 20
LINE_SCHEMA = "part BIGINT, line BIGINT, at BIGINT, value BINARY, cause STRING"
COMPRESSED = ".gz"
# What opening and decompressing a damaged file raises.
UNREADABLE = (OSError, EOFError, zlib.error)


@dataclass(frozen=True)
class Span:
    """Bytes [start, end) of a file, of whose lines those are read that begin in the first ``most`` bytes."""

    part: int
    path: str
    start: int
    end: int | None
    most: int | None = None


class _Part(InputPartition):
    def __init__(self, span: Span):
        super().__init__(span.part)
        self.span = span


class LineSource(DataSource):
    """``spark.read.format("corpusmill_lines")`` with options ``spans`` (JSON) and ``tolerant``."""

    @classmethod
    def name(cls) -> str:
        return "corpusmill_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LineReader(
            [Span(*s) for s in json.loads(self.options["spans"])], self.options.get("tolerant", "false") == "true"
        )


class LineReader(DataSourceReader):
    def __init__(self, spans: list[Span], tolerant: bool):
        self.spans, self.tolerant = spans, tolerant

    def partitions(self) -> Sequence[InputPartition]:
        return [_Part(s) for s in self.spans]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no spans at all
            return
        span, number = partition.span, 0

        def rows(lines: list, at: int, cause: str | None = None) -> pa.RecordBatch:
            n = len(lines)
            sizes = [len(line) + 1 for line in lines] if cause is None else [0]
            places = list(accumulate(sizes, initial=at))[:-1]
            columns = [
                pa.array([span.part] * n, pa.int64()), pa.array(range(number, number + n), pa.int64()),
                pa.array(places, pa.int64()), pa.array(lines, pa.binary()), pa.array([cause] * n, pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "line", "at", "value", "cause"])

        at = 0
        try:
            for lines in _lines(span):
                batch = rows(lines, at)
                number, at = number + len(lines), at + sum(map(len, lines)) + len(lines)
                yield batch
        except UNREADABLE as error:
            if not self.tolerant:
                raise
            yield rows([None], at, f"{type(error).__name__}: {error}")


def _lines(span: Span) -> Iterator[list[bytes]]:
    """The lines that begin in a span, some at a time."""
    system, path = file_system(span.path)
    with system.open_input_file(path) as raw:
        # read1 returns what is decompressed so far, so that damage further on costs only what lies behind it.
        more = gzip.GzipFile(fileobj=raw).read1 if span.path.endswith(COMPRESSED) else raw.read
        # Bytes of the span before the next line, and before the next block that is read.
        at, done, block = 0, 0, b""
        length = None if span.end is None else span.end - span.start
        if span.start > 0:
            # The line that the byte before the span belongs to began earlier.
            raw.seek(span.start - 1)
            done = -1
            while (newline := block.find(b"\n")) < 0:
                done += len(block)
                block = more(BLOCK_BYTES)
                if not block or done >= length:
                    return
            at = done + newline + 1
            block = block[newline + 1 :]
        most = None if span.most is None else at + span.most
        limit = min((n for n in (length, most) if n is not None), default=None)
        pieces: list[bytes] = []
        while limit is None or at < limit:
            *found, rest = block.split(b"\n")
            if found:
                found[0] = b"".join([*pieces, found[0]])
                pieces, kept = [], []
                for line in found:
                    if limit is not None and at >= limit:
                        break
                    kept.append(line)
                    at += len(line) + 1
                yield kept
            pieces.append(rest)
            block = more(BLOCK_BYTES)
            if not block:
                if (last := b"".join(pieces)) and (limit is None or at < limit):
                    yield [last]
                return


def spans_of(spark: SparkSession, *paths: str, span_bytes: int = SPAN_BYTES) -> list[Span]:
    """All files below the paths in the order of their names, cut into spans. The driver holds the list to plan reads.

    A file system that Python tasks cannot open is refused.
    """
    for path in paths:
        qualified(spark, path)
    listed = sorted((r["path"], r["length"]) for p in paths for r in files.inventory(spark, p).select("path", "length").collect())
    spans: list[Span] = []
    for path, length in listed:
        whole = path.endswith(COMPRESSED)
        for start in range(0, 1 if whole else length, span_bytes):
            spans.append(Span(len(spans), path, start, None if whole else min(start + span_bytes, length)))
    return spans


def read_spans(spark: SparkSession, spans: Sequence[Span], tolerant: bool = False) -> DataFrame:
    """(part, line, at, value, cause): the spans' lines and the bytes of their part before them; ``value`` is null where ``cause`` tells what was unreadable."""
    register(spark, LineSource)
    lines = spark.read.format(LineSource.name()).option("spans", json.dumps([astuple(s) for s in spans]))
    return lines.option("tolerant", str(tolerant).lower()).load()


def files_of(spark: SparkSession, spans: Sequence[Span]) -> DataFrame:
    """(part, path): the file of each span, the list the driver holds."""
    return spark.createDataFrame([(s.part, s.path) for s in spans], "part BIGINT, path STRING")


def _totals(lines: DataFrame) -> DataFrame:
    size = F.octet_length("value") + F.lit(1).cast("bigint")
    return lines.where("value IS NOT NULL").groupBy("part").agg(F.count("*").alias("lines"), F.sum(size).alias("bytes"))


def with_position(spark: SparkSession, spans: Sequence[Span], tolerant: bool = False) -> DataFrame:
    """(part, pos, value): every line with its 0-based place in the stream of all spans."""
    lines = read_spans(spark, spans, tolerant).where("value IS NOT NULL")
    # One row per span, of which the driver holds the list.
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = _totals(lines).select("part", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    placed = lines.join(materialized(totals, "line-totals"), "part")
    return placed.select("part", (F.col("before") + F.col("line")).alias("pos"), F.col("value").cast("string").alias("value"))


def head_bytes(spark: SparkSession, spans: Sequence[Span], n_bytes: int) -> DataFrame:
    """The stream's first ``n_bytes`` as ordered pieces (pos, piece), newlines included.

    Spans are totalled from the first on, as many at a time as their lengths promise to reach the head, none of them
    beyond it; then the head is read from those it lies in.
    """
    before: dict[int, tuple[int, int]] = {}
    held, lines, at = 0, 0, 0
    known = dict(_lengths(spark, spans))
    while at < len(spans) and held < n_bytes:
        stop, promised = at, 0
        while stop < len(spans) and (stop == at or promised < n_bytes - held):
            span = spans[stop]
            promised += (known[span.path] if span.end is None else span.end) - span.start
            stop += 1
        chosen = [Span(s.part, s.path, s.start, s.end, n_bytes - held) for s in spans[at:stop]]
        # One number pair per span chosen.
        totals = {r["part"]: r for r in _totals(read_spans(spark, chosen)).collect()}
        for span in spans[at:stop]:
            if held < n_bytes:
                before[span.part] = (lines, held)
            if found := totals.get(span.part):
                lines, held = lines + found["lines"], held + found["bytes"]
        at = stop
    inside = [s for s in spans[:at] if s.part in before]
    head = read_spans(spark, [Span(s.part, s.path, s.start, s.end, n_bytes - before[s.part][1]) for s in inside])
    if not inside:
        return head.select(F.col("line").alias("pos"), F.col("value").alias("piece")).where(F.lit(False))
    starts = spark.createDataFrame([(p, *b) for p, b in before.items()], "part BIGINT, l BIGINT, b BIGINT")
    line = F.concat("value", F.lit(b"\n"))
    left = F.lit(n_bytes) - F.col("b") - F.col("at")
    room = F.least(left, F.octet_length(line).cast("bigint")).cast("int")
    placed = head.join(F.broadcast(starts), "part").where(left > 0)
    return placed.select((F.col("l") + F.col("line")).alias("pos"), F.substring(line, F.lit(1), room).alias("piece"))


def _lengths(spark: SparkSession, spans: Sequence[Span]) -> list[tuple[str, int]]:
    """Lengths of the files of spans without an end."""
    paths = sorted({s.path for s in spans if s.end is None})
    if not paths:
        return []
    found = spark.read.format("binaryFile").load(paths).select("path", "length").collect()
    return [(r["path"], r["length"]) for r in found]
