"""Line-oriented text, plain or gzip, as one ordered stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import names
from corpusmill.operators import ordering
from corpusmill.session import materialized

PATHS_SAMPLED = 100  # fixed value


def read_lines(spark: SparkSession, *paths: str, tolerant: bool = False) -> DataFrame:
    """Lines with their place: file, split offset, and a number growing along each split.

    Splits hold consecutive lines and a split is read by one task, so within one scan (file, block, seq) is
    the order of the concatenated files. Another scan may split the files elsewhere: what relates the two
    must be written down from a single one, see ``stored``. Only ``\\n`` ends a line. gzip members are not splittable: one task each.
    ``tolerant`` skips unreadable or vanished files.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .option("ignoreMissingFiles", str(tolerant).lower())
        .text(list(paths))
    )
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def stored(lines: DataFrame) -> DataFrame:
    """The lines with their places as one scan saw them, written once to the shared folder."""
    return materialized(lines.select("file", "block", "seq", "value"), "lines")


def split_offsets(placed: DataFrame) -> DataFrame:
    """One row per split: lines and bytes before it in the stream, and its own. Written down once.

    ``placed`` is a written table of lines with their places, so that every reader of it sees the same splits.
    """
    splits = placed.groupBy("file", "block").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.octet_length("value") + F.lit(1).cast("bigint")).alias("n_bytes"),
        F.min("seq").alias("first_seq"),
    )
    files = splits.groupBy("file").agg(F.sum("n_lines").alias("l"), F.sum("n_bytes").alias("b"))
    # One row per file: the list of files, which the driver holds for planning anyway.
    earlier_files = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select(
        "file",
        F.coalesce(F.sum("l").over(earlier_files), F.lit(0)).alias("fl"),
        F.coalesce(F.sum("b").over(earlier_files), F.lit(0)).alias("fb"),
    )
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.join(starts, "file").select(
        "file",
        "block",
        "first_seq",
        "n_lines",
        "n_bytes",
        (F.col("fl") + F.coalesce(F.sum("n_lines").over(earlier), F.lit(0))).alias("lines_before"),
        (F.col("fb") + F.coalesce(F.sum("n_bytes").over(earlier), F.lit(0))).alias("bytes_before"),
    )
    return materialized(offsets, "split-offsets")


def _positions(placed: DataFrame, offsets: DataFrame) -> DataFrame:
    pos = F.col("lines_before") + F.col("seq") - F.col("first_seq")
    return placed.join(offsets, ["file", "block"]).select("file", "value", pos.alias("pos"))


def with_line_position(lines: DataFrame, written: bool = False) -> DataFrame:
    """Add ``pos``, the line's 0-based place in the stream; only split totals are aggregated.

    The input is scanned once and written with its places; offsets and lines both come from that table, so
    it does not matter if the files would be split differently, or more of them arrive, afterwards.
    ``written``: the lines are such a table already, as ``ingest.collect_lines`` leaves it.
    """
    placed = lines if written else stored(lines)
    return _positions(placed, split_offsets(placed))


def head_bytes(lines: DataFrame, n_bytes: int, written: bool = False) -> DataFrame:
    """The stream's first ``n_bytes`` as ordered pieces (pos, piece), newlines included.

    Splits that begin beyond the head are left out before any line is placed.
    """
    placed = lines if written else stored(lines)
    offsets = split_offsets(placed).where(F.col("bytes_before") < n_bytes)
    return ordering.byte_prefix(_positions(placed, offsets), "pos", "value", n_bytes).select("pos", "piece")


def path_list(lines: DataFrame, prefix: str, n: int = PATHS_SAMPLED) -> DataFrame:
    """The first ``n`` listed paths with their full address and file name.

    ``lines`` holds (pos, value), as from ``with_line_position``.
    """
    return (
        ordering.first_rows(lines, ["pos"], n)
        .select(
            "pos",
            F.col("value").alias("path"),
            names.with_prefix(prefix, F.col("value")).alias("url"),
            names.basename(F.col("value")).alias("name"),
        )
    )


def rejects(requested: DataFrame, available: DataFrame, name: str = "name") -> DataFrame:
    """Requested inputs that are not there: reported, while the rest goes on."""
    return requested.join(available.select(name).distinct(), name, "left_anti")


def not_done(inputs: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Inputs without an entry in the ledger. Spark broadcasts the ledger only while it is small."""
    return inputs.join(ledger.select(key), key, "left_anti")
