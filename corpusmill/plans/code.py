"""Record stream to byte-budgeted chunks of framed records, resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.frames import framed_size
from corpusmill.functions.text import encodable_bytes
from corpusmill.operators import ordering
from corpusmill.sinks import chunks

def budgeted(
    records: DataFrame, target_bytes: int | None, start: chunks.ResumePoint = chunks.ResumePoint(0, 0)
) -> DataFrame:
    """(pos, content) from the start position until the framed size reaches the target; all of them without one.

    Positions are not negative. Neither what was written before the start nor what lies beyond the target is read, if
    the records are stored in their order.
    """
    encoded = ordering.resume_from(records, "pos", start.pos).select(
        "pos", encodable_bytes(F.col("content")).alias("content")
    )
    if target_bytes is None:
        return encoded
    left = max(target_bytes - start.bytes, 0)
    return ordering.within_budget(encoded, "pos", framed_size(F.col("content")), left, start.pos).select("pos", "content")


def build(
    spark: SparkSession,
    records: DataFrame,
    out: str,
    target_bytes: int | None = None,
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> None:
    """Write (pos, content) records as chunks, going on after what earlier runs committed."""
    start = chunks.resume_point(spark, out, rows_per_chunk)
    chosen = budgeted(records, target_bytes, start)
    chunks.write_chunks(chosen, out, rows_per_chunk=rows_per_chunk, begun=start.begun)
