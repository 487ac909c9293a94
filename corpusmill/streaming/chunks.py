"""A record stream written as framed chunks, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions.text import encodable_bytes
from corpusmill.operators import ordering
from corpusmill.sinks import chunks


def add_batch(batch: DataFrame, batch_id: int, key: str, text: str, path: str, rows_per_chunk: int) -> None:
    """Write one micro-batch into its own folder of chunks, in key order.

    A replayed batch replaces its chunk files by the same bytes, so no offset has to be kept beside the
    query's checkpoint.
    """
    content = encodable_bytes(F.col(text)).alias("content")
    numbered = ordering.with_position(batch.select(key, content), key)
    chunks.write_chunks(numbered, f"{path}/batch_{batch_id:05d}", rows_per_chunk=rows_per_chunk)


def write_stream(
    stream: DataFrame,
    key: str,
    text: str,
    path: str,
    checkpoint: str,
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: add_batch(batch, batch_id, key, text, path, rows_per_chunk)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
