"""Incremental ingest: each input file once, resumable, with progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.session import PACKED

COLLECTED_SCHEMA = "file STRING, block BIGINT, seq BIGINT, value STRING"


def new_lines(
    spark: SparkSession, folder: str, glob: str = "*", files_per_batch: int | None = None, full_path: bool = False
) -> DataFrame:
    """Lines of files not seen before, with the file they come from.

    ``full_path`` tells files of one name in several folders apart; a stream's order needs that.
    """
    reader = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(
        F.col("_metadata.file_path" if full_path else "_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def collect_lines(lines: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything new, with each line's place, to the Parquet table ``target`` and stop.

    A batch owns the folder ``batch=<id>``, so replaying it after a crash replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("seq", F.monotonically_increasing_id())
        placed.write.mode("overwrite").options(**PACKED).parquet(f"{target}/batch={batch_id}")

    query = (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_new(lines: DataFrame, target: str, checkpoint: str, fmt: str = "json") -> StreamingQuery:
    """Append everything new to ``target`` and stop.

    The checkpoint records which files are done and the sink's log which output belongs to a committed
    batch, so running again adds nothing and a crash half-way leaves no duplicate.
    """
    query = (
        lines.select("file", "value").writeStream.format(fmt)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_counted(lines: DataFrame, target: str, progress: str, checkpoint: str, text: str = "value") -> None:
    """Append everything new to ``target`` and one row (batch, records, bytes) per batch to ``progress``, and stop.

    A batch that is run again after a crash overwrites its own folders, so nothing is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        counted = batch.observe(
            seen, F.count("*").alias("records"), F.sum(F.octet_length(text).cast("bigint")).alias("bytes")
        )
        counted.write.mode("overwrite").json(f"{target}/batch={number}")
        row = (number, seen.get["records"], seen.get["bytes"] or 0)
        one = batch.sparkSession.createDataFrame([row], "n BIGINT, records BIGINT, bytes BIGINT")
        one.write.mode("overwrite").parquet(f"{progress}/batch={number}")

    query = (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
