"""A block store that grows with a stream, storing only blocks it has not seen.

The fingerprints seen are keyed state of the query, held in RocksDB beside its checkpoint: a batch looks up the
fingerprints it brings and never reads the stored blocks. Blocks and recipe are appended by file sinks whose logs name
what each committed batch wrote, so a batch that is run again after a crash changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.redundancy import BLOCK_BYTES, fingerprint, split_blocks
from corpusmill.session import ship_package

BLOCKS_SCHEMA = "fp BINARY, block BINARY"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once per Arrow batch: what a hot block sends to its task shrinks to a row a batch."""
    for batch in batches:
        codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        yield batch.take(pa.array(np.unique(codes, return_index=True)[1]))


def unseen_blocks(stream: DataFrame, data: str, block_bytes: int | None = BLOCK_BYTES) -> DataFrame:
    """(fp, block) of every block of the stream, the first time it occurs."""
    cut = split_blocks(stream, data, [], block_bytes).where("block_no IS NOT NULL")
    marked = cut.select(fingerprint(F.col("block")).alias("fp"), "block")
    ship_package()
    return marked.mapInArrow(_first_of_batch, BLOCKS_SCHEMA).dropDuplicates(["fp"])


def recipe(stream: DataFrame, key: str, data: str, block_bytes: int | None = BLOCK_BYTES) -> DataFrame:
    """(key, block_no, fp): which blocks a record is made of."""
    cut = split_blocks(stream, data, [key], block_bytes).where("block_no IS NOT NULL")
    return cut.select(key, "block_no", fingerprint(F.col("block")).alias("fp"))


def _append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def grow_store(
    stream: DataFrame, key: str, data: str, path: str, checkpoint: str, block_bytes: int | None = BLOCK_BYTES
) -> None:
    """Feed everything available from a stream into the store, blocks and recipe side by side, then stop."""
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        blocks = _append(unseen_blocks(stream, data, block_bytes), f"{path}/blocks", f"{checkpoint}/blocks")
    finally:
        conf.set(STATE_STORE, before)
    used = _append(recipe(stream, key, data, block_bytes), f"{path}/recipe", f"{checkpoint}/recipe")
    try:
        blocks.awaitTermination()
    finally:
        used.awaitTermination()


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")


def read_recipe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/recipe")
