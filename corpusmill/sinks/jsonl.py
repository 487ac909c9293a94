"""Sharded JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import ordering


def place_in_shards(df: DataFrame, key: str, tie: tuple[str, ...] = (), **layout: int) -> DataFrame:
    """Add pos, shard, dir and file, by rank in key order."""
    return ordering.with_position(df, key, tie).withColumns(ordering.shard_columns("pos", **layout))


def numeric_key(text_id: str) -> Column:
    """Identifiers order as numbers; one that is not a number gets a hashed 52-bit place instead."""
    hashed = F.conv(F.substring(F.md5(text_id), 1, 13), 16, 10).cast("bigint")
    return F.coalesce(F.expr(f"try_cast({text_id} AS BIGINT)"), hashed)


def write_shards(
    df: DataFrame,
    path: str,
    key: str,
    tie: tuple[str, ...] = (),
    fields: tuple[str, ...] = ("id", "title", "text"),
    mode: str = "errorifexists",
    **layout: int,
) -> None:
    """Write ``<path>/dir=AA/file=wiki_00/*.json``, each holding up to 100 records in order.

    A text moves once, with its group of consecutive shards, of which each has a fixed number of rows; so the last folder,
    where all further shards wrap into the same file names, still spreads over tasks and gets several parts.
    """
    rows_per_file = layout.get("rows_per_file", ordering.ROWS_PER_SHARD)
    placed = ordering.in_groups(df, key, tie, rows_per_file).withColumns(ordering.shard_columns("pos", **layout))
    (
        placed.sortWithinPartitions("dir", "file", "shard", "pos")
        .select("dir", "file", *fields)
        .write.mode(mode)
        .partitionBy("dir", "file")
        .option("maxRecordsPerFile", rows_per_file)
        .json(path)
    )


def read_shards(spark: SparkSession, path: str, fields: str = "id STRING, title STRING, text STRING") -> DataFrame:
    return spark.read.schema(f"{fields}, dir STRING, file STRING").json(path)
