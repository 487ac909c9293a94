"""Record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Named columns of a Parquet table; the scan reads only those."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return table.select(*columns) if columns else table


def record_stream(spark: SparkSession, path: str, field: str = "content", position: str | None = None) -> DataFrame:
    """One text field of a record table, as ``content``, with its stored position if there is one."""
    table = spark.read.parquet(path)
    chosen = table[field].alias("content")
    return table.select(chosen) if position is None else table.select(table[position].alias("pos"), chosen)
