"""A deduplicated block store as two Parquet tables.

``blocks(fp, block, uses)`` holds each distinct block once, ``recipe(key, block_no, fp)`` the order in which a
record uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.redundancy import BLOCK_BYTES, fingerprint, split_blocks
from corpusmill.operators.skew import join_per_key
from corpusmill.session import materialized


def _cut(df: DataFrame, keep: list[str], data: str, block_bytes: int | None) -> DataFrame:
    """Blocks with their fingerprints, written down: cutting and hashing costs more than reading them back."""
    blocks = split_blocks(df, data, keep, block_bytes)
    return materialized(
        blocks.withColumn("fp", F.when(F.col("block_no").isNotNull(), fingerprint(F.col("block")))), "cut-blocks"
    )


def _distinct(marked: DataFrame, *by: str) -> DataFrame:
    """Equal blocks meet before the shuffle, so a block used everywhere crosses it once per task."""
    return marked.where("fp IS NOT NULL").groupBy(*by, "fp").agg(F.first("block").alias("block"), F.count("*").alias("uses"))


def write_store(df: DataFrame, key: str, data: str, path: str, block_bytes: int | None = BLOCK_BYTES) -> None:
    marked = _cut(df, [key], data, block_bytes)
    _distinct(marked).write.parquet(f"{path}/blocks")
    marked.select(key, "block_no", "fp").write.parquet(f"{path}/recipe")


def write_group_stores(df: DataFrame, group: str, key: str, data: str, path: str, block_bytes: int | None = BLOCK_BYTES) -> None:
    """One store per group below ``parts/<group>=...`` and one for everything below ``whole``.

    A block shared by groups is stored in each of their stores, but once in the whole, which is made of the groups'.
    """
    marked = _cut(df, [group, key], data, block_bytes)
    # Rebalanced, so that a group's files follow its size.
    parts = _distinct(marked, group).hint("rebalance", group)
    parts.write.partitionBy(group).parquet(f"{path}/parts/blocks")
    recipe = marked.where("fp IS NOT NULL").select(group, key, "block_no", "fp")
    recipe.hint("rebalance", group).write.partitionBy(group).parquet(f"{path}/parts/recipe")
    stored = df.sparkSession.read.schema("fp BINARY, block BINARY, uses BIGINT").parquet(f"{path}/parts/blocks")
    every = stored.groupBy("fp").agg(F.first("block").alias("block"), F.sum("uses").alias("uses"))
    every.write.parquet(f"{path}/whole/blocks")
    marked.select(key, "block_no", "fp").write.parquet(f"{path}/whole/recipe")


def group_store_sizes(spark: SparkSession, path: str, group: str, overall: str = "ALL") -> DataFrame:
    """(grp, is_total, unique_blocks, stored_bytes) of the stores of ``write_group_stores``."""
    size = F.octet_length("block").cast("bigint")
    held = [F.count("*").alias("unique_blocks"), F.sum(size).alias("stored_bytes")]
    parts = spark.read.parquet(f"{path}/parts/blocks").groupBy(F.col(group).alias("grp"), F.lit(False).alias("is_total")).agg(*held)
    whole = read_store(spark, f"{path}/whole")[0].agg(*held)
    named = whole.select(F.lit(overall).alias("grp"), F.lit(True).alias("is_total"), "unique_blocks", "stored_bytes")
    return parts.unionByName(named)


def read_store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/recipe")


def restored_blocks(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, block_no, block): every record's blocks, to be written in order. Hot blocks are salted."""
    blocks, recipe = read_store(spark, path)
    used = recipe.where("fp IS NOT NULL")
    placed = join_per_key(used, blocks, "fp", "uses", (key, "block_no")).select(key, "block_no", "block")
    empty = recipe.where("fp IS NULL").select(key, F.lit(0).alias("block_no"), F.lit(b"").alias("block"))
    return placed.unionByName(empty)


def restored_records(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, content): records put together again. A record was one row before, so it fits one row."""
    in_order = F.expr("listagg(block, X'') WITHIN GROUP (ORDER BY block_no)")
    return restored_blocks(spark, path, key).groupBy(key).agg(in_order.alias("content"))
