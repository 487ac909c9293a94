"""Planted redundancy: exact copies, near copies and append-only logs.

Copies are rows that name their source; bytes are produced where they are written, so ten copies of a
corpus do not pass ten times through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.corruption import flip_low_bits

# Numbers of copies, variants, logs and lines; names; the seed variants count up from.
COPIES = 10
VARIANTS = 5
LOGS = 5
LOG_LINES = 10
VARIANT_SEED = 42
BASE_NAME = "base.txt"
COPY_NAME = "dup_%d.txt"
VARIANT_NAME = "variant_%d.txt"
LOG_NAME = "log_%d.txt"
LOG_LINE = "LOG ENTRY %d"


def numbered(df: DataFrame, n: int, name: str, start: int = 1) -> DataFrame:
    """Every row ``n`` times with a running number: a narrow explode, not a join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(start), F.lit(n))))


def exact_copies(df: DataFrame, n: int = COPIES) -> DataFrame:
    """Each row as itself (copy 0) and ``n`` copies, with the file name of each."""
    file = F.when(F.col("copy") == 0, BASE_NAME).otherwise(F.format_string(COPY_NAME, "copy"))
    return numbered(df, n, "copy", start=0).withColumn("file", file)


def near_copies(
    blocks: DataFrame, data: str, key: Column, n: int = VARIANTS, seed: int = VARIANT_SEED, with_base: bool = False
) -> DataFrame:
    """``n`` corrupted variants of every block; variant ``i`` draws from ``seed + i``.

    ``key`` must tell blocks apart, so that a large file may be spread over many rows. ``with_base`` adds the block
    itself as variant 0.
    """
    varied = numbered(blocks, n, "variant", start=0 if with_base else 1)
    spared = F.col("variant") == 0 if with_base else None
    return flip_low_bits(varied, data, key, F.col("variant") + seed, spared=spared)


def append_logs(
    lines: DataFrame, order: str, text: str, logs: int = LOGS, entries: int = LOG_LINES
) -> DataFrame:
    """``logs`` copies of the base, each followed by ``entries`` log lines.

    (log, part, seq) orders the result: part 0 is the base, part 1 what was appended.
    """
    base = numbered(lines.select(F.col(order).cast("bigint").alias("seq"), F.col(text).alias("line")), logs, "log")
    spark = lines.sparkSession
    tail = numbered(numbered(spark.range(1).drop("id"), logs, "log"), entries, "entry")
    tail = tail.select(
        F.col("entry").cast("bigint").alias("seq"), F.format_string(LOG_LINE, "entry").alias("line"), "log"
    )
    both = base.withColumn("part", F.lit(0)).unionByName(tail.withColumn("part", F.lit(1)))
    return both.select("log", F.format_string(LOG_NAME, "log").alias("file"), "part", "seq", "line")
