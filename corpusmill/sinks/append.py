"""Appending and compressed text outputs, and statistics files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources import files


# Folder names of groups: a letter before the name keeps null, the empty name and a name that says null apart.
NAMED, NULL = "v", "n"
ROWS_PER_MEMBER = 1_000_000


def append_text(df: DataFrame, path: str, column: str = "value") -> None:
    """Append lines. Running twice appends twice: use ``streaming.ingest`` for once-only input."""
    df.select(column).write.mode("append").option("lineSep", "\n").text(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_gzip(df: DataFrame, text: str, group: str, path: str, rows_per_member: int = ROWS_PER_MEMBER) -> None:
    """Compressed text per group, once for the whole, and an index of the files.

    Rows are rebalanced by group: Spark puts small groups together into a task and splits large ones by their bytes, so a
    group's files follow its size, not the number of tasks its rows came from, and a group of a third of all rows is
    spread like the rest.
    """
    spark = df.sparkSession
    folder = F.when(F.col(group).isNull(), NULL).otherwise(F.concat(F.lit(NAMED), F.col(group).cast("string")))
    members = df.select(folder.alias("grp"), F.col(text).alias("value"))
    limits = {"compression": "gzip", "maxRecordsPerFile": str(rows_per_member)}
    members.hint("rebalance", "grp").write.partitionBy("grp").options(**limits).text(f"{path}/parts")
    members.select("value").hint("rebalance").write.options(**limits).text(f"{path}/whole")
    _members(spark, path).write.mode("overwrite").json(f"{path}/index")


def _members(spark: SparkSession, path: str) -> DataFrame:
    """(grp, is_total, member, gz_bytes): the files that ``write_gzip`` left."""
    parts = files.inventory(spark, f"{path}/parts", "*.gz")
    # Folder names escape some characters as %XX; a plus sign stands for itself.
    escaped = F.regexp_extract("path", r"/grp=([^/]+)/", 1)
    folder = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    name = F.when(F.startswith(folder, F.lit(NAMED)), F.substring(folder, 2, 2**31 - 1))
    whole = files.inventory(spark, f"{path}/whole", "*.gz")
    listed = lambda found, grp, total: found.select(
        grp.alias("grp"), F.lit(total).alias("is_total"), F.col("inside").alias("member"), F.col("length").alias("gz_bytes")
    )
    return listed(parts, name, False).unionByName(listed(whole, F.lit(None).cast("string"), True))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("grp STRING, is_total BOOLEAN, member STRING, gz_bytes BIGINT").json(f"{path}/index")


def gzip_sizes(df: DataFrame, path: str, overall: str = "ALL") -> DataFrame:
    """(grp, is_total, members, gz_bytes) of what ``write_gzip`` left; ``df`` only names the session."""
    sized = read_index(df.sparkSession, path).groupBy("grp", "is_total").agg(
        F.count("*").alias("members"), F.sum("gz_bytes").alias("gz_bytes")
    )
    return sized.withColumn("grp", F.when(F.col("is_total"), F.lit(overall)).otherwise(F.col("grp")))


def write_statistics(stats: DataFrame, path: str) -> None:
    """Statistics beside an archive, one JSON object per group."""
    stats.write.mode("overwrite").json(path)
