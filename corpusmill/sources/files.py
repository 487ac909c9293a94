"""File inventories and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import names

# Model file types that are not kept, the manifest separator, shard file names.
EXCLUDED_EXTENSIONS = ("msgpack", "h5", "ot", "md")
MANIFEST_SEPARATOR = "|"
SHARD_GLOB = "wiki_*"


def inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below a folder with its length; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "length", "modificationTime")
    below = urlparse(root).path.rstrip("/") + "/"
    inside = F.substring_index(F.col("path"), below, -1)
    category = F.when(inside.contains("/"), F.substring_index(inside, "/", 1))
    return files.withColumn("inside", inside).withColumn("category", category)


def without_extensions(path: Column, extensions: Sequence[str] = EXCLUDED_EXTENSIONS) -> Column:
    return ~path.rlike(rf"\.({'|'.join(extensions)})$")


def parse_manifest(entry: Column) -> tuple[Column, Column, Column]:
    """(identifier, description, safe folder name) of ``identifier|description``."""
    parts = F.split(entry, r"\|", 2)
    identifier = parts[0]
    return identifier, F.coalesce(F.get(parts, F.lit(1)), F.lit("")), names.safe_name(identifier)
