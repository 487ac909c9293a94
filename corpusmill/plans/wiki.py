"""XML dump to cleaned, truncated, sharded JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import spread
from corpusmill.sinks import jsonl, rejects
from corpusmill.sources import mediawiki


def extract(spark: SparkSession, dump: str) -> DataFrame:
    """(id, title, text) of the dump's articles: one narrow stage from the records to the text."""
    return mediawiki.clean_articles(
        mediawiki.articles(mediawiki.read_pages(spark, dump)).withColumnRenamed("text", "markup"), "markup"
    )


def extract_with_rejects(spark: SparkSession, dump: str) -> rejects.Parted:
    """The articles, and the malformed pages with their file, raw text and cause, from one pass over the dump."""
    rows = mediawiki.clean_or_reject(mediawiki.read_pages(spark, dump))
    return rejects.part(rows.withColumn("_key", jsonl.numeric_key("id")), "articles")


def build(
    spark: SparkSession, dump: str, out: str, mode: str = "overwrite", rejected: str | None = None
) -> rejects.Parted:
    """Shards are numbered by page id, so a repeated run writes the same records to the same shards.

    The articles are written down once before they are numbered: parsing and cleaning cost far more than
    reading them back. Malformed pages are counted in the result and, given a folder, written there as JSON lines.
    """
    parted = extract_with_rejects(spark, dump)
    jsonl.write_shards(parted.kept, out, "_key", ("id",), mode=mode)
    if rejected and parted.n_rejected:
        parted.rejected.select("file", "cause", "raw").write.mode("overwrite").json(rejected)
    return parted


def clean_table(table: DataFrame, markup: str) -> DataFrame:
    """Markup held in a table instead of a dump."""
    return mediawiki.clean_articles(spread(table), markup).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
