"""Encyclopedia XML dumps, plain or bz2, read in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import MAX_ARTICLE_BYTES, MIN_ARTICLE_BYTES, long_enough, truncate_bytes
from corpusmill.functions.wikitext import strip_markup

# The elements read, and the namespace of articles.
PAGE_SCHEMA = (
    "id STRING, title STRING, ns STRING, redirect STRUCT<_title: STRING>, "
    "revision ARRAY<STRUCT<id: STRING, text: STRUCT<_VALUE: STRING, _bytes: STRING>>>, "
    "_corrupt_record STRING"
)
PAGE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}
PAGE_OPEN, PAGE_CLOSE = "<page", "</page>"
ARTICLE_NAMESPACE = "0"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: id, title, ns, redirect, text, its file, and the raw record if it is malformed.

    The closing tag is the record separator, so plain and bz2 files split at any byte. ``explode`` of
    the one parsed value keeps later filters from being evaluated on a second parse.
    """
    records = spark.read.option("lineSep", PAGE_CLOSE).text(path).where(F.col("value").contains(PAGE_OPEN))
    page = F.concat(
        F.expr(f"substring(value, locate('{PAGE_OPEN}', value))"), F.lit(PAGE_CLOSE)
    )
    parsed = records.select(
        F.col("_metadata.file_path").alias("file"),
        F.explode(F.array(F.from_xml(page, PAGE_SCHEMA, PAGE_OPTIONS))).alias("page"),
    ).select("file", "page.*")
    return parsed.select(
        "id", "title", "ns", "redirect", last_text(F.col("revision")).alias("text"), "file", "_corrupt_record"
    )


def last_text(revisions: Column) -> Column:
    """The text of the last revision that has one."""
    texts = F.filter(F.transform(revisions, lambda r: r["text"]["_VALUE"]), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.try_element_at(texts, F.lit(-1))


def is_article(redirect: Column, ns: Column, text: Column) -> Column:
    """Neither a redirect nor outside the article namespace nor empty."""
    return redirect.isNull() & (ns == ARTICLE_NAMESPACE) & (F.coalesce(text, F.lit("")) != "")


def articles(pages: DataFrame) -> DataFrame:
    kept = pages.where(is_article(F.col("redirect"), F.col("ns"), F.col("text")))
    return kept.select("id", "title", "text")


def malformed(pages: DataFrame) -> DataFrame:
    return pages.where("_corrupt_record IS NOT NULL").select("_corrupt_record")


def clean_or_reject(pages: DataFrame, minimum: int = MIN_ARTICLE_BYTES, limit: int = MAX_ARTICLE_BYTES) -> DataFrame:
    """(id, title, text, file, raw, cause): cleaned articles as in ``clean_articles``, and malformed pages with their cause."""
    malformed_page = F.col("_corrupt_record").isNotNull()
    wanted = pages.where(malformed_page | is_article(F.col("redirect"), F.col("ns"), F.col("text")))
    cleaned = F.when(~malformed_page, strip_markup(F.col("text")))
    rows = wanted.select(
        F.when(~malformed_page, F.col("id")).alias("id"), F.when(~malformed_page, F.col("title")).alias("title"),
        "file", F.col("_corrupt_record").alias("raw"), F.explode(F.array(cleaned)).alias("text"),
    )
    kept = rows.where(F.col("raw").isNotNull() | long_enough(F.col("text"), minimum))
    cause = F.when(F.col("raw").isNotNull(), "malformed page")
    return kept.select("id", "title", truncate_bytes(F.col("text"), limit).alias("text"), "file", "raw", cause.alias("cause"))


def clean_articles(
    df: DataFrame,
    markup: str,
    minimum: int = MIN_ARTICLE_BYTES,
    limit: int = MAX_ARTICLE_BYTES,
) -> DataFrame:
    """Replace the markup column by ``text``: cleaned, at least ``minimum`` bytes, cut at ``limit``.

    The cleaned text is used three times; exploding it keeps the optimizer from running the rules again
    inside the pushed-down length filter.
    """
    others = [c for c in df.columns if c != markup]
    cleaned = df.select(*others, F.explode(F.array(strip_markup(F.col(markup)))).alias("text"))
    return cleaned.where(long_enough(F.col("text"), minimum)).select(
        *others, truncate_bytes(F.col("text"), limit).alias("text")
    )
