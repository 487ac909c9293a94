"""Sizes and file counts per category, size gates and presence checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import names

# Corpus categories and the sizes from which existing inputs are reused.
CATEGORIES = ("web", "wiki", "code", "synthetic", "models")
WEB_GATE_GIB = 300
WIKI_GATE_GIB = 20


def size_rollup(df: DataFrame, category: str, size: str, overall: str = "ALL") -> DataFrame:
    """Bytes and file count per category and, in the row marked ``is_total``, of everything.

    The mark tells the total from a category of its name, and from the category of null.
    """
    total = F.grouping(category) == 1
    label = F.when(total, F.lit(overall)).otherwise(F.col(category))
    return (
        df.rollup(category)
        .agg(
            F.sum(size).alias("total_bytes"),
            F.count("*").alias("files"),
            label.alias("_label"),
            total.alias("_total"),
        )
        .select(F.col("_label").alias("category"), F.col("_total").alias("is_total"), "total_bytes", "files")
    )


def with_all_categories(rollup: DataFrame, categories: tuple[str, ...] = CATEGORIES, overall: str = "ALL") -> DataFrame:
    """The fixed categories and the total; an empty one shows zero."""
    rows = [*((c, False) for c in categories), (overall, True)]
    wanted = rollup.sparkSession.createDataFrame(rows, "category string, is_total boolean")
    return wanted.join(rollup, ["category", "is_total"], "left").na.fill(0, ["total_bytes", "files"])


def at_least_gib(df: DataFrame, size: Column, gib: int) -> DataFrame:
    """One row: total bytes, whole GiB and whether the input is large enough to be reused."""
    total = F.coalesce(F.sum(size), F.lit(0)).cast("bigint")
    return df.agg(total.alias("total_bytes")).select(
        "total_bytes",
        names.whole_gib(F.col("total_bytes")).alias("whole_gib"),
        (names.whole_gib(F.col("total_bytes")) >= gib).alias("reuse"),
    )


def present(df: DataFrame, size: Column) -> DataFrame:
    """One row: whether there are records at all, and whether any has content."""
    return df.agg(
        (F.count("*") > 0).alias("exists"),
        F.coalesce(F.max(size) > 0, F.lit(False)).alias("non_empty"),
    )
