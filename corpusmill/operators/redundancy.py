"""Exact copies, block-level deduplication statistics and block overlap.

Every measure is an aggregate over fingerprints with map-side pre-aggregation: a block or document that
makes up a third of the data arrives at the shuffle as one row per input task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4096
VARIANT_BITS = 62


def fixed_blocks(data: Column, block_bytes: int = BLOCK_BYTES) -> Column:
    """Consecutive byte blocks of equal size, the last possibly shorter.

    Read as Latin-1 every byte is one character, so one regular expression cuts the record in a single
    pass; a substring per block would copy the whole record for each of them.
    """
    characters = F.decode(data.cast("binary"), "ISO-8859-1")
    cut = F.regexp_extract_all(characters, F.lit(f"(?s).{{1,{block_bytes}}}"), 0)
    return F.transform(cut, lambda block: F.encode(block, "ISO-8859-1"))


def line_blocks(text: Column) -> Column:
    """One block per line, newline included: an insertion shifts no later block."""
    lines = F.split(text, "\n", -1)
    last = F.size(lines) - 1
    ended = F.transform(lines, lambda line, at: F.when(at < last, F.concat(line, F.lit("\n"))).otherwise(line))
    return F.filter(ended, lambda line: line != "").cast("array<binary>")


def split_blocks(df: DataFrame, data: str, keep: list[str], block_bytes: int | None = BLOCK_BYTES) -> DataFrame:
    """One row per block: the kept columns, ``block_no`` (block number) and ``block`` (bytes).

    ``block_bytes=None`` splits at line ends. A record without bytes keeps one row with null ``block_no``.
    The blocks are cut before the explode, so no output row carries the whole record.
    """
    blocks = line_blocks(F.col(data)) if block_bytes is None else fixed_blocks(F.col(data), block_bytes)
    cut = df.select(*keep, blocks.alias("_blocks"))
    return cut.select(*keep, F.posexplode_outer("_blocks").alias("block_no", "block"))


def fingerprint(data: Column) -> Column:
    """SHA-256 as 32 bytes: half the shuffle volume of its hex digits."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Groups of byte-identical records with their copies, first key, bytes and surplus bytes; null is no record."""
    size = F.octet_length(text).cast("bigint")
    return (
        df.where(F.col(text).isNotNull())
        .select(key, fingerprint(F.col(text)).alias("digest"), size.alias("_size"))
        .groupBy("digest")
        .agg(
            F.count("*").alias("copies"),
            F.min(key).alias("first_id"),
            F.sum("_size").alias("total_bytes"),
            F.max("_size").alias("_size"),
        )
        .where("copies > 1")
        .withColumns(
            {"digest": F.lower(F.hex("digest")), "surplus_bytes": F.col("total_bytes") - F.col("_size")}
        )
        .drop("_size")
    )


def _blocks_per_group(df: DataFrame, group: str, data: str, block_bytes: int | None) -> DataFrame:
    """(group, fp): occurrences, block size and how many records start here."""
    blocks = split_blocks(df, data, [group], block_bytes)
    starts = F.when(F.coalesce(F.col("block_no"), F.lit(0)) == 0, 1).otherwise(0)
    return (
        blocks.select(
            F.col(group).alias("grp"),
            fingerprint(F.col("block")).alias("fp"),
            F.coalesce(F.octet_length("block"), F.lit(0)).cast("bigint").alias("size"),
            starts.alias("starts"),
        )
        .groupBy("grp", "fp")
        .agg(
            F.count("fp").alias("uses"),
            F.max("size").alias("size"),
            F.sum("starts").alias("starts"),
        )
    )


def _statistics() -> list[Column]:
    return [
        F.sum("starts").alias("files"),
        F.sum(F.col("uses") * F.col("size")).alias("raw_bytes"),
        F.sum("uses").alias("total_blocks"),
        F.count("fp").alias("unique_blocks"),
        F.sum("size").alias("stored_bytes"),
    ]


def block_statistics(
    df: DataFrame, group: str, data: str, block_bytes: int | None = BLOCK_BYTES, overall: str = "ALL"
) -> DataFrame:
    """Deduplication per group and, in the row marked ``is_total``, over everything.

    Blocks shared by groups are stored once overall.
    """
    per_group = _blocks_per_group(df, group, data, block_bytes)
    everywhere = per_group.groupBy("fp").agg(
        F.sum("uses").alias("uses"), F.max("size").alias("size"), F.sum("starts").alias("starts")
    )
    parts = per_group.groupBy("grp", F.lit(False).alias("is_total")).agg(*_statistics())
    whole = everywhere.agg(*_statistics()).select(F.lit(overall).alias("grp"), F.lit(True).alias("is_total"), "*")
    ratio = F.round(F.col("raw_bytes") / F.nullif(F.col("stored_bytes"), F.lit(0)), 4)
    return parts.unionByName(whole).withColumn("dedup_ratio", ratio)


def variant_overlap(base: DataFrame, variants: DataFrame, key: str, variant: str, n: int) -> DataFrame:
    """Jaccard overlap of each variant's distinct blocks with those of the record it was made from.

    Both inputs hold (key, fp), ``variants`` also the variant's number from 1 to ``n``.
    """
    rows = base.select(key, F.lit(0).cast("bigint").alias(variant), "fp").unionByName(
        variants.select(key, F.col(variant).cast("bigint").alias(variant), "fp")
    )
    return overlap_with_base(rows, key, variant, n)


def overlap_with_base(rows: DataFrame, key: str, variant: str, n: int) -> DataFrame:
    """The same over rows (key, variant, fp) in which variant 0 is the record itself.

    Pairs come from the planting itself, so no pair of records is ever formed: one aggregate notes for every block
    which variants hold it, as bits, and whether the base does, as bit 0. A number has room for 62 variants; further ones
    are counted in further rounds. Rows that lie together by key, as a record's blocks do when the records were dealt
    by key before they were cut, need not move.
    """
    rounds = [
        _overlap_round(rows, key, variant, first, min(first + VARIANT_BITS, n + 1))
        for first in range(1, n + 1, VARIANT_BITS)
    ]
    either = F.col("base_blocks") + F.col("variant_blocks") - F.col("shared_blocks")
    return reduce(DataFrame.unionByName, rounds).withColumn("jaccard", F.round(F.col("shared_blocks") / either, 6))


def _overlap_round(rows: DataFrame, key: str, variant: str, first: int, end: int) -> DataFrame:
    number = F.col(variant)
    inside = rows.where((number == 0) | number.between(first, end - 1))
    bit = F.expr(f"shiftleft(1L, CAST(CASE WHEN {variant} = 0 THEN 0 ELSE {variant} - {first - 1} END AS INT))")
    held = inside.groupBy(key, "fp").agg(F.bit_or(bit).alias("_bits"))

    def holds(place: int) -> Column:
        return F.getbit("_bits", F.lit(place)).cast("bigint")

    per_variant = [
        F.struct(
            F.lit(place).cast("bigint").alias(variant),
            F.sum(holds(place - first + 1)).alias("variant_blocks"),
            F.sum(holds(0) * holds(place - first + 1)).alias("shared_blocks"),
        )
        for place in range(first, end)
    ]
    counts = held.groupBy(key).agg(F.sum(holds(0)).alias("base_blocks"), F.array(*per_variant).alias("_variants"))
    return counts.select(key, "base_blocks", F.inline("_variants"))
