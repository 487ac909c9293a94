"""Raw, compressed and deduplicated sizes per group and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import redundancy
from corpusmill.sinks import append


def compare(df: DataFrame, group: str, text: str, out: str, block_bytes: int | None = redundancy.BLOCK_BYTES) -> DataFrame:
    """Write the compressed packs below ``out`` and set their sizes beside raw and deduplicated ones."""
    append.write_gzip(df, text, group, out)
    packed = append.gzip_sizes(df, out).withColumnsRenamed({"grp": "_grp", "is_total": "_total"})
    stats = redundancy.block_statistics(df, group, text, block_bytes)
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("is_total") == F.col("_total"))
    return stats.join(packed, same, "left").select(
        "grp",
        "is_total",
        "members",
        "files",
        "raw_bytes",
        "gz_bytes",
        "stored_bytes",
        F.round(F.col("gz_bytes") / F.col("raw_bytes"), 4).alias("gz_share"),
        F.round(F.col("stored_bytes") / F.col("raw_bytes"), 4).alias("stored_share"),
    )
