"""Seeded pseudo-random numbers that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed_number(text: Column, digits: int = 15) -> Column:
    """A non-negative number from the first hex digits of a text's MD5; 15 digits fit a bigint."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def seeded(seed: int | Column, *parts: Column, digits: int = 15) -> Column:
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return hashed_number(F.concat_ws(":", seed.cast("string"), *[p.cast("string") for p in parts]), digits)
