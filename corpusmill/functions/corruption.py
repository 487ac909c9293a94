"""Seeded byte corruption: one draw per hundred bytes, with replacement, flips the lowest bit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.hashing import seeded

# Corruption rate and bit.
BYTES_PER_DRAW = 100
HEX_DIGITS = "0123456789ABCDEF"
LOW_BIT_FLIPPED = "1032547698BADCFE"


def flip_positions(size: Column, key: Column, seed: Column) -> Column:
    """Sorted 0-based offsets hit an odd number of times (an even number of flips undoes itself)."""
    draws = F.call_function("div", size, F.lit(BYTES_PER_DRAW))
    return F.when(draws == 0, F.array().cast("array<bigint>")).otherwise(
        F.array_sort(F.transform(F.sequence(F.lit(1), draws), lambda k: F.pmod(seeded(seed, key, k), size)))
    )


def flip_low_bits(
    df: DataFrame, data: str, key: Column, seed: Column, out: str = "flipped", spared: Column | None = None
) -> DataFrame:
    """Add ``out`` (the corrupted bytes) and ``flips`` (how many bytes changed); ``spared`` rows stay as they are.

    ``data`` holds blocks of bounded size (see ``operators.redundancy.split_blocks``), so the sorted
    draws of one row stay few. The three steps are separate projections because a later one uses an
    earlier one many times.
    """
    size = F.octet_length(data).cast("bigint")
    positions = flip_positions(size, key, seed)
    if spared is not None:
        positions = F.when(spared, F.array().cast("array<bigint>")).otherwise(positions)
    drawn = df.withColumn("_drawn", positions)
    draws = F.col("_drawn")

    def ends_odd_run(position: Column, index: Column) -> Column:
        following = F.try_element_at(draws, (index + 2).cast("int"))
        run = index + 2 - F.array_position(draws, position)
        return (F.coalesce(following, F.lit(-1)) != position) & (run % 2 == 1)

    odd = drawn.withColumn("_at", F.filter(draws, ends_odd_run)).drop("_drawn")

    def upto(position: Column, index: Column) -> Column:
        start = F.when(index == 0, F.lit(0)).otherwise(F.try_element_at("_at", index.cast("int")) + 1)
        untouched = F.substring(F.col(data), (start + 1).cast("int"), (position - start).cast("int"))
        byte = F.hex(F.substring(F.col(data), (position + 1).cast("int"), F.lit(1)))
        low = F.translate(F.substring(byte, 2, 1), HEX_DIGITS, LOW_BIT_FLIPPED)
        return F.concat(F.hex(untouched), F.substring(byte, 1, 1), low)

    last = F.coalesce(F.try_element_at("_at", F.lit(-1)), F.lit(-1))
    tail = F.hex(F.substring(F.col(data), (last + 2).cast("int"), size.cast("int")))
    return (
        odd.withColumn(out, F.unhex(F.concat(F.array_join(F.transform("_at", upto), ""), tail)))
        .withColumn("flips", F.size("_at").cast("bigint"))
        .drop("_at")
    )
