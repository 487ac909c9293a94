"""Length-prefixed binary records: eight little-endian length bytes, then the content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 8


def frame(content: Column) -> Column:
    """One framed record from a binary column."""
    digits = F.lpad(F.hex(F.octet_length(content).cast("bigint")), 2 * HEADER_BYTES, "0")
    low_byte_first = [F.substring(digits, at, 2) for at in range(2 * HEADER_BYTES - 1, 0, -2)]
    return F.concat(F.unhex(F.concat(*low_byte_first)), content)


def framed_size(content: Column) -> Column:
    return F.octet_length(content).cast("bigint") + HEADER_BYTES
