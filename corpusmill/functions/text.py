"""Byte-exact text expressions: lengths are UTF-8 bytes, never characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MIN_ARTICLE_BYTES = 100
MAX_ARTICLE_BYTES = 10_000
REPLACEMENT_CHARACTER = "�"


def long_enough(text: Column, minimum: int = MIN_ARTICLE_BYTES) -> Column:
    return F.octet_length(text) >= minimum


def truncate_bytes(text: Column, limit: int = MAX_ARTICLE_BYTES) -> Column:
    """The longest prefix of at most ``limit`` bytes that does not split a character.

    A cut is sound when the byte after it is not a continuation byte (0x80-0xBF); a character has at
    most four bytes, so one of four neighbouring cuts is.
    """
    raw = text.cast("binary")

    def sound(cut: int) -> Column:
        following = F.hex(F.substring(raw, cut + 1, 1))
        return (following < "80") | (following > "BF")

    cut = F.when(sound(limit), limit)
    for back in (1, 2):
        cut = cut.when(sound(limit - back), limit - back)
    kept = F.substring(raw, F.lit(1), cut.otherwise(limit - 3)).cast("string")
    return F.when(F.octet_length(text) <= limit, text).otherwise(kept)


def encodable_bytes(text: Column) -> Column:
    """UTF-8 bytes of a string; malformed sequences are dropped.

    ``make_valid_utf8`` marks malformed sequences with U+FFFD. U+FFFD characters the text rightfully
    holds are escaped meanwhile; ``replace`` works on bytes and leaves malformed ones alone.
    """

    def swapped(column: Column, *pairs: tuple[str, str]) -> Column:
        for old, new in pairs:
            column = F.replace(column, F.lit(old), F.lit(new))
        return column

    escaped = swapped(text, ("\x01", "\x01a"), (REPLACEMENT_CHARACTER, "\x01b"))
    dropped = swapped(F.make_valid_utf8(escaped), (REPLACEMENT_CHARACTER, ""))
    cleaned = swapped(dropped, ("\x01b", REPLACEMENT_CHARACTER), ("\x01a", "\x01"))
    return F.when(F.is_valid_utf8(text), text).otherwise(cleaned).cast("binary")


def article_json(article_id: Column, title: Column, text: Column) -> Column:
    return F.to_json(F.struct(article_id.alias("id"), title.alias("title"), text.alias("text")))
