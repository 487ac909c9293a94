"""Words of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def words_of(rows: DataFrame, text_col: str, words_col: str = "_words") -> DataFrame:
    """The rows with an array of the words of ``text_col``; the text must not be null.

    Only the first and the last piece of the split can be empty.
    """
    rows = rows.withColumn("_split", F.split(text_col, SPACES))
    first = F.when(F.element_at("_split", 1) == "", 2).otherwise(1)
    last = F.size("_split") - F.when(F.element_at("_split", -1) == "", 1).otherwise(0)
    return rows.withColumn(words_col, F.slice("_split", first, F.greatest(last - first + 1, F.lit(0)))).drop("_split")


def arrow_words(texts: pa.Array, between: str = SPACES) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and the number of words per text; a null text has none."""
    pieces = pc.split_pattern_regex(pc.fill_null(texts, ""), between)
    # Only the first and the last piece of a text can be empty.
    held = pc.not_equal(pieces.values, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(held)])
    return pieces.values.filter(pa.array(held)), np.diff(before[pieces.offsets.to_numpy()])


def parts(texts: pa.Array, most: int) -> list[slice]:
    """Consecutive texts of at most ``most`` bytes together; a longer text stands alone."""
    out, first, held = [], 0, 0
    for k, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if k > first and held + size > most:
            out.append(slice(first, k))
            first, held = k, 0
        held += size
    return [*out, slice(first, len(texts))] if len(texts) else []
