"""Joining counts back to their rows when one key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Heavy keys are those that hold more than 1/HOT_KEYS of all rows, hence fewer than HOT_KEYS of them.
HOT_KEYS = 10_000
LEAST_SHARE = 10_000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    spread_by: Sequence[str],
    how: str = "inner",
    hot_keys: int = HOT_KEYS,
    least_share: int = LEAST_SHARE,
) -> DataFrame:
    """Join ``rows`` with a table holding one row per key, of which ``weight`` is the key's row count.

    A share is 1/``hot_keys`` of all rows, or ``least_share`` rows if that is more. A key with more rows gets as many
    salts as it has shares, dealt by the ``spread_by`` columns, which should tell a key's rows apart: so no (key, salt)
    holds much more than a share, however the weights are distributed. There are fewer than ``hot_keys`` such keys and
    at most as many salts again, which bounds the list of heavy keys that is broadcast. Every row is joined exactly once.
    """
    salted_rows, salted_keys = _salted(rows, per_key, key, weight, spread_by, hot_keys, least_share)
    return salted_rows.join(salted_keys, [key, "_salt"], how).drop("_salt")


def _salted(
    rows: DataFrame, per_key: DataFrame, key: str, weight: str, spread_by: Sequence[str], hot_keys: int, least_share: int
) -> tuple[DataFrame, DataFrame]:
    total = per_key.agg(F.sum(weight).alias("total")).first()["total"] or 0
    share = max(-(-total // hot_keys), least_share)
    salts = F.ceil(F.col(weight) / F.lit(share)).cast("bigint")
    heavy = per_key.where(F.col(weight) > share).select(key, salts.alias("_salts"))
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_salts"))).otherwise(F.lit(0))
    salted_rows = rows.join(F.broadcast(heavy), key, "left").withColumn("_salt", salt.cast("bigint")).drop("_salts")
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.greatest(salts, F.lit(1).cast("bigint")) - 1)
    return salted_rows, per_key.withColumn("_salt", F.explode(every_salt))
