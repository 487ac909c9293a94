"""Operators that depend on record order, without a window over the whole table.

A running total over everything would put all rows into one task. Here the order key, a number, is cut
into buckets of 2**16 keys. One aggregation, combined before its shuffle, gives the totals per bucket;
the small table of bucket totals is written down and summed up (itself cut the same way), and only the
rows of one bucket are ever ordered together. A window therefore sees at most 2**16 rows, or 2**20 bucket
totals, however large or skewed the table is. Often no row has to move at all: see ``with_position`` and
``within_budget``.

Contract: the key is not null and unique, or ``tie`` columns make it so, and lies within 52 bits (record positions
do). A null or repeated key ends the job with an error instead of losing a row or giving one place twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import names
from corpusmill.session import materialized

# Rows per output file, files per folder, folders, records per chunk, batch size.
ROWS_PER_SHARD = 100
SHARDS_PER_FOLDER = 100
FOLDERS = 26
ROWS_PER_CHUNK = 10_000
ROWS_PER_BATCH = 8
FRAME_OVERHEAD = 8
MILESTONE_ROWS = 100

DENSE_KEY = (16, 36)  # record positions: neighbours share a bucket
PROBE_KEYS, PROBE_GROWTH = 1 << 16, 8  # keys of the first range that is totalled for a budget; growth of the next
HASH_KEY = (28, 40)  # 52-bit hashes: 2**24 buckets, filled evenly
GROUP_ROWS, MOST_GROUPS = 10_000, 1 << 12  # rows of a group that is written by one task, and how many groups there may be


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def _number(key: str) -> Column:
    """The order key as a number; a null one is an error, as its row would have no place."""
    return F.coalesce(F.col(key).cast("bigint"), F.raise_error(F.lit(f"null order key: {key}")).cast("bigint"))


def _bucket_totals(df: DataFrame, key: str, costs: dict[str, Column], fine: int) -> DataFrame:
    """Per bucket: the sum of each cost, the number of rows, the first and last key and a fingerprint of the keys."""
    number = F.col("_k")
    return materialized(
        df.withColumn("_k", _number(key)).groupBy(F.shiftright(number, fine).alias("_b")).agg(
            *[F.sum(c.cast("bigint")).alias(f"_s_{n}") for n, c in costs.items()],
            F.count("*").alias("_n"),
            F.min(number).alias("_first"),
            F.max(number).alias("_last"),
            F.bit_xor(F.xxhash64(number)).alias("_print"),
        ),
        "bucket-totals",
    )


def _bucket_offsets(per_bucket: DataFrame, costs: Iterable[str], shift: int) -> DataFrame:
    """The bucket totals with ``_o_<name>``, the total before each bucket.

    Totals are first summed over groups of 2**shift buckets, so that the window over all groups and the one
    inside a group hold at most 2**20 of these small rows each.
    """
    grouped = per_bucket.withColumn("_g", F.shiftright("_b", shift))
    groups = grouped.groupBy("_g").agg(*[F.sum(f"_s_{n}").alias(f"_t_{n}") for n in costs])
    all_earlier = W.orderBy("_g").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select(
        "_g", *[F.coalesce(F.sum(f"_t_{n}").over(all_earlier), F.lit(0)).alias(f"_p_{n}") for n in costs]
    )
    earlier = W.partitionBy("_g").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = {f"_o_{n}": F.col(f"_p_{n}") + F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)) for n in costs}
    return grouped.join(groups, "_g").select(*per_bucket.columns, *[o.alias(n) for n, o in offsets.items()])


def running_totals(
    df: DataFrame,
    key: str,
    costs: dict[str, Column],
    tie: Sequence[str] = (),
    shifts: tuple[int, int] = DENSE_KEY,
) -> DataFrame:
    """Add ``before_<name>``: the sum of each cost over all rows earlier in key order.

    The input is read twice; where a cost is derived from wide columns, hand in a ``materialized`` table
    of keys and costs. Its rows are shuffled once, by bucket.
    """
    fine, coarse = shifts
    per_bucket = _bucket_totals(df, key, costs, fine)
    offsets = _bucket_offsets(per_bucket, costs, coarse - fine).select("_b", *[f"_o_{n}" for n in costs])
    return _totals_in_buckets(df, key, costs, tie, fine, offsets)


def _totals_in_buckets(
    df: DataFrame, key: str, costs: dict[str, Column], tie: Sequence[str], fine: int, offsets: DataFrame
) -> DataFrame:
    rows = df.withColumns(
        {"_b": F.shiftright(F.col(key).cast("bigint"), fine)}
        | {f"_c_{n}": c.cast("bigint") for n, c in costs.items()}
    )
    in_bucket = W.partitionBy("_b").orderBy(key, *tie)
    earlier = in_bucket.rowsBetween(W.unboundedPreceding, -1)
    place = F.struct(key, *tie)
    repeated = F.raise_error(F.lit(f"repeated order key: {', '.join((key, *tie))}")).cast("bigint")
    unique = F.when(F.lag(place).over(in_bucket) == place, repeated).otherwise(F.lit(0))
    totals = {
        f"before_{n}": F.col(f"_o_{n}") + F.coalesce(F.sum(f"_c_{n}").over(earlier), F.lit(0)) + unique for n in costs
    }
    return rows.join(offsets, "_b").select(*df.columns, *[t.alias(n) for n, t in totals.items()])


def with_position(
    df: DataFrame,
    key: str,
    tie: Sequence[str] = (),
    shifts: tuple[int, int] = DENSE_KEY,
    name: str = "pos",
) -> DataFrame:
    """Add the row's 0-based rank in key order: dense, unique, independent of partitioning.

    In a bucket without gaps the rank follows from the key by subtraction. Rows of such buckets only look
    up the bucket's offset, which moves none of them while the offsets are small enough to broadcast;
    Spark decides that by their size. Only buckets with gaps are shuffled and ordered.
    """
    fine, coarse = shifts
    costs = {"rows": F.lit(1)}
    if tie:
        return running_totals(df, key, costs, tie, shifts).withColumnRenamed("before_rows", name)
    per_bucket = _bucket_totals(df, key, costs, fine)
    offsets = _bucket_offsets(per_bucket, costs, coarse - fine)
    # As many keys as places and the fingerprint of just these keys: none is missing and none repeated.
    expected = F.aggregate(
        F.sequence("_first", "_last"), F.lit(0).cast("bigint"), lambda seen, k: seen.bitwiseXOR(F.xxhash64(k))
    )
    dense = F.col("_last") - F.col("_first") + 1 == F.col("_n")
    offsets = materialized(offsets.withColumn("_full", F.when(dense, expected == F.col("_print")).otherwise(False)), "offsets")
    full = F.col("_full")
    lookup = offsets.where(full).select("_b", "_first", "_o_rows")
    ranked = (
        df.withColumn("_b", F.shiftright(F.col(key).cast("bigint"), fine))
        .join(lookup, "_b")
        .select(*df.columns, (F.col("_o_rows") + F.col(key) - F.col("_first")).alias(name))
    )
    gapped = offsets.where(~full).select("_b", "_o_rows")
    ordered = _totals_in_buckets(df, key, costs, tie, fine, gapped).withColumnRenamed("before_rows", name)
    buckets = offsets.agg(F.count_if(full).alias("full"), F.count_if(~full).alias("gapped")).first()
    if buckets["gapped"] == 0:
        return ranked
    return ordered if buckets["full"] == 0 else ranked.unionByName(ordered)


def in_groups(df: DataFrame, key: str, tie: Sequence[str] = (), unit: int = 1, name: str = "pos", group: str = "group") -> DataFrame:
    """Add the row's rank as ``with_position`` does, and its group: so many whole units of ``unit`` consecutive ranks.

    A row moves once, whatever gaps the key has, and lies with its whole group in one partition. The keys alone, written
    down once, are ranked; where each group begins is a table of at most ``MOST_GROUPS`` rows (one for every core's share,
    or for ``GROUP_ROWS`` rows) that every task holds, and inside a group the rank follows from the order.
    """
    place = F.struct(F.col(key).alias(key), *[F.col(c).alias(c) for c in tie])
    keys = materialized(df.select(key, *tie), "keys")
    units = -(-keys.count() // unit)
    groups = min(max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-units * unit // GROUP_ROWS)), MOST_GROUPS)
    step = unit * max(-(-units // groups), 1)
    first = with_position(keys, key, tie, name="_first").where(F.col("_first") % step == 0)
    begun = first.select("_first", place.alias("_from"), _div(F.col("_first"), step).alias(group))
    begun = materialized(begun, "groups")
    to = F.lead("_from").over(W.orderBy("_first"))
    bounds = F.broadcast(begun.withColumn("_to", to))
    # Numbers first: they tell all but the group at hand apart, and cost less than the whole place.
    near = (F.col(key) >= F.col("_from")[key]) & (F.col("_to").isNull() | (F.col(key) <= F.col("_to")[key]))
    inside = near & (place >= F.col("_from")) & (F.col("_to").isNull() | (place < F.col("_to")))
    found = df.join(bounds, inside).select(*df.columns, "_first", group).repartition(group)
    rank = F.row_number().over(W.partitionBy(group).orderBy(key, *tie))
    return found.select(*df.columns, group, (F.col("_first") + rank - 1).alias(name))


@dataclass(frozen=True)
class Cut:
    """Where a budget is reached: the last key taken, none if all rows are, and the total before it."""

    key: int | None
    before: int


def _range(key: str, after: int | None, to: int) -> Column:
    inside = F.col(key) <= to
    return inside if after is None else inside & (F.col(key) > after)


def _probed(sized: DataFrame, budget: int, start: int | None) -> tuple[int | None, int | None, int]:
    """The keys (after, to] in which the total reaches the budget, and the total before; ``to`` is None if it does not.

    Ranges of keys are totalled from the start on. A range is as wide as the bytes per key of the last one promise for
    the rest of the budget, at most ``PROBE_GROWTH`` times as wide as that one. So of a table stored in key order about
    the budget is read, whatever its size: the scan skips what lies beyond by the key's statistics.
    """
    after = None if start is None else start - 1
    width = PROBE_KEYS
    to = (start or 0) + width - 1
    taken = 0
    while True:
        total = sized.where(_range("key", after, to)).agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
        if taken + total >= budget:
            return after, to, taken
        if sized.where(F.col("key") > to).isEmpty():
            return after, None, taken + total
        taken += total
        promised = (budget - taken) * width * 9 // (8 * total) if total else width * PROBE_GROWTH
        width = min(max(promised, PROBE_KEYS), width * PROBE_GROWTH)
        after, to = to, to + width


def budget_cut(df: DataFrame, key: str, cost: Column, budget: int, start: int | None = None) -> Cut | None:
    """The last record taken when records are taken in key order until the budget is reached.

    ``start`` is a key before which there are no records. Totals of growing key ranges name the range in which the
    budget is reached, bucket totals inside it the one bucket; only its rows are ordered.
    """
    if budget <= 0:
        return None
    fine, coarse = DENSE_KEY
    sized = df.select(F.col(key).cast("bigint").alias("key"), cost.cast("bigint").alias("bytes"))
    if not sized.where("key IS NULL").isEmpty():
        raise ValueError(f"null order key: {key}")
    after, to, taken = _probed(sized, budget, start)
    if to is None:
        return Cut(None, taken)
    near = sized.where(_range("key", after, to))
    costs = {"bytes": F.col("bytes")}
    offsets = _bucket_offsets(_bucket_totals(near, "key", costs, fine), costs, coarse - fine)
    last = offsets.where(F.col("_o_bytes") < budget - taken).orderBy(F.desc("_b")).limit(1).first()
    inside = near.where(F.col("key").between(last["_first"], last["_last"]))
    # The rows of one bucket, at most 2**16.
    earlier = W.partitionBy(F.shiftright("key", fine)).orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    before = F.lit(taken + last["_o_bytes"]) + F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
    found = (
        inside.select("key", before.alias("before"))
        .where(F.col("before") < budget)
        .orderBy(F.desc("key"))
        .limit(1)
        .first()
    )
    return Cut(found["key"], found["before"])


def within_budget(df: DataFrame, key: str, cost: Column, budget: int, start: int | None = None) -> DataFrame:
    """Rows taken in key order until their total reaches the budget; the last may overshoot it.

    They are a range of keys, so the result is a filter the scan can use, and no row moves. A table that is stored in
    key order is read up to the budget only, see ``budget_cut``.
    """
    cut = budget_cut(df, key, cost, budget, start)
    if cut is None:
        return df.where(F.lit(False))
    return df if cut.key is None else df.where(F.col(key) <= cut.key)


def byte_prefix(df: DataFrame, key: str, data: str, n_bytes: int) -> DataFrame:
    """The first ``n_bytes`` of the newline-terminated records in key order, the last one cut short.

    Adds ``piece``: the record's bytes (with its newline) that fall inside the prefix.
    """
    line = F.concat(F.col(data).cast("binary"), F.lit(b"\n"))
    cut = budget_cut(df, key, F.octet_length(data) + 1, n_bytes)
    if cut is None:
        return df.where(F.lit(False)).withColumn("piece", line)
    if cut.key is None:
        return df.withColumn("piece", line)
    room = min(n_bytes - cut.before, 2**31 - 1)
    piece = F.when(F.col(key) < cut.key, line).otherwise(F.substring(line, 1, room))
    return df.where(F.col(key) <= cut.key).withColumn("piece", piece)


def milestones(
    df: DataFrame, key: str, cost: Column, target_bytes: int, every: int = MILESTONE_ROWS
) -> DataFrame:
    """One row per ``every`` records: position, bytes so far, GiB and percent of the target."""
    sized = materialized(df.select(key, cost.cast("bigint").alias("_size")), "sizes")
    totals = running_totals(sized, key, {"rows": F.lit(1), "bytes": F.col("_size")})
    so_far = F.col("before_bytes") + F.col("_size")
    return totals.where(F.col("before_rows") % every == 0).select(
        F.col("before_rows").alias("pos"),
        so_far.alias("total_bytes"),
        names.gib(so_far).alias("gib"),
        names.percent_of(so_far, target_bytes).alias("percent"),
    )


def chunk_columns(pos: str = "pos", rows_per_chunk: int = ROWS_PER_CHUNK) -> dict[str, Column]:
    chunk = _div(F.col(pos), rows_per_chunk)
    return {
        "chunk": chunk,
        "row_in_chunk": F.col(pos) % rows_per_chunk,
        "chunk_file": names.chunk_name(chunk),
    }


def shard_columns(
    pos: str = "pos",
    rows_per_file: int = ROWS_PER_SHARD,
    files_per_folder: int = SHARDS_PER_FOLDER,
    folders: int = FOLDERS,
) -> dict[str, Column]:
    """Folder and file of a record; everything past the last folder wraps into that folder's files."""
    file_no = _div(F.col(pos), rows_per_file)
    folder = F.least(_div(file_no, files_per_folder), F.lit(folders - 1).cast("bigint"))
    return {
        "shard": file_no,
        "dir": names.double_letter(folder),
        "file": names.shard_name(file_no % files_per_folder),
    }


def first_rows(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in input order: a per-partition top-n, then one merge of n rows each."""
    return df.orderBy(*order).limit(n)


def resume_from(df: DataFrame, pos: str, start: int | Column) -> DataFrame:
    """Rows at or after an offset; a pushed-down scan filter where the position is a stored column."""
    return df.where(F.col(pos) >= start)


def seeded_shuffle(df: DataFrame, key: str, seed: int, name: str = "pos") -> DataFrame:
    """Add a 0-based position in a pseudo-random order fixed by the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))
    hashed = df.withColumns(
        {"_digest": digest, "_prefix": F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")}
    )
    ranked = with_position(hashed, "_prefix", ("_digest", key), HASH_KEY, name)
    return ranked.select(*df.columns, name)


def batches(df: DataFrame, key: str, seed: int, rows_per_batch: int = ROWS_PER_BATCH) -> DataFrame:
    """Batches of consecutive rows after a seeded shuffle; the last may be short."""
    return seeded_shuffle(df, key, seed).withColumn("batch", _div(F.col("pos"), rows_per_batch))
