"""Block overlap between any records: an exact similarity join on sets of blocks.

Two records are linked if the Jaccard similarity of their distinct blocks reaches a threshold. Every link is found:

1. Records with equal sets are one class and go on as one, held by their least key.
2. A class's blocks are ordered by how many classes hold them, rarest first. Of n blocks only the first n - ceil(t n) + 1
   are indexed: two classes with similarity t share one of those. Blocks that a single class holds come first and
   link nothing, so most records of a corpus index nothing at all.
3. Classes meet where they share an indexed block and their sizes allow the similarity. A block's classes are cut
   into units of at most ``UNIT`` of neighbouring sizes, and two units meet in one group. Inside it pairs are compared
   on whole sets, each pair only at the rarest block it shares, and one row per class leaves the group. So rows stay
   linear in a hot block, where the pairs themselves would not.

No block is dropped for being frequent. Blocks are told apart by 128 bits of their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.redundancy import BLOCK_BYTES, fingerprint, fixed_blocks, line_blocks
from corpusmill.session import materialized, ship_package

SIMILARITY = 50  # per cent
UNIT = 2048
# Pairs looked at, and set members compared, at once.
PAIRS, MEMBERS = 1 << 18, 1 << 19


def block_sets(df: DataFrame, key: str, data: str, block_bytes: int | None = BLOCK_BYTES) -> DataFrame:
    """(key, n_blocks, blocks, digest): each record's distinct blocks, sorted; a null or empty record has none."""
    blocks = line_blocks(F.col(data)) if block_bytes is None else fixed_blocks(F.col(data), block_bytes)
    prints = F.transform(blocks, lambda block: F.substring(fingerprint(block), 1, 16))
    held = F.coalesce(F.sort_array(F.array_distinct(prints)), F.expr("cast(array() as array<binary>)"))
    # The explode of one value keeps the fingerprints from being computed again for each use.
    sets = df.select(F.col(key).alias("key"), F.explode(F.array(held)).alias("blocks"))
    digest = F.sha2(F.array_join(F.transform("blocks", lambda b: F.hex(b)), ""), 256)
    return sets.select("key", F.size("blocks").alias("n_blocks"), "blocks", digest.alias("digest"))


def _needed(n: Column, similarity: int) -> Column:
    """The least number of shared blocks that a set of n blocks needs for a link: ceil(t n)."""
    return F.ceil(F.lit(similarity) * n / F.lit(100)).cast("int")


def _indexed(classes: DataFrame, similarity: int) -> DataFrame:
    """Classes that may have links: (cid, n, copies, shared, first), ``shared`` their repeated blocks, rarest first.

    The first ``first`` of those are indexed.
    """
    held = classes.select("cid", F.explode("blocks").alias("block"))
    # Combined before the shuffle: a block held by all is one row per task.
    repeated = held.groupBy("block").agg(F.count("*").alias("df")).where("df > 1")
    of_class = held.join(repeated, "block").groupBy("cid").agg(
        F.sort_array(F.collect_list(F.struct("df", "block"))).alias("ordered")
    )
    sized = of_class.join(classes.select("cid", "n", "copies"), "cid")
    first = F.size("ordered") - _needed(F.col("n"), similarity) + 1
    return sized.select("cid", "n", "copies", F.col("ordered.block").alias("shared"), first.alias("first")).where("first > 0")


def _met(indexed: DataFrame, similarity: int) -> DataFrame:
    """One row per class and group it is compared in: (block, lo, hi, own, cid, n, copies, pos, shared)."""
    places = indexed.select("*", F.posexplode(F.slice("shared", 1, F.col("first"))).alias("pos", "block")).drop("first")
    # Sizes n and m can be linked if the smaller is t of the larger, so only neighbouring bands can.
    band = F.floor(F.log(F.col("n")) / -np.log(similarity / 100) + 1e-9).cast("int") if similarity < 100 else F.col("n")
    places = materialized(places.withColumn("band", band), "postings")
    bands = places.groupBy("block", "band").agg(F.ceil(F.count("*") / UNIT).cast("int").alias("units"), F.count("*").alias("c"))
    company = bands.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "units"))).alias("units"), F.sum("c").alias("classes")
    ).where("classes > 1").drop("classes")
    unit = lambda b, k: F.struct(b.alias("band"), k.alias("k"))
    near = F.array_distinct(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    counted = lambda b: F.coalesce(F.try_element_at("units", b), F.lit(0))
    numbers = lambda b: F.when(counted(b) > 0, F.sequence(F.lit(0), counted(b) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    others = F.flatten(F.transform(near, lambda b: F.transform(numbers(b), lambda k: unit(b, k))))
    own = unit(F.col("band"), F.pmod(F.xxhash64("cid"), counted(F.col("band"))).cast("int"))
    dealt = places.join(company, "block").withColumn("own", own).withColumn("other", F.explode(others))
    return dealt.select(
        "block", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") == F.least("own", "other")).alias("left"), (F.col("own") == F.greatest("own", "other")).alias("right"),
        "cid", "n", "copies", "pos", "shared",
    )


def _expanded(counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number in row) for so many things per row, at most about ``most`` at a time, rows in one piece."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = ends[at] - counts[at]
        stop = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
        own = counts[at:stop]
        row = np.repeat(np.arange(at, stop), own)
        yield row, np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
        at = stop


def _shares(
    a: np.ndarray, b: np.ndarray, pos: np.ndarray, offsets: np.ndarray, code: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per pair of members the size of their sets' intersection, and whether it has a block before the group's."""
    width = int(code.max(initial=0)) + 1
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = np.sort(owner * width + code)
    both, early = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    for row, number in _expanded(np.diff(offsets)[a], MEMBERS):
        wanted = b[row] * width + code[offsets[a[row]] + number]
        at = np.searchsorted(keys, wanted)
        held = keys[np.minimum(at, len(keys) - 1)] == wanted
        both += np.bincount(row[held], minlength=len(a))
        early[row[held & (number < pos[a[row]])]] = True
    return both, early


def _compare(table: pa.Table, similarity: int) -> pa.RecordBatch | None:
    """Per class and group its links, its greatest similarity and the least class that has it; groups are whole."""
    group = np.cumsum(np.append(False, _changes(table)))
    left, right = (table.column(c).to_numpy() for c in ("left", "right"))
    cid = table.column("cid").combine_chunks()
    rank = pc.rank(cid, tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
    n, copies, pos = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "copies", "pos"))
    lists = table.column("shared").combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    code = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    rest = np.diff(offsets) - pos - 1
    # Members of a unit that meets itself are both: each pair of those once, else every left with every right one.
    order = np.lexsort((~left, group))
    place = np.arange(len(order))
    g, both_sides = group[order], (left & right)[order]
    first_right = np.searchsorted(g * 2 + ~left[order], g * 2 + 1)
    end = np.searchsorted(g, g, side="right")
    begin = np.where(both_sides, place + 1, first_right)
    counts = np.where(left[order], end - begin, 0)
    # What a stretch of pairs tells of a class is added to what is known of it; no pair outlasts its stretch.
    links, greatest, nearest = np.zeros(len(cid), np.int64), np.zeros(len(cid)), np.full(len(cid), -1)
    for row, number in _expanded(counts, PAIRS):
        a, b = order[row], order[begin[row] + number]
        least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fits = (100 * least >= similarity * most) & (
            (100 + similarity) * (1 + np.minimum(rest[a], rest[b])) >= similarity * (least + most)
        )
        a, b = a[fits], b[fits]
        both, early = _shares(a, b, pos, offsets, code)
        linked = ~early & ((100 + similarity) * both >= similarity * (n[a] + n[b]))
        a, b, both = a[linked], b[linked], both[linked]
        if not len(a):
            continue
        jaccard = both / (n[a] + n[b] - both)
        one, other, jaccard = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([jaccard, jaccard])
        links += np.bincount(one, weights=copies[other], minlength=len(cid)).astype(np.int64)
        best = np.lexsort((rank[other], -jaccard, one))
        best = best[np.append(True, np.diff(one[best]) != 0)]
        one, other, jaccard = one[best], other[best], jaccard[best]
        nearer = (jaccard == greatest[one]) & (rank[other] < rank[nearest[one]])
        better = (jaccard > greatest[one]) | nearer
        greatest[one[better]], nearest[one[better]] = jaccard[better], other[better]
    found = np.flatnonzero(nearest >= 0)
    if not len(found):
        return None
    return pa.RecordBatch.from_arrays(
        [cid.take(pa.array(found)), pa.array(links[found]), pa.array(greatest[found]), cid.take(pa.array(nearest[found]))],
        names=["cid", "links", "similarity", "nearest"],
    )


def _changes(table: pa.Table) -> np.ndarray:
    """Whether each row but the first begins a new group."""
    out = np.zeros(max(len(table) - 1, 0), bool)
    for name in ("block", "lo", "hi"):
        values = table.column(name).combine_chunks()
        for part in values.flatten() if pa.types.is_struct(values.type) else [values]:
            out |= pc.not_equal(part[1:], part[:-1]).to_numpy(zero_copy_only=False)
    return out


def linked_classes(classes: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Per class with links: (cid, links, similarity, nearest) over classes (cid, copies, n, blocks).

    ``links`` counts the records of the classes linked, ``similarity`` is the greatest and ``nearest`` the least class
    that has it.
    """
    met = _met(materialized(_indexed(classes, similarity), "indexed"), similarity)
    dealt = met.repartition("block", "lo", "hi").sortWithinPartitions("block", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch])
            starts = np.flatnonzero(_changes(table)) + 1
            if not len(starts):
                held.append(batch)
                continue
            whole, rest = table.slice(0, starts[-1]), table.slice(starts[-1])
            held = rest.combine_chunks().to_batches()
            if (found := _compare(whole, similarity)) is not None:
                yield found
        if held and (found := _compare(pa.Table.from_batches(held), similarity)) is not None:
            yield found

    ship_package()
    kind = classes.schema["cid"].dataType.simpleString()
    found = dealt.mapInArrow(run, f"cid {kind}, links bigint, similarity double, nearest {kind}")
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "nearest"))
    return found.groupBy("cid").agg(F.sum("links").alias("links"), best.alias("b")).select(
        "cid", "links", (-F.col("b.s")).alias("similarity"), "b.nearest"
    )


def block_overlap(
    df: DataFrame, key: str, data: str, block_bytes: int | None = BLOCK_BYTES, similarity: int = SIMILARITY
) -> DataFrame:
    """Per record: ``n_blocks``, ``class_id``, ``n_links`` and the nearest other class with its ``jaccard``.

    ``class_id`` is the least key with the same blocks; ``n_links`` counts the other records, equal ones included, with
    at least ``similarity`` per cent of the blocks in common. A record without blocks is a class of its own.
    """
    sets = materialized(block_sets(df, key, data, block_bytes), "block-sets")
    classes = sets.where("n_blocks > 0 AND key IS NOT NULL").groupBy("digest").agg(
        F.min("key").alias("cid"), F.count("*").alias("copies"), F.first("n_blocks").alias("n"), F.first("blocks").alias("blocks")
    )
    classes = materialized(classes, "classes")
    linked = linked_classes(classes, similarity).withColumnRenamed("cid", "_cid")
    known = classes.select("digest", "cid", "copies").join(linked, F.col("cid") == F.col("_cid"), "left")
    rows = sets.select("key", "n_blocks", F.when((F.col("n_blocks") > 0) & F.col("key").isNotNull(), F.col("digest")).alias("digest"))
    joined = rows.join(known, "digest", "left")
    return joined.select(
        F.col("key").alias(key),
        F.col("n_blocks").cast("bigint").alias("n_blocks"),
        F.coalesce("cid", "key").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        F.round("similarity", 6).alias("jaccard"),
        F.col("nearest").alias("nearest_id"),
    )
