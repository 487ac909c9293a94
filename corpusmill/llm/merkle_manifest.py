"""Merkle manifest of a dataset: a content-addressed store of digests, and proofs by descent from the root.

1. Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
   Per group, leaves ascend by their key; groups ascend by name, null first.
2. Every two consecutive nodes (a last one alone) become the digest of their concatenated hex digests until one
   remains, per group its subroot; the subroots give the root in the same way.
3. ``DIGIT_BITS`` binary levels make one record of the store: a digest and the up to 2**DIGIT_BITS digests it stands
   for. A node's rank, read in digits of so many bits, is its way down from the root.
4. Requested leaves descend together: each level joins the digests reached with their records, takes the children
   that the requests' next digit selects and collects the unselected ones beside their way as a path segment. A path is
   carried once for all leaves below it; segments go in front of what was collected higher up, which reverses the
   descent into a proof from leaf to root.

Ranks come from one range sort by group and key, written down, and from row numbers within its files: no window, and
a group of any size spreads over as many tasks as its rows need. A record and the requests below it are bounded by
2**DIGIT_BITS rows, the records by levels of that base.

Defined results: null and empty fields differ; a null key comes first; rows that tie in group and key are ordered by
their leaf, and equal rows are leaves of their own; an empty table has neither root nor proofs; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.session import materialized, ship_package

DIGIT_BITS = 10
FANOUT = 1 << DIGIT_BITS
NO_DIGEST = ""


def field(value: Column) -> Column:
    """A field as it enters a leaf; the byte count keeps neighbouring fields apart."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (key, leaf, presented, grp, rank, n), ``groups`` (name, grp, subroot) and the records by level.

    ``leaf_records`` and ``group_records`` hold one table (digest, height, children) per digit, the lowest first.
    """

    leaves: DataFrame
    groups: DataFrame
    leaf_records: list[DataFrame]
    group_records: list[DataFrame]


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank``, their 0-based place in their group, and ``n``, the group's size.

    ``rows`` is a written table. Equal rows are told apart by where they stand in it, so a row that repeats very often
    still spreads over the range partitions.
    """
    by = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_at")]
    laid = rows.withColumn("_at", F.monotonically_increasing_id())
    laid = materialized(laid.repartitionByRange(*by).sortWithinPartitions(*by).drop("_at"), "ranked")
    placed = laid.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    stretches = placed.groupBy("_file", group).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    # One row per file and group in it; files are numbered in the order of the range partitions.
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("bigint")
    of_group = W.partitionBy(group)
    earlier = of_group.orderBy("_number", "_file").rowsBetween(W.unboundedPreceding, -1)
    stretches = materialized(
        stretches.withColumn("_number", number).select(
            F.col("_file").alias("_f"), F.col(group).alias("_g"), "_first",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(of_group).alias("n"),
        ),
        "stretches",
    )
    met = placed.join(stretches, (F.col("_file") == F.col("_f")) & F.col(group).eqNullSafe(F.col("_g")))
    return met.select(*rows.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank"), "n")


def _halved(nodes: Column, times: Column) -> Column:
    """The nodes that remain after so many rounds in which every two consecutive ones become their digest."""

    def once(level: Column, _: Column) -> Column:
        last = F.call_function("div", F.size(level) + 1, F.lit(2)).cast("int") - 1
        pair = lambda k: F.concat(F.get(level, 2 * k), F.coalesce(F.get(level, 2 * k + 1), F.lit("")))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(pair(k), 256))

    rounds = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(rounds, nodes, once)


def _records(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records by level over nodes (grp, rank, n, digest), and per group its top: (grp, level, digest)."""
    levels, tops = [], None
    while True:
        pages = nodes.groupBy("grp", "n", F.shiftright("rank", DIGIT_BITS).alias("page")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("_nodes")
        )
        # The top record ends at one node; all others span their full number of binary levels.
        least = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
        height = F.when(F.col("n") > FANOUT, DIGIT_BITS).otherwise(least).cast("int")
        pages = pages.select("grp", "n", "page", height.alias("height"), F.col("_nodes.digest").alias("children"))
        pages = materialized(
            pages.withColumn("digest", F.element_at(_halved(F.col("children"), F.col("height")), 1)), "records"
        )
        top = pages.where(F.col("n") <= FANOUT).select("grp", F.lit(len(levels)).alias("level"), "digest")
        tops = top if tops is None else tops.unionByName(top)
        levels.append(pages)
        nodes = pages.where(F.col("n") > FANOUT).select(
            "grp", F.col("page").alias("rank"), F.ceil(F.col("n") / FANOUT).cast("bigint").alias("n"), "digest"
        )
        if nodes.isEmpty():
            return levels, materialized(tops, "tops")


def build(
    rows: DataFrame, key: str, group: str, leaf: Column, presented: Column | None = None, carry: Sequence[str] = ()
) -> Manifest:
    """The manifest of the rows.

    ``presented`` is the digest that is to be checked against the manifest in place of the leaf where it is not null;
    ``carry`` names further columns that the proofs return.
    """
    presented = F.lit(None).cast("string") if presented is None else presented
    named = rows.select(
        F.col(key).alias("key"), F.col(group).alias("name"), leaf.alias("leaf"), presented.alias("presented"),
        F.struct(F.lit(0).alias("_"), *[F.col(c) for c in carry]).alias("carried"),
    )
    placed = materialized(ranked(materialized(named, "leaves"), "name", ["key", "leaf"]), "placed")
    names = materialized(placed.select("name", F.lit(0).cast("bigint").alias("all")).distinct(), "names")
    groups = materialized(ranked(names, "all", ["name"]).select("name", F.col("rank").alias("grp"), F.col("n").alias("m")), "groups")
    numbered = groups.select(F.col("name").alias("_name"), "grp")
    leaves = placed.join(numbered, F.col("name").eqNullSafe(F.col("_name"))).drop("_name", "name")
    leaves = materialized(leaves, "leaves")
    leaf_records, tops = _records(leaves.select("grp", "rank", "n", F.col("leaf").alias("digest")))
    groups = materialized(groups.join(tops, "grp"), "groups")
    nodes = groups.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("rank"), F.col("m").alias("n"), "digest")
    group_records, _ = _records(nodes)
    return Manifest(leaves, groups, leaf_records, group_records)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _segments(children: list[str], height: int, digits: list[int]) -> list[list[str]]:
    """For each digit the unselected nodes on its way up through one record, marked by the side they are on."""
    levels = [children]
    for _ in range(height):
        below = levels[-1]
        levels.append([_digest("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    out = []
    for digit in digits:
        segment = []
        for b in range(height):
            k = digit >> b
            row = levels[b]
            other = k ^ 1
            segment.append(("l" if k & 1 else "r") + row[other] if other < len(row) else NO_DIGEST)
        out.append(segment)
    return out


def _step(reached: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One digit down: ``reached`` (grp, page, digest, above) and ``wanted`` (grp, page, items) by record.

    Items are structs whose first field is the digit; the result has a row per item: (grp, page, child, above, item).
    """
    once = records.select("digest", "height", "children").dropDuplicates(["digest"])
    met = reached.join(once, "digest").join(wanted, ["grp", "page"]).select(
        "grp", "page", "height", "children", "above", F.col("items.digit").alias("digits"), "items"
    )
    item = wanted.schema["items"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in range(6)]
            items = batch.column(6)
            for r in range(batch.num_rows):
                grp, page, height, children, above, digits = (c[r].as_py() for c in columns)
                paths = [segment + above for segment in _segments(children, height, digits)]
                n = len(digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([grp] * n, pa.int64()),
                        pa.array([(page << DIGIT_BITS) + d for d in digits], pa.int64()),
                        pa.array([children[d] for d in digits], pa.string()),
                        pa.array(paths, pa.list_(pa.string())),
                        items[r].values,
                    ],
                    names=["grp", "page", "digest", "above", "item"],
                )

    ship_package()
    return met.mapInArrow(
        run, f"grp bigint, page bigint, digest string, above array<string>, item {item.simpleString()}"
    )


def _prefixes(nodes: DataFrame, level: int) -> DataFrame:
    """The records of a level that nodes (grp, rank) pass, with the digits they take there."""
    digit = F.col("_node").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    passed = nodes.select("grp", F.shiftright("rank", level * DIGIT_BITS).alias("_node")).distinct()
    return passed.groupBy("grp", F.shiftright("_node", DIGIT_BITS).alias("page")).agg(
        F.collect_list(F.struct(digit.alias("digit"))).alias("items")
    )


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per requested leaf: key, carried columns, leaf, presented, subroot, root and ``path`` from leaf to root.

    ``requests`` holds (grp, rank); without it every leaf is requested. A path element is an unselected digest after
    ``l`` or ``r``, the side it is on, or empty where a node was alone.
    """
    leaves = manifest.leaves
    if requests is not None:
        leaves = leaves.join(requests.select("grp", "rank").distinct(), ["grp", "rank"], "left_semi")
    empty = F.expr("cast(array() as array<string>)")
    root = manifest.group_records[-1].select(F.lit(0).cast("bigint").alias("grp"), F.lit(0).cast("bigint").alias("page"), "digest", empty.alias("above"))
    of_groups = leaves.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("rank")).distinct()
    reached = root
    for level in reversed(range(len(manifest.group_records))):
        step = _step(reached, manifest.group_records[level], _prefixes(of_groups, level))
        reached = materialized(step.select("grp", "page", "digest", "above"), "reached")
    subroots = materialized(
        reached.select(F.col("page").alias("grp"), "digest", "above").join(manifest.groups.select("grp", "level"), "grp"),
        "subroots",
    )
    below = None
    for level in reversed(range(len(manifest.leaf_records))):
        entering = subroots.where(F.col("level") == level).select("grp", F.lit(0).cast("bigint").alias("page"), "digest", "above")
        reached = entering if below is None else below.unionByName(entering)
        if level:
            step = _step(reached, manifest.leaf_records[level], _prefixes(leaves, level))
            below = materialized(step.select("grp", "page", "digest", "above"), "reached")
    digit = F.col("rank").bitwiseAND(F.lit(FANOUT - 1)).cast("int").alias("digit")
    wanted = leaves.groupBy("grp", F.shiftright("rank", DIGIT_BITS).alias("page")).agg(
        F.collect_list(F.struct(digit, "key", "presented", "carried")).alias("items")
    )
    found = _step(reached, manifest.leaf_records[0], wanted)
    tops = subroots.select("grp", F.col("digest").alias("subroot"))
    whole = manifest.group_records[-1].select(F.col("digest").alias("root"))
    return found.join(tops, "grp").select(
        F.col("item.key").alias("key"), "item.carried", F.col("digest").alias("leaf"), "item.presented", "subroot",
        whole.scalar().alias("root"), F.col("above").alias("path"),
    )


def proof_digest(path: Column) -> Column:
    """The SHA-256 of a path's digests from leaf to root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest leads to along a path."""

    def up(node: Column, step: Column) -> Column:
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(F.startswith(step, F.lit("l")), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, digest, up)
