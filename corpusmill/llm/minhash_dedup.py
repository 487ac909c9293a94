"""Near-duplicate documents by MinHash bands and odd sketches.

1. A text's set of word shingles is hashed in the JVM; ``HASHES`` MinHash samples of it make ``BANDS`` bands of
   ``ROWS`` samples and an odd sketch: the samples, each hashed with its number, toggle bits of a bitmap of
   ``SKETCH_BITS``, so that the population count of the XOR of two bitmaps tells how many samples differ.
2. Documents with equal sets are one class, known by a number; only classes go on, whatever type the ids have.
3. In each band bucket every class meets the bucket's least and its greatest member (a star, so the pairs are
   linear in the bucket). Pairs whose sketches estimate a similarity below ``ESTIMATE`` are dropped: the margin is five
   standard deviations of the estimate. The rest are confirmed on the full sets, and components are formed.
4. A bucket of more than three members that then holds more than one component is cut into blocks by hash, and the
   blocks with members outside the bucket's main component meet every block, one pair of blocks a group. Inside it,
   pairs of different components whose sketches pass are counted exactly, and only a spanning forest of the links
   found leaves the group, so rows stay linear however alike the members are. So every pair that shares a bucket is
   linked, known to be joined already, or compared; no bucket is capped. Buckets with the same members are compared
   once. A pair at the threshold shares a bucket with probability 1 - (1 - 0.8**5)**26 = 0.99997.

Only texts of documents that share a bucket are shuffled, once, to build their sets.

Defined results: null texts and texts without a word have an empty set and link with nothing; a text with fewer words
than a shingle is one shingle; repeated ids give a row each (and link if their sets do); an empty table gives an empty
result. Only the id and text columns are read. Sets are held as 64-bit hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.words import words_of
from corpusmill.session import materialized, ship_package

SHINGLE, SIMILARITY = 5, 80  # words, per cent
BANDS, ROWS = 26, 5
HASHES = BANDS * ROWS
SKETCH_BITS, SKETCH_LONGS = 512, 8
ESTIMATE = 0.62
# Members and shingles of one block, and shingles held as matrix columns at once.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1 << 20, 4096
SEED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_set(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id`` and ``shingles``, the distinct hashes of a text's word windows."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = words_of(docs.select(F.col(id_col).alias("id"), lowered.alias("_text")), "_text")
    n = F.size("_words")
    windows = F.arrays_zip(
        *[F.slice("_words", k + 1, F.greatest(n - (width - 1), F.lit(0))).alias(f"w{k}") for k in range(width)]
    )
    hashed = F.array_distinct(F.transform(windows, lambda w: F.xxhash64(w)))
    return rows.select(
        "id",
        F.when(n >= width, hashed)
        .when(n > 0, F.array(F.xxhash64("_words")))
        .otherwise(F.expr("cast(array() as array<bigint>)"))
        .alias("shingles"),
    )


class Sketcher:
    """MinHash bands and odd sketches of shingle sets."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
        self.salt = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        x = shingles.view(np.uint64)
        x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 512):
            h = self.a * x[None, at : at + 512]
            h += self.b
            np.minimum(out, h.min(axis=1), out=out)
        return out

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def bands(self, samples: np.ndarray) -> np.ndarray:
        """(N, BANDS) 64-bit keys of the bands, different for each band."""
        parts = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]) + np.uint64(1)
        for r in range(ROWS):
            key = self._mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
        return key.view(np.int64)

    def odd_sketch(self, samples: np.ndarray) -> np.ndarray:
        """(N, SKETCH_LONGS) bitmaps in which every sample has toggled one bit."""
        bit = (self._mix(samples.astype(np.uint64) + self.salt[None]) % np.uint64(SKETCH_BITS)).astype(np.int64)
        counts = np.zeros((len(samples), SKETCH_BITS), np.uint8)
        for k in range(HASHES):
            counts[np.arange(len(samples)), bit[:, k]] ^= 1
        return np.packbits(counts, axis=1).view(">i8").astype(np.int64)


def estimated(differing_bits: int | np.ndarray) -> np.ndarray:
    """The similarity that so many differing bits of two odd sketches stand for."""
    share = np.minimum(1 - 2 * np.asarray(differing_bits) / SKETCH_BITS, 1.0)
    return 1 + SKETCH_BITS / (4 * HASHES) * np.log(np.maximum(share, 1e-9))


MOST_BITS = int(max(d for d in range(SKETCH_BITS // 2) if estimated(d) >= ESTIMATE))


def sketched(sets: DataFrame) -> DataFrame:
    """``id``, ``n_shingles``, the set's digest (two longs), its bands and odd sketch; both null for an empty set."""
    sorted_set = F.sort_array("shingles")
    rows = sets.select(
        "id", "shingles", F.xxhash64(sorted_set).alias("d1"), F.hash(sorted_set).cast("bigint").alias("d2")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Sketcher()
        longs = pa.list_(pa.int64())
        for batch in batches:
            column = batch.column(1)
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            n = len(column)
            samples = np.zeros((n, HASHES), np.uint32)
            for i in np.flatnonzero(np.diff(offsets)):
                samples[i] = make.samples(flat[offsets[i] : offsets[i + 1]])
            sizes = np.diff(offsets).astype(np.int64)
            empty = sizes == 0
            lists = []
            for values in (make.bands(samples), make.odd_sketch(samples)):
                listed = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), pa.int64()), values.shape[1])
                lists.append(pa.array([None if e else v for e, v in zip(empty, listed.to_pylist(), strict=True)], longs)
                             if empty.any() else listed.cast(longs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), batch.column(2), batch.column(3), *lists],
                names=["id", "n_shingles", "d1", "d2", "bands", "sketch"],
            )

    ship_package()
    kind = sets.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>"
    )


def _alike(x: str, y: str) -> Column:
    """The odd sketches differ in at most the bits that the estimate allows."""
    bits = F.lit(0)
    for k in range(SKETCH_LONGS):
        bits = bits + F.bit_count(F.get(F.col(x), F.lit(k)).bitwiseXOR(F.get(F.col(y), F.lit(k))))
    return bits <= MOST_BITS


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both.cast("bigint") >= similarity * union).select("a", "b")


def _block_links(
    members: DataFrame, joined: DataFrame, sketch: DataFrame, sets: DataFrame, similarity: int
) -> DataFrame:
    """Links (a, b) that join the different components of a bucket; ``joined`` holds the components so far.

    Buckets of up to three members have been compared in full by their two stars.
    """
    placed = members.where("n > 3").join(joined, F.col("cid") == F.col("node"), "left").select(
        "bucket", "cid", "lo", F.coalesce("component", "cid").alias("comp")
    )
    weighed = materialized(placed.join(sets.select("cid", F.size("shingles").alias("size")), "cid"), "placed")
    # The bucket's main component is the one its least member is in.
    main = F.max(F.when(F.col("cid") == F.col("lo"), F.col("comp")))
    buckets = weighed.groupBy("bucket").agg(
        main.alias("main"),
        F.min("comp").alias("first"),
        F.max("comp").alias("last"),
        F.count("*").alias("n"),
        F.sum("size").alias("size"),
        F.bit_xor(F.xxhash64("cid")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("x2"),
    )
    alone = buckets.where("first <> last").groupBy("n", "size", "x1", "x2").agg(F.min_by(F.struct("bucket", "main"), "bucket").alias("b"))
    parted = weighed.join(alone.select("b.bucket", "b.main"), "bucket").withColumn("inside", F.col("comp") == F.col("main"))
    blocks = parted.groupBy("bucket").agg(
        *[
            F.greatest(
                F.ceil(F.count(F.when(side, 1)) / BLOCK), F.ceil(F.sum(F.when(side, F.col("size")).otherwise(0)) / BLOCK_SHINGLES)
            ).cast("int").alias(name)
            for name, side in (("n_in", F.col("inside")), ("n_out", ~F.col("inside")))
        ]
    )
    dealt = parted.join(blocks, "bucket")
    of = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    own = F.when(F.col("inside"), F.col("n_out") + of("n_in")).otherwise(of("n_out"))
    # Blocks below n_out are outside the main component; every pair with at least one of those is a group.
    met = F.sequence(F.lit(0), F.when(F.col("inside"), F.col("n_out")).otherwise(F.col("n_out") + F.col("n_in")) - 1)
    dealt = dealt.withColumn("own", own).select("bucket", "cid", "comp", "own", F.explode(met).alias("other"))
    grouped = dealt.select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "comp"
    )
    full = grouped.join(sketch, "cid").join(sets, "cid")

    def run(table: pa.Table) -> pa.Table:
        return _forest(table, similarity)

    ship_package()
    kind = sets.schema["cid"].dataType.simpleString()
    return full.groupBy("bucket", "i", "j").applyInArrow(run, f"a {kind}, b {kind}")


def _forest(table: pa.Table, similarity: int) -> pa.Table:
    """A spanning forest of the links between the components of one pair of blocks."""
    table = table.combine_chunks()
    ids = table.column("cid").combine_chunks()
    component = table.column("comp").combine_chunks()
    # Structs have no dictionary encoding, so their values stand for themselves.
    known: dict = {}
    comp = np.array([known.setdefault(str(c), len(known)) for c in component.to_pylist()])
    sketch = np.asarray(table.column("sketch").combine_chunks().flatten()).reshape(len(ids), SKETCH_LONGS)
    lists = table.column("shingles").combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets).astype(np.int64)
    own, i, j = table.column("own").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    bits = np.zeros((len(left), len(right)), np.int64)
    for k in range(SKETCH_LONGS):
        bits += np.bitwise_count(sketch[left, k].view(np.uint64)[:, None] ^ sketch[right, k].view(np.uint64)[None])
    open_ = (bits <= MOST_BITS) & (comp[left][:, None] != comp[right][None])
    rows, cols = open_.any(axis=1), open_.any(axis=0)
    left, right, open_ = left[rows], right[cols], open_[rows][:, cols]
    both = _intersections(flat, offsets, left, right)
    close = open_ & (100 * both >= similarity * (size[left][:, None] + size[right][None] - both))
    a, b = _spanning(close)
    return pa.table({"a": ids.take(pa.array(left[a])), "b": ids.take(pa.array(right[b]))})


def _intersections(flat: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(left, right) sizes of the sets' intersections, by products of membership matrices a few columns at a time."""
    out = np.zeros((len(left), len(right)), np.int64)
    sides = []
    for members in (left, right):
        values = [flat[offsets[m] : offsets[m + 1]] for m in members]
        sides.append((np.concatenate([*values, flat[:0]]), np.repeat(np.arange(len(members)), [len(v) for v in values])))
    common = np.intersect1d(sides[0][0], sides[1][0])
    placed = []
    for values, owner in sides:
        at = np.searchsorted(common, values)
        held = at < len(common)
        held[held] = common[at[held]] == values[held]
        order = np.argsort(at[held], kind="stable")
        placed.append((at[held][order], owner[held][order]))
    for start in range(0, len(common), COLUMNS):
        matrices = []
        for (at, owner), members in zip(placed, (left, right), strict=True):
            cut = slice(*np.searchsorted(at, [start, start + COLUMNS]))
            matrix = np.zeros((len(members), COLUMNS), np.float32)
            matrix[owner[cut], at[cut] - start] = 1
            matrices.append(matrix)
        out += (matrices[0] @ matrices[1].T).astype(np.int64)
    return out


def _spanning(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the edges of a spanning forest of a bipartite graph, breadth first."""
    new_rows, new_cols = np.ones(close.shape[0], bool), np.ones(close.shape[1], bool)
    a, b = [], []
    for root in range(close.shape[0]):
        if not new_rows[root]:
            continue
        new_rows[root] = False
        frontier = [(root, True)]
        while frontier:
            node, is_row = frontier.pop()
            fresh = np.flatnonzero(close[node] & new_cols if is_row else close[:, node] & new_rows)
            (new_cols if is_row else new_rows)[fresh] = False
            for other in fresh.tolist():
                a.append(node if is_row else other)
                b.append(other if is_row else node)
                frontier.append((other, not is_row))
    return np.array(a, np.int64), np.array(b, np.int64)


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """Per row its id, ``n_shingles``, ``component_id`` and ``kept`` (the id is the component's smallest)."""
    sketches = sketched(shingle_set(docs, id_col, text_col, width)).withColumn("row", F.monotonically_increasing_id())
    sketches = materialized(sketches, "sketches")
    full = sketches.where("n_shingles > 0 and id is not null")
    # The least row is the class's number; the table of rows is written, so it stays the same.
    classes = full.groupBy("d1", "d2", "n_shingles").agg(
        F.min("row").alias("cid"), F.min("id").alias("least"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = materialized(classes, "classes")
    banded = classes.select("cid", F.explode("bands").alias("bucket"))
    ends = banded.groupBy("bucket").agg(
        F.min("cid").alias("lo"), F.max("cid").alias("hi"), F.count("*").alias("n")
    ).where("lo < hi")
    members = materialized(banded.join(ends, "bucket").select("bucket", "cid", "lo", "hi", "n"), "buckets")
    sharing = classes.join(members.select("cid").distinct(), "cid").select("least").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Rows that repeat an id may differ in their text, so sets are matched to classes by digest as well.
    chosen = texts.join(sharing, texts["id"] == sharing["least"]).select("id", "text")
    digested = shingle_set(chosen, "id", "text", width).withColumn("_sorted", F.sort_array("shingles"))
    digested = digested.select(
        F.col("id").alias("least"), "shingles", F.xxhash64("_sorted").alias("d1"), F.hash("_sorted").cast("bigint").alias("d2")
    )
    sets = digested.join(classes.select("cid", "least", "d1", "d2"), ["least", "d1", "d2"]).select(
        "cid", "shingles"
    ).dropDuplicates(["cid"])
    sets = materialized(sets, "sets")
    sketch = classes.select("cid", "sketch")
    side = lambda name: sketch.select(F.col("cid").alias(name), F.col("sketch").alias(f"s{name}"))
    stars = members.select(F.inline(F.array(
        F.struct(F.col("lo").alias("a"), F.col("cid").alias("b")),
        F.struct(F.least("cid", "hi").alias("a"), F.greatest("cid", "hi").alias("b")),
    ))).where("a < b").distinct()
    near = stars.join(side("a"), "a").join(side("b"), "b").where(_alike("sa", "sb")).select("a", "b")
    links = materialized(_confirmed(near, sets, similarity), "links")
    joined = materialized(components(links), "joined")

    more = _block_links(members, joined, sketch, sets, similarity)
    every = materialized(components(links.unionByName(more)), "components")

    placed = classes.select("d1", "d2", "n_shingles", "cid", "least").join(every, F.col("cid") == F.col("node"), "left").select(
        "d1", "d2", "n_shingles", "least", "component"
    )
    heads = placed.where("component is not null").groupBy("component").agg(F.min("least").alias("head"))
    grouped = placed.join(heads, "component", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("head", "least").alias("component_id")
    )
    out = sketches.select("id", "n_shingles", "d1", "d2").join(grouped, ["d1", "d2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
