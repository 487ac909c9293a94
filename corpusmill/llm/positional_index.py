"""Benchmark decontamination by a distributed positional inverted index.

The corpus is indexed in segments of whole documents: a segment is one stored row with its distinct terms and, term by
term, the positions at which they stand. Positions count through the documents of a segment with ``GAP`` unused places
between two of them, so no match crosses documents. A segment holds at most about ``SEGMENT_BYTES`` of text unless a
single text is longer; segments are made and searched where they are stored, so the corpus is never shuffled and a
term that is everywhere is one list per segment.

Queries are word lists. They are taken in blocks of at most ``BLOCK_BYTES`` of text; each block is read to the driver
and sent to the tasks that search the segments, so what is broadcast is bounded whatever the query set holds, and a
larger set takes more passes over the index.

* Phrases: in each segment a window's terms are ordered by the length of their lists there. The list of the rarest,
  moved back by its offset in the window, gives the candidate starts; the other lists, adjusted in the same way, are
  intersected in this order. A window with a term that the segment lacks has no candidates.
* Proximity: from the rarest term of an item every stretch of ``width`` words around its positions is a candidate, and
  the other terms, again from rare to frequent, drop those in which they have no position.

Candidates are held ``CANDIDATES`` at a time; none is dropped.

Defined results: null and word-less texts are indexed with no words; query items that are null or have no words match
nothing; equal windows of several items are looked up once and reported for each; query rows that repeat an id are one
item with the windows of all; an item without an id marks words but is not listed. Repeated document ids are documents
of their own. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import arrow_words, parts
from corpusmill.session import materialized, ship_package, work_folder

# Fixed by the contract: everything between words, after lowering A-Z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GAP = 64
SEGMENT_BYTES = 256 << 10
BLOCK_BYTES = 16 << 20
CANDIDATES = 1 << 17

BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "16",
}
# Pages and row groups are looked at after every row, as a row is a segment; the defaults let a hundred rows pile up.
FILES = {
    "parquet.block.size": str(8 << 20),
    **{f"parquet.{part}.size.row.check.{end}": "1" for part in ("page", "block") for end in ("min", "max")},
}
# No text, hence no segment, has more than 2**31 words.
SEGMENT_SCHEMA = (
    "segment string, ids array<{id}>, starts array<int>, words array<int>, terms array<string>, "
    "term_ends array<int>, positions array<int>"
)
MATCH_SCHEMA = "segment string, doc_no bigint, id {id}, item string, start bigint, length bigint"


def _segment(name: str, ids: pa.Array, texts: pa.Array) -> dict:
    words, counts = arrow_words(pc.ascii_lower(texts), NO_WORD)
    starts = np.concatenate([[0], np.cumsum(counts + GAP)])[:-1].astype(np.int32)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    place = np.arange(len(codes)) + np.repeat(starts.astype(np.int64) - (np.cumsum(counts) - counts), counts)
    order = np.argsort(codes, kind="stable")
    return {
        "segment": name,
        "ids": ids,
        "starts": starts,
        "words": counts.astype(np.int32),
        "terms": coded.dictionary,
        "term_ends": np.cumsum(np.bincount(codes, minlength=len(coded.dictionary))).astype(np.int32),
        "positions": place[order].astype(np.int32),
    }


@contextmanager
def _bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Texts and segments reach tasks a few megabytes at a time: rows are large, and the default bound counts rows."""
    before = {key: spark.conf.get(key) for key in BATCHES}
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "index") -> DataFrame:
    """The stored segments of all documents, one row each, read back from the shared folder."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.string())
            for cut in parts(texts, SEGMENT_BYTES):
                n = cut.stop - cut.start
                built = _segment(f"{part}-{made}", ids.slice(cut.start, n), texts.slice(cut.start, n))
                made += 1
                columns = [pa.array([built.pop("segment")])]
                for values in built.values():
                    flat = values if isinstance(values, pa.Array) else pa.array(values)
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["segment", "ids", "starts", "words", "terms", "term_ends", "positions"]
                )

    ship_package()
    spark, path = docs.sparkSession, work_folder(docs.sparkSession, name)
    segments = rows.mapInArrow(run, SEGMENT_SCHEMA.format(id=kind))
    with _bounded_batches(spark):
        segments.write.options(**FILES).parquet(path)
    return spark.read.schema(segments.schema).parquet(path)


@dataclass
class Postings:
    """The positions of one segment, term by term, as one ascending list of term * span + position, and a last key."""

    terms: pa.Array
    ends: np.ndarray
    begins: np.ndarray
    keys: np.ndarray
    span: int

    @classmethod
    def of(cls, terms: pa.Array, ends: np.ndarray, positions: np.ndarray) -> Postings:
        ends = ends.astype(np.int64)
        span = int(positions.max(initial=0)) + 2 * GAP
        begins = np.concatenate([[0], ends])[:-1]
        keys = np.append(positions.astype(np.int64), np.iinfo(np.int64).max)
        keys[:-1] += np.repeat(np.arange(len(ends)) * span, ends - begins)
        return cls(terms, ends, begins, keys, span)

    def sizes(self, codes: np.ndarray) -> np.ndarray:
        """Lengths of the terms' lists; 0 for -1, a term the segment lacks."""
        return np.append(self.ends - self.begins, 0)[codes]

    def positions(self, code: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th position of each term."""
        return self.keys[self.begins[code] + k] - code * self.span

    def next_at(self, code: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The term's first position not before the given one, or one beyond every position."""
        found = self.keys[np.searchsorted(self.keys, code * self.span + position)]
        beyond = found >= (code + 1) * self.span
        return np.where(beyond, np.iinfo(np.int64).max, found - code * self.span)

    def holds(self, code: np.ndarray, position: np.ndarray) -> np.ndarray:
        return self.next_at(code, position) == position

    def by_rarity(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The places of each row's terms from the rarest on; places beyond a row's length come last."""
        unused = np.arange(codes.shape[1])[None] >= lengths[:, None]
        return np.argsort(np.where(unused, np.iinfo(np.int64).max, self.sizes(codes)), axis=1, kind="stable")

    def _candidates(self, rarest: np.ndarray, per_position: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, position) of every position of each row's rarest term, a bounded number at a time."""
        sizes = self.sizes(rarest)
        ends = np.cumsum(sizes)
        step = max(CANDIDATES // per_position, 1)
        for at in range(0, int(ends[-1]) if len(ends) else 0, step):
            number = np.arange(at, min(at + step, int(ends[-1])))
            row = np.searchsorted(ends, number, side="right")
            yield row, self.positions(rarest[row], number - (ends - sizes)[row])

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, start) of every place where a row of term codes, of which ``lengths`` count, stands word for word."""
        order = self.by_rarity(codes, lengths)
        rows, starts = [], []
        rarest = np.take_along_axis(codes, order[:, :1], 1)[:, 0]
        for row, position in self._candidates(rarest):
            start = position - order[row, 0]
            keep = start >= 0
            row, start = row[keep], start[keep]
            for rank in range(1, codes.shape[1]):
                place = order[row, rank]
                counted = rank < lengths[row]
                fits = ~counted
                fits[counted] = self.holds(codes[row, place][counted], (start + place)[counted])
                row, start = row[fits], start[fits]
            rows.append(row)
            starts.append(start)
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *rows]), np.concatenate([empty, *starts])

    def near(self, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the shortest stretches from a place on in which all (distinct) terms occur within ``width``."""
        order = np.argsort(self.sizes(codes), kind="stable")
        found = [np.zeros((0, 2), np.int64)]
        for _, position in self._candidates(codes[order[:1]], width):
            at = np.unique((position[:, None] - np.arange(width)[None]).ravel())
            first, last = np.full(len(at), np.iinfo(np.int64).max), np.zeros(len(at), np.int64)
            for code in codes[order].tolist():
                term = self.next_at(np.full(len(at), code), at)
                keep = term < at + width
                at, first, last = at[keep], np.minimum(first, term)[keep], np.maximum(last, term)[keep]
            found.append(np.stack([first, last + 1], 1))
        every = np.unique(np.concatenate(found), axis=0)
        return every[:, 0], every[:, 1]


@dataclass
class Block:
    """A block of query items in the form the tasks search for: distinct windows over the block's vocabulary."""

    names: list
    vocabulary: pa.Array
    windows: np.ndarray  # (windows, width) term numbers, -1 beyond a window's length
    lengths: np.ndarray
    owner: np.ndarray  # item and window of each pair, ordered by window
    window: np.ndarray
    terms: list[np.ndarray]  # distinct term numbers of each item

    @classmethod
    def of(cls, names: list, texts: list[str | None], width: int) -> Block:
        words, counts = arrow_words(pc.ascii_lower(pa.array(texts, pa.string())), NO_WORD)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known: dict = {}
        item = np.array([known.setdefault(n if n is not None else (k,), len(known)) for k, n in enumerate(names)], np.int64)
        ends = np.cumsum(counts)
        windows, owners = [np.full((0, width), -1)], [np.zeros(0, np.int64)]
        terms: list[list] = [[] for _ in known]
        for row, (end, count) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
            if not count:
                continue
            own = codes[end - count : end]
            rows = np.lib.stride_tricks.sliding_window_view(own, min(width, count))
            windows.append(np.pad(rows, ((0, 0), (0, width - rows.shape[1])), constant_values=-1))
            owners.append(np.full(len(rows), item[row]))
            terms[item[row]].append(own)
        distinct, which = np.unique(np.concatenate(windows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(owners)], 1), axis=0)
        listed = [None if isinstance(n, tuple) else n for n in known]
        found = [np.unique(np.concatenate([np.zeros(0, np.int64), *t])) for t in terms]
        return cls(listed, coded.dictionary, distinct, (distinct >= 0).sum(axis=1), pairs[:, 1], pairs[:, 0], found)

    def codes(self, postings: Postings) -> np.ndarray:
        """The segment's code of each term of the block and, at the end, of no term; -1 where it lacks one."""
        at = pc.fill_null(pc.index_in(self.vocabulary, value_set=postings.terms), -1)
        return np.concatenate([at.to_numpy(zero_copy_only=False).astype(np.int64), [-1]])


def _stretches(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching stretches [start, end) of one owner merged."""
    order = np.lexsort((end, start, owner))
    owner, start, end = owner[order], start[order], end[order]
    if not len(owner):
        return owner, start, end
    shift = np.unique(owner, return_inverse=True)[1] * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    first = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    at = np.flatnonzero(first)
    return owner[at], start[at], (reach - shift)[np.concatenate([at[1:], [len(owner)]]) - 1]


def _search(index: DataFrame, block: Block, width: int | None) -> DataFrame:
    """Merged matches of a block of queries, as phrases or within ``width`` words."""
    id_kind = index.schema["ids"].dataType.elementType.simpleString()

    def phrases(postings: Postings, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = codes[block.windows]
        chosen = np.flatnonzero(((table >= 0) | (block.windows < 0)).all(axis=1))
        row, start = postings.phrases(table[chosen], block.lengths[chosen])
        window = chosen[row]
        # Every item that has the window found.
        first, last = np.searchsorted(block.window, window), np.searchsorted(block.window, window, side="right")
        times = last - first
        pair = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
        return block.owner[pair], np.repeat(start, times), np.repeat(start + block.lengths[window], times)

    def near(postings: Postings, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [np.zeros((3, 0), np.int64)]
        for item, terms in enumerate(block.terms):
            own = codes[terms]
            if len(own) and (own >= 0).all():
                start, end = postings.near(own, width)
                found.append(np.stack([np.full(len(start), item), start, end]))
        return tuple(np.concatenate(found, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                segment = batch.column(0)[r].as_py()
                ids, starts, _, terms, ends, positions = (batch.column(k)[r].values for k in range(1, 7))
                starts, ends, positions = (x.to_numpy(zero_copy_only=False) for x in (starts, ends, positions))
                postings = Postings.of(terms, ends, positions)
                find = phrases if width is None else near
                item, start, end = _stretches(*find(postings, block.codes(postings)))
                # Documents are further apart than any stretch is wide.
                doc = np.searchsorted(starts, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment] * len(doc), pa.string()),
                        pa.array(doc, pa.int64()),
                        ids.take(pa.array(doc, pa.int64())),
                        pa.array([block.names[k] for k in item.tolist()], pa.string()),
                        pa.array(start - starts[doc], pa.int64()),
                        pa.array(end - start, pa.int64()),
                    ],
                    names=["segment", "doc_no", "id", "item", "start", "length"],
                )

    ship_package()
    return index.mapInArrow(run, MATCH_SCHEMA.format(id=id_kind))


def search(
    index: DataFrame,
    items: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    width: int | None = None,
) -> DataFrame:
    """(segment, doc_no, id, item, start, length): where items match, overlapping matches of an item merged.

    An item matches where one of its windows of ``window`` consecutive words (the whole item, if it is shorter) stands
    word for word or, if ``width`` is given, where all its distinct words stand within so many words, ``GAP`` at most.
    """
    if width is not None and not 0 < width <= GAP:
        raise ValueError(f"width must be from 1 to {GAP}")
    queries = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    total = queries.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n_blocks = max(-(-total // BLOCK_BYTES), 1)
    found = None
    for number in range(n_blocks):
        chosen = queries.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == number).collect()
        block = Block.of([r["id"] for r in chosen], [r["text"] for r in chosen], window)
        with _bounded_batches(items.sparkSession):
            matches = materialized(_search(index, block, width), "matches")
        found = matches if found is None else found.unionByName(matches)
    return found


def _covered(spans: str) -> Column:
    """The number of places that stretches (start, end) cover together."""
    zero = F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["reach"], s["end"]).alias("reach"),
        (acc["n"] + F.greatest(s["end"] - F.greatest(acc["reach"], s["start"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(F.sort_array(spans), zero, step, lambda acc: acc["n"])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document: its id, ``n_words``, ``n_hit`` (words in matches), ``items`` (sorted ids) and ``contaminated``."""
    index = build_index(docs, id_col, text_col)
    matches = search(index, items, item_col, item_text_col, window)
    found = matches.groupBy("segment", "doc_no").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )
    listed = index.select("segment", F.posexplode(F.arrays_zip("ids", "words")).alias("doc_no", "doc"))
    joined = listed.join(found, ["segment", "doc_no"], "left")
    n_hit = F.coalesce(_covered("spans"), F.lit(0).cast("bigint"))
    return joined.select(
        F.col("doc.ids").alias(id_col),
        F.col("doc.words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )
