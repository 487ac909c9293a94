"""Order-preserving packing: dynamic programming over window cuts at document and sentence boundaries.

The documents of a partition form one stream, in the table's order, that is cut into blocks of whole documents of
about ``BLOCK_TOKENS`` tokens. Within a block the window ends are chosen so that padding plus penalties for
truncation is least. With ``f(p)`` the least cost of the stream before place ``p``::

    f(p) = penalty(p) + min( min over q in [p - window, p) of f(q) + window - (p - q),
                             min over k of f(p - 2**k) )          # such a sequence needs no padding; 2**k >= LEAST_WHOLE
           + PER_SEQUENCE

Up to a constant, the first minimum is of ``f(q) + q`` over a sliding window, which a monotone queue gives in constant
time per place. Places are document ends (no penalty), ends of sentences (``SENTENCE_CUT``), and, inside stretches
without any, every ``STRIDE`` tokens (``WORD_CUT``), so that a cut always exists.

A block is at most one document longer than its target, nothing is shuffled, and a task holds one block. A stream is
what Spark reads as one partition; its number is the upper part of ``sequence_id``.

Defined results: a null or empty text is the end token alone; repeated rows are packed as often as they occur; an empty
table gives no pieces. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import ship_package

WINDOW = 2048
END_TOKEN = 1
BLOCK_TOKENS = 1 << 18
SENTENCE_CUT, WORD_CUT, PER_SEQUENCE = 2.0, 8.0, 1.0
STRIDE = 64
LEAST_WHOLE = 128  # shorter sequences gain nothing from being a power of two
CACHE_WORDS = 400_000

PIECE_SCHEMA = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class WordEncoder(dict):
    """Token ids of texts, word by word from a cache; the keys are words, the values their ids as bytes.

    A space between two other characters always begins a token of this vocabulary's pre-tokenizer, so the pieces of a
    text cut there can be encoded apart and kept. Texts with other white space beside a space are encoded as a whole.
    The cache is emptied when it holds ``CACHE_WORDS`` words. ``encode`` maps a text to its ids.
    """

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _OtherSpaceError
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = array("I", self.encode(" " + word)).tobytes()
        return found

    def ids(self, text: str) -> np.ndarray:
        first, *words = text.split(" ")
        try:
            if words and (not first or first[-1].isspace()):
                raise _OtherSpaceError
            raw = array("I", self.encode(first)).tobytes() + b"".join(map(self.__getitem__, words))
            return np.frombuffer(raw, dtype=np.uint32)
        except _OtherSpaceError:
            return np.array(self.encode(text), dtype=np.uint32)


class _OtherSpaceError(Exception):
    """The text can't be cut at its spaces."""


def byte_bpe(path: str, ranks: str | None = None, pattern: str | None = None) -> Callable[[str], list[int]]:
    """The ids a tokenizer file gives to a text; special tokens' names are ordinary text.

    With ``ranks`` and ``pattern``, the same vocabulary as a table of byte sequences is used, which gives the same ids
    several times faster.
    """
    if ranks is None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary


def public_byte_bpe() -> Callable[[str], list[int]]:
    """The public 50k byte-level vocabulary of the tokenizer package installed on the executors."""
    import public_tokenizers

    return byte_bpe(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def sentence_ends(encode: Callable[[str], list[int]], size: int = 1 << 16) -> np.ndarray:
    """Which ids end a sentence: those that full stops, marks and line ends become, alone and doubled."""
    marks = [".", "!", "?", "\n", "\n\n", "...", ".\n", "!\n", "?\n", "。", ".\"", "!\"", "?\"", ".)"]
    table = np.zeros(size, dtype=bool)
    for mark in marks:
        ids = encode(mark)
        if ids:
            table[ids[-1]] = True
    return table


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending from 0 to the number of tokens, and the penalty of each."""
    n = len(ids)
    at = np.union1d(np.flatnonzero(ends[np.minimum(ids, len(ends) - 1)]) + 1, doc_ends)
    at = at[at <= n]
    gaps = np.diff(np.concatenate([[0], at]))
    wide = np.flatnonzero(gaps > 4 * STRIDE)
    fill = [np.arange(at[i] - gaps[i] + STRIDE, at[i], STRIDE) for i in wide]
    places = np.concatenate([[0], at, *fill]).astype(np.int64)
    cost = np.concatenate(
        [[0.0], np.full(len(at), SENTENCE_CUT), np.full(sum(map(len, fill)), WORD_CUT)]
    )
    order = np.argsort(places, kind="stable")
    places, cost = places[order], cost[order]
    cost[np.isin(places, doc_ends)] = 0.0
    return places, cost


def best_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """The window ends of least total cost, ascending; the last place is always one.

    Neighbouring places must be at most ``window`` apart. Among equal costs the earliest start wins.
    """
    n = len(places)
    index = np.full(int(places[-1]) + 1, -1, dtype=np.int64)
    index[places] = np.arange(n)
    pairs = []  # (end, start) of windows that need no padding
    size = LEAST_WHOLE
    while size < window:
        back = places - size
        j = np.where(back >= 0, index[np.maximum(back, 0)], -1)
        found = np.flatnonzero(j >= 0)
        pairs.append(np.stack([found, j[found]], axis=1))
        size *= 2
    whole = np.concatenate(pairs)
    whole = whole[np.argsort(whole[:, 0], kind="stable")]
    ends, begins, w = [*whole[:, 0].tolist(), n], whole[:, 1].tolist(), 0
    at, extra = places.tolist(), (penalty + PER_SEQUENCE).tolist()
    cost, start = [0.0] * n, [-1] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (cost + place, index), values ascending
    next_end = ends[0]
    for i in range(1, n):
        p = at[i]
        while at[queue[0][1]] < p - window:
            queue.popleft()
        value, j = queue[0]
        value += window - p
        while next_end == i:
            if cost[begins[w]] < value:
                j = begins[w]
                value = cost[j]
            w += 1
            next_end = ends[w]
        value += extra[i]
        cost[i], start[i] = value, j
        value += p
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, i))
    cuts, i = [], n - 1
    while i > 0:
        cuts.append(at[i])
        i = start[i]
    return cuts[::-1]


def pack_block(doc_ids: list, parts: list[np.ndarray], first_sequence: int, ends: np.ndarray, window: int) -> dict:
    """The pieces of one block as columns."""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    ids = np.concatenate(parts)
    doc_ends = np.cumsum(lengths)
    places, penalty = cut_places(ids, doc_ends, ends)
    cuts = np.array(best_cuts(places, penalty, window), dtype=np.int64)
    stops = np.union1d(cuts, doc_ends)
    starts = np.concatenate([[0], stops[:-1]])
    doc = np.searchsorted(doc_ends, starts, side="right")
    sequence = np.searchsorted(cuts, starts, side="right")
    sequence_start = np.concatenate([[0], cuts])[sequence]
    raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    return {
        "id": [doc_ids[i] for i in doc],
        "start": starts - (doc_ends - lengths)[doc],
        "length": stops - starts,
        "ids_crc32": np.array(crc, dtype=np.int64),
        "doc_tokens": lengths[doc],
        "sequence_id": first_sequence + sequence,
        "offset": starts - sequence_start,
        "n_sequences": len(cuts),
    }


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: Callable[[], Callable[[str], list[int]]] = public_byte_bpe,
    window: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
    end_token: int = END_TOKEN,
) -> DataFrame:
    """One row per piece: the document, where the piece starts in it, its length and checksum, sequence and offset.

    ``tokenizer`` makes the encoder once per task. ``start`` counts the document's tokens before the piece.
    """
    if window & (window - 1) or window <= 4 * STRIDE:
        raise ValueError(f"window must be a power of two above {4 * STRIDE}")
    rows = docs.select(
        F.col(id_col),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.spark_partition_id().alias("_stream"),
    )
    id_type = rows.schema[0].dataType
    arrow_names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer()
        encoder, ends = WordEncoder(encode), sentence_ends(encode)
        keys, parts, tokens, sequence, key_type = [], [], 0, None, None

        def flush() -> pa.RecordBatch:
            nonlocal keys, parts, tokens, sequence
            out = pack_block(keys, parts, sequence, ends, window)
            sequence += out["n_sequences"]
            keys, parts, tokens = [], [], 0
            arrays = [pa.array(out["id"], type=key_type), *[pa.array(out[c], type=pa.int64()) for c in arrow_names]]
            return pa.RecordBatch.from_arrays(arrays, names=[id_col, *arrow_names])

        for batch in batches:
            key_type = batch.column(0).type
            for key, text, stream in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if sequence is None:
                    sequence = stream.as_py() << 32
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end_token))
                keys.append(key)
                parts.append(ids)
                tokens += len(ids)
                if tokens >= block_tokens:
                    yield flush()
        if keys:
            yield flush()

    ship_package()
    name = f"`{id_col}`"
    return rows.mapInArrow(run, f"{name} {id_type.simpleString()}, {PIECE_SCHEMA}")
