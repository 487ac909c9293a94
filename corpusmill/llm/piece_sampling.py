"""Encoding and decoding with a piece model: distinct sampled segmentations by Gumbel top-k.

The lattice of a text has an edge for every piece of the model at every place; characters without a piece are spelt in
bytes. As no piece continues over a word's beginning, it is a chain of the words' lattices. An edge weighs
``(rank + 2) ** -sharpness`` by its piece's rank in the model, and a segmentation's probability is proportional to the
product of its edges' weights, by exact sums over each lattice.

Sampling without replacement is an A* search over prefixes with perturbed bounds: the best segmentation below a
prefix has a Gumbel value located at the prefix's log probability. A prefix and the segmentations that leave it form a
tree; going down a sampled path, every place leaves behind one open node for the edges not taken, whose value is a
Gumbel of their joint probability, truncated at the value of its parent. The open node of largest value is expanded
next, so segmentations come out in falling order of their perturbed log probability and never twice. The value of the
best open node after ``k`` is the threshold of the inclusion scores ``1 - exp(-exp(log p - threshold))``.

Random numbers are seeded by the row's key. Defined results: a null or empty text has one segmentation without
pieces, with probability 1; a text with fewer than ``k`` segmentations gives all of them, with score 1; rows with equal
keys and texts give equal samples; an empty table an empty result. Only the named columns are read.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.session import ship_package

SPACE = "▁"
SHARPNESS, SAMPLES = 1.0, 3
# Rows whose lattices are laid out and searched together: a group ends at so many characters; a row is never split.
GROUP_CHARS = 400_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class PieceModel(NamedTuple):
    """Pieces as a trie: sorted keys ``node << 21 | character`` with the node that follows, and per node the
    piece's id (-1: none) and log weight; ids of the 256 byte pieces; the longest piece's length."""

    keys: np.ndarray
    following: np.ndarray
    piece: np.ndarray
    weight: np.ndarray
    bytes: list[int]
    byte_weight: float
    longest: int
    spelling: list[bytes]


@functools.lru_cache(2)
def public_pieces(sharpness: float = SHARPNESS) -> PieceModel:
    """The public 32k piece model of the tokenizer package installed on the executors."""
    import public_tokenizers

    return read_model(public_tokenizers.path("piece_bpe_32k.model"), sharpness)


def read_model(path: str, sharpness: float = SHARPNESS) -> PieceModel:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    spelt = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    spelling = [b""] * p.get_piece_size()
    for b, i in enumerate(spelt):
        spelling[i] = bytes([b])
    edges: dict[int, int] = {}
    ends: dict[int, int] = {}
    for i in plain:
        node = 0
        for c in p.id_to_piece(i):
            node = edges.setdefault(node << 21 | ord(c), len(edges) + 1)
        ends[node] = i
        spelling[i] = p.id_to_piece(i).encode()
    keys = np.array(sorted(edges), np.int64)
    piece, weight = np.full(len(edges) + 1, -1, np.int32), np.zeros(len(edges) + 1)
    for node, i in ends.items():
        piece[node], weight[node] = i, -sharpness * math.log(2 - p.get_score(i))
    longest = max(len(p.id_to_piece(i)) for i in plain)
    following = np.array([edges[key] for key in keys.tolist()], np.int64)
    return PieceModel(keys, following, piece, weight, spelt, float(weight[list(ends)].min()), longest, spelling)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: 64 well spread bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lattices:
    """The lattices of several words, each word once.

    Places are numbered by their distance from their word's end, so that the sums over the ways from each place to
    the end are taken for all words together, one distance at a time. ``starts`` has each word's first place and
    ``n`` stands for every end. Place ``i`` has the edges ``first[i]`` to ``first[i + 1]``; an edge has ``target``,
    ``log_p`` given its place, and its ids at ``id_at`` of ``ids``, ``n_ids`` of them.
    """

    def __init__(self, words: list[str], model: PieceModel):
        lengths = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.n = n = len(chars)
        ends = np.cumsum(lengths)
        to_end = np.repeat(ends, lengths) - np.arange(n)
        at, node = np.arange(n), np.zeros(n, np.int64)
        starts, sizes, nodes = [], [], []
        for length in range(1, model.longest + 1):
            key = node << 21 | chars[at + length - 1]
            k = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
            hit = model.keys[k] == key
            at, node = at[hit], model.following[k[hit]]
            whole = model.piece[node] >= 0
            starts.append(at[whole])
            sizes.append(np.full(len(starts[-1]), length))
            nodes.append(node[whole])
            more = to_end[at] > length
            at, node = at[more], node[more]
        unknown = np.ones(n, bool)
        unknown[starts[0]] = False
        spelt = np.flatnonzero(unknown)
        start = np.concatenate([*starts, spelt])
        size = np.concatenate([*sizes, np.ones(len(spelt), np.int64)])
        node = np.concatenate([*nodes, np.full(len(spelt), -1)])
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[spelt].tolist()]
        n_ids = np.concatenate([np.ones(len(start) - len(spelt), np.int64), np.array([len(r) for r in raw], np.int64)])
        weight = np.where(node >= 0, model.weight[node], model.byte_weight * n_ids)
        self.ids = np.concatenate(
            [model.piece[node[: len(start) - len(spelt)]], np.array([model.bytes[b] for r in raw for b in r], np.int32)]
        ).astype(np.int32)
        id_at = np.cumsum(n_ids) - n_ids

        by_distance = np.argsort(to_end, kind="stable")
        number = np.empty(n + 1, np.int64)
        number[by_distance] = np.arange(n)
        self.starts = number[ends - lengths]
        self.number, self.begins = number, ends - lengths
        order = np.lexsort((size, number[start]))
        start, size, weight = start[order], size[order], weight[order]
        self.n_ids, self.id_at = n_ids[order], id_at[order]
        self.target = np.where(size < to_end[start], number[start + size], n)
        counts = np.bincount(number[start], minlength=n)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        total, self.log_p = np.zeros(n + 1), np.empty(len(start))
        levels = np.concatenate([[0], np.cumsum(np.bincount(to_end, minlength=1)[1:])])
        for lo, hi in zip(levels[:-1].tolist(), levels[1:].tolist(), strict=True):
            e, f = self.first[lo], self.first[hi]
            way, inner = weight[e:f] + total[self.target[e:f]], self.first[lo:hi] - e
            top = np.maximum.reduceat(way, inner)
            total[lo:hi] = top + np.log(np.add.reduceat(np.exp(way - np.repeat(top, counts[lo:hi])), inner))
            self.log_p[e:f] = way - np.repeat(total[lo:hi], counts[lo:hi])

        # Cumulated shares in 32 bits below the place's number: one sorted array serves the draws at all places.
        share = np.exp(self.log_p)
        rank = np.arange(len(start)) - np.repeat(self.first[:-1], counts)
        for k in range(1, int(counts.max(initial=0))):
            e = np.flatnonzero(rank == k)
            share[e] += share[e - 1]
        limit = np.minimum(share * 2.0**32, 2.0**32 - 1).astype(np.uint64)
        limit[self.first[1:] - 1] = np.uint64(2**32 - 1)
        self.thresholds = np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(32), counts) | limit

    def walk(self, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples a way from each place to its word's end; (walker, edge) of every step, in the walkers' order."""
        walker, walkers, edges, step = np.arange(len(place)), [], [], 0
        while len(walker):
            draw = mixed(seed + np.array([step], np.uint64) * GOLDEN) >> np.uint64(32)
            edge = np.searchsorted(self.thresholds, place.astype(np.uint64) << np.uint64(32) | draw)
            walkers.append(walker)
            edges.append(edge)
            place = self.target[edge]
            on = place < self.n
            walker, place, seed, step = walker[on], place[on], seed[on], step + 1
        if not walkers:
            return walker, walker
        walker = np.concatenate(walkers)
        order = np.argsort(walker, kind="stable")
        return walker[order], np.concatenate(edges)[order]

    def ids_of(self, path: np.ndarray) -> np.ndarray:
        n_ids = self.n_ids[path]
        within = np.arange(n_ids.sum()) - np.repeat(np.cumsum(n_ids) - n_ids, n_ids)
        return self.ids[np.repeat(self.id_at[path], n_ids) + within]

    def places(self, word: int, length: int) -> list[tuple[list[float], list[tuple[int, tuple[int, ...], float]]]]:
        """A word's places from its beginning: cumulated shares and edges (next place, ids, log probability)."""
        at = self.number[self.begins[word] : self.begins[word] + length]
        index = {int(p): i for i, p in enumerate(at)} | {self.n: length}
        out = []
        for place in at:
            edges = range(self.first[place], self.first[place + 1])
            found = [(index[int(self.target[e])], tuple(self.ids_of(np.array([e])).tolist()), float(self.log_p[e])) for e in edges]
            out.append((np.cumsum(np.exp(self.log_p[edges.start : edges.stop])).tolist(), found))
        return out


class Places(NamedTuple):
    places: list


class Search:
    """One text's search: its open nodes (value, ticket, path, step, edges excluded there, log p before it)."""

    def __init__(self, chain: np.ndarray, seed: int, k: int):
        self.chain, self.k = chain, k
        self.rng = np.random.default_rng([seed & 0xFFFFFFFF, (seed >> 32) & 0xFFFFFFFF])
        self.seed = np.uint64(seed)
        self.opened: list[tuple] = []
        self.found: list[tuple[np.ndarray, float, float]] = []
        self.ticket = 0
        root = -math.log(-math.log(self.rng.random()))
        none = np.empty(0, np.int64)
        # The path that the next descent completes: edges, their words, log p, value; the word and place it goes on at.
        self.pending = (none, none, 0.0, root, 0, None)

    def put(self, value: float, path: tuple, step: int, excluded: tuple, before: float) -> None:
        self.ticket += 1
        heapq.heappush(self.opened, (-value, self.ticket, path, step, excluded, before))

    def going(self) -> bool:
        return self.pending is not None

    def walkers(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and seeds of the words that are still to be walked."""
        *_, word, place = self.pending
        places = self.chain[word:]
        if place is not None:
            places = places.copy()
            places[0] = place
        sample = mixed(self.seed + np.array([len(self.found) + 1], np.uint64) * GOLDEN)
        return places, mixed(sample + np.arange(word, len(self.chain), dtype=np.uint64) * GOLDEN)

    def descended(self, lattices: Lattices, words: np.ndarray, edges: np.ndarray) -> None:
        """Takes the walked end of the pending path, opens nodes for the edges not taken, and chooses what is next."""
        old_edges, old_words, log_p, value, first_word, _ = self.pending
        path = np.concatenate([old_edges, edges]), np.concatenate([old_words, words + first_word])
        if len(edges):
            lp = lattices.log_p[edges]
            before = log_p + np.concatenate([[0.0], np.cumsum(lp)[:-1]])
            rest = -np.expm1(lp)
            with np.errstate(divide="ignore"):
                place = before + np.log(np.where(rest > 1e-12, rest, 0.0))
                values = place - np.log(np.exp(place - value) - np.log(self.rng.random(len(lp))))
            # Only as many open nodes can be expanded as samples are still wanted, and one for the threshold.
            for s in np.argsort(-values, kind="stable")[: self.k + 1 - len(self.found)].tolist():
                if values[s] > -math.inf:
                    self.put(float(values[s]), path, len(old_edges) + s, (int(edges[s]),), float(before[s]))
            log_p += float(lp.sum())
        self.found.append((path[0], log_p, value))
        self.pending = self.next_path(lattices) if len(self.found) < self.k and self.opened else None

    def next_path(self, lattices: Lattices) -> tuple:
        negative, _, path, step, excluded, before = heapq.heappop(self.opened)
        taken, word = int(path[0][step]), int(path[1][step])
        place = np.searchsorted(lattices.first, taken, side="right") - 1
        left = [e for e in range(lattices.first[place], lattices.first[place + 1]) if e not in excluded]
        shares = np.exp(lattices.log_p[left])
        cumulated = np.cumsum(shares / shares.sum())
        e = left[min(int(np.searchsorted(cumulated, self.rng.random(), side="right")), len(left) - 1)]
        log_p = float(lattices.log_p[e])
        remaining = float(shares.sum()) - math.exp(log_p)
        if len(left) > 1 and remaining > 1e-300:
            at = before + math.log(remaining)
            value = at - math.log(math.exp(at + negative) - math.log(self.rng.random()))
            self.put(value, path, step, (*excluded, e), before)
        after = int(lattices.target[e])
        on = (word, after) if after < lattices.n else (word + 1, None)
        edges, words = np.append(path[0][:step], e), np.append(path[1][:step], word)
        return edges, words, before + log_p, -negative, *on

    def results(self, lattices: Lattices) -> list[tuple[np.ndarray, float, float, float]]:
        threshold = -self.opened[0][0] if self.opened else -math.inf
        score = lambda p: 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(p - threshold, 700.0)))
        return [(lattices.ids_of(path), p, value, score(p)) for path, p, value in self.found]


def words_of(text: str) -> list[str]:
    return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE)) if text else []


class Sampler:
    def __init__(self, model: PieceModel):
        self.model = model

    def lattices(self, text: str) -> list[Places]:
        """The lattice of each word of a text, to look at."""
        words = words_of(text)
        made = Lattices(words, self.model)
        return [Places(made.places(i, len(w))) for i, w in enumerate(words)]

    def sample(self, text: str, k: int, seed: int) -> list[tuple[np.ndarray, float, float, float]]:
        """Up to ``k`` distinct (ids, log probability, perturbed log probability, inclusion score), best first."""
        return self.sample_all([text], k, [seed])[0]

    def sample_all(self, texts: list[str], k: int, seeds: list[int]) -> list[list[tuple]]:
        """The samples of several texts, whose searches take their steps together."""
        known: dict[str, int] = {}
        numbers = [[known.setdefault(w, len(known)) for w in words_of(text)] for text in texts]
        lattices = Lattices(list(known), self.model) if known else None
        searches = [Search(lattices.starts[n], seed, k) if n else None for n, seed in zip(numbers, seeds, strict=True)]
        active = [s for s in searches if s is not None]
        while active:
            places, walk_seeds = zip(*[s.walkers() for s in active], strict=True)
            walker, edge = lattices.walk(np.concatenate(places), np.concatenate(walk_seeds))
            base = np.concatenate([[0], np.cumsum([len(p) for p in places])])
            cut = np.searchsorted(walker, base)
            for s, first, lo, hi in zip(active, base[:-1], cut[:-1], cut[1:], strict=True):
                s.descended(lattices, walker[lo:hi] - first, edge[lo:hi])
            active = [s for s in active if s.going()]
        nothing = [(np.empty(0, np.int32), 0.0, 0.0, 1.0)]
        return [nothing if s is None else s.results(lattices) for s in searches]


def decode(ids: list[int], model: PieceModel) -> str:
    """The text of a segmentation; bytes that are no UTF-8 become replacement characters."""
    text = b"".join(map(model.spelling.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``GROUP_CHARS`` characters, one row at least."""
    first, size = 0, 0
    for r, text in enumerate(texts):
        size += len(text.as_py())
        if size >= GROUP_CHARS:
            yield first, r + 1
            first, size = r + 1, 0
    if first < len(texts):
        yield first, len(texts)


def sample_segmentations(
    rows: DataFrame,
    key_cols: list[str],
    text_col: str = "text",
    k: int = SAMPLES,
    seed: int = 0,
    model: Callable[[], PieceModel] = public_pieces,
) -> DataFrame:
    """Per row and sample: the key, ``sample_no`` from 0, ``ids``, ``log_prob``, ``perturbed`` and ``inclusion``."""
    keyed = rows.select(
        *key_cols,
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]).alias("_seed"),
    )
    n_keys = len(key_cols)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema[:n_keys])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(model())
        names = [*key_cols, "sample_no", "ids", "log_prob", "perturbed", "inclusion"]
        for batch in batches:
            for first, end in groups(batch.column(n_keys)):
                part = batch.slice(first, end - first)
                seeds = [x % (1 << 64) for x in part.column(n_keys + 1).to_pylist()]
                found = sampler.sample_all(part.column(n_keys).to_pylist(), k, seeds)
                flat = [x for samples in found for x in samples]
                counts = [len(samples) for samples in found]
                rows_of = pa.array(np.repeat(np.arange(len(found)), counts))
                keys = [part.column(c).take(rows_of) for c in range(n_keys)]
                number = pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in counts]))
                offsets = np.concatenate([[0], np.cumsum([len(x[0]) for x in flat])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([x[0] for x in flat])))
                scores = [pa.array([x[c] for x in flat], pa.float64()) for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([*keys, number, ids, *scores], names=names)

    ship_package()
    return keyed.mapInArrow(
        run, f"{key_schema}, sample_no int, ids array<int>, log_prob double, perturbed double, inclusion double"
    )


def decode_segmentations(rows: DataFrame, ids_col: str = "ids", model: Callable[[], PieceModel] = public_pieces) -> DataFrame:
    """The rows with ``decoded``, the text of their ``ids``; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = model()
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            texts = [None if x is None else decode(x, made) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    ship_package()
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema)
