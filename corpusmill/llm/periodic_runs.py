"""Periodic runs of words in texts, found on a grammar of the text.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST_WORDS`` long and ``LEAST_PERIODS``
times q, that no neighbouring word extends.

1. Re-Pair over the word ids of each text, in rounds: repeated pairs are ranked by frequency, and an occurrence becomes a
   new nonterminal where its pair outranks the pairs that overlap it, so a round replaces a text's most frequent pair
   everywhere and others beside it. It ends when no pair repeats. What remains is joined by a balanced tree.
2. Every nonterminal is looked at once, at its first place in the text: which runs cross the boundary between its two
   halves? Such a run repeats, its period further on or back, the eight words on one side of the boundary; places of
   equal eight words are the candidates. Their extents inside the nonterminal follow from the longest common extensions
   of the words there and one period further, read off ranks of doubled blocks, so they are exact.
3. A run found in a nonterminal is translated to all places at which the grammar derives it, and stretches of one period
   that lie inside another are merged into it. What is left is maximal in the text.

Texts never leave their row: nothing is shuffled. Texts of up to ``PART_BYTES`` together are worked on in arrays at
once; a longer text is worked on alone, in space and time of its length times its logarithm.

Defined results: null, empty and word-less texts have no words and no runs; repeated rows and ids give a row each; of
several periods of one stretch the smallest counts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import arrow_words, parts
from corpusmill.session import ship_package

# Fixed by the contract.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# A run repeats at least so many consecutive words after one period; half of them lie on one side of any boundary.
ANCHOR = (LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS) // 2
PART_BYTES = 4 << 20
CANDIDATES = 1 << 21


@dataclass
class Grammar:
    """Nonterminals by their first place [lo, hi) and boundary, and every further place at which each is derived."""

    lo: np.ndarray
    cut: np.ndarray
    hi: np.ndarray
    rule: np.ndarray  # of each place, ascending
    place: np.ndarray


def _coded(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense numbers of equal values, and how many there are."""
    encoded = pa.array(values).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(encoded.dictionary)


def _repair(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
    """Re-Pair of texts whose words are unlike those of other texts.

    Per round the rules (lo, cut, hi) with their places as (rule in round, place); and the starts of the symbols left.
    """
    at = np.arange(len(words))
    symbol, size = words.astype(np.int64), np.ones(len(words), np.int64)
    text = np.repeat(np.arange(len(starts)), ends - starts)
    n_symbols = int(symbol.max(initial=-1)) + 1
    alive = np.ones(len(words), bool)
    rounds, done = [], []
    while len(symbol):
        follows = np.append(text[1:] == text[:-1], False)
        nxt = np.append(symbol[1:], -1)
        equal = follows & (symbol == nxt)
        # In a stretch of one symbol every second pair is an occurrence, from its beginning on.
        index = np.arange(len(symbol))
        begin = np.maximum.accumulate(np.where(np.append(False, equal[:-1]), 0, index))
        odd = equal & ((index - begin) % 2 == 1)
        chosen = np.flatnonzero(follows & ~odd & (alive | equal))
        code, n_codes = _coded(symbol[chosen] * n_symbols + nxt[chosen])
        count = np.bincount(code, minlength=n_codes)
        order = np.argsort(count, kind="stable")
        rank = np.empty(n_codes, np.int64)
        rank[order] = np.arange(1, n_codes + 1)
        height = np.zeros(len(symbol) + 2, np.int64)
        height[chosen + 1] = np.where(count[code] > 1, rank[code], 0)
        here = height[1:-1]
        top = (here > 0) & (here > height[:-2]) & (here > height[2:])
        pair = np.full(len(symbol), -1)
        pair[chosen] = code
        times = np.bincount(pair[top], minlength=n_codes)
        top[top] = times[pair[top]] > 1
        first = np.flatnonzero(top)
        # Texts without a repeated pair are done.
        busy = np.zeros(len(starts), bool)
        busy[text[first]] = True
        new, n_new = _coded(pair[first])
        whole = size[first] + size[first + 1]
        lead = np.full(n_new, -1)
        lead[new[::-1]] = np.arange(len(first))[::-1]
        lo = at[first[lead]]
        rounds.append((lo, lo + size[first[lead]], lo + whole[lead], new, at[first]))
        fresh = np.zeros(len(symbol), bool)
        fresh[first] = True
        symbol[first], size[first] = n_symbols + new, whole
        n_symbols += n_new
        gone = np.zeros(len(symbol), bool)
        gone[first + 1] = True
        touched = fresh | np.append(fresh[1:], False)
        # The symbol before a replaced pair meets a new neighbour, as does the one after it.
        alive = (here > 0) | touched
        keep = ~gone
        finished = keep & ~busy[text]
        done.append(at[finished])
        keep &= busy[text]
        symbol, size, at, text, alive = symbol[keep], size[keep], at[keep], text[keep], alive[keep]
    return rounds, np.sort(np.concatenate([np.zeros(0, np.int64), *done]))


def grammar(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of texts standing at [start, end); words are numbered per text."""
    rounds, left = _repair(words, starts, ends)
    lows, cuts, highs, rules, places, n = [], [], [], [], [], 0
    for lo, cut, hi, rule, place in rounds:
        order = np.argsort(rule, kind="stable")
        lows.append(lo), cuts.append(cut), highs.append(hi), rules.append(rule[order] + n), places.append(place[order])
        n += len(lo)
    # The balanced tree over the symbols that are left: blocks of 1, 2, 4, ... of them meet the block after.
    text = np.searchsorted(starts, left, side="right") - 1
    first = np.searchsorted(left, starts)
    count = np.searchsorted(left, ends) - first
    number = np.arange(len(left)) - first[text]
    block = 1
    while block < count.max(initial=0):
        mid = np.flatnonzero(number % (2 * block) == block)
        beyond = number[mid] + block >= count[text[mid]]
        after = np.where(beyond, 0, mid + block)
        lo = left[mid - block]
        lows.append(lo), cuts.append(left[mid]), highs.append(np.where(beyond, ends[text[mid]], left[after]))
        rules.append(n + np.arange(len(mid))), places.append(lo)
        n += len(mid)
        block *= 2
    join = lambda arrays: np.concatenate([np.zeros(0, np.int64), *arrays])
    return Grammar(join(lows), join(cuts), join(highs), join(rules), join(places))


class Extensions:
    """Longest common extensions inside some of the texts, by exact ranks of blocks of doubled length."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray, longest: int):
        self.starts, sizes = starts, (ends - starts)[chosen]
        # The chosen texts one after another, and how far each has moved.
        begins = np.cumsum(sizes) - sizes
        self.moved = np.zeros(len(starts), np.int64)
        self.moved[chosen] = starts[chosen] - begins
        n = int(sizes.sum())
        self.start, end = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
        index = np.arange(n)
        self.ranks, width = [words[index + np.repeat(self.moved[chosen], sizes)].astype(np.int64)], 1
        while 2 * width <= longest:
            below = self.ranks[-1]
            held = np.flatnonzero(index + 2 * width <= end)
            rank = -1 - index
            rank[held] = _coded(below[held] * n + below[held + width])[0]
            self.ranks.append(rank)
            width *= 2

    def _placed(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        moved = self.moved[np.searchsorted(self.starts, i, side="right") - 1]
        return i - moved, j - moved

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i before j, both before the text's end or at it)."""
        n = len(self.start)
        i, j = self._placed(i, j)
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            rank, a, b = self.ranks[k], i + length, j + length
            inside = b < n
            same = np.zeros(len(i), bool)
            same[inside] = rank[a[inside]] == rank[b[inside]]
            length[same] += 1 << k
        return length

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to i equal those up to j, both exclusive."""
        i, j = self._placed(i, j)
        length = np.zeros(len(i), np.int64)
        low = self.start[np.minimum(i, len(self.start) - 1)]
        for k in reversed(range(len(self.ranks))):
            a, b = i - length - (1 << k), j - length - (1 << k)
            inside = a >= low
            same = np.zeros(len(i), bool)
            same[inside] = self.ranks[k][a[inside]] == self.ranks[k][b[inside]]
            length[same] += 1 << k
        return length


def _anchors(words: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal stretches of ``ANCHOR`` words: each place's group, -1 where none is equal, and places by group.

    Stretches are told apart by a hash: equal ones always share a group, and what unlike ones add is tested exactly.
    """
    n = len(words)
    state = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    state ^= state >> np.uint64(29)
    width = 1
    while width < ANCHOR:
        state = state * np.uint64(0xBF58476D1CE4E5B9) + np.concatenate([state[width:], np.zeros(min(width, n), np.uint64)])
        state ^= state >> np.uint64(31)
        width *= 2
    held = np.flatnonzero(np.arange(n) + width <= np.repeat(ends, ends - starts))
    code, n_codes = _coded(state[held].view(np.int64))
    repeated = np.bincount(code, minlength=n_codes)[code] > 1
    held, code = held[repeated], code[repeated]
    order = np.argsort(code, kind="stable")
    group = np.full(n, -1)
    group[held] = code
    return group, code[order], held[order]


@dataclass
class Repeats:
    """Nonterminals with anchors beside their boundary that repeat in reach: where, and their equals' range in ``held``."""

    node: np.ndarray
    place: np.ndarray
    low: np.ndarray
    times: np.ndarray
    held: np.ndarray

    def periods(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate periods (nonterminal, period) of runs that cross a boundary, a bounded number at a time."""
        total = np.cumsum(self.times)
        for at in range(0, int(total[-1]) if len(total) else 0, CANDIDATES):
            number = np.arange(at, min(at + CANDIDATES, int(total[-1])))
            row = np.searchsorted(total, number, side="right")
            period = np.abs(self.held[self.low[row] + number - (total - self.times)[row]] - self.place[row])
            apart = period > 0
            pair = np.unique(self.node[row][apart] * n + period[apart])
            yield pair // n, pair % n


def _repeats(g: Grammar, chosen: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Repeats:
    group, code, held = _anchors(words, ends, starts)
    n = len(words) + 1
    keys = code * n + held
    tested = []
    for shift in (0, -ANCHOR):
        place = g.cut[chosen] + shift
        inside = (place >= g.lo[chosen]) & (place + ANCHOR <= g.hi[chosen])
        node, place = chosen[inside], place[inside]
        known = group[place] >= 0
        node, place = node[known], place[known]
        longest = (g.hi[node] - g.lo[node]) // LEAST_PERIODS
        low = np.searchsorted(keys, group[place] * n + np.maximum(place - longest, g.lo[node]))
        high = np.searchsorted(keys, group[place] * n + np.minimum(place + longest, g.hi[node] - ANCHOR), side="right")
        # An anchor finds itself; only others tell a period.
        others = high - low > 1
        tested.append((node[others], place[others], low[others], (high - low)[others]))
    return Repeats(*(np.concatenate(c) for c in zip(*tested, strict=True)), held)


def _least_period(node: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Numbers of the rows that hold the smallest period of their stretch."""
    order = np.lexsort((period, end, start, node))
    same = np.ones(len(order), bool)
    same[1:] = (np.diff(node[order]) != 0) | (np.diff(start[order]) != 0) | (np.diff(end[order]) != 0)
    return order[same]


def find_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, ordered by start and period; words are numbered per text."""
    g = grammar(words, starts, ends)
    chosen = np.flatnonzero(g.hi - g.lo >= LEAST_WORDS)
    repeats = _repeats(g, chosen, words, starts, ends)
    texts = np.unique(np.searchsorted(starts, g.lo[repeats.node], side="right") - 1)
    longest = int((g.hi[repeats.node] - g.lo[repeats.node]).max(initial=0))
    extend, found = Extensions(words, starts, ends, texts, longest), [np.zeros((4, 0), np.int64)]
    for node, period in repeats.periods(len(words) + 1):
        for inner in (g.cut[node], g.cut[node] - period):
            fits = (inner >= g.lo[node]) & (inner + period < g.hi[node])
            fits[fits] = words[inner[fits]] == words[inner[fits] + period[fits]]
            x, q, i = node[fits], period[fits], inner[fits]
            start = np.maximum(i - extend.backward(i, i + q), g.lo[x])
            end = np.minimum(i + q + extend.forward(i, i + q), g.hi[x])
            long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
            x, start, end, q = x[long], start[long], end[long], q[long]
            least = _least_period(x, start, end, q)
            found.append(np.stack([x, start, end, q])[:, least])
    x, start, end, q = np.concatenate(found, axis=1)
    least = _least_period(x, start, end, q)
    x, start, end, q = x[least], start[least], end[least], q[least]
    # To every place of the nonterminal.
    first, last = np.searchsorted(g.rule, x), np.searchsorted(g.rule, x, side="right")
    times = last - first
    row = np.repeat(np.arange(len(x)), times)
    moved = g.place[np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)] - g.lo[x[row]]
    start, end, q = start[row] + moved, end[row] + moved, q[row]
    # Within another stretch of the same period.
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    shift = np.cumsum(np.append(0, np.diff(q) != 0))[: len(q)] * (len(words) + 1)
    reach = np.maximum.accumulate(end + shift)
    outer = np.ones(len(q), bool)
    outer[1:] = (end + shift)[1:] > reach[:-1]
    start, end, q = start[outer], end[outer], q[outer]
    least = _least_period(np.zeros(len(q), np.int64), start, end, q)
    start, end, q = start[least], end[least], q[least]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _collapsed(words: pa.Array, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> pa.Array:
    """The texts without the words that a run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change)[:-1] == 0
    before = np.concatenate([[0], np.cumsum(kept)])[offsets]
    lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def runs_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Per text its number of words, its runs and the collapsed text."""
    words, counts = arrow_words(texts)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    starts, ends = offsets[:-1][counts > 0], offsets[1:][counts > 0]
    code, _ = _coded(words.dictionary_encode().indices.to_numpy(zero_copy_only=False))
    own, _ = _coded(np.repeat(np.arange(len(counts)), counts) * (len(words) + 1) + code)
    start, end, period = find_runs(own, starts, ends)
    text = np.searchsorted(offsets, start, side="right") - 1
    listed = pa.StructArray.from_arrays(
        [pa.array(start - offsets[text]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
    )
    of_text = np.searchsorted(text, np.arange(len(counts) + 1))
    lists = pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), listed)
    return counts.astype(np.int64), lists, _collapsed(words, offsets, start, end, period)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``n_words``, ``runs`` (start, length, period by start and period) and ``collapsed`` text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.string())
            for cut in parts(texts, PART_BYTES):
                n = cut.stop - cut.start
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(cut.start, n), *map(pa.array, runs_of(texts.slice(cut.start, n)))],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    ship_package()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(
        run, f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return out.withColumnRenamed("id", id_col)
