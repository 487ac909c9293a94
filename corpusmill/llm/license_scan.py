"""License scans by conditional compression.

1. Words are runs of ASCII letters and digits, lower-cased, wherever lines end. Where ``SHINGLE`` consecutive words of a
   text occur in a template in this order, the template may stand there; places that agree on where it would begin are
   one block, from the first to the last of them and, on either side, a few of the words that the template has
   there. Of blocks that cover one another for the most part the longest stays. A text without such words has no
   candidates.
2. A block is compressed alone and with every template as a raw zstandard dictionary. Templates are ranked by the share
   of the block's compressed size that they save.
3. They are confirmed by the exact wording, in this order, as long as they save ``LEAST_SAVING``: the first of which at
   most ``MOST_CHANGED`` of the words are to be inserted, deleted or replaced to find it in the block, which may
   have further words before and after, is the winner. Its differences are listed word by word. If there is none, the
   first of the ranking is given, not confirmed.

Texts stay in their rows and only blocks leave them, short ones; the search for shared words runs over whole Arrow batches
in arrays, the rest over the few texts that have some. Defined results: null and empty texts have no blocks; equal
savings go to the template whose name is first; repeated rows give repeated results; an empty table an empty one. Only
the id and text columns are read.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.license_texts import TEMPLATES
from corpusmill.llm.words import arrow_words, parts
from corpusmill.session import ship_package

SHINGLE = 3
LEAST_SAVING, MOST_CHANGED = 0.2, 0.25
LEVEL = 19
# How far apart, in words, two places may put a template's beginning and still agree on it; a share and a least number.
DRIFT, LEAST_DRIFT = 0.25, 2
PART_BYTES, CACHED = 4 << 20, 50_000
RESULT = (
    "block_no int, start int, end int, block string, template string, saving double, changed_words int, "
    "template_words int, confirmed boolean, changes string"
)


def words(text: str) -> list[str]:
    return re.findall(r"[A-Za-z0-9]+", text.lower() if text.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), text))


def plain(text: str) -> bytes:
    """What is compressed: line ends and case are not wording, and would only hide it."""
    return re.sub(r"\s+", " ", text).lower().encode()


def word_changes(block: list[str], template: list[str]) -> int:
    """Least number of words to insert, delete or replace, with free words before and after the template."""
    wanted, place = np.array(template), np.arange(len(template) + 1)
    row = place.copy()
    best = len(template)
    for word in block:
        step = row + 1
        step[0] = 0
        np.minimum(step[1:], row[:-1] + (wanted != word), out=step[1:])
        # A word of the template that the block lacks costs one more than what came before it.
        row = np.minimum.accumulate(step - place) + place
        best = min(best, int(row[-1]))
    return best


def differences(block: list[str], template: list[str]) -> str:
    """The template's words that are missing (-) and those in their place (+), without what surrounds the template."""
    steps = difflib.SequenceMatcher(None, template, block, autojunk=False).get_opcodes()
    out = []
    for kind, a, b, c, d in steps:
        around = kind == "insert" and a in (0, len(template))
        if kind != "equal" and not around:
            out.append(" ".join([*(f"-{w}" for w in template[a:b]), *(f"+{w}" for w in block[c:d])]))
    return "; ".join(out)


@dataclass
class Verdict:
    template: str
    saving: float
    changed: int
    wanted: int
    confirmed: bool
    changes: str


class Scanner:
    """Finds blocks that may hold a template, and tells which one by compression and wording."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES):
        import zstandard as z

        settings = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.templates = dict(sorted(templates.items()))
        self.words = {name: words(text) for name, text in self.templates.items()}
        self.plain = z.ZstdCompressor(level=LEVEL, **settings)
        self.by_name = {
            name: z.ZstdCompressor(
                level=LEVEL, dict_data=z.ZstdCompressionDict(plain(text), dict_type=z.DICT_TYPE_RAWCONTENT), **settings
            )
            for name, text in self.templates.items()
        }
        self.shingles: dict[tuple, list[tuple[str, int]]] = {}
        for name, own in self.words.items():
            for k in range(len(own) - SHINGLE + 1):
                self.shingles.setdefault(tuple(own[k : k + SHINGLE]), []).append((name, k))
        self.vocabulary = pa.array(sorted({w for own in self.words.values() for w in own}), pa.string())
        number = {w: k + 1 for k, w in enumerate(self.vocabulary.to_pylist())}
        self.keys = np.array(sorted(self._key(np.array([[number[w] for w in s] for s in self.shingles]).T)))
        self.known: dict[str, Verdict] = {}

    def _key(self, numbers: np.ndarray) -> np.ndarray:
        base = len(self.vocabulary) + 1
        out = np.zeros(numbers.shape[1], np.int64)
        for row in numbers:
            out = out * base + row
        return out

    def with_shared_words(self, texts: pa.Array) -> np.ndarray:
        """Numbers of the texts in which some consecutive words occur in a template."""
        tokens, counts = arrow_words(pc.ascii_lower(texts), "[^a-z0-9]+")
        ends = np.cumsum(counts)
        number = pc.fill_null(pc.index_in(tokens, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False) + 1
        n = max(len(number) - SHINGLE + 1, 0)
        rows = np.stack([number[k : k + n] for k in range(SHINGLE)]).astype(np.int64)
        key = self._key(rows)
        at = np.searchsorted(self.keys, key)
        hit = np.flatnonzero((rows > 0).all(axis=0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key))
        text = np.searchsorted(ends, hit, side="right")
        return np.unique(text[np.searchsorted(ends, hit + SHINGLE - 1, side="right") == text])

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the blocks in the text, by start."""
        found = [(m[0].lower(), m.start(), m.end()) for m in re.finditer("[A-Za-z0-9]+", text)]
        own = [w for w, *_ in found]
        begins: dict[str, list[tuple[int, int]]] = {}
        for i in range(len(own) - SHINGLE + 1):
            for name, k in self.shingles.get(tuple(own[i : i + SHINGLE]), ()):
                begins.setdefault(name, []).append((i - k, i))
        ranges = set()
        for name, places in begins.items():
            size = len(self.words[name])
            drift = max(LEAST_DRIFT, int(DRIFT * size))
            places.sort()
            first = 0
            for k in range(1, len(places) + 1):
                if k == len(places) or places[k][0] - places[k - 1][0] > drift:
                    group = places[first:k]
                    low, high = min(i for _, i in group), max(i for _, i in group) + SHINGLE
                    spare = max(LEAST_DRIFT, int(DRIFT * (high - low)))
                    begin, end = min(b for b, _ in group), max(b for b, _ in group) + size
                    ranges.add((max(min(low, begin), low - spare, 0), min(max(high, end), high + spare, len(own))))
                    first = k
        kept: list[tuple[int, int]] = []
        for low, high in sorted(ranges, key=lambda r: (r[0] - r[1], r)):
            if all(2 * (min(high, h) - max(low, lo)) <= high - low for lo, h in kept):
                kept.append((low, high))
        return sorted((found[low][1], found[high - 1][2]) for low, high in kept)

    def savings(self, block: str) -> list[tuple[float, str]]:
        """(share saved, template), the largest first."""
        raw = plain(block)
        alone = len(self.plain.compress(raw))
        found = [((alone - len(c.compress(raw))) / alone, name) for name, c in self.by_name.items()]
        return sorted(found, key=lambda f: (-f[0], f[1]))

    def judge(self, block: str) -> Verdict:
        if block not in self.known:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[block] = self._judged(block)
        return self.known[block]

    def _judged(self, block: str) -> Verdict:
        own, first = words(block), None
        for saving, name in self.savings(block):
            wanted = self.words[name]
            # Less words than the template needs cannot confirm it, whatever they are.
            short = len(wanted) - len(own) > MOST_CHANGED * len(wanted)
            if first is not None and (short or saving < LEAST_SAVING):
                continue
            changed = word_changes(own, wanted)
            if saving >= LEAST_SAVING and changed <= MOST_CHANGED * len(wanted):
                return Verdict(name, saving, changed, len(wanted), True, differences(own, wanted))
            first = first or Verdict(name, saving, changed, len(wanted), False, "")
        return first


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """One row per block: id, ``block_no``, its place and text, the winning template and how its wording differs."""
    templates = dict(templates)
    kind = docs.schema[id_col].dataType.simpleString()
    columns = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.string()), "")
            for cut in parts(texts, PART_BYTES):
                rows, owner = [], []
                piece = texts.slice(cut.start, cut.stop - cut.start)
                for k in scanner.with_shared_words(piece).tolist():
                    text = piece[k].as_py()
                    for number, (start, end) in enumerate(scanner.blocks(text)):
                        v = scanner.judge(text[start:end])
                        rows.append((number, start, end, text[start:end], v.template, v.saving, v.changed, v.wanted, v.confirmed, v.changes))
                        owner.append(cut.start + k)
                arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), *arrays], names=["id", *names])

    ship_package()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {RESULT}")
    return found.withColumnRenamed("id", id_col)
