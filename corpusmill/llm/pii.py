"""Personal data by candidate gradient boosting, with DataFrame functions only.

1. Base patterns give spans that always count.
2. Generators with high recall propose further, overlapping spans of each kind: obfuscated addresses, numbers without a
   country code, cards of other lengths, addresses with ports.
3. A candidate is a weakly labelled example: positive if its canonical form, the obfuscation undone, passes the kind's
   check (a known top-level domain, parts up to 255, the Luhn sum, a possible area and exchange) or a base span covers
   it. What the check looks at is never a feature; the features are its format and context, so the trees learn in which
   surroundings what looks like personal data checks out, and where it does so by chance.
4. Boosted trees of depth two are fitted per kind on the table of feature values and counts of all candidates. The table
   stays on the executors: a round adds up its gradients, and only sums per pair of feature values reach the driver.
5. A threshold per kind is calibrated on held-out documents: the lowest score from which at least ``PRECISION``
   of the held-out candidates are positive. A kind without such a score adds nothing. Candidates at or above it whose
   canonical form checks out are redacted as well, unless they overlap a span that is already there or have a feature
   value that was not seen ``LEAST_LEAF`` times in training.

Matches leave their document as rows (document, place, what stands beside it), written down once; places are running
sums, overlaps running maxima over the matches of a document in order, so a text with very many of them costs no more
than sorting them. Only documents with a match are shuffled, without their texts.

Defined results: null texts count as empty and have no spans; offsets are code points, the end exclusive; repeated
rows give repeated results; an empty table gives an empty result (no model is needed then). Only the id and text
columns are read, so others may have any name. Patterns are possessive and anchored at the start of a run, so that
very long texts and runs take linear time and no deep recursion.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.session import materialized

KINDS = ("email", "ip", "card", "phone")

# The base patterns in a form that gives the same matches in linear time: a run is entered at its start, or where the
# previous match ended. A digit comes first where one must, so that other characters are passed over at once.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?:(?<=\G[0-9])|(?<![0-9][0-9]))[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# How the at sign, the dot of a name and the dot of a number are obfuscated.
AT = r"(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)"
DOT = r"(?:\.|\x20?[(\[](?:dot|\.)[)\]]\x20?|\x20dot\x20)"
POINT = r"(?:[.:]|\x20?[(\[](?:dot|\.)[)\]]\x20?)"
GENERATORS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    "ip": rf"[0-9](?<![0-9.:][0-9])[0-9]*+(?:{POINT}[0-9]++){{3,4}}+(?![0-9])",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"[+(0-9](?<![0-9A-Za-z.+(][+(0-9])\(?[0-9]?(?:[\x20().-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])",
}
# Every match of the pattern holds one of these, so a text without them need not be searched.
HOLDS = {"base_email": ("@",), "wide_email": ("@", "at)", "at]", " at ")}
CONTEXT_WORD = r"(?i)(?:mail|call|phone|tel|fax|contact|card|visa|pay|host|server|address|ip)[a-z]*[\x20:.=#]{0,3}\z"
TOP_LEVEL = (
    "com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|co|me|tv|eu|us|uk|de|fr|es|it|nl|be|ch|at|se|no|dk|fi|pl|cz|pt"
    "|ie|ru|ua|tr|in|cn|jp|kr|au|nz|ca|mx|br|ar|cl|za|example|test|invalid|localhost"
)

# Feature names and how many values each can take after bucketing.
BUCKETS = {
    "length": 6, "digits": 8, "separators": 5, "groups": 6, "parens": 2, "upper": 2, "tail": 4, "form": 3,
    "before": 4, "after": 4, "word": 2,
}
ROUNDS, LEARNING_RATE, LEAST_LEAF = 24, 0.3, 5.0
PRECISION = 0.9
HELD_OUT = 5  # one document in five, by its id, calibrates
SCORE_BINS = 4096  # of held-out scores, whose running totals are taken apart
CONTEXT, CHUNK = 12, 1024  # characters kept before a match; characters of the pieces a text is put together from


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    digits = F.reverse(_digits(hit))
    values = F.transform(F.sequence(F.lit(1), F.char_length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _valid(kind: Column, hit: Column) -> Column:
    """Whether a base match counts."""
    return (
        F.when(kind == KINDS.index("ip"), F.regexp_like(hit, F.lit(rf"\A{_PART}(?:\.{_PART}){{3}}\z")))
        .when(kind == KINDS.index("card"), _luhn(hit))
        .when(kind == KINDS.index("phone"), F.char_length(_digits(hit)).between(8, 15))
        .otherwise(True)
    )


def _checks_out(kind: Column, hit: Column) -> Column:
    """Whether the canonical form of a candidate passes its kind's check."""
    address = F.regexp_replace(F.regexp_replace(hit, AT, "@"), DOT, ".")
    email = rf"(?i)\A[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:{TOP_LEVEL})\z"
    number = F.regexp_replace(hit, r"\x20?[(\[](?:dot|\.)[)\]]\x20?", ".")
    phone = r"\A1?[2-9][0-9]{2}[2-9][0-9]{6}\z"
    called = _digits(hit)
    return (
        F.when(kind == KINDS.index("email"), F.regexp_like(address, F.lit(email)))
        .when(kind == KINDS.index("ip"), F.regexp_like(number, F.lit(rf"\A{_PART}(?:\.{_PART}){{3}}(?::[0-9]{{1,5}})?\z")))
        .when(kind == KINDS.index("card"), _luhn(hit) & F.char_length(called).between(13, 19))
        .otherwise(F.regexp_like(called, F.lit(phone)) | (F.startswith(hit, F.lit("+")) & F.char_length(called).between(8, 15)))
    )


def _bucket(value: Column, *limits: int) -> Column:
    """How many of the limits the value reaches."""
    out = F.lit(0)
    for limit in limits:
        out = out + F.when(value >= limit, 1).otherwise(0)
    return out


def _char_class(char: Column) -> Column:
    return (
        F.when(F.coalesce(char, F.lit("")) == "", 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"\w"), 2).otherwise(3)
    )


def _features(hit: Column, before: Column, after: Column) -> Column:
    n = lambda pattern: F.regexp_count(hit, F.lit(pattern))
    domain = F.regexp_extract(hit, r"([A-Za-z]+)\z", 1)
    values = {
        "length": _bucket(F.char_length(hit), 10, 14, 18, 24, 40),
        "digits": _bucket(F.char_length(_digits(hit)), 1, 4, 7, 10, 12, 16, 20),
        "separators": _bucket(n(r"[\x20.:-]"), 1, 2, 3, 5),
        "groups": _bucket(n("[0-9]+"), 1, 2, 3, 4, 5),
        "parens": _bucket(n("[(]"), 1),
        "upper": _bucket(n("[A-Z]"), 1),
        "tail": _bucket(F.char_length(domain), 2, 4, 7),
        "form": F.when(hit.rlike(r"[(\[](?:at|dot|\.)[)\]]"), 1).when(hit.rlike(r"\x20(?:at|dot)\x20|:"), 2).otherwise(0),
        "before": _char_class(F.right(before, F.lit(1))),
        "after": _char_class(after),
        "word": F.when(F.regexp_like(before, F.lit(CONTEXT_WORD)), 1).otherwise(0),
    }
    return F.struct(*[values[name].cast("int").alias(name) for name in BUCKETS])


# ---- matches as rows ------------------------------------------------------------------------------------


def search(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: bool = False) -> DataFrame:
    """(row, id, matches) of every document, written down; ``carried`` adds the document and its text.

    A match holds ``wide`` (proposed by a generator), its kind, the characters since the match before, what stands
    directly before (up to ``CONTEXT`` characters, none of the match before) and after it, and the match itself.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    more = [F.struct(*[F.col(c) for c in docs.columns]).alias("doc")] if carried else []
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *more)

    def hits(name: str, pattern: str) -> Column:
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if holds := HOLDS.get(name):
            some = reduce(lambda x, y: x | y, [F.contains("text", F.lit(h)) for h in holds])
            found = F.when(some, found).otherwise(F.expr("cast(array() as array<string>)"))
        return found.alias(f"h_{name}")

    def gaps(name: str, pattern: str) -> Column:
        """What stands between the matches; most texts have none and are not cut."""
        return F.when(F.size(f"h_{name}") > 0, F.split("text", pattern, -1)).alias(f"g_{name}")

    def placed(name: str) -> Column:
        group, kind = name.split("_")
        n, gap = F.size(f"h_{name}"), F.col(f"g_{name}")
        sides = F.arrays_zip(F.slice(gap, 1, n).alias("gap"), F.col(f"h_{name}").alias("hit"), F.slice(gap, 2, n).alias("rest"))
        found = F.transform(
            sides,
            lambda m: F.struct(
                F.lit(group == "wide").alias("wide"),
                F.lit(KINDS.index(kind)).alias("kind"),
                F.char_length(m["gap"]).alias("gap"),
                F.right(m["gap"], F.lit(CONTEXT)).alias("before"),
                F.left(m["rest"], F.lit(1)).alias("after"),
                m["hit"].alias("hit"),
            ),
        )
        none = F.expr("cast(array() as array<struct<wide:boolean,kind:int,gap:int,before:string,after:string,hit:string>>)")
        return F.coalesce(found, none)

    # One search for each pattern: what is used more than once is a column before it is used.
    patterns = {f"{g}_{k}": p for g, by in (("base", BASE), ("wide", GENERATORS)) for k, p in by.items()}
    kept = ["id", "text", *(["doc"] if carried else [])]
    matched = rows.select(*kept, *[hits(name, p) for name, p in patterns.items()])
    parted = matched.select(*matched.columns, *[gaps(name, p) for name, p in patterns.items()])
    every = F.concat(*map(placed, patterns))
    searched = parted.select(*(c for c in kept if carried or c != "text"), every.alias("matches"))
    return materialized(searched.withColumn("row", F.monotonically_increasing_id()), "pii-matches")


def _places(found: DataFrame) -> DataFrame:
    """One row per match: (row, held, wide, kind, start, end, hit, before, after)."""
    held = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(HELD_OUT)) == 0
    rows = found.select("row", held.alias("held"), F.posexplode("matches").alias("pos", "m")).select("row", "held", "pos", "m.*")
    size = F.char_length("hit")
    so_far = W.partitionBy("row", "wide", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("end", F.sum(F.col("gap") + size).over(so_far).cast("int")).select(
        "row", "held", "wide", "kind", (F.col("end") - size).alias("start"), "end", "hit", "before", "after"
    )


def _touches(of: Column, *by: str) -> Column:
    """Whether a span overlaps one of the spans ``of`` which is true, within the partition.

    Of the spans that begin no later the furthest end tells, of those that begin later the nearest beginning.
    """
    forward = W.partitionBy(*by).orderBy("start", F.when(of, 0).otherwise(1)).rowsBetween(W.unboundedPreceding, -1)
    backward = W.partitionBy(*by).orderBy(F.desc("start"), F.when(of, 1).otherwise(0)).rowsBetween(W.unboundedPreceding, -1)
    reached = F.max(F.when(of, F.col("end"))).over(forward) > F.col("start")
    nearest = F.min(F.when(of, F.col("start"))).over(backward) < F.col("end")
    return F.coalesce(reached, F.lit(False)) | F.coalesce(nearest, F.lit(False))


def spans_found(found: DataFrame) -> DataFrame:
    """Base spans and candidates: (row, held, wide, kind, start, end, checked, covered, blocked, f), written down."""
    places = _places(found).where(F.col("wide") | _valid(F.col("kind"), F.col("hit")))
    base = ~F.col("wide")
    judged = places.withColumns({"covered": _touches(base, "row", "kind"), "blocked": _touches(base, "row")})
    return materialized(
        judged.select(
            "row", "held", "wide", "kind", "start", "end", "covered", "blocked",
            F.when(F.col("wide"), _checks_out(F.col("kind"), F.col("hit"))).alias("checked"),
            F.when(F.col("wide"), _features(F.col("hit"), F.col("before"), F.col("after"))).alias("f"),
        ),
        "pii-spans",
    )


# ---- boosting on the table of counts ------------------------------------------------------------------


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


# Feature values as places in one row: a feature's values follow those of the features before it.
_AT = dict(zip(BUCKETS, accumulate(BUCKETS.values(), initial=0), strict=False))
_PLACES = sum(BUCKETS.values())
Sums = dict[str, list[list[float]]]  # per feature and value the sums of gradients and curvatures
TREES = "array<struct<s: int, v: int, ls: int, lv: int, ll: double, lr: double, rs: int, rv: int, rl: double, rr: double>>"


def _best_split(sums: Sums) -> tuple | None:
    """The (feature, value) whose split 'below value / from value' lowers the loss most, by Newton gain."""
    score = lambda g, h: g * g / (h + 1.0)
    total = _total(next(iter(sums.values())))
    best, gain = None, 1e-6
    for name, by_value in sums.items():
        left = [0.0, 0.0]
        for value in range(1, len(by_value)):
            left = [left[k] + by_value[value - 1][k] for k in (0, 1)]
            right = [total[k] - left[k] for k in (0, 1)]
            now = score(*left) + score(*right) - score(*total)
            if now > gain:
                best, gain = (name, value), now
    return best


def _total(by_value: Sequence[Sequence[float]]) -> list[float]:
    return [sum(cell[k] for cell in by_value) for k in (0, 1)]


def _tree(root: Sums, side: Callable[[tuple, bool], Sums]) -> tuple | None:
    """The next tree from the sums over all rows and over those on either side of a split."""
    split = _best_split(root)
    if split is None:
        return None
    sides = []
    for upper in (False, True):
        own = side(split, upper)
        inner = _best_split(own)
        by_value = next(iter(own.values())) if inner is None else own[inner[0]]
        parts = [by_value, by_value] if inner is None else [by_value[: inner[1]], by_value[inner[1] :]]
        leaves = [LEARNING_RATE * g / (h + 1.0) for g, h in map(_total, parts)]
        sides.append((inner, *leaves))
    return (split, *sides)


def _start(n: int, pos: int) -> float:
    return math.log((pos + 0.5) / (n - pos + 0.5))


def boost(rows: Sequence[dict]) -> tuple[float, list[tuple]]:
    """A starting score and trees ``(split, (split, leaf, leaf), (split, leaf, leaf))`` from weighted rows.

    Each row holds the feature values, ``n`` candidates and ``n_pos`` positive ones. The reference for :func:`boosted`.
    """
    start, trees = _start(sum(r["n"] for r in rows), sum(r["n_pos"] for r in rows)), []
    for _ in range(ROUNDS):
        chances = [score_row((start, trees), r) for r in rows]
        grads = [(r["n_pos"] - r["n"] * p, r["n"] * p * (1 - p)) for r, p in zip(rows, chances, strict=True)]

        def sums(chosen: Callable[[dict], bool], grads: Sequence[tuple[float, float]] = grads) -> Sums:
            out = {name: [[0.0, 0.0] for _ in range(size)] for name, size in BUCKETS.items()}
            for r, grad in zip(rows, grads, strict=True):
                for name in BUCKETS if chosen(r) else ():
                    for k in (0, 1):
                        out[name][r[name]][k] += grad[k]
            return out

        tree = _tree(sums(lambda r: True), lambda split, upper: sums(lambda r: (r[split[0]] >= split[1]) == upper))  # noqa: B023
        if tree is None:
            break
        trees.append(tree)
    return start, trees


def _scored(models: dict[int, tuple[float, list[tuple]]]) -> Column:
    """The probability of a cell (kind, places). Trees are one constant, so that code does not grow with them."""

    def flat(tree: tuple) -> dict:
        (name, value), *sides = tree
        out = {"s": list(BUCKETS).index(name), "v": _AT[name] + value}
        for mark, (inner, low, high) in zip("lr", sides, strict=True):
            name, value = inner or (next(iter(BUCKETS)), 0)
            out |= {f"{mark}s": list(BUCKETS).index(name), f"{mark}v": _AT[name] + value, f"{mark}l": low, f"{mark}r": high}
        return out

    def value(t: Column) -> Column:
        reaches = lambda s, v: F.get("places", t[s]) >= t[v]
        low, high = (F.when(reaches(f"{m}s", f"{m}v"), t[f"{m}r"]).otherwise(t[f"{m}l"]) for m in "lr")
        return F.when(reaches("s", "v"), high).otherwise(low)

    total = F.lit(None).cast("double")
    for kind, (start, trees) in models.items():
        known = F.from_json(F.lit(json.dumps([flat(t) for t in trees])), TREES)
        own = F.aggregate(known, F.lit(start), lambda seen, t: seen + value(t))
        total = F.when(F.col("kind") == kind, own).otherwise(total)
    return 1 / (1 + F.exp(-total))


def boosted(cells: DataFrame, starts: dict[int, float]) -> dict[int, tuple[float, list[tuple]]]:
    """The same from all cells (kind, places, n, n_pos) of the kinds that ``starts`` has, fitted side by side.

    A round is one aggregation of every cell: sums for each pair of feature values, of which a split and the splits on
    its two sides follow. So the driver receives at most some thousand sums a round, however many cells there are. They
    are whole numbers, which no order of adding changes.
    """
    models = {kind: (start, []) for kind, start in starts.items()}
    growing = set(models)
    unit = 2.0**20
    both = F.flatten(F.transform("places", lambda x: F.transform(F.filter("places", lambda y: y >= x), lambda y: x * _PLACES + y)))
    paired = materialized(cells.withColumn("pairs", both), "pii-cells")
    for _ in range(ROUNDS):
        if not growing:
            break
        rows = paired.where(F.col("kind").isin(sorted(growing))).withColumn("p", _scored(models))
        grads = rows.select(
            "kind", "pairs", F.round((F.col("n_pos") - F.col("n") * F.col("p")) * unit).cast("bigint").alias("g"),
            F.round(F.col("n") * F.col("p") * (1 - F.col("p")) * unit).cast("bigint").alias("h"),
        )
        added = grads.select("kind", "g", "h", F.explode("pairs").alias("pair")).groupBy("kind", "pair").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")
        )
        found: dict[int, dict] = {kind: {} for kind in growing}
        for r in added.collect():
            x, y = divmod(r["pair"], _PLACES)
            found[r["kind"]][x, y] = found[r["kind"]][y, x] = (r["g"] / unit, r["h"] / unit)
        for kind, pairs in found.items():

            def sums(over: Sequence[int] | None, pairs: dict = pairs) -> Sums:
                """Sums of the cells with one of the places ``over``, of all without."""
                cell = lambda place: [pairs.get((place, x), (0.0, 0.0)) for x in ([place] if over is None else over)]
                return {name: [_total(cell(_AT[name] + v)) for v in range(size)] for name, size in BUCKETS.items()}

            def side(split: tuple, upper: bool, sums: Callable = sums) -> Sums:
                name, value = split
                return sums([_AT[name] + v for v in (range(value, BUCKETS[name]) if upper else range(value))])

            tree = _tree(sums(None), side)
            if tree is None:
                growing.discard(kind)
            else:
                models[kind][1].append(tree)
    return models


def score_row(model: tuple[float, list[tuple]], row: dict) -> float:
    """The probability the trees give to feature values; the reference for :func:`score_column`."""
    total = model[0]
    for split, low, high in model[1]:
        inner, left, right = high if row[split[0]] >= split[1] else low
        total += right if inner is None or row[inner[0]] >= inner[1] else left
    return _sigmoid(total)


def score_column(model: tuple[float, list[tuple]], f: Column) -> Column:
    total = F.lit(model[0])
    reaches = lambda split: f[split[0]] >= split[1]
    for split, low, high in model[1]:
        side = [F.lit(r) if s is None else F.when(reaches(s), r).otherwise(le) for s, le, r in (low, high)]
        total = total + F.when(reaches(split), side[1]).otherwise(side[0])
    return 1 / (1 + F.exp(-total))


def thresholds(cells: DataFrame, models: dict[int, tuple[float, list[tuple]]]) -> dict[int, float]:
    """Per kind the lowest score from which at least ``PRECISION`` of the held-out candidates are positive.

    Running totals over the scores are taken within bins of them, to which those of the bins above are added.
    """
    known = cells.where(F.col("kind").isin(list(models))).select("kind", _scored(models).alias("score"), "n", "n_pos")
    totals = [F.sum(c).alias(c) for c in ("n", "n_pos")]
    scores = known.groupBy("kind", "score").agg(*totals).withColumn("bin", F.floor(F.col("score") * SCORE_BINS))
    above = W.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = scores.groupBy("kind", "bin").agg(*totals)
    bins = bins.select("kind", "bin", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"above_{c}") for c in ("n", "n_pos")])
    down = W.partitionBy("kind", "bin").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, W.currentRow)
    so_far = scores.join(bins, ["kind", "bin"]).select(
        "kind", "score", *[(F.col(f"above_{c}") + F.sum(c).over(down)).alias(c) for c in ("n", "n_pos")]
    )
    right = so_far.where((F.col("n") >= LEAST_LEAF) & (F.col("n_pos") >= F.lit(PRECISION) * F.col("n")))
    return {r["kind"]: r["score"] for r in right.groupBy("kind").agg(F.min("score").alias("score")).collect()}


@dataclass(frozen=True)
class Model:
    """Trees, threshold and the feature values seen often enough in training, of one kind."""

    trees: tuple[float, list[tuple]]
    cut: float
    seen: dict[str, list[int]]

    def takes(self, f: Column) -> Column:
        known = reduce(lambda x, y: x & y, [f[name].isin(values) for name, values in self.seen.items()])
        return known & (score_column(self.trees, f) >= F.lit(self.cut - 1e-9))


def fit(spans: DataFrame) -> dict[str, Model]:
    """The model of each kind that can be calibrated, from the candidates of all documents.

    Candidates with the same feature values are one cell; trees, thresholds and the values seen come from every cell.
    """
    positive = F.col("checked") | F.col("covered")
    places = F.array(*[F.col(f"f.{name}") + at for name, at in _AT.items()])
    rows = spans.where("wide").select("held", "kind", positive.cast("int").alias("positive"), places.alias("places"))
    cells = materialized(
        rows.groupBy("held", "kind", "places").agg(F.count("*").alias("n"), F.sum("positive").alias("n_pos")), "pii-counts"
    )
    values = cells.select("held", "kind", "n", "n_pos", F.explode("places").alias("place"))
    counted = values.groupBy("held", "kind", "place").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")).collect()
    train = {(r["kind"], r["place"]): (r["n"], r["n_pos"]) for r in counted if not r["held"]}
    held = {r["kind"] for r in counted if r["held"]}
    first = next(iter(BUCKETS.values()))  # every cell has one of the first feature's places
    totals = {k: _total([train.get((k, v), (0, 0)) for v in range(first)]) for k in range(len(KINDS))}
    starts = {k: _start(n, pos) for k, (n, pos) in totals.items() if pos >= LEAST_LEAF and k in held}
    if not starts:
        return {}
    grown = boosted(cells.where(~F.col("held")), starts)
    often = lambda k, place: train.get((k, place), (0, 0))[0] >= LEAST_LEAF
    return {
        KINDS[k]: Model(
            grown[k], cut, {name: [v for v in range(size) if often(k, _AT[name] + v)] for name, size in BUCKETS.items()}
        )
        for k, cut in sorted(thresholds(cells.where("held"), grown).items())
    }


def chosen(spans: DataFrame, models: dict[str, Model]) -> DataFrame:
    """The spans that count, base ones and those that the models add: (row, wide, kind, start, end)."""
    take = F.lit(False)
    for kind, model in models.items():
        take = take | ((F.col("kind") == KINDS.index(kind)) & model.takes(F.col("f")))
    added = spans.where(F.col("wide") & F.col("checked") & ~F.col("blocked")).where(take)
    # Of added spans that overlap, the first kind's stays; within a kind they never overlap.
    lower = F.lit(False)
    for k in range(len(KINDS) - 1):
        lower = lower | ((F.col("kind") > k) & _touches(F.col("kind") == k, "row"))
    free = added.withColumn("_lower", lower).where(~F.col("_lower"))
    kept = ["row", "wide", "kind", "start", "end"]
    return spans.where(~F.col("wide")).select(*kept).unionByName(free.select(*kept))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``base`` and all ``spans``, arrays of (kind, start, end) by kind and start."""
    found = search(docs, id_col, text_col)
    spans = spans_found(found)
    span = F.struct("kind", "start", "end")
    listed = chosen(spans, fit(spans)).groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(~F.col("wide"), span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    )
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    return found.select("id", "row").join(listed, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind; null texts stay null.

    Documents without a match pass through; only the others meet their spans.
    """
    found = search(docs, id_col, text_col, carried=True)
    spans = spans_found(found)
    # Spans that overlap are replaced together, by the first one's kind: each begins where the furthest end before was.
    order = W.partitionBy("row").orderBy("start", "end", "kind")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = chosen(spans, fit(spans)).withColumn("reach", reach)
    cuts = placed.groupBy("row").agg(
        F.sort_array(
            F.collect_list(F.when(F.col("start") >= F.col("reach"), F.struct("start", "reach", "kind")))
        ).alias("cuts"),
        F.max("end").alias("tail"),
    )
    untouched = found.where(F.size("matches") == 0).select("doc")
    touched = found.where(F.size("matches") > 0).select("row", "doc", "text").join(cuts, "row", "left")
    pieces = touched.select(
        "doc", "cuts", "tail", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks")
    )
    new = F.when(F.col("cuts").isNull(), F.col("doc")[text_col]).otherwise(redacted("chunks", "cuts", "tail"))
    changed = pieces.select(F.col("doc"), new.alias("_new"))
    out = lambda c: F.col("_new") if c == text_col else F.col("doc")[c]
    return untouched.select("doc.*").unionByName(changed.select(*[out(c).alias(c) for c in docs.columns]))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans in their order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _stretch(chunks: str, start: Column, end: Column) -> Column:
    """The characters [start, end) of a text cut into chunks, touching only the chunks they lie in."""
    div = lambda x: F.call_function("div", x, F.lit(CHUNK)).cast("int")
    first, last = div(start), div(end)
    at = lambda i: F.coalesce(F.get(F.col(chunks), i), F.lit(""))
    inside = F.substring(at(first), start % CHUNK + 1, end - start)
    between = F.array_join(F.slice(F.col(chunks), first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    across = F.concat(F.substring(at(first), start % CHUNK + 1, F.lit(CHUNK)), between, F.substring(at(last), F.lit(1), end % CHUNK))
    return F.when(first == last, inside).otherwise(across)


def redacted(chunks: str, cuts: str, tail: str) -> Column:
    """A text in chunks with each cut (start, reach, kind) replaced by ``[KIND]``, the text from ``reach`` on before it."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    parts = F.transform(cuts, lambda c: F.concat(_stretch(chunks, c["reach"], c["start"]), F.get(tags, c["kind"])))
    rest = F.size(chunks) * CHUNK
    return F.concat(F.array_join(parts, ""), _stretch(chunks, F.col(tail), F.greatest(rest, F.col(tail))))
