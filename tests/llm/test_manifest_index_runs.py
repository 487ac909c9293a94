"""Merkle manifest, positional index and periodic runs against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle_manifest, periodic_runs, positional_index, queries

SF = "/root/testdata/sf0.001"


# ---- manifest ---------------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k : k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def _path(levels, place):
    steps = []
    for row in levels[:-1]:
        other = place ^ 1
        steps.append(("l" if place & 1 else "r") + row[other] if other < len(row) else "")
        place >>= 1
    return steps


def _fold(node, steps):
    for step in steps:
        node = _h(step[1:], node) if step[:1] == "l" else _h(node, step[1:])
    return node


def _leaf(values):
    text = [None if v is None else str(v) for v in values]
    return _h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in text])


def _manifest(rows):
    """{leaf: (subroot, root, path)} of rows (key, group, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, _leaf(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [_levels([leaf for *_, leaf in sorted(groups[g])]) for g in names]
    upper = _levels([t[-1][0] for t in trees])
    return sorted(
        (leaf, tree[-1][0], upper[-1][0], tuple(_path(tree, k) + _path(upper, g)))
        for g, tree in enumerate(trees)
        for k, leaf in enumerate(tree[0])
    )


def _proved(spark, rows):
    frame = spark.createDataFrame(rows, "id long, grp string, text string").selectExpr("*", "1 as rank", "'x' as digest")
    leaf = merkle_manifest.leaf_digest(F.col("id"), F.col("grp"), F.col("text"))
    return merkle_manifest.build(frame.repartition(3), "id", "grp", leaf, carry=["rank"])


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle_manifest, "DIGIT_BITS", bits)
    monkeypatch.setattr(merkle_manifest, "FANOUT", 1 << bits)
    sizes = {"a": 1, "b": 2, "c": 3, "é": 9, None: 21, "zz": 33, "": 4, "B": 16}
    rows = [(k, g, None if k % 5 == 0 else f"t{k}" * (k % 3)) for g, n in sizes.items() for k in range(n)]
    rows += [(None, "a", "no key"), (7, "zz", "t7"), (7, "zz", "t7"), (7, "zz", "x" * 100_000)]
    manifest = _proved(spark, rows)
    found = merkle_manifest.prove(manifest).withColumn("up", merkle_manifest.folded(F.col("leaf"), F.col("path")))
    found = found.withColumn("proof", merkle_manifest.proof_digest(F.col("path"))).collect()
    assert sorted((r.leaf, r.subroot, r.root, tuple(r.path)) for r in found) == _manifest(rows)
    assert all(r.up == r.root and r.proof == _h(*[s[1:] for s in r.path]) and r.carried["rank"] == 1 for r in found)
    some = manifest.leaves.where("rank = 2").select("grp", "rank")
    asked = merkle_manifest.prove(manifest, some.unionByName(some)).collect()
    assert len(asked) == sum(n > 2 for n in sizes.values())
    assert {r.leaf for r in asked} <= {r.leaf for r in found}


def test_manifest_of_little(spark):
    for rows in ([], [(1, None, None)]):
        found = merkle_manifest.prove(_proved(spark, rows)).collect()
        assert [(r.leaf, r.subroot, r.root, tuple(r.path)) for r in found] == _manifest(rows)


def test_manifest_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    leaves = {d.doc_id: _leaf(d) for d in docs}
    other = {d.doc_id: _leaf((d[0], d[1], d[2], d[3] + 1, d[4])) for d in docs if zlib.crc32(str(d[0]).encode()) % 7 == 0}
    got = {r.doc_id: r for r in queries.op12_merkle_dataset_manifest(spark, SF).collect()}
    assert {i: r.leaf for i, r in got.items()} == leaves and len({r.root for r in got.values()}) == 1
    assert {i for i, r in got.items() if not r.verified} == set(other) and other
    assert all((r.folded_root == r.root) == r.verified for r in got.values())


# ---- index ------------------------------------------------------------------------------------------


def _words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _hits(text, items, window):
    """Positions inside windows found, and the items that have them."""
    words, hit, found = _words(text), set(), set()
    for name, item in items:
        own = _words(item)
        n = min(window, len(own))
        for k in range(len(own) - n + 1) if n else ():
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[k : k + n]:
                    hit |= set(range(at, at + n))
                    found.add(name)
    return len(words), len(hit), sorted(found - {None})


def _near(text, item, width):
    words, own, found = _words(text), set(_words(item)), set()
    for at in range(1 - width, len(words)):
        window = range(max(at, 0), min(at + width, len(words)))
        first = {words[k]: k for k in reversed(window) if words[k] in own}
        if own and len(first) == len(own):
            found |= set(range(min(first.values()), 1 + max(first.values())))
    return found


def _corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Über", "日本", "W3", "a-b"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(str(k), text(rng.randint(1, 14))) for k in range(25)]
    items += [("x", None), ("y", " .,;\n"), (None, text(2)), ("3", "w1 w2"), ("same", items[4][1]), ("t", "w0 " * 9)]
    docs = [(k, text(rng.randint(0, 80)) + " " + (rng.choice(items)[1] or "").upper()) for k in range(60)]
    docs += [(60, None), (61, ""), (62, "..."), (5, docs[5][1]), (None, docs[6][1]), (63, "w0 " * 3000), (64, "q" * 99_999)]
    return docs, items


@pytest.mark.parametrize("window, segment, candidates", [(10, 1 << 22, 1 << 21), (3, 300, 7)])
def test_decontamination_equals_brute_force(spark, monkeypatch, window, segment, candidates):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(positional_index, "CANDIDATES", candidates)
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", segment)
    docs, items = _corpus(window)
    corpus = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as words", "2 as segment")
    asked = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "3 as id")
    got = positional_index.decontaminate(corpus.repartition(3), asked, window=window).collect()
    want = [(i, *_hits(text, items, window)) for i, text in docs]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_proximity_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", 500)
    docs, items = _corpus(8)
    docs = [d for d in docs if d[0] not in (5, None)]
    items = [(k, t) for k, t in items if k not in ("3", None)]
    index = positional_index.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    got = {}
    for r in positional_index.search(index, spark.createDataFrame(items, "item_id string, text string"), width=9).collect():
        got.setdefault((r.id, r.item), set()).update(range(r.start, r.start + r.length))
    want = {(i, name): _near(text, item, 9) for i, text in docs for name, item in items}
    assert got == {key: places for key, places in want.items() if places} and got
    with pytest.raises(ValueError):
        positional_index.search(index, index, width=65)


def test_index_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in positional_index.decontaminate(docs, none).collect()] == [(1, 3, 0, [], False)]
    assert positional_index.decontaminate(docs.limit(0), none).count() == 0


# ---- runs -------------------------------------------------------------------------------------------


def _runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _collapsed(words, runs):
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def _periodic(rng):
    n, kind = rng.randint(0, 180), rng.randint(0, 6)
    if kind == 0:
        return [rng.randint(0, 1) for _ in range(n)]
    if kind == 1:
        return [rng.randint(0, 300) for _ in range(n)]
    if kind == 2:
        base = [rng.randint(0, 3) for _ in range(rng.randint(1, 30))]
        words = [base[i % len(base)] for i in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            words[rng.randrange(n)] = 9
        return words
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 4:
        return [0] * n
    if kind == 5:
        words = []
        while len(words) < n:
            words += [rng.randint(0, 5) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9)
        return words
    return [bin(i).count("1") % 2 for i in range(n)]


@pytest.mark.parametrize("candidates", [1 << 21, 5])
def test_runs_equal_brute_force(monkeypatch, candidates):
    monkeypatch.setattr(periodic_runs, "CANDIDATES", candidates)
    rng = random.Random(candidates)
    for _ in range(40):
        texts = [[f"w{w}" for w in _periodic(rng)] for _ in range(rng.randint(1, 9))]
        counts, runs, collapsed = periodic_runs.runs_of(pa.array(["\v ".join(t) + " " for t in texts]))
        want = [_runs(t) for t in texts]
        assert [[(r["start"], r["length"], r["period"]) for r in rs] for rs in runs.to_pylist()] == want
        assert collapsed.to_pylist() == [_collapsed(t, w) for t, w in zip(texts, want, strict=True)]
        assert counts.tolist() == [len(t) for t in texts]


def test_grammar_derives_the_text():
    rng = random.Random(2)
    words = periodic_runs._coded(periodic_runs.np.array([rng.randint(0, 3) for _ in range(500)]))[0]
    np = periodic_runs.np
    g = periodic_runs.grammar(words, np.array([0]), np.array([500]))
    for rule, place in zip(g.rule, g.place, strict=True):
        size = g.hi[rule] - g.lo[rule]
        assert (words[place : place + size] == words[g.lo[rule] : g.hi[rule]]).all() and g.lo[rule] < g.cut[rule] < g.hi[rule]
    # Each place is derived once, and together they nest: a binary tree over the words has one node fewer than words.
    assert len(g.place) == len({(p, g.hi[r] - g.lo[r]) for r, p in zip(g.rule, g.place, strict=True)}) == 499


def test_runs_of_odd_rows(spark, odd_documents):
    got = {r.doc_id: r for r in periodic_runs.detect(odd_documents).collect()}
    assert periodic_runs.detect(odd_documents).count() == 12 and periodic_runs.detect(odd_documents.limit(0)).count() == 0
    assert [got[i].n_words for i in (1, 2, 3, 4, 7)] == [0, 0, 0, 1, 1] and got[1].collapsed == ""
    assert [tuple(r) for r in got[8].runs] == [(0, 60_000, 3)] and got[8].collapsed == "lorem ipsum dolor"


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = [(d.doc_id, d.text if len(d.text) < 20_000 else d.text[:20_000]) for d in docs]
    frame = spark.createDataFrame([*docs, (None, "a " * 30), (10**6, None)], "doc_id long, text string")
    planted = {r.doc_id: r.text for r in queries.planted_runs(frame).collect()}
    for i, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", text)
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        assert re.findall("[^\x20\x09-\x0d]+", planted[i]) == words
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    short = {i for i, text in docs if len(text) < 4_000}
    for i in short:
        words = re.findall("[^\x20\x09-\x0d]+", planted[i])
        runs = _runs(words)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        row = got[i]
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *want)
        assert (row.runs_sha256, row.collapsed_sha256) == (_h(lines), _h(_collapsed(words, runs)))
    assert sum(got[i].n_runs > 0 for i in short) > 3
