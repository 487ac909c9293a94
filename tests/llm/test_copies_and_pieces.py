"""Near copies of texts and vectors, URL lists and sampled segmentations, against brute force and on odd rows."""

from __future__ import annotations

import collections
import datetime as dt
import math

import numpy as np
import pytest

from corpusmill.llm import components, embedding_dedup, minhash_dedup, piece_sampling, url_filter


def _components(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 9), (9, 9), (20, 10), (10, 11), (2, 1), (30, 31)] + [(40, k) for k in range(41, 80)]
    links += [(k, k + 1) for k in range(100, 140)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = _components({x for ab in links for x in ab}, links)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _sets(rows, width):
    out = {}
    for i, text in rows:
        words = [w for w in "".join(c if c not in "\t\n\v\f\r" else " " for c in text or "").split(" ") if w]
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        out[i] = grams or ({tuple(words)} if words else set())
    return out


def _variants():
    rng = np.random.default_rng(4)
    rows, vocabulary = [], [f"w{k}" for k in range(3000)]
    for group in range(12):
        base = rng.choice(vocabulary, 120).tolist()
        for copy in range(10):
            words = list(base)
            for k in rng.choice(120, rng.integers(0, 7), replace=False):
                words[k] = f"x{rng.integers(9999)}"
            rows.append((1000 - group * 10 - copy, " ".join(words)))
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_equals_brute_force(spark, width):
    rows = [*_variants(), (1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, "z " * 30_000), (6, "q" * 100_000)]
    sets = _sets(rows, width)
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = _components(ids, links)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as id", "3 as bucket")
    got = minhash_dedup.dedup(docs, width=width).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(sets[i]), want[i], want[i] == i) for i in ids
    }


def test_minhash_on_odd_rows(odd_documents):
    got = minhash_dedup.dedup(odd_documents).collect()
    assert len(got) == 12
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert [r.kept for r in got if r.doc_id is None] == [True]
    assert minhash_dedup.dedup(odd_documents.limit(0)).count() == 0


def test_odd_sketches_estimate_similarity():
    make, rng = minhash_dedup.Sketcher(), np.random.default_rng(0)
    for similarity in (0.7, 0.8, 0.95):
        shared = int(2000 * similarity / (1 + similarity) * 2)
        errors = []
        for _ in range(20):
            x = rng.integers(-(1 << 62), 1 << 62, 4000 - shared)
            a, b = x[:2000], np.concatenate([x[:shared], x[2000:]])
            samples = np.stack([make.samples(a), make.samples(b)])
            bits = np.array([bin(int(v) & (1 << 64) - 1).count("1") for v in np.bitwise_xor(*make.odd_sketch(samples))])
            errors.append(float(minhash_dedup.estimated(bits.sum())) - similarity)
        assert abs(np.mean(errors)) < 0.04 and np.max(np.abs(errors)) < 0.18


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for group in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 30))):
            rows.append((len(rows), (base + rng.normal(0, 0.12, 16)).tolist(), group % 3))
    rows += [(5000 + k, rows[0][1], 0) for k in range(20)]
    odd = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, rows[0][1], None), (9003, [float("nan")] * 16, 0),
           (9004, [None] * 16, 1), (9005, [1.0, 2.0], 0), (9006, [], 0)]
    table = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.dedup(table.selectExpr("*", "1 as cid", "2 as size")).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.93) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(close, False)
    ids = [r[0] for r in rows]
    want = _components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close), strict=True)])
    assert {i: got[i].n_links for i in ids} == dict(zip(ids, close.sum(axis=1).tolist(), strict=True))
    assert {i: got[i].component_id for i in ids} == want
    assert all(got[r[0]].n_links == 0 and got[r[0]].kept for r in odd) and len(got) == len(rows) + len(odd)
    result = spark.createDataFrame([tuple(r) for r in got.values()], "vec_id long, n_links long, c long, kept boolean")
    assert embedding_dedup.audit(table, result) == 1.0
    assert embedding_dedup.dedup(table.limit(0)).count() == 0


def test_tiny_and_huge_vectors(spark):
    """Neither a length that vanishes nor one that overflows changes a cosine."""
    rows = [(1, [1e-200, 0.0]), (2, [0.0, 1e-200]), (3, [1.0, 0.0]), (4, [1e200, 0.0]), (5, [2.0, 0.0]), (6, [5e-324, 0.0]),
            (7, [1.7e308, 1.7e308]), (8, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.dedup(table).collect()}
    assert got == {1: (4, 1), 2: (0, 2), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (4, 1), 7: (1, 7), 8: (1, 7)}


def _isolated_pairs(n, dims, seed):
    """Pairs just above the threshold without any other neighbour, the hard case of a neighbour search."""
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n // 2, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cos = rng.uniform(0.931, 0.945, (n // 2, 1))
    return np.concatenate([a, cos * a + np.sqrt(1 - cos**2) * b])


def test_recall_does_not_fall_with_size(spark):
    for n in (3_000, 18_000):
        x = _isolated_pairs(n, 48, n)
        table = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())], "vec_id int, embedding array<double>, label int")
        result, reached = embedding_dedup.audited_dedup(table.repartition(8))
        alone = result.where("n_links = 0").count()
        assert reached >= 0.999 and alone <= 0.004 * n
        assert result.where("n_links > 1").count() == 0


def test_full_lists_do_not_hide_links_between_groups(spark):
    """Two dense groups whose members all have closer neighbours in their own group than the links that join them."""
    rng = np.random.default_rng(3)
    centre = np.zeros((2, 32))
    centre[0, 0], centre[1, 0], centre[1, 1] = 1, math.cos(0.36), math.sin(0.36)
    x = np.concatenate([c + rng.normal(0, 0.003, (400, 32)) for c in centre])
    table = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.dedup(table).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.93
    assert close[:400, 400:].any() and {r.component_id for r in got} == {0}
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate((close.sum(axis=1) - 1).tolist()))


def test_url_list_as_of_the_fetch(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    entries = [
        ("a", "host", "x.example.com", day(10), "add"), ("a", "host", "x.example.com", day(20), "remove"),
        ("a", "host", "x.example.com", day(30), "add"), ("b", "domain", "Example.com", day(15), "add"),
        ("c", "prefix", "x.example.com/p/q", day(0), "add"), ("c", "prefix", "x.example.com/p/q", day(0), "add"),
        ("d", "host", "x.example.com", day(5), "add"), ("d", "host", "x.example.com", day(5), "remove"),
        (None, "host", "x.example.com", day(5), "add"),
    ]
    listed = url_filter.intervals(
        spark.createDataFrame(entries, "list_name string, kind string, pattern string, listed_at date, action string")
    )
    url = "https://u@X.example.com:8080/p/q/r.html?z=1#f"
    captures = [(k, url, day(d)) for k, d in enumerate((5, 10, 19, 20, 30))]
    captures += [(9, None, day(5)), (10, "nonsense", day(5)), (11, url, None), (12, "http://other.org", day(50))]
    captures += [captures[0]]
    out = url_filter.evaluate(
        spark.createDataFrame(captures, "id long, url string, at date"), listed, "id", "url", "at"
    ).collect()
    assert len(out) == len(captures)
    got = {r.id: (r.n_matches, r.lists, r.blocked) for r in out}
    assert [got[k] for k in range(5)] == [
        (1, "c", True), (2, "a,c", True), (3, "a,b,c", True), (2, "b,c", True), (3, "a,b,c", True),
    ]
    assert all(got[k] == (0, "", False) for k in (9, 10, 11, 12))


def test_url_patterns_and_case(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    long = "p" + "/p" * 60
    entries = [
        ("a", "prefix", "X.com/Path", day(0), "add"), ("a", "host", "Y.com", day(0), "add"), ("a", "host", "y.com", day(10), "remove"),
        ("b", "domain", "Z.com", day(0), "add"), ("b", "domain", "z.com", day(0), "add"), ("c", "prefix", f"l.com/{long}", day(0), "add"),
        ("d", "domain", "m.com", day(5), "add"), ("d", "domain", "M.COM", day(5), "remove"),
    ]
    listed = url_filter.intervals(
        spark.createDataFrame(entries, "list_name string, kind string, pattern string, listed_at date, action string")
    )
    urls = [
        ("http://x.com/Path/q", day(1)), ("http://x.com/path/q", day(1)), ("http://Y.com", day(9)), ("http://y.COM/", day(10)),
        ("https://sub.z.com/", day(1)), (f"http://l.com/{long}/q?x", day(1)), ("http://m.com", day(6)),
        ("http://" + "s." * 50 + "z.com", day(1)),
    ]
    rows = spark.createDataFrame([(k, *u) for k, u in enumerate(urls)], "id long, url string, at date").selectExpr("*", "'k' as kind", "1 as pattern", "2 as valid_to")
    got = {r.id: (r.n_matches, r.lists) for r in url_filter.evaluate(rows, listed, "id", "url", "at").collect()}
    assert got == {0: (1, "a"), 1: (0, ""), 2: (1, "a"), 3: (0, ""), 4: (1, "b"), 5: (1, "c"), 6: (0, ""), 7: (1, "b")}
    assert url_filter.evaluate(rows.limit(0), listed, "id", "url", "at").count() == 0
    assert {r.blocked for r in url_filter.evaluate(rows, listed.limit(0), "id", "url", "at").collect()} == {False}


def test_blocks_join_what_a_bucket_holds(spark):
    """A spanning forest of exact links from many variants of one text, no more rows than members."""
    rng = np.random.default_rng(8)
    sets = {}
    for n in (500, 1000):
        base = rng.integers(0, 1 << 40, 200)
        rows = []
        for k in range(n):
            own = base.copy()
            own[rng.choice(200, 16, replace=False)] = rng.integers(0, 1 << 40, 16)
            rows.append((k, sorted(set(own.tolist()))))
        sets = {k: set(v) for k, v in rows}
        make = minhash_dedup.Sketcher()
        sketches = make.odd_sketch(np.stack([make.samples(np.array(v)) for _, v in rows])).tolist()
        members = spark.createDataFrame([(7, k, 0, n - 1, n) for k in range(n)], "bucket long, cid long, lo long, hi long, n long")
        frame = spark.createDataFrame(rows, "cid long, shingles array<long>")
        sketch = spark.createDataFrame([(k, s) for k, s in enumerate(sketches)], "cid long, sketch array<long>")
        joined = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "node long, component long")
        links = minhash_dedup._block_links(members, joined, sketch, frame, 80).collect()
        assert len(links) < 2 * n
        near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])  # noqa: B023, E731
        assert all(near(r.a, r.b) for r in links)
        every = [(a, b) for a in sets for b in sets if a < b and near(a, b)]
        start = [(0, 1), (1, 2)]
        assert _components(sets, start + [(r.a, r.b) for r in links]) == _components(sets, start + every)


def test_segmentations(spark):
    model = piece_sampling.public_pieces()
    sampler = piece_sampling.Sampler(model)

    def every(lattice, i=0):
        if i == len(lattice.places):
            yield (), 0.0
            return
        for j, ids, log_p in lattice.places[i][1]:
            for rest, q in every(lattice, j):
                yield ids + rest, log_p + q

    exact = dict(every(sampler.lattices("cat")[0]))
    assert abs(sum(map(math.exp, exact.values())) - 1) < 1e-9
    first, weighted, n = collections.Counter(), collections.Counter(), 3000
    for seed in range(n):
        found = sampler.sample("cat", 3, seed)
        assert len({tuple(f[0]) for f in found}) == 3
        assert found[0][2] >= found[1][2] >= found[2][2]
        first[tuple(found[0][0])] += 1
        for ids, log_p, _, score in found:
            assert abs(exact[tuple(ids)] - log_p) < 1e-9
            weighted[tuple(ids)] += 1 / score / n
    for ids, log_p in exact.items():
        if math.exp(log_p) > 0.03:
            assert abs(first[ids] / n - math.exp(log_p)) < 0.03 and abs(weighted[ids] - 1) < 0.1
    assert [f[3] for f in sampler.sample("a", 99, 1)] == [1.0] * len(sampler.sample("a", 99, 1))
    texts = [None, "", " ", "日本語 é\n x  y", " lead \U0001f389 tail ", "word " * 3000, "z" * 3000, "word", "word"]
    rows = spark.createDataFrame([(k % 8, k, t) for k, t in enumerate(texts)], "a long, b int, text string")
    sampled = piece_sampling.sample_segmentations(rows.selectExpr("*", "1 as ids"), ["a", "b"], k=3)
    back = piece_sampling.decode_segmentations(sampled).collect()
    assert {r.b for r in back} == set(range(9)) and all(r.decoded == (texts[r.b] or "") for r in back)
    again = piece_sampling.sample_segmentations(rows, ["a", "b"], k=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, sampled.collect()))
