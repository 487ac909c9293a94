"""Block overlap between any records, against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.operators import overlap


def brute(rows, size, similarity):
    """{key: (n_blocks, class, links, best, nearest)}; repeated keys are not used here."""
    sets = {}
    for key, text in rows:
        raw = (text or "").encode()
        pieces = [raw[i : i + size] for i in range(0, len(raw), size)] if size else raw.splitlines(keepends=True)
        sets[key] = frozenset(pieces)
    first = {}
    for key in sorted(sets):
        first.setdefault(sets[key], key)
    out = {}
    for key, own in sets.items():
        links, best = 0, (0.0, None)
        for other, theirs in sets.items():
            both = len(own & theirs)
            if other == key or not own or 100 * both < similarity * len(own | theirs):
                continue
            links += 1
            if theirs != own:
                best = min(best, (-both / len(own | theirs), first[theirs]))
        out[key] = (len(own), first[own] if own else key, links, -best[0] if best[0] else None, best[1])
    return out


def variants(seed):
    rng = random.Random(seed)
    lines = [f"line {k}\n" for k in range(400)]
    rows = []
    for group in range(8):
        base = rng.sample(lines, rng.randint(1, 40))
        for _ in range(rng.randint(1, 12)):
            text = [x for x in base if rng.random() > 0.15] + rng.sample(lines, rng.randint(0, 4))
            rows.append((len(rows) * 7 % 1000, "".join(text)))
    hot = "".join(lines[:30])
    rows += [(2000 + k, hot) for k in range(25)] + [(3000 + k, hot + f"own {k}\n" * (k % 3)) for k in range(40)]
    return rows + [(4000, None), (4001, ""), (4002, "\n"), (4003, "é" * 5000)]


@pytest.mark.parametrize("size, similarity, unit", [(None, 50, 512), (None, 80, 3), (9, 50, 7), (9, 100, 2)])
def test_overlap_equals_brute_force(spark, monkeypatch, size, similarity, unit):
    monkeypatch.setattr(overlap, "UNIT", unit)
    monkeypatch.setattr(overlap, "PAIRS", 50)
    rows = variants(similarity + unit)
    frame = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "1 as n", "2 as cid", "'x' as digest")
    got = overlap.block_overlap(frame.repartition(5), "id", "text", size, similarity).collect()
    want = brute(rows, size, similarity)
    assert len(got) == len(rows)
    for r in got:
        blocks, first, links, best, nearest = want[r.id]
        assert (r.n_blocks, r.class_id, r.n_links, r.nearest_id) == (blocks, first, links, nearest)
        assert r.jaccard is None if best is None else abs(r.jaccard - best) < 1e-6


def test_rows_stay_linear_in_a_hot_group(spark):
    """Every pair of a hot group is a link; what leaves the comparing stage is a few rows per record."""
    base = "".join(f"shared {k}\n" for k in range(30))
    counts = {}
    for n in (300, 1200):
        frame = spark.range(n).selectExpr("id", f"concat('{base}', 'own ', id, '\n') as text")
        sets = overlap.block_sets(frame, "id", "text", None)
        classes = sets.selectExpr("key as cid", "1L as copies", "n_blocks as n", "blocks")
        met = overlap._met(overlap._indexed(classes, 50), 50)
        counts[n] = met.count()
        found = overlap.linked_classes(classes, 50)
        assert {(r.links, round(r.similarity, 4)) for r in found.collect()} == {(n - 1, round(30 / 32, 4))}
    assert counts[1200] <= 3 * counts[300] * 4


def test_odd_rows(spark):
    rows = [(None, "a\nb\n"), (1, "a\nb\n"), (1, "a\nb\n"), (2, None), (2, "")]
    got = overlap.block_overlap(spark.createDataFrame(rows, "id long, text string"), "id", "text", None).collect()
    assert sorted((str(r.id), r.class_id, r.n_links) for r in got) == [
        ("1", 1, 1), ("1", 1, 1), ("2", 2, 0), ("2", 2, 0), ("None", None, 0),
    ]
    empty = spark.createDataFrame([], "id long, text string")
    assert overlap.block_overlap(empty, "id", "text").count() == 0


def test_pairs_are_dealt_in_whole_rows():
    counts = np.array([0, 3, 0, 10, 1, 2, 0])
    parts = list(overlap._expanded(counts, 4))
    assert np.concatenate([p[0] for p in parts]).tolist() == np.repeat(np.arange(7), counts).tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == [k for n in counts for k in range(n)]


def test_memory_does_not_grow_with_the_pairs_linked():
    """Two units that meet, every pair linked: what is held follows the members, not the pairs."""

    def peak(size):
        rows, unit = range(2 * size), [{"band": 0, "k": 0}, {"band": 0, "k": 1}]
        table = pa.table({
            "block": pa.array([b"x"] * len(rows)), "lo": pa.array([unit[0]] * len(rows)), "hi": pa.array([unit[1]] * len(rows)),
            "left": pa.array([r < size for r in rows]), "right": pa.array([r >= size for r in rows]),
            "cid": pa.array(rows, pa.int64()), "n": pa.array([2] * len(rows), pa.int32()),
            "copies": pa.array([1] * len(rows), pa.int64()), "pos": pa.array([0] * len(rows), pa.int32()),
            "shared": pa.array([[b"x", b"y"]] * len(rows)),
        })
        tracemalloc.start()
        got = overlap._compare(table, 50).to_pydict()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sorted(got["cid"]) == list(rows) and set(got["links"]) == {size} and set(got["similarity"]) == {1.0}
        assert {c: n for c, n in zip(got["cid"], got["nearest"], strict=True)} == {r: size if r < size else 0 for r in rows}
        return most / 2**20

    small, large = peak(512), peak(2048)
    print(f"MB held: {small:.0f} and {large:.0f}, pairs times 16")
    assert large < 1.5 * small
