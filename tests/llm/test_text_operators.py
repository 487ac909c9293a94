"""Rules, personal data, language, toxicity, packing and licenses, against brute force and on odd rows."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import language_id, license_scan, packing, pii, quality_rules, toxicity

SF = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _measure(text):
    text = text or ""
    words, lines = re.findall(WORD, text), [x for x in text.split("\n") if re.search(WORD, x)]
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_ledger_equals_brute_force(documents, odd_documents):
    for docs in (documents, odd_documents):
        rows = docs.select(F.col("doc_id"), "text").collect()
        got = sorted(map(str, (tuple(r) for r in quality_rules.measured(docs).collect())))
        assert got == sorted(str((r.doc_id, *_measure(r.text))) for r in rows)


def test_policies_and_ablations_are_bit_operations(documents):
    entries = quality_rules.ledger(documents)
    table = quality_rules.apply_policy(entries, quality_rules.POLICIES["v2"]).toPandas()
    mask = quality_rules.mask_of(quality_rules.POLICIES["v2"])
    assert (table["kept"] == ((table["failed_bits"] & mask) == 0)).all()
    for row in quality_rules.ablations(entries).collect():
        rules = quality_rules.POLICIES[row.policy]
        bit, own = quality_rules.mask_of((row.rule,)), table["failed_bits"] & quality_rules.mask_of(rules)
        assert (row.n_docs, row.n_rejected) == (len(table), (own != 0).sum())
        assert (row.n_failed, row.n_only_here) == ((own & bit != 0).sum(), (own == bit).sum())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_equal_brute_force(spark, documents, odd_documents):
    hard = spark.createDataFrame(
        [
            (-1, "a@b.c_x@y.z.w q.q@w é x@y.z"), (-2, "1.2.3.4.5.6.7.8 001.2.3.255 256.1.1.1 1.2.3.4"),
            (-3, "é 4111 1111 1111 1111, 4111-1111-1111-1111-1 7 4111111111111111 5"), (-4, "1" * 50_000),
            (-5, "+1 (2) 3.4-5678 +1234567+12345678 + +1a"),
        ],
        "doc_id long, text string",
    )
    every = documents.select("doc_id", "text").unionByName(hard).unionByName(odd_documents.select("doc_id", "text"))
    got = pii.find_spans(every).select("doc_id", pii.joined(F.col("base")).alias("s")).collect()
    want = [(r.doc_id, _base_spans(r.text)) for r in every.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_spans_hold_the_base_and_redaction_removes_them(documents):
    found = pii.find_spans(documents)
    assert found.where(F.size(F.array_except("base", "spans")) > 0).count() == 0
    red = pii.redact(documents)
    assert red.columns == documents.columns and red.count() == documents.count()
    assert red.where(F.col("text").contains("@mail")).count() == 0
    assert red.where(F.col("text").contains("[EMAIL]")).count() > 0


def _obfuscated(seed, n):
    """Documents with plain and obfuscated personal data, lookalikes of it, and the places of the obfuscated ones."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["lorem", "ipsum", "dolor", "sit", "noon", "room", "amet"])
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card(k):
        body = digits(k - 1)
        return next(body + c for c in "0123456789" if _luhn(body + c))

    def bad(number):
        return number[:-1] + str((int(number[-1]) + 1 + rng.randrange(8)) % 10)

    user = lambda: f"{word()}{rng.randint(1, 99)}"
    ip = lambda: [str(rng.randint(1, 255)) for _ in range(4)]
    rows, planted = [], {}
    for i in range(n):
        text, kinds = "", []
        for _ in range(rng.randint(2, 6)):
            text += f"{word()} {word()} "
            kind = rng.randrange(9)
            hidden = {
                0: lambda: ("email", f"{user()}@{word()}.com", False),
                1: lambda: ("email", f"{user()}{rng.choice([' [at] ', '(at)', '[at]'])}{word()}{rng.choice([' [dot] ', '(dot)', '.'])}org", True),
                2: lambda: ("ip", ".".join(ip()), False),
                3: lambda: ("ip", "[.]".join(ip()), True),
                4: lambda: ("card", "card: " + card(16), False),
                5: lambda: ("card", "card: " + card(15), True),
                6: lambda: ("none", f"order {bad(card(16))}", False),
                7: lambda: ("none", f"at {word()}. Room {digits(3)}[.]{digits(4)}", False),
                8: lambda: ("none", f"meet at {word()}.{word()}", False),
            }[kind]()
            what = hidden[1].removeprefix("card: ")
            start = len(text) + len(hidden[1]) - len(what)
            text += hidden[1] + " "
            if hidden[2]:
                kinds.append((hidden[0], start, start + len(what)))
        rows.append((i, text))
        planted[i] = set(kinds)
    return rows, planted


def test_trees_add_obfuscated_spans(spark):
    rows, planted = _obfuscated(7, 1500)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    named = lambda spans: {(pii.KINDS[s.kind], s.start, s.end) for s in spans}
    hits = wanted = added = 0
    for r in pii.find_spans(frame).collect():
        base, spans = named(r.base), named(r.spans)
        assert base <= spans and not planted[r.doc_id] & base
        hits += len(planted[r.doc_id] & spans)
        wanted += len(planted[r.doc_id])
        added += len(spans - base)
    assert hits >= 0.9 * wanted and hits >= 0.9 * added and wanted > 1000
    text = " ".join(r.text for r in pii.redact(frame).collect())
    assert "[EMAIL]" in text and "[CARD]" in text and text.count("[at]") + text.count("(at)") < 0.1 * wanted


def test_many_matches_take_linear_time(spark):
    import time

    def seconds(n):
        text = " ".join(f"user{k}@mail{k % 7}.example.com and {k % 256}.1.2.3" for k in range(n))
        frame = spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string")
        start = time.perf_counter()
        (found,) = [r for r in pii.find_spans(frame).collect() if r.doc_id == 1]
        (red,) = [r.text for r in pii.redact(frame).collect() if r.doc_id == 1]
        assert len(found.base) == 2 * n and red == " ".join(["[EMAIL] and [IP]"] * n)
        return time.perf_counter() - start

    seconds(10)
    few, many = seconds(2_500), seconds(10_000)
    assert many < 8 * few + 2 and many < 40


def test_redaction_of_overlaps_and_edges(spark):
    """Spans at both ends, over chunk borders, of several kinds over one another, beside characters beyond the basic plane."""
    rng = random.Random(3)
    rows = [(0, "a@b.com"), (1, "a@b.com c@d.org"), (2, ""), (3, None), (4, "\U0001f600 1.2.3.4\U0001f600"), (5, "+1.2.3.4.5 and x")]
    for i in range(6, 30):
        parts = [rng.choice(["é" * rng.randint(0, 900), "a@b.com", "9.8.7.6", "+1 (377) 555-0271", "\n", "\U0001f600"]) for _ in range(12)]
        rows.append((i, " ".join(parts)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as cuts", "'x' as doc", "2 as row", "3 as tail")
    spans = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.spans) for r in pii.find_spans(frame).collect()}
    got = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert set(got) == set(range(30)) and got[3] is None
    for i, text in rows:
        if text is None:
            continue
        out, at = "", 0
        for start, end, kind in spans[i]:
            if start >= at:
                out += text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, end)
        assert got[i] == out + text[at:]


def test_personal_data_in_odd_rows(spark, odd_documents):
    assert pii.find_spans(odd_documents.limit(0)).count() == 0 and pii.redact(odd_documents.limit(0)).count() == 0
    red = pii.redact(odd_documents)
    assert red.columns == odd_documents.columns and red.count() == 12
    assert {r.text for r in red.where("doc_id = 9").collect()} == {"mail [EMAIL] [PHONE]"}


def test_boosted_trees_as_columns(spark):
    rng = np.random.default_rng(1)
    rows = [{k: int(rng.integers(n)) for k, n in pii.BUCKETS.items()} | {"n": 10} for _ in range(300)]
    for r in rows:
        r["n_pos"] = 9 if r["digits"] >= 4 and r["word"] else 1
    model = pii.boost(rows)
    table = spark.createDataFrame(pd.DataFrame(rows)).select(F.struct(*pii.BUCKETS).alias("f"), "n_pos")
    got = table.select(pii.score_column(model, F.col("f")).alias("p"), "n_pos").toPandas()
    assert np.allclose(sorted(got["p"]), sorted(pii.score_row(model, r) for r in rows))
    assert got[got.n_pos == 9].p.min() > got[got.n_pos == 1].p.max()


def test_models_are_fitted_on_every_cell(spark, monkeypatch):
    """More cells than any table of counts that could be collected before; trees and thresholds as from all of them."""
    monkeypatch.setattr(pii, "ROUNDS", 3)
    rng = np.random.default_rng(2)
    table = pd.DataFrame({k: rng.integers(n, size=26_000) for k, n in pii.BUCKETS.items()})
    table["kind"], table["held"] = rng.integers(2, size=len(table)), rng.random(len(table)) < 0.2
    table["checked"] = (table["digits"] + 2 * table["word"] + table["kind"] > 3) ^ (rng.random(len(table)) < 0.03)
    frame = spark.createDataFrame(table)
    got = pii.fit(frame.select(
        "held", F.lit(True).alias("wide"), F.col("kind").cast("int").alias("kind"), "checked", F.lit(False).alias("covered"),
        F.struct(*[F.col(k).cast("int").alias(k) for k in pii.BUCKETS]).alias("f"),
    ))
    assert sorted(got) == ["email", "ip"]
    for kind, name in enumerate(("email", "ip")):
        rows = table[table["kind"] == kind].assign(n=1, n_pos=lambda t: t["checked"].astype(int)).to_dict("records")
        start, trees = pii.boost([r for r in rows if not r["held"]])
        assert abs(got[name].trees[0] - start) < 1e-9 and [t[0] for t in got[name].trees[1]] == [t[0] for t in trees]
        held = [r for r in rows if r["held"]]
        scores = np.array([pii.score_row(got[name].trees, r) for r in held])
        assert np.allclose(scores, [pii.score_row((start, trees), r) for r in held], atol=1e-5)
        positive = np.array([r["n_pos"] for r in held])
        right = [c for c in np.unique(scores) if (top := scores >= c - 1e-12).sum() >= 5 and positive[top].mean() >= 0.9]
        assert abs(got[name].cut - min(right)) < 1e-9


def test_gru_gradients_and_accuracy(documents, odd_documents):
    net = language_id.ByteGru(3, hidden=4, seed=1)
    for name in ("table", "state", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64) * 0.5)
    rng = np.random.default_rng(0)
    x, mask, y = rng.integers(0, 256, (6, 5)), np.ones((6, 5)), rng.integers(0, 3, 5)[None, None]
    mask[4:, 0] = 0
    _, grads = net.gradients(x, mask, y)
    for p, g in zip(net.parameters(), grads, strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        at, sides = p[i], []
        for d in (1e-2, -1e-2):
            p[i] = at + d
            sides.append(net.gradients(x, mask, y)[0])
        p[i] = at
        assert abs((sides[0] - sides[1]) / 2e-2 - g[i]) < 1e-3
    model = language_id.train(language_id.training_sample(documents))
    out = language_id.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id")
    held = out.where(language_id.is_held_out(F.col("doc_id"))).toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    odd = language_id.identify(odd_documents, model).collect()
    assert len(odd) == 12 and {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd)
    none = language_id.identify(documents.limit(0), language_id.train(language_id.training_sample(documents.limit(0))))
    assert none.count() == 0


def test_toxicity_on_held_out_rows(spark, odd_documents):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").where(language_id.is_held_out(F.col("doc_id"))).toPandas()
    hit = out["score"] >= 0.3
    assert hit[out.toxic == 1].mean() > 0.8 and hit[out.toxic == 0].mean() < 0.02
    odd = toxicity.score(odd_documents, model).collect()
    assert len(odd) == 12 and all(0 <= r.score < 0.3 for r in odd)
    assert toxicity.train(docs, labels.where("toxic = 0")) is None


def test_label_model_finds_accuracies_and_doubles():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.2
    fire = np.array([0.8, 0.7, 0.6, 0.5])
    votes = (rng.random((4000, 4)) < np.where(y[:, None], fire, 0.02)).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # a voter that repeats another
    post, fires, corr = toxicity.label_model(votes, 0.2)
    odds = votes[:, :4] @ np.log(fire / 0.02) + (1 - votes[:, :4]) @ np.log((1 - fire) / 0.98) + np.log(0.2 / 0.8)
    assert ((post > 0.5) == y).mean() > ((odds > 0) == y).mean() - 0.02  # the best that true accuracies give
    assert np.abs(fires[1][:4] - fire).max() < 0.08
    assert corr[0, 4] > 0.9 and corr[0, 1] < 0.1  # the posterior explains away what voters share


def test_packing_round_trip(documents, odd_documents):
    encode = packing.public_byte_bpe()
    for docs in (documents.select("doc_id", "text"), odd_documents.where("doc_id <> 6")):
        pieces = packing.pack(docs).toPandas()
        seqs = pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
        assert (seqs["offset"].apply(lambda o: o.iloc[0]) == 0).all()
        sizes = seqs["length"].sum()
        assert sizes.max() <= 2048 and (seqs["offset"].max() + seqs["length"].last() == sizes).all()
        by_doc = {k: g.sort_values("start") for k, g in pieces.groupby("doc_id", dropna=False)}
        for row in docs.collect():
            ids = np.array([*encode(row.text or ""), 1], dtype="<u4")
            own = by_doc[row.doc_id] if row.doc_id is not None else pieces[pieces.doc_id.isna()].sort_values("start")
            assert own["length"].sum() == len(ids) and (own["doc_tokens"] == len(ids)).all()
            for start, length, crc in zip(own["start"], own["length"], own["ids_crc32"], strict=True):
                assert zlib.crc32(ids[int(start) : int(start + length)].tobytes()) == crc


def test_cuts_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        places = np.concatenate([[0], np.cumsum(rng.integers(1, 200, 30))])
        penalty = rng.integers(0, 9, 31).astype(float)
        best = [0.0] + [np.inf] * 30
        for i in range(1, 31):
            for j in range(i):
                size = places[i] - places[j]
                if size <= 512:
                    whole = size & (size - 1) == 0 and size >= packing.LEAST_WHOLE
                    pad = 0 if whole else 512 - size
                    best[i] = min(best[i], best[j] + pad + penalty[i] + packing.PER_SEQUENCE)
        cuts, cost, at = packing.best_cuts(places, penalty, 512), 0.0, 0
        for c in cuts:
            size = c - at
            whole = size & (size - 1) == 0 and size >= packing.LEAST_WHOLE
            cost += (0 if whole else 512 - size) + penalty[list(places).index(c)] + packing.PER_SEQUENCE
            at = c
        assert cuts[-1] == places[-1] and abs(cost - best[30]) < 1e-9


def test_word_cache_gives_the_tokenizer_ids(documents):
    import public_tokenizers as public

    plain = packing.byte_bpe(public.path("byte_bpe_50k.json"))
    cached = packing.WordEncoder(packing.public_byte_bpe())
    texts = [r.text for r in documents.limit(100).collect()]
    for text in [*texts, "", " ", "  a", "a  b", "a \n b", " lead", "é ñ  b", "x <|endoftext|> y", "tail "]:
        assert cached.ids(text).tolist() == plain(text)


def _plain_changes(block, template):
    """Edit distance of the template to the nearest stretch of the block, by the textbook table."""
    rows = [[j for j in range(len(template) + 1)]]
    for x in block:
        row = [0]
        for j, y in enumerate(template, 1):
            row.append(min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] + (x != y)))
        rows.append(row)
    return min(r[-1] for r in rows)


def test_licenses_equal_brute_force(spark):
    """Every template planted with changed words, other case and line ends among other words."""
    rng = random.Random(5)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x1", "the", "of"]) for _ in range(n))
    rows, planted = [], {}
    for copy in range(4):
        for name, text in license_scan.TEMPLATES.items():
            tokens = text.split()
            for k in rng.sample(range(len(tokens)), len(tokens) // 20 * min(copy, 2)):
                tokens[k] = rng.choice(["other", "words", ""])
            body = "".join(t + rng.choice([" ", "\n", "  \t"] if copy else [" "]) for t in tokens)
            body = body.upper() if copy == 3 else body
            planted[len(rows)] = name
            rows.append((len(rows), filler(rng.randint(0, 60)) + "\n" + body + filler(rng.randint(0, 60))))
    rows += [(9000 + k, filler(200)) for k in range(20)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    scanner = license_scan.Scanner()
    best, texts = {}, dict(rows)
    for r in got:
        assert r.block == texts[r.doc_id][r.start : r.end]
        plain = re.sub(r"\s+", " ", r.block).lower().encode()
        saved = {n: len(scanner.plain.compress(plain)) - len(c.compress(plain)) for n, c in scanner.by_name.items()}
        alone = len(scanner.plain.compress(plain))
        ranking = sorted(saved, key=lambda n: (-saved[n], n))
        far = {n: _plain_changes(license_scan.words(r.block), license_scan.words(license_scan.TEMPLATES[n])) for n in ranking}
        good = [n for n in ranking if saved[n] >= 0.2 * alone and far[n] <= 0.25 * len(license_scan.words(license_scan.TEMPLATES[n]))]
        assert r.template == [*good, ranking[0]][0] and r.confirmed == bool(good)
        changed = far[r.template]
        assert r.changed_words == changed and r.template_words == len(license_scan.words(license_scan.TEMPLATES[r.template]))
        assert r.confirmed == (r.saving >= 0.2 and changed <= 0.25 * r.template_words)
        assert (r.changes != "") == (r.confirmed and changed > 0)
        if r.confirmed:
            best.setdefault(r.doc_id, set()).add(r.template)
    # Two notices differ in their version alone, which may be among the words changed.
    alike = lambda name: name.replace("gpl-2.0-notice", "gpl-3.0-notice")
    assert [i for i, name in planted.items() if alike(name) not in set(map(alike, best.get(i, ())))] == []
    assert not any(i >= 9000 for i in best)


def test_all_documents_get_the_tokenizer_ids(spark):
    """The word cache against the tokenizer's own file, over the whole of the larger table."""
    import public_tokenizers as public
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    cached = packing.public_byte_bpe()
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        for text, want in zip(part, tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            assert list(cached(text)) == want.ids


def test_packing_pads_little_and_keeps_repeated_ids(spark, documents):
    twice = documents.select("doc_id", "text").unionByName(documents.select("doc_id", "text").limit(50))
    pieces = packing.pack(twice.coalesce(1)).toPandas()
    used = pieces.groupby("sequence_id")["length"].sum()
    whole = used.map(lambda n: n if n & (n - 1) == 0 else 2048)
    assert (whole.sum() - used.sum()) / whole.sum() < 0.02 and used.max() <= 2048
    encode = packing.public_byte_bpe()
    assert pieces.length.sum() == sum(len(encode(r.text or "")) + 1 for r in twice.collect())
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]


def test_pooled_language_probabilities_equal_brute_force():
    """Every byte's label on its own, window by window, against texts pooled in batches."""
    net = language_id.ByteGru(4, hidden=5, seed=3)
    rng = random.Random(2)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, language_id.STEPS, 3 * language_id.STEPS + 7]))) for _ in range(60)]
    got = language_id.predict(net, texts)
    for text, pooled in zip(texts, got, strict=True):
        total = np.zeros(4)
        for at in range(0, len(text), language_id.STEPS):
            window = text[at : at + language_id.STEPS].ljust(language_id.STEPS, b"\0")
            p = net.position_probabilities(net.states(np.frombuffer(window, np.uint8).astype(np.intp)[:, None]))
            total += p[: len(text) - at, :, 0].sum(axis=0)
        assert np.allclose(pooled, total / max(len(text), 1), atol=1e-5)


def test_votes_and_scores_equal_brute_force(spark):
    words = ["idiot", "stup", "hate", "trash", "ugly"]
    rng = random.Random(4)
    pool = ["idiots", "STUPID", "Hate!!", "chat", "trash", "x", "ugly?!", "FINE DAY", "shate", "ok", "idiot\nidiot"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "idiot" * 30, "hate " * 5000]
    voters = toxicity.Voters(words)

    def votes(text):
        lower = text.lower()
        counts = [
            sum(lower.startswith(w, k) and not (k and lower[k - 1].isalpha()) for k in range(len(lower) - len(w) + 1)) for w in words
        ]
        hits, kinds, n_words = sum(counts), sum(c > 0 for c in counts), text.count(" ") + 1
        shouted = re.search(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b", text) is not None
        patterns = [kinds >= 2, kinds >= 3, hits >= 2, 100 * hits >= n_words, hits > 0 and shouted, hits > 0 and re.search("[!?]{2,}", text) is not None]
        return [*(c > 0 for c in counts), *patterns, np.log1p(hits), np.log1p(kinds)]

    x = np.array([votes(t) for t in texts], np.float64)
    assert np.allclose(x, [voters.features(t) for t in texts])
    weights = np.random.default_rng(1).normal(size=x.shape[1] + 1)
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.Model(words, weights)).collect()}
    want = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
    assert np.allclose([got[k] for k in range(len(texts))], want, atol=1e-5)


def test_license_blocks(spark, odd_documents):
    rows = [
        (1, "Text.\nLicensed under the Apache License,\nVersion 2.0.\nMore."), (2, "a driving license is needed"),
        (3, "Alle Rechte. ALL RIGHTS RESERVED."), (4, "This work is licensed under the GNU General Public License, version 2."),
        (5, "word " * 500 + license_scan.TEMPLATES["mit-text"].replace(" ", "\n") + " word" * 500),
        (6, "Released under the MIT License. Licensed under CC BY-NC 4.0."), (6, "Released under the MIT License."),
        (7, "released under  the MIT licence"), (8, None), (9, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as id", "'t' as template")
    got = license_scan.scan(frame).collect()
    out = sorted((r.doc_id, r.template, r.confirmed, r.changes) for r in got)
    assert out == [
        (1, "apache-2.0", True, ""), (3, "all-rights-reserved", True, ""), (4, "gpl-3.0", True, "-3 +2"), (5, "mit-text", True, ""),
        (6, "cc-by-nc-4.0", True, ""), (6, "mit", True, ""), (6, "mit", True, ""), (7, "mit", True, "-license +licence"),
    ]
    assert license_scan.scan(odd_documents).count() == 0 and license_scan.scan(odd_documents.limit(0)).count() == 0


def test_equal_savings_go_to_the_first_name(spark):
    twin = license_scan.TEMPLATES["mit"]
    rows = spark.createDataFrame([(1, twin)], "doc_id long, text string")
    (found,) = license_scan.scan(rows, templates={"zz": twin, "aa": twin, "mm": "Something else entirely here."}).collect()
    assert found.template == "aa" and found.confirmed
