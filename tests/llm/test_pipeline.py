"""The pipeline's stages on odd rows, and the chain against brute force over what each stage was given."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import language_id, minhash_dedup, packing, pii, quality_rules
from corpusmill.session import materialized
from tests.llm.test_copies_and_pieces import _components, _sets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it returned."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialized(stage(spark, docs, SF), name)
        seen[name] = (docs, out)
        docs = out
    return seen


def rows(frame):
    return sorted(map(str, map(tuple, frame.collect())))


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").schema
    for name in list(stages)[:-1]:
        got = stages[name][1].schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in columns]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_copies", "personal_data", "packed"]


def test_language_keeps_what_the_operator_is_sure_of(stages):
    given, out = stages["language"]
    model = language_id.train(language_id.training_sample(given))
    sure = language_id.identify(given, model).where("lang_pred <> 'und' AND score >= 0.3").select("doc_id").collect()
    kept = {r.doc_id for r in sure}
    assert rows(out) == rows(given.where(F.col("doc_id").isin(list(kept)))) and 0 < len(kept) <= given.count()


def test_quality_keeps_what_passes(stages):
    given, out = stages["quality"]
    entries = quality_rules.ledger(given)
    kept = quality_rules.apply_policy(entries, quality_rules.POLICIES["v3"]).where("kept").select("doc_id").collect()
    assert rows(out) == rows(given.where(F.col("doc_id").isin([r.doc_id for r in kept])))


def test_near_copies_equal_brute_force(stages):
    given, out = stages["near_copies"]
    texts = {r.doc_id: r.text for r in given.collect()}
    sets = _sets(texts.items(), minhash_dedup.SHINGLE)
    ids = sorted(texts)
    near = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    least = _components(ids, [(a, b) for a in ids for b in ids if a < b and near(a, b)])
    assert {r.doc_id for r in out.collect()} == {i for i in ids if least[i] == i}
    assert rows(out) == rows(given.where(F.col("doc_id").isin([i for i in ids if least[i] == i])))


def test_personal_data_is_replaced(stages):
    given, out = stages["personal_data"]
    spans = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.spans) for r in pii.find_spans(given).collect()}
    got = {r.doc_id: r for r in out.collect()}
    for r in given.collect():
        text, at = "", 0
        for start, end, kind in spans[r.doc_id]:
            if start >= at:
                text += r.text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, end)
        text += r.text[at:]
        assert (got[r.doc_id].text, got[r.doc_id].n_chars) == (text, len(text))
    assert sum(map(len, spans.values())) > 0


def test_packed_pieces_cover_every_token(stages):
    import public_tokenizers as public

    given, out = stages["packed"]
    ids = packing.byte_bpe(public.path("byte_bpe_50k.json"))
    sizes = {r.doc_id: len(ids(r.text or "")) + 1 for r in given.collect()}
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, size in sizes.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at and length > 0
            at += length
        assert at == size


def test_run_is_the_chain(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.select("doc_id", "start", "length").distinct().count() == stages["packed"][1].count()


CLASHES = ["1 as _doc", "2 as _plain", "'k' as _key", "3 as kept", "4 as score", "array(5) as spans", "6 as row"]


@pytest.fixture(scope="module")
def odd(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    data = [
        (1, None, "en", 0), (2, "", "en", 0), (3, " \n\t", None, 3), (4, base, "en", len(base)), (4, base, "en", len(base)),
        (None, base + " nu", "en", 9), (5, "x" * 50_000, "en", 1), (6, (base + " ") * 400, "en", 2), (7, "mail a@b.com now", None, None),
        (8, base + " xi", "en", 1), (8, "one two three four five six seven eight nine ten eleven", "de", 1), (None, None, None, None),
    ]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, n_chars long").withColumn("source", F.lit("s"))
    return frame.selectExpr("*", *CLASHES)


@pytest.mark.parametrize("number", range(5))
def test_odd_rows_and_empty_tables(spark, odd, number):
    name, stage = corpus_pipeline.STAGES[number]
    for given in (odd, odd.limit(0)):
        out = stage(spark, given, SF)
        if name != "packed":
            assert out.columns == given.columns
            assert out.count() <= given.count()
            assert not name.startswith("personal") or out.count() == given.count()
        else:
            assert out.where("length <= 0").count() == 0


def test_no_text_is_lost_with_its_id(spark):
    """Rows that repeat an id with different texts are judged apart; rows that repeat both are one."""
    a, b = "a " * 3 + "q w e r t y", "b " * 3 + "c d e f g h"
    data = [(3, b), (7, a), (7, b), (8, None), (8, None), (9, ""), (7, a)]
    out = corpus_pipeline.near_copies(spark, spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", *CLASHES), SF)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(3, b), (7, a), (8, None), (9, "")], key=str)


def test_redacted_copies_keep_no_address(stages):
    assert not [r for r in stages["personal_data"][1].collect() if re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", r.text or "")]
