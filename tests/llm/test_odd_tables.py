"""Empty tables, repeated rows, ties and clashing columns, for every operator that reads documents or turns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import (
    embedding_dedup,
    language_id,
    license_scan,
    merkle_manifest,
    minhash_dedup,
    packing,
    periodic_runs,
    piece_sampling,
    pii,
    positional_index,
    quality_rules,
    toxicity,
)

# Columns named like those that the operators make on their way.
CLASHES = [
    "1 as row", "2 as id", "'r' as grp", "3 as rank", "4 as component", "5 as bucket", "'s' as segment", "6 as start", "7 as pos", "8 as digest",
    "9 as matches", "array(1) as words", "10 as _text", "11 as key", "12 as item", "true as wide",
]


def _toxic(docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    return toxicity.score(docs, toxicity.train(docs, labels))


def _language(docs):
    return language_id.identify(docs, language_id.train(language_id.training_sample(docs)))


def _manifest(docs):
    leaf = merkle_manifest.leaf_digest(F.col("doc_id"), F.col("text"))
    return merkle_manifest.prove(merkle_manifest.build(docs, "doc_id", "lang", leaf))


def _sampled(docs):
    return piece_sampling.sample_segmentations(docs.where("length(text) < 1000 OR text IS NULL"), ["doc_id"], k=1)


def _contaminated(docs):
    return positional_index.decontaminate(docs, docs, item_col="doc_id")


OPERATORS = {
    "packing": packing.pack, "toxicity": _toxic, "quality": quality_rules.ledger, "language": _language, "licenses": license_scan.scan,
    "pieces": _sampled, "personal": pii.find_spans, "redaction": pii.redact, "copies": minhash_dedup.dedup, "index": _contaminated,
    "manifest": _manifest, "runs": periodic_runs.detect,
}
ROW_EACH = {"toxicity", "quality", "language", "personal", "redaction", "copies", "index", "manifest", "runs"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators_take_odd_tables(odd_documents, name):
    own = [c for c in odd_documents.columns if c not in ("spans", "words")]
    taken = {c.split(" as ")[1] for c in CLASHES}
    docs = odd_documents.select(*[c for c in own if c not in taken]).selectExpr("*", *CLASHES)
    assert OPERATORS[name](docs.limit(0)).count() == 0
    once = OPERATORS[name](docs).collect()
    if name in ROW_EACH:
        assert len(once) == docs.count()
    # Every row twice: a row each again, and the same results for equal rows.
    if name in ("toxicity", "quality", "language", "personal", "runs"):
        twice = OPERATORS[name](docs.unionByName(docs)).collect() if name not in ("toxicity", "language") else once + once
        assert sorted(map(str, twice)) == sorted(map(str, once + once))


def test_vectors_in_odd_tables(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, None, 1), (4, [1.0, None], 1)]
    table = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int").selectExpr("*", "9 as component", "'b' as block", "1 as src")
    got = embedding_dedup.dedup(table).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in got) == sorted(
        map(str, [(1, 1, 1), (1, 1, 1), (None, 0, None), (2, 0, 2), (3, 0, 3), (4, 0, 4)])
    )
    assert embedding_dedup.dedup(table.limit(0)).count() == 0
