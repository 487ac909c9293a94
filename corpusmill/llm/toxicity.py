"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on posterior labels.

* **Voters.** Lexicon voters are word beginnings that stand out in documents marked toxic, the most telling first and
  none that extends or begins another; each votes if a word of the text begins so. Pattern voters look at how many of them a text
  has, how often and how densely, at shouting and at repeated marks.
* **Label model.** A latent label makes each voter fire with a probability of its own; expectation maximisation
  estimates the prior and these accuracies from the votes alone, started from the labelled share. Correlations of
  the voters given the posterior discount, from the first step on, voters that say the same thing.
* **Classifier.** A logistic regression of the votes and the logarithms of the counts learns the posterior.

Learning is bounded: at most about ``SAMPLE`` labelled rows, chosen by a hash of the id, of which rows with
``crc32(id) mod 4 = 2`` are never part; at most ``LEXICON`` words. Labels choose words and the prior, nothing else.
Scoring covers whole texts of all rows, row by row.

Defined results: null texts count as empty and get the score of a text without any vote; without labelled toxic rows
every score is 0; repeated rows score alike; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.language_id import is_held_out
from corpusmill.session import materialized, ship_package

# About so many labelled rows are fitted on; so many word beginnings are voters, chosen among so many of the highest rank.
SAMPLE, LEXICON, CANDIDATES = 8_000, 100, 5_000
SHORTEST, LONGEST = 3, 8  # letters of a word's beginning
LEAST_DOCS, LEAST_SHARE, LEAST_LIFT = 5, 0.02, 2.5
EM_STEPS, SMOOTH = 40, 0.5
STRONG = 0.5  # correlation from which two voters are taken to say the same thing
RIDGE = 1e-3
PATTERNS = ("two_words", "three_words", "two_hits", "dense", "shouting", "marks")


class Model(NamedTuple):
    """Words in the order of their votes, and the classifier's weights (bias last)."""

    words: list[str]
    weights: np.ndarray


class Voters:
    """Votes of a text: one per lexicon word, then the patterns, then two log counts."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.words = words
        self.finder = ahocorasick.Automaton()
        for k, word in enumerate(words):
            self.finder.add_word(word, (k, len(word)))
        if words:
            self.finder.make_automaton()

    def features(self, text: str) -> np.ndarray:
        n, lower = len(self.words), text.lower()
        counts = np.zeros(n, np.int64)
        for end, (k, size) in self.finder.iter(lower) if n else ():
            start = end - size + 1
            if start and lower[start - 1].isalpha():
                continue
            counts[k] += 1
        hits, kinds, n_words = int(counts.sum()), int((counts > 0).sum()), text.count(" ") + 1
        patterns = [
            kinds >= 2,
            kinds >= 3,
            hits >= 2,
            100 * hits >= n_words,
            hits > 0 and re.search(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b", text) is not None,
            hits > 0 and re.search(r"[!?]{2,}", text) is not None,
        ]
        return np.concatenate([counts > 0, patterns, [np.log1p(hits), np.log1p(kinds)]]).astype(np.float32)


def label_model(votes: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each row of 0/1 ``votes``, the voters' firing probabilities (2, M) and their correlations (M, M)."""
    n, m = votes.shape
    # At the start a row is toxic as far as its number of votes is among the ``prior`` share of largest ones.
    total = votes.sum(axis=1)
    cut = np.quantile(total, 1 - prior) if n else 0.0
    post = np.where((total >= max(cut, 1)), 0.9, 0.02)
    fires = np.zeros((2, m))
    weight = np.ones(m)
    for step in range(EM_STEPS):
        for y, w in ((0, 1 - post), (1, post)):
            fires[y] = (w @ votes + SMOOTH) / (w.sum() + 2 * SMOOTH)
        share = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        if step % 5 == 0:
            corr = correlations(votes, post, fires)
            weight = 1 / np.maximum(np.where(corr >= STRONG, corr, 0).sum(axis=1), 1.0)
        odds = np.log(fires[1] / fires[0]) * weight
        absent = np.log((1 - fires[1]) / (1 - fires[0])) * weight
        score = votes @ (odds - absent) + absent.sum() + np.log(share / (1 - share))
        post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return post, fires, correlations(votes, post, fires)


def correlations(votes: np.ndarray, post: np.ndarray, fires: np.ndarray) -> np.ndarray:
    """How far voters agree beyond what the latent label explains."""
    rest = votes - (post[:, None] * fires[1] + (1 - post[:, None]) * fires[0])
    cov = rest.T @ rest / max(len(votes), 1)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    return cov / scale[:, None] / scale[None, :]


def fit_linear(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights and bias of the logistic regression with soft labels, by Newton steps on the ridge objective."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE * len(x))
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + ridge * w
        hess = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int
) -> DataFrame:
    """About ``sample`` rows (text, y) with a label, none of them held out, written down."""
    marked = labels.where(F.col(label_col).isNotNull() & ~is_held_out(F.col(id_col))).groupBy(id_col).agg(
        F.max(label_col).alias("y")
    )
    n = marked.count()
    few = marked.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, sample / max(n, 1)))))
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialized(texts.join(few, id_col).select(F.xxhash64(id_col).alias("key"), "text", "y"), "labelled")


def lexicon(rows: DataFrame, size: int = LEXICON) -> list[str]:
    """The word beginnings that tell most toxic documents from others, ranked by documents times log ratio."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    beginnings = F.transform(
        F.sequence(F.lit(SHORTEST), F.lit(LONGEST)),
        lambda k: F.when(F.char_length("word") >= k, F.substring(F.col("word"), F.lit(1), k)),
    )
    per_doc = rows.select("key", "y", F.explode(words).alias("word")).where(F.char_length("word") >= SHORTEST)
    total = rows.agg(F.sum((F.col("y") > 0).cast("int")), F.sum((F.col("y") == 0).cast("int"))).first()
    if not total[0] or total[1] is None:
        return []
    per_word = (
        per_doc.select("key", "y", F.explode(beginnings).alias("word"))
        .where("word is not null")
        .distinct()
        .groupBy("word")
        .agg(F.sum((F.col("y") > 0).cast("int")).alias("n1"), F.sum((F.col("y") == 0).cast("int")).alias("n0"))
        .where(F.col("n1") >= max(LEAST_DOCS, LEAST_SHARE * total[0]))
    )
    lift = F.log((F.col("n1") + 0.5) / (total[0] + 1)) - F.log((F.col("n0") + 0.5) / (total[1] + 1))
    ranked = per_word.withColumn("lift", lift).where(F.col("lift") >= LEAST_LIFT)
    ranked = ranked.orderBy(F.desc(F.col("lift") * F.col("n1")), F.desc(F.char_length("word")), "word").limit(CANDIDATES)
    chosen: list[str] = []
    for row in ranked.select("word").collect():
        word = row["word"]
        if len(chosen) < size and not any(word.startswith(c) or c.startswith(word) for c in chosen):
            chosen.append(word)
    return chosen


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Model | None:
    """The model, or None if no labelled row is toxic."""
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, sample)
    words = lexicon(rows)
    if not words:
        return None
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(words)
        for batch in batches:
            x = [voters.features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float32())), batch.column(2)], names=["key", "x", "y"]
            )

    voted = rows.select("key", "text", F.col("y").cast("int")).mapInArrow(run, "key bigint, x array<float>, y int")
    table = voted.toPandas().sort_values("key")
    x = np.stack(table["x"].to_numpy()).astype(np.float64)
    n_votes = len(words) + len(PATTERNS)
    prior = float(np.clip((table["y"] > 0).mean(), 1e-3, 0.5))
    post, _, _ = label_model(x[:, :n_votes], prior)
    return Model(words, fit_linear(x, post))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and ``score``, the probability that it is toxic."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if model is None:
        return rows.select(id_col, F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.words)
        for batch in batches:
            x = np.array([voters.features(t.as_py()) for t in batch.column(1)], dtype=np.float64)
            z = x.reshape(batch.num_rows, -1) @ model.weights[:-1] + model.weights[-1] if batch.num_rows else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=[id_col, "score"])

    ship_package()
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")
