"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads windows of ``STEPS`` bytes in both directions, labels every byte with a distribution over the
learned languages, and a document's probabilities are the mean over all its bytes. It is trained in numpy by
backpropagation through time. Gates use the piecewise linear sigmoid ``clip(x / 4 + 1/2, 0, 1)``.

Training uses a bounded sample: about ``SAMPLE_PER_LANGUAGE`` documents of each language, chosen by a hash of their
id, and of each at most ``EXCERPT`` characters from a hashed place. Prediction covers all bytes of all texts; a task
holds ``LANES`` windows at a time, whatever a text's length, and the model's size does not depend on the data.

Defined results: a null text or one without a letter is ``und`` with score 0; without any labelled document
everything is ``und``; repeated rows are predicted alike; an empty table gives an empty result. Of two equal
probabilities the alphabetically first language wins. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import ship_package

HIDDEN, STEPS, LANES = 8, 64, 2048
SAMPLE_PER_LANGUAGE, EXCERPT = 1500, 256
TRAIN_STEPS, TRAIN_LANES, LEARNING_RATE, SEED = 300, 256, 0.02, 7
UNDETERMINED = "und"


class ByteGru:
    """Weights of both directions, stacked on the first axis; features come before lanes in every array.

    ``table`` (2, 3H, 256) is what a byte adds to reset gate, update gate and candidate, ``state`` (2, 3H, H) what the
    previous state adds to them; the reset gate scales the state's part of the candidate. ``out`` (K, 2H) and
    ``bias`` (K, 1) label a position from both directions' states.
    """

    def __init__(self, n_classes: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.hidden = hidden
        self.table, self.state = draw(2, 3 * hidden, 256), draw(2, 3 * hidden, hidden)
        self.out, self.bias = draw(n_classes, 2 * hidden), np.zeros((n_classes, 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.state, self.out, self.bias]

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (T, 2, H, B) over bytes ``x`` (T, B); row t of direction 1 belongs to byte T - 1 - t."""
        hid, (steps, lanes) = self.hidden, x.shape
        h = np.zeros((2, hid, lanes), np.float32)
        out = np.empty((steps, 2, hid, lanes), np.float32)
        gates = np.empty((2, 3 * hid, lanes), np.float32)
        past, cand = np.empty_like(gates), np.empty_like(h)
        for t in range(steps):
            np.take(self.table[0], x[t], axis=1, out=gates[0], mode="clip")
            np.take(self.table[1], x[steps - 1 - t], axis=1, out=gates[1], mode="clip")
            np.matmul(self.state, h, out=past)
            two = gates[:, : 2 * hid]
            two += past[:, : 2 * hid]
            two *= 0.25
            two += 0.5
            np.clip(two, 0, 1, out=two)
            np.multiply(two[:, :hid], past[:, 2 * hid :], out=cand)
            cand += gates[:, 2 * hid :]
            np.tanh(cand, out=cand)
            if keep is not None:
                keep.append((h.copy(), two.copy(), past[:, 2 * hid :].copy(), cand.copy()))
            h -= cand
            h *= two[:, hid:]
            h += cand
            out[t] = h
        return out

    def position_probabilities(self, states: np.ndarray) -> np.ndarray:
        """(T, K, B): the distribution at every byte."""
        scores = np.matmul(self.out[:, : self.hidden], states[:, 0])
        scores += np.matmul(self.out[:, self.hidden :], states[::-1, 1])
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over the masked bytes and its gradients, by backpropagation through time."""
        hid, (steps, lanes) = self.hidden, x.shape
        keep: list = []
        states = self.states(x, keep)
        p = self.position_probabilities(states)
        weight = mask / mask.sum()
        picked = np.take_along_axis(p, np.broadcast_to(y, (steps, 1, lanes)), axis=1)[:, 0]
        loss = float(-(weight * np.log(picked + 1e-12)).sum())
        err = p
        np.put_along_axis(err, np.broadcast_to(y, (steps, 1, lanes)), (picked - 1)[:, None], axis=1)
        err *= weight[:, None]
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=1)
        g_out = np.einsum("tkb,thb->kh", err, both, optimize=True)
        g_bias = err.sum(axis=(0, 2))[:, None]
        g_states = np.matmul(self.out.T, err)
        g_table, g_state = np.zeros_like(self.table), np.zeros_like(self.state)
        g_h = np.zeros((2, hid, lanes), np.float32)
        for t in reversed(range(steps)):
            before, gates, past, cand = keep[t]
            reset, update = gates[:, :hid], gates[:, hid:]
            g_h[0] += g_states[t, :hid]
            g_h[1] += g_states[steps - 1 - t, hid:]
            g_cand = g_h * (1 - update) * (1 - cand * cand)
            g_update = g_h * (before - cand) * 0.25 * ((update > 0) & (update < 1))
            g_reset = g_cand * past * 0.25 * ((reset > 0) & (reset < 1))
            from_input = np.concatenate([g_reset, g_update, g_cand], axis=1)
            from_state = np.concatenate([g_reset, g_update, g_cand * reset], axis=1)
            for d in (0, 1):
                np.add.at(g_table[d].T, x[t if d == 0 else steps - 1 - t], from_input[d].T)
            g_state += np.matmul(from_state, before.transpose(0, 2, 1))
            g_h = g_h * update + np.matmul(self.state.transpose(0, 2, 1), from_state)
        return loss, [g_table, g_state, g_out, g_bias]


def windows_of(texts: list[bytes], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into windows (N, steps) of bytes, with the mask of real bytes and the text of each window."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // steps)
    padded = b"".join(t.ljust(int(c) * steps, b"\0") for t, c in zip(texts, counts, strict=True))
    x = np.frombuffer(padded, dtype=np.uint8).reshape(-1, steps)
    owner = np.repeat(np.arange(len(texts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    mask = (within * steps)[:, None] + np.arange(steps) < sizes[owner][:, None]
    return x, mask, owner


def train(samples: pd.DataFrame, steps: int = TRAIN_STEPS, seed: int = SEED) -> tuple[list[str], ByteGru] | None:
    """Languages and network from rows (lang, excerpt); every language is drawn equally often. None without rows."""
    languages = sorted(samples["lang"].unique())
    x, mask, owner = windows_of([t.encode() for t in samples["excerpt"]])
    if not len(x):
        return None
    code = samples["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy()[owner]
    pools = [np.flatnonzero(code == k) for k in range(len(languages))]
    pools = [p if len(p) else np.arange(len(x)) for p in pools]
    net, rng = ByteGru(len(languages), seed=seed), np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(p, -(-TRAIN_LANES // len(pools))) for p in pools])
        _, grads = net.gradients(
            x[chosen].T.astype(np.intp), mask[chosen].T.astype(np.float32), code[chosen][None, None, :]
        )
        rate = LEARNING_RATE * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(net.parameters(), grads, mean, square, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return languages, net


def predict(net: ByteGru, texts: list[bytes]) -> np.ndarray:
    """(len(texts), K) mean probabilities; rows of empty texts are zero."""
    n_classes = len(net.out)
    total = np.zeros((n_classes, len(texts)))
    x, mask, owner = windows_of(texts)
    for at in range(0, len(x), LANES):
        part = slice(at, at + LANES)
        p = net.position_probabilities(net.states(np.ascontiguousarray(x[part].T).astype(np.intp)))
        full = mask[part].all()
        summed = (p if full else p * mask[part].T[:, None]).sum(axis=0)
        for k in range(n_classes):
            total[k] += np.bincount(owner[part], weights=summed[k], minlength=len(texts))
    sizes = np.array([max(len(t), 1) for t in texts])
    return (total / sizes).T


def is_held_out(id_column: Column) -> Column:
    """Rows that no model learns from."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 4 == 2


def training_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> pd.DataFrame:
    """About ``SAMPLE_PER_LANGUAGE`` excerpts per language from rows that are not held out; all of rarer languages."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.where(
        ~is_held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    ).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"), F.xxhash64(key).alias("_hash"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return pd.DataFrame({"lang": [], "excerpt": []})
    share = F.create_map(
        *[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, SAMPLE_PER_LANGUAGE / n))]
    )
    place = F.pmod(F.shiftright("_hash", 20), F.greatest(F.char_length("_text") - EXCERPT, F.lit(1))) + 1
    taken = rows.where(F.pmod("_hash", F.lit(1 << 20)) < F.lit(1 << 20) * share[F.col("lang")])
    out = taken.select("lang", "_hash", F.substring("_text", place.cast("int"), F.lit(EXCERPT)).alias("excerpt"))
    return out.toPandas().sort_values(["lang", "_hash", "excerpt"]).reset_index(drop=True)


def identify(
    docs: DataFrame,
    model: tuple[list[str], ByteGru] | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row its id, ``lang_pred`` and ``score``, the mean probability of that language over the text's bytes."""
    lettered = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    rows = docs.select(F.col(id_col), lettered.alias("_text"))
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted, scores = [], []
            texts: list[bytes] = []

            def flush(texts: list[bytes], predicted: list, scores: list) -> None:
                p = predict(model[1], texts) if model else np.zeros((len(texts), 1))
                best = p.argmax(axis=1)
                for i, text in enumerate(texts):
                    known = bool(model and text)
                    predicted.append(model[0][best[i]] if known else UNDETERMINED)
                    scores.append(float(min(p[i, best[i]], 1.0)) if known else 0.0)
                texts.clear()

            size = 0
            for text in batch.column(1):
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                size += len(texts[-1])
                if size >= 4 * LANES * STEPS:
                    flush(texts, predicted, scores)
                    size = 0
            flush(texts, predicted, scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    ship_package()
    return rows.mapInArrow(run, schema)
