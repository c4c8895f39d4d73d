"""Quality scores by positive-unlabelled learning.

Every text is described by figures of its whole length: shares of character classes, lengths, repetition of
words, word pairs and lines, and the worst stretch of each. A small network is trained on trusted positives
and on unlabelled documents by the non-negative unbiased risk

    prior * E_p[loss(f, +1)] + max(0, E_u[loss(f, -1)] - prior * E_p[loss(f, -1)])

with the logistic loss, so that ``sigmoid(f)`` estimates the probability of label 1; ``prior`` is the share
of positives among the trusted labels. A step whose negative part is below zero goes back along it instead.

Training reads a bounded pseudorandom sample (``most_positive``, ``most_unlabelled``); everything is scored.
Labels, language, source and identifier are no inputs. A null text is empty and gets a score as well. Repeated
rows get equal scores. Labels that are null are ignored; of several labels of a document each counts as an
example. Without any positive label every score is the prior of 0.5. Empty tables give no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablerich.llm.common import query, table

THRESHOLD = 0.3
#: Words of a stretch.
STRETCH = 128
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]


def _shares(hist: np.ndarray) -> np.ndarray:
    """Of rows of byte counts: shares of classes, and of each punctuation mark."""
    n = np.maximum(1, hist.sum(axis=1))
    upper, lower = hist[:, 65:91].sum(axis=1), hist[:, 97:123].sum(axis=1)
    groups = [upper, lower, hist[:, 48:58].sum(axis=1), hist[:, 32], hist[:, 10], hist[:, 128:].sum(axis=1), hist[:, :32].sum(axis=1)]
    marks = np.minimum(1, 20 * hist[:, _PUNCTUATION] / n[:, None])
    return np.column_stack([*(g / n for g in groups), upper / np.maximum(1, upper + lower), marks])


def _repetition(codes: np.ndarray, lengths: np.ndarray, stretch: np.ndarray, stretches: int) -> np.ndarray:
    """Of each stretch of words: share of distinct words, of the commonest, of equal neighbours, and lengths."""
    n = np.bincount(stretch, minlength=stretches)
    kinds = int(codes.max()) + 1
    keys, counts = np.unique(stretch * kinds + codes, return_counts=True)
    owner = keys // kinds
    commonest = np.maximum.reduceat(counts, np.searchsorted(owner, np.arange(stretches)))
    equal = np.bincount(stretch[1:], weights=(codes[1:] == codes[:-1]) & (stretch[1:] == stretch[:-1]), minlength=stretches)
    mean = np.bincount(stretch, weights=lengths, minlength=stretches) / n
    return np.column_stack([np.bincount(owner, minlength=stretches) / n, commonest / n, equal / n, np.minimum(mean, 40) / 10])


def features(text: str | None) -> np.ndarray:
    """Figures of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    lines = raw.split(b"\n")
    n, stretches = len(words), max(1, -(-len(words) // STRETCH))
    buffer = np.frombuffer(raw, np.uint8)
    piece = -(-max(1, len(buffer)) // stretches)
    hist = np.array([np.bincount(buffer[i * piece : (i + 1) * piece], minlength=256) for i in range(stretches)])
    shares, all_shares = _shares(hist), _shares(hist.sum(axis=0, keepdims=True))[0]
    if n:
        seen = {w: i for i, w in enumerate(dict.fromkeys(words))}
        codes = np.fromiter(map(seen.__getitem__, words), np.int64, n)
        lengths = np.fromiter(map(len, words), np.int64, n)
        whole = _repetition(codes, lengths, np.zeros(n, np.int64), 1)[0]
        parts = _repetition(codes, lengths, np.arange(n) // STRETCH, stretches)
        pairs = len(np.unique(codes[:-1] * len(seen) + codes[1:])) / max(1, n - 1)
    else:
        whole, parts, pairs = np.zeros(4), np.zeros((1, 4)), 1.0
    return np.concatenate(
        [
            np.log1p([len(raw), n, len(lines), len(raw) / len(lines)]) / 10,
            [len(set(lines)) / len(lines), pairs], whole, parts.min(axis=0), parts.max(axis=0), all_shares, shares.max(axis=0),
        ]
    ).astype(np.float32)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, place, x`` of every row with a ``place``; ``x`` holds the figures of its text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("place"), x], ["doc_id", "place", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "place", "text").mapInArrow(scan, f"doc_id {kind}, place bigint, x array<float>")


@dataclass
class Model:
    """A network with one hidden layer over standardised figures."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _softplus(v: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, v)


def train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 600, batch: int = 512,
    rate: float = 5e-3, decay: float = 1e-4, seed: int = 9,
) -> Model:
    """Minimise the non-negative risk with Adam; deterministic."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    d = len(mean)
    params = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    p, u = (np.clip((m - mean) / scale, -8, 8) for m in (positive, unlabelled))
    for step in range(1, steps + 1):
        xp, xu = p[rng.integers(0, len(p), batch)], u[rng.integers(0, len(u), batch)]
        x = np.concatenate([xp, xu])
        h = np.tanh(x @ params[0] + params[1])
        f = h @ params[2] + params[3]
        fp, fu = f[:batch], f[batch:]
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative = _softplus(fu).mean() - prior * _softplus(fp).mean()
        if negative >= 0:
            g = np.concatenate([prior * (sp - 1) - prior * sp, su]) / batch
        else:
            g = np.concatenate([prior * sp, -su]) / batch
        gh = np.outer(g, params[2]) * (1 - h * h)
        grads = [x.T @ gh, gh.sum(axis=0), h.T @ g, np.array([g.sum()])]
        lr = rate * (0.5 * (1 + np.cos(np.pi * step / steps)) + 0.01)
        for i, grad in enumerate(grads):
            grad = grad + decay * params[i] if i in (0, 2) else grad
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad * grad
            params[i] -= lr * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, params)


def held_out() -> Column:
    """Whether a document's label is kept for testing."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _matrix(rows: DataFrame, most: int) -> np.ndarray:
    """The figures of ``most`` rows at most, in an order of their own that no run changes."""
    found = rows.orderBy("place", "x").limit(most).select("x").toPandas()["x"].to_numpy()
    return np.stack(found).astype(np.float64) if len(found) else np.zeros((0, 0))


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = 20_000, most_unlabelled: int = 40_000, seed: int = 9) -> Model | None:
    """Train on the labels outside the held-out part; None without positives among ``docs``.

    At most ``most_positive`` rows with a label and ``most_unlabelled`` rows are drawn by a hash of ``doc_id`` and text,
    whatever the identifiers are. Unlabelled rows are drawn by their number in the table too, so that equal rows are
    drawn one by one.
    """
    place = F.xxhash64(F.lit(seed), "doc_id").alias("place")
    row_place = F.xxhash64(F.lit(seed), "doc_id", "text").alias("place")
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "quality")
    prior = known.agg(F.avg("quality")).first()[0]
    drawn = known.filter("quality = 1").select("doc_id", place).distinct().orderBy("place", "doc_id").limit(most_positive)
    # At most ``most_positive`` identifiers.
    trusted = docs.select("doc_id", "text").join(F.broadcast(drawn.drop("place")), "doc_id")
    positive = _matrix(described(trusted.withColumn("place", row_place)), most_positive)
    if not len(positive):
        return None
    share = min(1.0, most_unlabelled / max(1, docs.count()))
    ticket = F.xxhash64(F.lit(seed + 1), "doc_id", "text", F.monotonically_increasing_id())
    numbered = docs.select("doc_id", "text", row_place, F.pmod(ticket, F.lit(1 << 30)).alias("ticket"))
    unlabelled = _matrix(described(numbered.filter(F.col("ticket") < int(share * (1 << 30)))), most_unlabelled)
    if not len(unlabelled):
        unlabelled = positive
    return train(positive, unlabelled, min(float(prior), 0.98), seed=seed)


def _scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    if model is None or not len(texts):
        return np.full(len(texts), 0.5)
    return model.scores(np.stack([features(t.as_py()) for t in texts]).astype(np.float64))


def score(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """``doc_id, held_out, score`` for every row of ``docs``; texts are read once more, in the pass that scores them."""
    model = fit(docs, labels, **bounds)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_scores(model, batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, all their columns."""
    model = fit(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column("text")) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
