"""Quality classifier from positive and unlabelled texts.

The classifier sees trusted positives and unlabelled web text, never a negative label. It minimises the non-negative
unbiased risk  prior * R+(f) + max(0, R-u(f) - prior * R-p(f))  with the logistic loss, so that its output estimates
the probability of a good text. The class prior is estimated from the same two samples.

Fitting runs on the driver over two samples of bounded size (parameters); scoring runs in one pass over all texts
without a shuffle. Only the model, a few tens of kilobytes whatever the input, goes to the tasks.

Defined cases: a null text counts as empty, an empty text is scored like any other; a row without an id is in no fold,
is scored, and is not learned from; a document with contradicting or repeated labels is trusted only if all of them
say 1; without positives or without unlabelled text the score of every row is the prior, 0.5; further columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import drawn, fold, per_row

_SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, 9, np.uint8)  # 9: other printable bytes
for _i, _bytes in enumerate(
    (range(97, 123), range(65, 91), range(48, 58), b" \t\x0b\x0c\r", b"\n", _SYMBOLS, b".,;:", b"!?", b"\"'()-")
):
    _CLASS[list(_bytes)] = _i
_CLASS[128:] = 0  # letters beyond ASCII, for the languages at hand
_CLASS[:9] = _CLASS[14:32] = _CLASS[127] = 10
_CLASSES = 11


def features(raw: bytes) -> np.ndarray:
    """Shape of a whole text, in any language: classes of characters and their transitions, repetition, lines."""
    codes = np.frombuffer(raw, np.uint8)
    kinds = _CLASS[codes]
    n = max(1, len(kinds))
    pairs = np.bincount(
        kinds[:-1].astype(np.int64) * _CLASSES + kinds[1:], minlength=_CLASSES * _CLASSES
    ) if len(kinds) > 1 else np.zeros(_CLASSES * _CLASSES)
    words = raw.lower().split()
    n_words = max(1, len(words))
    counts = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    most = max(counts.values(), default=0)
    twos = len(set(zip(words, words[1:]))) / max(1, len(words) - 1)
    fours = len(set(zip(words, words[1:], words[2:], words[3:]))) / max(1, len(words) - 3)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    letters = np.bincount(kinds, minlength=_CLASSES)[:_CLASSES]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    shape = [
        np.log1p(len(raw)) / 10, np.log1p(len(words)) / 10, len(raw) / n_words / 10, sizes.std() / 10 if len(words) else 0,
        (sizes > 20).mean() if len(words) else 0, len(counts) / n_words, most / n_words, twos, fours,
        len(set(lines)) / n_lines, np.log1p(n_words / n_lines) / 5, letters[1] / max(1, letters[0] + letters[1]),
        sum(not x[-1:].isalnum() for x in words) / n_words, float(len(words) < 10), float(not words),
    ]
    return np.concatenate((shape, letters / n, np.sqrt(pairs / n))).astype(np.float32)


@dataclass
class Model:
    """A network of one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, (x - self.mean) / self.scale)[1], -30, 30)))


def _forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + w[3][0]


def _fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int, seed: int, hidden: int = 24) -> list[np.ndarray]:
    """Adam on the non-negative risk; where the negative part is below zero, its gradient is followed upwards."""
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    w = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, steps + 1):
        bp, bu = p[rng.integers(0, len(p), 512)], u[rng.integers(0, len(u), 512)]
        (hp, fp), (hu, fu) = _forward(w, bp), _forward(w, bu)
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative >= 0:
            gp, gu = prior * (sp - 1) / len(fp) - prior * sp / len(fp), su / len(fu)
        else:  # the bound is hit: undo the over-fitting of the negative part
            gp, gu = prior * sp / len(fp), -su / len(fu)
        x, h, g = np.vstack((bp, bu)), np.vstack((hp, hu)), np.concatenate((gp, gu))
        back = np.outer(g, w[2]) * (1 - h * h)
        grads = [x.T @ back + 1e-3 * w[0], back.sum(0), h.T @ g + 1e-3 * w[2], np.array([g.sum()])]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad * grad
            w[i] = w[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """The share of positives among the unlabelled, from scores of rows that the scorer has not seen.

    Above any threshold c lie at most share(unlabelled) / share(positive) of positives; the least of these upper
    bounds over thresholds, each widened by its sampling error, estimates the share.
    """
    order = np.sort(positive)[::-1]
    n, m = len(order), len(unlabelled)
    if not n or not m:
        return 0.5
    above_p = np.arange(1, n + 1) / n
    above_u = 1 - np.searchsorted(np.sort(unlabelled), order, side="left") / m
    error = np.sqrt(np.log(4 / confidence) / 2) * (n**-0.5 + m**-0.5)
    best = int(np.argmin((above_u + error) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 1500, seed: int = 7) -> Model:
    """A model from features of trusted positives and of unlabelled texts, in any order."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(1), np.ones(1), [], 0.5)
    mean, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 0.02)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    half = lambda x, i: x[i::2] if len(x) > 1 else x
    rough = _fit(half(p, 0), half(u, 0), 0.5, steps // 3, seed)  # ranks; half of the rows stay unseen
    prior = estimate_prior(_forward(rough, half(p, 1))[1], _forward(rough, half(u, 1))[1])
    return Model(mean, scale, _fit(p, u, prior, steps, seed + 1), prior)


def train(documents: DataFrame, labels: DataFrame, sample: int = 6000, seed: int = 7) -> Model:
    """Learns from documents (doc_id, text) and labels (doc_id, quality) of the folds other than 0.

    sample bounds the rows of each kind that come to the driver, as features: the trusted positives, and the texts
    of the corpus at large, whose labels are not looked at. Rows are drawn by a hash of the id, alike at every run.
    Features are computed for the drawn ids only, one row of each, however many rows an id has.
    """
    open_ids = documents.select("doc_id").where(fold(F.col("doc_id")) > 0)
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1").select("doc_id")
    wanted = (
        drawn(open_ids.join(trusted, "doc_id", "left_semi"), sample, seed).withColumn("kind", F.lit(1))
        .unionByName(drawn(open_ids, sample, seed + 1).withColumn("kind", F.lit(0)))
        .withColumnRenamed("doc_id", "wanted")
    )
    # At most 2 * sample ids: the bound of what is broadcast. Of the rows of one id a task keeps one, the least text.
    rows = documents.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted"))
    rows = rows.groupBy("kind", "doc_id").agg(F.min(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    got = per_row(rows, "x array<float>", ["doc_id", "kind"], "text", lambda raw: (features(raw).tolist(),)).toPandas()
    got = got.sort_values(["kind", "doc_id"])  # in one order at every run
    width = len(features(b""))
    of = lambda kind: np.array(got.x[got.kind == kind].tolist(), np.float64).reshape(-1, width)
    return fit(of(1), of(0), seed=seed)


def score(documents: DataFrame, model: Model, keep: list[str], score: str = "score") -> DataFrame:
    """The kept columns and the score (0 to 1) of every whole text, in a column named by `score`."""

    def one(raw: bytes) -> tuple[float]:
        return (float(model.score(features(raw)[None].astype(np.float64))[0]),)

    return per_row(documents, f"{score} double", keep, "text", one)
