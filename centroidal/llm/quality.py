"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a linear model over text features by
minimising the non-negative unbiased risk pi R_p(+1) + max(0, R_u(-1) - pi R_p(-1)) (logistic loss).
The class prior pi is estimated first: a plain positive-against-unlabelled model scores both
sides, and pi is the least ratio of their upper tails (best-bin estimate), where only positives
remain. Labels other than 1 are not used for training.

The unlabelled side is every training row: its features are written once, and each of some twenty Newton steps is one
Spark job that sums loss, gradient and curvature over them; tail counts are one more. Inside the region where the
estimated risk of the negative class is not negative the unbiased risk is convex, and Newton's steps minimise it; a step
that leaves the region is halved until it does not, which is where the maximum takes hold. Only the positives, labelled
rows, are bounded by ``sample_rows`` (expected, by a hash of the id; the bound is the parameter); their features reach
the driver. Scores cover every whole text; null and empty texts have the features of no words and get that score.
Without positives or unlabelled rows the model is constant.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.llm.frames import dropped, map_batches, written

SAMPLE_ROWS = 20_000
#: Newton steps at most, halvings of one, the gradient's length that ends them, and the weight of squared weights.
STEPS, HALVINGS, SMALL, DECAY = 25, 8, 1e-5, 1e-4

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGIT = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:"
_SYMBOL = bytes(c for c in range(0x21, 0x7F) if c not in _UPPER + _LOWER + _DIGIT + _STOPS)
_LOUD = b"!?#$%&*|"
N_BASE = 14
N_FEATURES = 2 * N_BASE


def _share(text: bytes, chars: bytes) -> float:
    return (len(text) - len(text.translate(None, chars))) / len(text)


def features(text: str | None) -> list[float]:
    """Shares of character classes, word shapes and repetition of one whole text."""
    if not text or not text.strip():
        return [0.0] * N_BASE
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x]
    own = len(set(words))
    return [
        math.log1p(n) / 10,
        _share(raw, _UPPER), _share(raw, _DIGIT), _share(raw, _STOPS), _share(raw, _SPACE),
        min(1.0, 5 * _share(raw, _SYMBOL)), min(1.0, 10 * _share(raw, _LOUD)),
        min(1.0, len(text) / n / 20),
        own / n,
        math.log(own) / math.log(n) if n > 1 else 1.0,
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words, words[2:])) / n,
        len(set(lines)) / len(lines),
        len(lines) / n,
    ]


def _design(base: np.ndarray) -> np.ndarray:
    """Base features with their squares."""
    return np.hstack([base, base * base])


def _feature_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.float64()))], names=["x"])


@dataclass
class QualityModel:
    """A standardised linear model and the class prior it was trained with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, base: np.ndarray) -> np.ndarray:
        z = (_design(base) - self.mean) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def standardised(base: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The design of base features, standardised, with a last column of ones."""
    return np.hstack([(_design(base) - mean) / scale, np.ones((len(base), 1))])


def moment_sums(base: np.ndarray) -> np.ndarray:
    """Rows, sums and sums of squares of the design."""
    x = _design(base)
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def risk_sums(base: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over rows of the loss as negatives log(1 + e^z), its gradient and its second derivatives."""
    x = standardised(base, mean, scale)
    z = x @ w
    s = _sigmoid(z)
    return np.concatenate([[np.logaddexp(0, z).sum()], s @ x, ((x * (s * (1 - s))[:, None]).T @ x).ravel()])


def tail_counts(base: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Rows whose score reaches each of the ascending thresholds."""
    z = np.sort(standardised(base, mean, scale) @ w)
    return (len(z) - np.searchsorted(z, thresholds, "left")).astype(float)


Summed = Callable[..., np.ndarray]


def estimate_prior(positive: np.ndarray, tails: Callable[[np.ndarray], np.ndarray], n: float) -> float:
    """Least ratio of upper tails P_u(s >= t) / P_p(s >= t) over thresholds that at least a tenth of
    the positives pass, with a margin for sampling error; within [0.01, 0.99]. ``tails``: counts of the
    ``n`` unlabelled rows that reach thresholds."""
    p = np.sort(positive)
    t = np.quantile(p, np.linspace(0, 0.9, 91))
    tail_p = 1 - np.searchsorted(p, t, "left") / len(p)
    tail_u = tails(t) / n
    margin = math.sqrt(1 / len(p)) + math.sqrt(1 / n)
    best = int(np.argmin((tail_u + margin) / tail_p))
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def _newton(value: Callable, size: int) -> np.ndarray:
    """Minimise from zero; ``value(w)`` gives loss, gradient, curvature and whether w is allowed."""
    w = np.zeros(size)
    loss, gradient, curvature, _ = value(w)
    for _ in range(STEPS):
        if np.linalg.norm(gradient) < SMALL:
            break
        step = np.linalg.solve(curvature + 1e-9 * np.eye(size), gradient)
        for half in range(HALVINGS):
            trial = w - step / 2 ** half
            found = value(trial)
            if found[3] and found[0] <= loss:
                break
        else:
            break
        done = loss - found[0] < 1e-9 * abs(loss)
        w, (loss, gradient, curvature, _) = trial, found
        if done:
            break
    return w


def train_pu(positive: np.ndarray, unlabelled: Summed, prior: float | None = None) -> QualityModel:
    """Fit on base features of trusted positives; ``unlabelled(f, *args)`` gives the sum of ``f(base, *args)`` over parts
    of the unlabelled rows."""
    moments = unlabelled(moment_sums)
    own = moment_sums(positive)
    n, k = moments[0], N_FEATURES
    every = moments + own
    mean = every[1:k + 1] / every[0]
    scale = np.sqrt(np.maximum(0.0, every[k + 1:] / every[0] - mean * mean)) + 1e-6
    xp = standardised(positive, mean, scale)
    size = k + 1
    decay = np.append(np.full(k, DECAY), 0.0)

    def parts(w):
        sums = unlabelled(risk_sums, mean, scale, w) / n
        return sums[0], sums[1:size + 1], sums[size + 1:].reshape(size, size)

    if prior is None:
        def against(w):
            loss, gradient, curvature = parts(w)
            z = xp @ w
            s = _sigmoid(z)
            return ((np.logaddexp(0, -z).mean() + loss + decay @ (w * w)) / 2, (gradient - (1 - s) @ xp / len(xp)) / 2 + decay * w,
                    (curvature + (xp * (s * (1 - s))[:, None]).T @ xp / len(xp)) / 2 + np.diag(decay), True)
        w = _newton(against, size)
        prior = estimate_prior(xp @ w, lambda t: unlabelled(tail_counts, mean, scale, w, t), n)

    centre = xp.mean(0)

    def non_negative(w):
        loss, gradient, curvature = parts(w)
        z = xp @ w
        negative = loss - prior * np.logaddexp(0, z).mean()
        # prior (R_p(+1) - R_p(-1)) is linear for the logistic loss
        return loss - prior * z.mean() + decay @ (w * w) / 2, gradient - prior * centre + decay * w, curvature + np.diag(decay), negative >= 0

    w = _newton(non_negative, size)
    return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)


def _sampled(rows: DataFrame, sample_rows: int) -> DataFrame:
    n = rows.count()
    unit = F.xxhash64("id", F.lit(10)).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / float(1 << 52)
    return rows.filter(unit < min(1.0, sample_rows / max(1, n))).select("text")


def _bases(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_BASE)


def _summed(features_of: DataFrame) -> Summed:
    """Sums of a function over the Arrow batches of the features, added up by Spark: one job a call."""
    def total(f, *args) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = None
            for b in batches:
                if b.num_rows:
                    part = f(_bases(b.column(0)), *args)
                    own = part if own is None else own + part
            if own is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own))), pa.array(own)], names=["cell", "value"])
        cells = features_of.select("x").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        return np.array([r["value"] for r in cells.orderBy("cell").collect()])
    return total


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Train on ``docs`` (all of them the unlabelled web text) and the rows that ``labels`` marks 1. A document
    counts as positive once however often ``labels`` repeats its mark."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("mark")).filter("mark = 1").select("id")
    trusted = map_batches(_sampled(rows.join(marked, "id", "left_semi"), sample_rows), _feature_batch, "x array<double>").toArrow()
    positive = np.concatenate([np.zeros((0, N_BASE)), *(_bases(c) for c in trusted.column("x").chunks)])
    unlabelled = written(docs.sparkSession, map_batches(rows.select("text"), _feature_batch, "x array<double>"), "quality-features")
    if not len(positive) or unlabelled.isEmpty():
        zero = np.zeros(N_FEATURES)
        model = QualityModel(zero, zero + 1, zero, 0.0, 0.5)
    else:
        model = train_pu(positive, _summed(unlabelled))
    dropped(unlabelled)
    return model


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every whole text; one row per input row."""
    kept = docs.select(id_col, text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t) for t in b.column(1).to_pylist()], dtype=np.float64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], names=[id_col, "score"])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, score double")
