"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the words of a text and the first letters of its words. It is
trained from confirmed toxic texts (positives) and from texts whose label is not looked at
(unlabelled), by the risk

    R = p * mean_P l(f, +1) + max(0, mean_U l(f, -1) - p * mean_P l(f, -1))

where p is the share of toxic texts. Where the second part falls below zero, the step goes
against its gradient, as in the non-negative estimator of Kiryo et al. (2017).

Fitting uses at most ``max_positive`` and ``max_unlabelled`` rows, the ones with the smallest
hash of their id. The share p and every score cover all rows.

* A null text counts as empty; an empty text has the score of the intercept alone.
* Repeated rows are scored alike. Without any positive row all scores are 0.
* A text is scored by the set of its features, so very long texts cost one pass.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import each

_LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
THRESHOLD = 0.7


def features(text: str | None) -> set[str]:
    """The distinct words of a text, and each word's first letters (marked by ``~``)."""
    words = set(_LETTERS.findall((text or "").lower()))
    for n in PREFIXES:
        words |= {w[:n] + "~" for w in words if len(w) >= n and w[-1] != "~"}
    return words


@dataclass
class Model:
    """Weights by feature, and an intercept."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0
    prior: float = 0.0

    def score(self, text: str | None) -> float:
        known = self.weights.keys() & features(text)
        z = self.bias + sum(self.weights[f] for f in sorted(known))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


@dataclass(frozen=True)
class Settings:
    max_positive: int = 3000
    max_unlabelled: int = 9000
    min_documents: int = 3
    min_lift: float = 2.0
    min_gain: float = 25.0
    max_features: int = 20_000
    epochs: int = 300
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


def _vocabulary(positive: list[str], unlabelled: list[str], s: Settings) -> list[str]:
    """Features of at least ``min_documents`` positives whose share there is ``min_lift`` times
    that among the unlabelled or more, the most telling first."""
    in_p, in_u = Counter(), Counter()
    for text in positive:
        in_p.update(features(text))
    least = min(s.min_documents, max(1, len(positive)))
    in_p = Counter({f: c for f, c in in_p.items() if c >= least})
    for text in unlabelled:
        in_u.update(in_p.keys() & features(text))
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    lift = {f: ((c + 0.5) / (n_p + 1)) / ((in_u[f] + 0.5) / (n_u + 1)) for f, c in in_p.items()}
    gain = {f: in_p[f] * np.log(x) for f, x in lift.items() if x >= s.min_lift}
    gain = {f: g for f, g in gain.items() if g >= min(s.min_gain, max(gain.values()) / 2)}
    return [f for f, _ in sorted(gain.items(), key=lambda x: (-x[1], x[0]))[: s.max_features]]


def _sparse(texts: list[str], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts in one array, and where each text starts."""
    ids = [
        np.array(sorted(index[f] for f in index.keys() & features(t)), dtype=np.int32)
        for t in texts
    ]
    starts = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum([len(i) for i in ids], out=starts[1:])
    return np.concatenate(ids), starts


def _outputs(w: np.ndarray, b: float, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(w[flat])])
    return sums[starts[1:]] - sums[starts[:-1]] + b


def _gradient(g: np.ndarray, flat: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(flat, weights=np.repeat(g, np.diff(starts)), minlength=n)


def fit(
    positive: list[str], unlabelled: list[str], prior: float, settings: Settings = Settings()
) -> Model:
    """Train on texts. ``prior`` is the share of toxic texts among all."""
    if not positive or not unlabelled or prior <= 0:
        return Model()
    prior = min(prior, 0.95)
    names = _vocabulary(positive, unlabelled, settings)
    index = {f: i for i, f in enumerate(names)}
    n = len(names)
    p_flat, p_at = _sparse(positive, index)
    u_flat, u_at = _sparse(unlabelled, index)
    w, b = np.zeros(n), np.log(prior / (1 - prior))
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, settings.epochs + 1):
        f_p, f_u = _outputs(w, b, p_flat, p_at), _outputs(w, b, u_flat, u_at)
        s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))  # slopes of l(f, -1)
        negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        g_u, g_p = s_u / len(f_u), -prior * s_p / len(f_p)
        if negative >= 0:
            g_p = g_p - prior * (1 - s_p) / len(f_p)
        else:
            g_u, g_p = -g_u, -g_p
        grad = _gradient(g_p, p_flat, p_at, n) + _gradient(g_u, u_flat, u_at, n)
        full = np.append(grad + settings.decay * w, g_p.sum() + g_u.sum())
        mean = 0.9 * mean + 0.1 * full
        square = 0.999 * square + 0.001 * full**2
        move = settings.rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.999**step)) + 1e-8
        )
        w, b = w - move[:n], b - move[n]
    kept = {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}
    return Model(kept, float(b), float(prior))


def scores(text: Column, model: Model) -> Column:
    """The score of a text column under a trained model."""

    @F.arrow_udf(T.DoubleType())
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in each(texts)], pa.float64())

    return apply(text)


def train(
    docs: DataFrame,
    labels: DataFrame,
    train_on: Column | None = None,
    settings: Settings = Settings(),
) -> Model:
    """Train from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``train_on`` is a condition on ``doc_id``; labels of other rows are not read. Positives
    are labelled toxic. Unlabelled texts are drawn from all admitted documents, whatever
    their label may say, so they follow the corpus. The share of toxic texts is taken over
    all admitted labels; a row with several labels is toxic if one says so.
    """
    admitted = F.col("doc_id").isNotNull() & (F.lit(True) if train_on is None else train_on)
    known = (
        labels.select("doc_id", "toxic")
        .where(admitted & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first().p or 0.0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = known.where(F.col("toxic") == 1).orderBy(*order).limit(settings.max_positive)
    drawn = docs.select("doc_id").where(admitted).orderBy(*order).limit(settings.max_unlabelled)
    return fit(_texts(docs, toxic), _texts(docs, drawn), float(share), settings)


def _texts(docs: DataFrame, ids: DataFrame) -> list[str]:
    """The texts of a list of ids that a parameter bounds, in a fixed order."""
    few = F.broadcast(ids.select("doc_id").distinct())
    found = docs.select("doc_id", "text").join(few, "doc_id", "left_semi")
    return found.orderBy("doc_id", "text").toArrow()["text"].to_pylist()
