"""Quality classifier from trusted positives and unlabelled text: non-negative positive-unlabelled risk.

The network sees shape features of whole texts. It is fitted on bounded samples (``Fit``); all rows are scored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lines import repeated_words
from .text import pieces, texts


def _classes() -> np.ndarray:
    """Sixteen classes of bytes."""
    table = np.full(256, 15, np.uint8)
    groups = (b"aeiouy", b"bcdfghjklmnpqrstvwxz", bytes(range(65, 91)), b"0123456789", b" \t", b"\n\r\x0b\x0c", b".", b",;:", b"!", b"?", b"#*$%&", b"|<>", b"'\"`()[]{}", b"/\\_-+=@~^", bytes(range(0x80, 0xC0)))
    for k, group in enumerate(groups):
        table[list(group)] = k
    return table


CLASSES = _classes()
EXTRA = 9
WIDTH = 256 + EXTRA


def features(text: bytes) -> np.ndarray:
    """Root shares of pairs of byte classes, and shares that tell repetition, shouting and broken lines.

    Repetition is looked for inside parts of about a megabyte.
    """
    pairs = np.zeros(256, np.int64)
    n = chars = distinct = twins = repeated = lines = copies = open_ended = 0
    for part in pieces(text):
        c = CLASSES[np.frombuffer(part, np.uint8)]
        pairs += np.bincount(c[:-1].astype(np.int64) * 16 + c[1:], minlength=256) if len(c) > 1 else 0
        w = part.split()
        n += len(w)
        chars += sum(map(len, w))
        distinct += len(set(w))
        twins += sum(map(operator.eq, w, w[1:]))
        repeated += repeated_words(w)
        rows = [x for x in part.split(b"\n") if x.strip()]
        lines += len(rows)
        copies += len(rows) - len(set(rows))
        open_ended += sum(not x.rstrip().endswith((b".", b"!", b"?", b'"')) for x in rows)
    words, rows = max(n, 1), max(lines, 1)
    upper = pairs.reshape(16, 16)[2].sum()
    extra = (np.log1p(n) / 5, chars / words / 10, distinct / words, twins / words, repeated / words, copies / rows, upper / max(1, pairs.sum()), np.log1p(n / rows) / 3, open_ended / rows)
    return np.r_[np.sqrt(pairs / max(1, pairs.sum())), extra].astype(np.float32)


@dataclass(frozen=True)
class Fit:
    """``positives`` and ``unlabelled``: rows learned from, in expectation, chosen by a hash of the key."""

    positives: int = 8000
    unlabelled: int = 16000
    hidden: int = 8
    steps: int = 150
    batch: int = 512
    rate: float = 3e-3
    decay: float = 1e-2
    seed: int = 7


@dataclass
class Network:
    """One hidden layer over standardised features; ``prior`` is the share of positives in unlabelled text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -60, 60)))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def risk_gradient(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Non-negative risk under the logistic loss, and its gradient by the logits of both samples.

    The part that estimates the negatives' loss, E_u[l(-g)] - prior E_p[l(-g)], can't be below zero
    in truth; where a batch makes it so, a step is taken that lifts it back.
    """
    sig_p, sig_u = 1 / (1 + np.exp(-positive)), 1 / (1 + np.exp(-unlabelled))
    negative = softplus(unlabelled).mean() - prior * softplus(positive).mean()
    loss = prior * softplus(-positive).mean() + max(0.0, negative)
    on_p, on_u = -prior * sig_p / len(positive), sig_u / len(unlabelled)
    if negative < 0:
        return loss, -on_p, -on_u
    return loss, prior * (sig_p - 1) / len(positive) + on_p, on_u


def train_network(p: np.ndarray, u: np.ndarray, prior: float | None, fit: Fit) -> Network:
    """Adam on the risk; with no prior given, plain logistic loss between the two samples."""
    r = np.random.default_rng(fit.seed)
    mean, scale = u.mean(0), u.std(0) + 1e-3
    net = Network(mean, scale, [r.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, fit.hidden)), np.zeros(fit.hidden), r.normal(0, 1 / np.sqrt(fit.hidden), fit.hidden), np.zeros(())], prior or 0.5)
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (p, u))
    m, v, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    while step < fit.steps:
        order = r.permutation(len(u))
        for at in range(0, len(u), fit.batch):
            xu, xp = u[order[at : at + fit.batch]], p[r.integers(0, len(p), min(fit.batch, len(p)))]
            a, b, c, d = net.weights
            hp, hu = np.tanh(xp @ a + b), np.tanh(xu @ a + b)
            gp, gu = hp @ c + d, hu @ c + d
            if prior is None:
                dp, du = (1 / (1 + np.exp(-gp)) - 1) / len(gp), 1 / (1 + np.exp(-gu)) / len(gu)
            else:
                _, dp, du = risk_gradient(gp, gu, prior)
            bp, bu = dp[:, None] * c * (1 - hp * hp), du[:, None] * c * (1 - hu * hu)
            grads = [xp.T @ bp + xu.T @ bu + fit.decay * a, bp.sum(0) + bu.sum(0), hp.T @ dp + hu.T @ du + fit.decay * c, dp.sum() + du.sum()]
            step += 1
            rate = fit.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.weights[i] = net.weights[i] - rate * m[i] / (np.sqrt(v[i]) + 1e-8)
    return net


def estimate_prior(p: np.ndarray, u: np.ndarray, fit: Fit) -> float:
    """Share of positives in ``u``: the least ratio of the two samples' tails above a score.

    A classifier of ``p`` against ``u`` is fitted on one half; on the other half, tails that hold
    only positives are smaller in ``u`` by just the prior. Tails of less than half the positives are
    left out, as chance could make them small.
    """
    net = train_network(p[::2], u[::2], None, fit)
    sp, su = np.sort(net.logits(p[1::2])), np.sort(net.logits(u[1::2]))
    if not len(sp) or not len(su):
        return 0.5
    at = np.quantile(sp, np.linspace(0.005, 0.5, 200))
    tail_p, tail_u = 1 - np.searchsorted(sp, at) / len(sp), 1 - np.searchsorted(su, at) / len(su)
    k = int(np.argmin(tail_u / tail_p))
    return float(np.clip(tail_u[k] / tail_p[k], 0.05, 0.98))


def _matrix(rows: DataFrame, text: str) -> np.ndarray:
    """Features of a bounded sample, in an order that doesn't depend on the partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t).tobytes() for t in texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["x"])

    found = sorted(r.x for r in rows.select(text).mapInArrow(run, "x binary").collect())
    out = np.frombuffer(b"".join(found), np.float32).reshape(-1, WIDTH).astype(np.float64)
    return out[np.random.default_rng(0).permutation(len(out))]


def _sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    n = rows.count()
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, size / max(1, n)))))


def train(docs: DataFrame, positives: DataFrame, key: str = "doc_id", text: str = "text", fit: Fit = Fit()) -> Network | None:
    """Network from ``docs`` as unlabelled text and the rows of ``docs`` whose key is in ``positives``; None without any.

    The sampled keys are at most about ``fit.positives``, a size that may be broadcast.
    """
    keys = F.broadcast(_sample(positives.select(key).filter(F.col(key).isNotNull()).distinct(), key, fit.positives))
    docs = docs.select(key, text)
    p, u = _matrix(docs.join(keys, key, "left_semi"), text), _matrix(_sample(docs, key, fit.unlabelled), text)
    if len(p) < 2 or len(u) < 2:
        return None
    return train_network(p, u, estimate_prior(p, u, fit), fit)


def score(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score``: probability that a text is good. Null is empty text; without a network all scores are 0.5.

    Repeated rows and null keys give a row each; an empty table gives an empty one; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = net.scores(np.stack([features(t) for t in texts(b.column(1))])) if net and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=[key, "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")
