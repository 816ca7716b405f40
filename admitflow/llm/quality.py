"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document; only the counts of vote patterns, of which there are a fixed
number, reach the driver. Expectation-maximisation estimates each labeller's accuracies from them, the posterior of a
document's pattern is its soft label, and a bounded sample of so labelled documents trains a linear scorer on hashed
features, which then judges every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, released

DIMS = 4096
LABELLERS = ("capitals", "symbols", "endings", "repeats", "variety", "lines", "cells")
_UPPER, _ALPHA, _SYMBOL = (np.array([chr(i) in s for i in range(256)]) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "#$%&*|<>{}[]^~@+=_\\/!"))


def measure(text: str, raw: np.ndarray) -> np.ndarray:
    """The figures that the labellers judge: shares of the text, and its number of words."""
    words, lines = text.split(), text.split("\n")
    bins = np.bincount(raw, minlength=256)
    n, letters = max(1, len(words)), max(1, bins[_ALPHA].sum())
    return np.array([
        bins[_UPPER].sum() / letters,
        bins[_SYMBOL].sum() / max(1, len(raw)),
        sum(not w[-1].isalnum() and w[-1] not in ".,;:?)\"'" for w in words) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(words)) / n,
        1 - len(set(lines)) / len(lines),
        words.count("|") / n,
        len(words),
    ])


def votes(m: np.ndarray) -> np.ndarray:
    """Votes of the labellers on rows of figures: 1 good, -1 bad, 0 no vote. Short texts get fewer votes."""
    n = m[:, 7]
    judge = lambda x, bad, good, least: np.where(n < least, 0, np.where(bad(x), -1, np.where(good(x), 1, 0)))
    return np.stack([
        judge(m[:, 0], lambda x: x > 0.5, lambda x: x < 0.2, 3),
        judge(m[:, 1], lambda x: x > 0.06, lambda x: x < 0.02, 3),
        judge(m[:, 2], lambda x: x > 0.4, lambda x: x < 0.1, 3),
        judge(m[:, 3], lambda x: x > 0.3, lambda x: x < 0.1, 5),
        judge(m[:, 4], lambda x: x < 0.15, lambda x: x > 0.45, 40),
        judge(m[:, 5], lambda x: x > 0.6, lambda x: x < 0.2, 20),
        judge(m[:, 6], lambda x: x > 0.15, lambda x: x < -1, 5),
    ], axis=1).astype(np.int8)


def features(text: str, raw: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte pairs by share of the text, and hashed bins of the figures: positions and values, norm 1 each."""
    pairs = (raw[:-1].astype(np.uint32) << 8 | raw[1:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
    bins = np.bincount(pairs, minlength=DIMS)
    at = np.flatnonzero(bins)
    value = np.sqrt(bins[at] / max(1, len(pairs)))
    coarse = np.minimum((np.sqrt(np.maximum(m[:7], 0)) * 8).astype(int), 8)
    extra = np.array([xxhash.xxh32_intdigest(f"{k}:{b}") % DIMS for k, b in enumerate(coarse.tolist())])
    return np.concatenate([at, extra]), np.concatenate([value, np.full(len(extra), 7**-0.5)])


def _texts(batch: pa.RecordBatch, size: int = 500) -> Iterator[tuple[pa.RecordBatch, list[tuple[str, np.ndarray]]]]:
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        texts = [t or "" for t in part.column("text").to_pylist()]
        yield part, [(t, np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)) for t in texts]


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(3 ** len(LABELLERS), np.int64)
    for batch in batches:
        for _, texts in _texts(batch):
            counts += np.bincount(_pattern(votes(np.array([measure(*t) for t in texts]))), minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["pattern", "n"])


def _pattern(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) + 1) @ 3 ** np.arange(v.shape[1])


@dataclass
class QualityModel:
    caught: dict[str, float]  # by labeller, chance of a bad vote on a bad document on which it votes
    alarms: dict[str, float]  # the same on a good document
    prior: float
    posterior: np.ndarray  # of good, by vote pattern
    weights: np.ndarray
    bias: float


def estimate(counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Chances of a bad vote on bad and on good documents, share of good ones, and posterior of good by pattern.

    Expectation-maximisation over the pattern counts. Each labeller has an accuracy for either class, as a labeller
    that knows one kind of junk calls the other kinds good. Votes not cast say nothing. A few counts of the starting
    values are added, and the ranges of the two chances don't overlap, so that the classes can't change places.
    """
    k = len(LABELLERS)
    vote = np.arange(3**k)[:, None] // 3 ** np.arange(k) % 3 - 1
    caught, alarms, prior = np.full(k, 0.4), np.full(k, 0.01), 0.9
    logs = lambda p: np.where(vote == -1, np.log(p), np.where(vote == 1, np.log(1 - p), 0)).sum(axis=1)
    for _ in range(rounds):
        posterior = 1 / (1 + np.exp(np.clip(logs(caught) + np.log(1 - prior) - logs(alarms) - np.log(prior), -50, 50)))
        bad, good = counts * (1 - posterior), counts * posterior
        caught = np.clip((bad @ (vote == -1) + 2) / (bad @ (vote != 0) + 5), 0.15, 0.99)
        alarms = np.clip((good @ (vote == -1) + 0.1) / (good @ (vote != 0) + 10), 1e-4, 0.1)
        prior = float(np.clip((good.sum() + 9) / (counts.sum() + 10), 0.3, 0.99))
    return caught, alarms, prior, posterior


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _texts(batch):
            figures = [measure(*t) for t in texts]
            pattern = _pattern(votes(np.array(figures)))
            got = [features(*t, m) for t, m in zip(texts, figures)]
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array([a.astype(np.int16).tobytes() for a, _ in got]), pa.array([v.astype(np.float32).tobytes() for _, v in got])], ["pattern", "at", "value"])


def train_quality_model(docs: DataFrame, sample_rows: int = 4000, epochs: int = 120) -> QualityModel:
    """Votes of all ``docs(doc_id, text)``; a scorer fitted on about ``sample_rows`` of their distinct rows.

    The sample is bounded at every size and holds no copies, see ``bounded_sample``. An empty table gives a model
    that scores 0.5.
    """
    table = docs.select("text").mapInArrow(released(_vote), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(3 ** len(LABELLERS), np.int64)
    for r in table:
        counts[r.pattern] = r.n
    caught, alarms, prior, posterior = estimate(counts)
    sample = bounded_sample(docs.select("doc_id", "text").where("text is not null"), sample_rows).select("text")
    rows = sorted(sample.mapInArrow(released(_train), "pattern long, at binary, value binary").collect())
    weights, bias = np.zeros(DIMS), 0.0
    if rows:
        at = [np.frombuffer(r.at, np.int16).astype(np.int64) for r in rows]
        flat, value = np.concatenate(at), np.concatenate([np.frombuffer(r.value, np.float32) for r in rows]).astype(np.float64)
        row = np.repeat(np.arange(len(rows)), [len(a) for a in at])
        target = posterior[[r.pattern for r in rows]]
        share = np.clip(target.mean(), 0.02, 0.98)
        importance = target * 0.5 / share + (1 - target) * 0.5 / (1 - share)
        square, square_bias = np.full(DIMS, 1e-3), 1e-3
        for _ in range(epochs):  # full-batch steps scaled by past gradients
            p = 1 / (1 + np.exp(-(np.bincount(row, value * weights[flat], len(rows)) + bias)))
            error = importance * (p - target) / len(rows)
            step = np.bincount(flat, value * error[row], DIMS) + 1e-5 * weights
            square, square_bias = square + step**2, square_bias + error.sum() ** 2
            weights, bias = weights - 0.3 * step / np.sqrt(square), bias - 0.3 * error.sum() / np.sqrt(square_bias)
    return QualityModel(dict(zip(LABELLERS, caught.tolist())), dict(zip(LABELLERS, alarms.tolist())), prior, posterior, weights, float(bias))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` with quality (0 to 1), weak_label and accepted; a column of such a name is replaced.

    ``weak_label`` is the posterior from the votes alone. A document is accepted where the scorer gives
    ``threshold`` or more; null, empty and blank texts score 0 and are rejected. Every row gives one row.
    """
    new = ["quality", "weak_label", "accepted"]
    docs = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", quality double, weak_label double, accepted boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: QualityModel = shared.value
        for batch in batches:
            for part, texts in _texts(batch):
                figures = [measure(*t) for t in texts]
                got = [features(*t, f) for t, f in zip(texts, figures)]
                score = np.array([1 / (1 + np.exp(-np.clip(v @ m.weights[a] + m.bias, -50, 50))) for a, v in got])
                weak = m.posterior[_pattern(votes(np.array(figures)))]
                blank = np.array([f[7] == 0 for f in figures])
                score[blank], weak[blank] = 0, 0
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score), pa.array(weak), pa.array(score >= threshold)], [*part.schema.names, *new])

    return docs.mapInArrow(released(run), schema)
