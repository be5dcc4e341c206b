"""Quality scores: random Fourier features of document statistics, ridge normal equations, isotonic calibration.

A text becomes a vector of statistics; cosines of random projections
approximate a Gaussian kernel over them; each partition of the labelled sample
sums up its normal equations, and the driver solves them. Two halves of the
sample are also solved apart, each scores the other, and an isotonic fit of
those scores turns ridge values into probabilities.

The fit uses at most about ``max_rows`` labelled rows (a documented bound, drawn
by hash); scoring covers every row and whole texts, without a shuffle.

Defined results: null and empty texts are scored as texts without words. A text
of any length is summed up by its 25 statistics. Rows that repeat stay rows and
score alike; rows of one id are scored one by one; a null id is in the fold of
the empty text. Repeated labels of an id are averaged, ties count as 1; equal
ridge values have one calibrated score. Without usable labels, or with labels of
one kind, every score is their mean (0.5 for none). Empty tables give no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, crc_fold, labelled_sample, map_texts, materialize, tune

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HIGH = np.zeros(256, bool)
_HIGH[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 44, 46, 58, 59, 63]] = True
_OTHER = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH | _STOP)
CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _STOP, _OTHER]).astype(np.float64)
N_STATS = 25


def statistics(text: bytes) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * N_STATS
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = CLASSES @ counts / n
    share = counts[counts > 0] / n
    words = text.lower().split()
    k = max(1, len(words))
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    lines = text.split(b"\n")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    return [
        np.log1p(n), *kinds.tolist(), -float(share @ np.log(share)), np.log1p(len(words)), distinct / k, np.log1p(distinct) / np.log1p(k) if words else 0.0, repeats / k,
        float(sizes.mean()), float(sizes.std()), float((sizes == 1).mean()), len(set(lines)) / len(lines), np.log1p(len(lines)), len(lines) / k,
        counts[33] / k, counts[124] / k, float(counts[[35, 36, 37, 38, 42]].sum()) / k, (counts[46] + counts[63]) / k, counts[44] / k, min(1.0, n / 200.0),
    ]


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, N_STATS)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit of y over x: centres of the blocks and their values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, at = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + at]
    sums = np.array(blocks)
    return sums[:, 2] / sums[:, 1], sums[:, 0] / sums[:, 1]


class Model:
    """Everything a worker needs to score: a few hundred kilobytes at most."""

    def __init__(self, mean, scale, projection, phase, weights, knots, constant=None) -> None:
        self.mean, self.scale, self.projection, self.phase, self.weights, self.knots, self.constant = mean, scale, projection, phase, weights, knots, constant

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.ones((len(z), 1)), np.sqrt(2 / len(self.phase)) * np.cos(z @ self.projection + self.phase)], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        raw = self.features(_matrix(texts)) @ self.weights
        return np.clip(np.interp(raw, *self.knots) + 1e-3 * (np.tanh(raw - 0.5)), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1, max_rows: int = 20_000, n_features: int = 384, gamma: float = 0.02, ridge: float = 1e-2, seed: int = 7) -> Model:
    """A model of ``label`` from rows outside the held-out fold."""
    tune(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, id_col, text_col, folds, held_out, max_rows, "quality")

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix([t or b"" for t in batch.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(m.tolist(), pa.list_(pa.float64()))], names=["id", "y", "x"])

    # the sample is bounded, its scan is not: only what lies behind the shuffle is brought into few tasks
    table = materialize(sample.mapInArrow(stats, f"id {docs.schema[id_col].dataType.simpleString()}, y double, x array<double>").distinct().select("y", "x").coalesce(8))
    pick = [F.col("x")[i] for i in range(N_STATS)]
    row = table.agg(F.count("*"), F.avg("y"), *(F.avg(c) for c in pick), *(F.stddev_pop(c) for c in pick)).first()
    n, base = row[0], row[1]
    if not n or base in (0.0, 1.0):
        return Model(None, None, None, None, None, None, 0.5 if not n else float(base))
    rng = np.random.default_rng(seed)
    mean, scale = np.array(row[2 : 2 + N_STATS]), np.array(row[2 + N_STATS :]) + 1e-6
    model = Model(mean, scale, rng.normal(0, np.sqrt(2 * gamma), (N_STATS, n_features)), rng.uniform(0, 2 * np.pi, n_features), None, None)
    width = n_features + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        total = np.zeros((2, width, width + 1))
        for batch in batches:
            y = np.asarray(batch.column(0))
            z = model.features(np.array(batch.column(1).to_pylist()))
            half = (np.abs(z[:, 1:9]).sum(axis=1) * 1e6).astype(np.int64) % 2
            for h in (0, 1):
                total[h] += z[half == h].T @ np.c_[z, y][half == h]
        return {"sums": total}

    halves = sum(np.frombuffer(b["sums"]).reshape(2, width, width + 1) for b in blobs(table, normal))

    def solve(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[:, :width] + ridge * np.eye(width), total[:, width])

    apart = [solve(halves[1]), solve(halves[0])]  # each half is scored by the other's weights

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = model.features(np.array(batch.column(1).to_pylist()))
                half = (np.abs(z[:, 1:9]).sum(axis=1) * 1e6).astype(np.int64) % 2
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.where(half == 0, z @ apart[0], z @ apart[1]))], names=["y", "raw"])

    pairs = table.mapInArrow(crossed, "y double, raw double").toPandas()  # at most about max_rows rows
    model.weights = solve(halves[0] + halves[1])
    model.knots = isotonic(pairs["raw"].to_numpy(), pairs["y"].to_numpy())
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_texts(docs, id_col, text_col, lambda texts: {"score": pa.array(shared.value.scores(texts))}, f"doc_id {kind}, held_out boolean, score double", {"doc_id": docs[id_col], "held_out": crc_fold(docs[id_col], folds) == held_out})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``; all columns stay."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.scores([(t or "").encode() for t in batch.column(at).to_pylist()]) >= threshold))

    return docs.mapInArrow(run, docs.schema)
