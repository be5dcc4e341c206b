"""Toxicity scores by a factorization machine over hashed terms.

Terms are words and word stems hashed into buckets. A likelihood-ratio test over
the labelled sample picks the buckets that tell the labels apart; a second one
picks those that tell them apart among the rows with one of the strongest of
these, though perhaps not alone. A factorization machine learns a weight for
each and a vector for each, so that pairs of terms (an insult together with a
mention of a group) count beyond the sum of their weights.

The fit uses at most about ``max_rows`` labelled rows (a documented bound, drawn
by hash); scoring covers every row and whole texts, without a shuffle.
``max_terms`` and ``max_pair_terms`` bound the model, not the rows: the picked
terms are those of the highest statistics, equal ones by bucket.

Defined results: null and empty texts are scored as texts without terms, which
is the bias alone. A text of any length counts each of its terms once, so
repeats in it change nothing. Rows that repeat stay rows and score alike; rows of
one id are scored one by one; a null id is in the fold of the empty text.
Repeated labels of an id are averaged, ties count as 1. Without usable labels,
or with labels of one kind, every score is their mean (0 for none). Empty tables
give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, crc_fold, labelled_sample, map_texts, materialize, tune, word_bytes

BUCKETS = 1 << 19
STEM = 6


def term_buckets(text: bytes) -> np.ndarray:
    """The distinct buckets of a text's words, and of the first bytes of longer words."""
    words = set(word_bytes(text))
    stems = {w[:STEM] for w in words if len(w) > STEM}
    n = len(words)
    out = np.empty(n + len(stems), np.int64)
    out[:n] = np.fromiter(map(zlib.crc32, words), np.int64, n)
    out[n:] = np.fromiter((zlib.crc32(s, 0x5EED) for s in stems), np.int64, len(stems))
    out %= BUCKETS
    return np.unique(out)


class Model:
    """Picked buckets, bias, weights and vectors."""

    def __init__(self, picked: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray, constant: float | None = None) -> None:
        self.slot = None
        self.picked, self.bias, self.weights, self.vectors, self.constant = picked, bias, weights, vectors, constant

    def slots(self, text: bytes) -> np.ndarray:
        """Positions of the text's picked terms."""
        if self.slot is None:
            self.slot = np.full(BUCKETS, -1, np.int32)
            self.slot[self.picked] = np.arange(len(self.picked))
        words = set(word_bytes(text))
        words_at = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        stems = {w[:STEM] for w in words if len(w) > STEM}
        stems_at = np.fromiter((zlib.crc32(s, 0x5EED) for s in stems), np.int64, len(stems))
        at = self.slot[np.concatenate([words_at, stems_at]) % BUCKETS]
        return np.unique(at[at >= 0])

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        at = self.slots(text)
        v = self.vectors[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at].sum() + pairs, -30, 30))))


def train(rows: list[np.ndarray], y: np.ndarray, n_terms: int, rank: int, epochs: int, rate: float, ridge: float, seed: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic factorization machine by AdaGrad over mini-batches."""
    rng = np.random.default_rng(seed)
    bias, weights = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(n_terms)
    vectors = rng.normal(0, 0.01, (n_terms, rank))
    gw, gv, gb = np.full(n_terms, 1e-6), np.full((n_terms, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for batch in np.array_split(order, -(-len(rows) // 256)):
            sizes = np.array([len(rows[i]) for i in batch])
            flat = np.concatenate([rows[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), sizes)
            v = vectors[flat]
            sums = np.zeros((len(batch), rank))
            np.add.at(sums, owner, v)
            squares = np.bincount(owner, (v**2).sum(axis=1), len(batch))
            z = bias + np.bincount(owner, weights[flat], len(batch)) + 0.5 * ((sums**2).sum(axis=1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            grad_w = np.bincount(flat, err[owner], n_terms) + ridge * weights
            grad_v = np.zeros((n_terms, rank))
            np.add.at(grad_v, flat, err[owner, None] * (sums[owner] - v))
            grad_v += ridge * vectors
            grad_b = err.sum()
            gw += grad_w**2
            gv += grad_v**2
            gb += grad_b**2
            weights -= rate * grad_w / np.sqrt(gw)
            vectors -= 0.2 * rate * grad_v / np.sqrt(gv)
            bias -= rate * grad_b / np.sqrt(gb)
    return bias, weights, vectors


def pair_terms(table: DataFrame, best: np.ndarray, seen: np.ndarray, most: int, chance: float = 10.8, least: int = 5) -> np.ndarray:
    """At most ``most`` buckets that tell the labels apart among the rows that hold one of the buckets ``best``.

    ``table`` is (y, terms); ``seen`` counts the rows of each label that hold each of ``best``.
    Pairs are counted in each batch, then in Spark, and tested by a likelihood ratio (``chance``: one in a thousand).
    """
    shared = table.sparkSession.sparkContext.broadcast(np.sort(best))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                terms = np.asarray(t.values).astype(np.int64)
                held = np.intersect1d(known, terms)
                found.append(((held[:, None] * BUCKETS + terms) * 2 + int(y)).ravel())
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(np.where(keys & 1, 0, n)), pa.array(np.where(keys & 1, n, 0))], names=["pair", "no", "yes"])

    counts = table.mapInArrow(pairs, "pair long, no long, yes long").groupBy("pair").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).where(F.col("no") + F.col("yes") >= least)
    totals = table.sparkSession.createDataFrame([(int(k), float(a), float(b)) for k, a, b in zip(best.tolist(), *seen.tolist(), strict=True)], "k long, all_no double, all_yes double")
    part = lambda n, row, column: F.when(n > 0, n * F.log(n * (F.col("all_no") + F.col("all_yes")) / (row * column))).otherwise(0.0)
    no, yes, none, both = F.col("no"), F.col("yes"), F.col("all_no") - F.col("no"), F.col("all_yes") - F.col("yes")
    cells = part(no, no + yes, F.col("all_no")) + part(yes, no + yes, F.col("all_yes")) + part(none, none + both, F.col("all_no")) + part(both, none + both, F.col("all_yes"))
    told = counts.withColumn("k", F.floor(F.col("pair") / BUCKETS)).join(F.broadcast(totals), "k").withColumn("surprise", 2 * cells).where(F.col("surprise") > chance)
    terms = told.groupBy((F.col("pair") % BUCKETS).alias("term")).agg(F.max("surprise").alias("surprise")).orderBy(F.desc("surprise"), "term").limit(most)
    return np.array([r["term"] for r in terms.collect()], np.int64)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2, max_rows: int = 20_000, max_terms: int = 4096, max_pair_terms: int = 1024, strongest: int = 48, rank: int = 4, epochs: int = 12, steps: int = 800, rate: float = 0.15, ridge: float = 2e-5, seed: int = 7) -> Model:
    """A model of ``label`` from rows outside the held-out fold. Small samples get more epochs, ``steps`` batches in all at least."""
    tune(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, id_col, text_col, folds, held_out, max_rows, "toxicity")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([term_buckets(t or b"").astype(np.int32) for t in batch.column(2).to_pylist()], pa.list_(pa.int32()))], names=["id", "y", "terms"])

    # the sample is bounded, its scan is not: only what lies behind the shuffle is brought into few tasks
    table = materialize(sample.mapInArrow(terms, f"id {docs.schema[id_col].dataType.simpleString()}, y double, terms array<int>").distinct().select("y", "terms").coalesce(6))

    def counts(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        seen, n = np.zeros((2, BUCKETS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen[int(y)][np.asarray(t.values)] += 1
                n[int(y)] += 1
        return {"seen": seen, "n": n}

    parts = blobs(table, counts)
    if not parts:
        return Model(np.empty(0, int), 0.0, np.empty(0), np.empty((0, rank)), 0.0)
    n = sum(np.frombuffer(p["n"], np.int64) for p in parts).astype(float)
    if n.min() == 0:
        return Model(np.empty(0, int), 0.0, np.empty(0), np.empty((0, rank)), float(n[1] > 0))
    seen = sum(np.frombuffer(p["seen"], np.int32).reshape(2, BUCKETS).astype(np.int64) for p in parts).astype(float)
    total = seen.sum(axis=0)
    expected = total * (n / n.sum())[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = 2 * np.nansum(np.where(seen > 0, seen * np.log(seen / expected), 0.0), axis=0)
    surprise[total < 3] = 0
    picked = np.sort(np.argsort(-surprise, kind="stable")[:max_terms])
    picked = picked[surprise[picked] > 6.6]  # one in a hundred by chance
    best = picked[np.argsort(-surprise[picked], kind="stable")[:strongest]]
    picked = np.union1d(picked, pair_terms(table, best, seen[:, best], max_pair_terms))
    model = Model(picked, 0.0, np.zeros(len(picked)), np.zeros((len(picked), rank)))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int32)
        place[picked] = np.arange(len(picked))
        for batch in batches:
            if batch.num_rows:
                found = [place[np.asarray(t.values)] for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[f >= 0] for f in found], pa.list_(pa.int32()))], names=["y", "at"])

    known = table.mapInArrow(slots, "y double, at array<int>").toPandas()  # about max_rows rows of picked terms
    order = sorted(range(len(known)), key=lambda i: (known["y"][i], len(known["at"][i]), *known["at"][i][:8]))
    rows = [np.sort(np.asarray(known["at"][i], np.int64)) for i in order]
    model.bias, model.weights, model.vectors = train(rows, known["y"].to_numpy()[order], len(picked), rank, max(epochs, steps * 256 // len(rows)), rate, ridge, seed)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def scores(texts: list[bytes]) -> dict[str, pa.Array]:
        return {"score": pa.array([shared.value.score(t) for t in texts], pa.float64())}

    scored = map_texts(docs, id_col, text_col, scores, f"doc_id {kind}, held_out boolean, score double", {"doc_id": docs[id_col], "held_out": crc_fold(docs[id_col], folds) == held_out})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
