"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its terms, hashed to 32 bits: words (runs of letters and digits, lower
case) and their beginnings of 3 to 7 letters, which inflected words share.
The model gives every term a weight and a short vector; a pair of terms adds the product of
their vectors, so an insult next to a group's name can count for more than both alone,
which additive weights cannot say. Neither labels nor any other column is an input of a
score.

The model is fitted on the driver from at most ``SAMPLE`` labelled documents (a documented
bound, chosen by hash among all rows of the training folds); terms in fewer than ``LEAST_DF``
of them are left out, and of the rest the ``TERMS`` that tell the classes apart best are
kept, so the model's size is bounded too. All documents are scored, whole.

Defined cases: a null or empty text has no terms and gets the prior score; a null id is not
held out; labels that are null or lack a document are not used, repeated labels of an id
count as toxic if one is; the bias starts from the share of toxic rows plus half a toxic and
one and a half clean ones, which is the score of every text where there are no training rows
(0.25). Repeated rows get equal scores. An empty table gives no rows. Only named columns are
read.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE = 20_000
LEAST_DF = 4
TERMS = 1 << 10
FACTORS = 4
PREFIXES = (3, 4, 5, 6, 7)
FOLDS = 5


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the terms of a text."""
    words = set(re.findall(r"[^\W_]+", (text or "").lower()))
    words.update([word[:n] for word in words for n in PREFIXES if len(word) > n])
    hashes = (crc32(word.encode("utf-8", "replace")) for word in words)
    return np.unique(np.fromiter(hashes, np.uint32, len(words)))


@dataclass
class Model:
    """``hashes`` are sorted; weights and vectors stand in their order."""

    hashes: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def known(self, hashed: np.ndarray) -> np.ndarray:
        """Positions in the model of those hashes that it knows."""
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        return at[self.hashes[at] == hashed]

    def logits(self, sets: list[np.ndarray]) -> np.ndarray:
        """Bias + weights + products of the vectors of all pairs of terms of each set."""
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        columns = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        return _logits(self, rows, columns, len(sets))[0]


def _sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, values, n) if len(rows) else np.zeros(n)


def _logits(model: Model, rows, columns, n):
    total = model.bias + _sums(rows, model.weights[columns], n)
    sums = np.empty((n, model.vectors.shape[1]))
    for f in range(model.vectors.shape[1]):
        v = model.vectors[columns, f]
        sums[:, f] = _sums(rows, v, n)
        total += 0.5 * (sums[:, f] ** 2 - _sums(rows, v * v, n))
    return total, sums


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _telling_terms(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Sorted hashes of the terms whose toxic share differs most from the overall share."""
    none = [np.zeros(0, np.uint32)]
    vocabulary, df = np.unique(np.concatenate(none + sets), return_counts=True)
    often = df >= LEAST_DF
    vocabulary, df = vocabulary[often], df[often]
    seen, counts = np.unique(
        np.concatenate(none + [s for s, label in zip(sets, labels) if label]), return_counts=True
    )
    toxic = np.zeros(len(vocabulary))
    _, at, from_ = np.intersect1d(vocabulary, seen, assume_unique=True, return_indices=True)
    toxic[at] = counts[from_]
    share = float(labels.mean()) if len(labels) else 0.0
    spread = np.sqrt(np.maximum(df * share * (1 - share), 1e-9))
    tells = np.abs(toxic - df * share) / spread
    return np.sort(vocabulary[np.argsort(-tells, kind="stable")[:TERMS]])


def fit(sets: list[np.ndarray], labels: np.ndarray, rounds: int = 120, rate: float = 0.05) -> Model:
    """Fit by Adam on the whole sample at once; deterministic."""
    n, positive = len(sets), float(labels.sum())
    bias = float(np.log((positive + 0.5) / (n - positive + 1.5)))
    hashes = _telling_terms(sets, labels)
    m = len(hashes)
    model = Model(hashes, bias, np.zeros(m), np.random.default_rng(7).normal(0, 0.01, (m, FACTORS)))
    known = [model.known(s) for s in sets]
    rows = np.repeat(np.arange(n), [len(k) for k in known])
    columns = np.concatenate(known) if n else np.zeros(0, np.int64)
    if not m or positive in (0, n):
        model.vectors[:] = 0
        return model
    theta = [np.array([bias]), model.weights, model.vectors]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    decay = (0.0, 2e-5, 2e-4)
    for step in range(1, rounds + 1):
        model.bias = float(theta[0][0])
        logits, sums = _logits(model, rows, columns, n)
        error = (_sigmoid(logits) - labels) / n
        each = error[rows]
        by_term = np.bincount(columns, each, m)
        vectors = np.empty_like(model.vectors)
        for f in range(FACTORS):
            vectors[:, f] = np.bincount(columns, each * sums[rows, f], m) - by_term * model.vectors[:, f]
        for i, gradient in enumerate((np.array([error.sum()]), by_term, vectors)):
            gradient = gradient + decay[i] * theta[i]
            first[i] += 0.1 * (gradient - first[i])
            second[i] += 0.001 * (gradient**2 - second[i])
            theta[i] -= (
                rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
            )
    model.bias = float(theta[0][0])
    return model


def held_out(ids):
    """Column: the id's row is kept from training (crc32 of its text divisible by the folds)."""
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on a sample of the labelled documents outside the held-out fold."""
    chosen = (
        labels.select("doc_id", "toxic")
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [terms(text).tobytes() for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": sets})

    # At most ``sample`` rows of two numbers: safe to broadcast.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .mapInPandas(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, terms binary")
        .toPandas()
        .sort_values(["doc_id", "terms"])
    )
    sets = [np.frombuffer(t, np.uint32) for t in rows["terms"]]
    return fit(sets, (rows["toxic"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row; the model is bounded, so it goes with the tasks."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [model.known(terms(text)) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": _sigmoid(model.logits(sets))})

    return docs.select("doc_id", "text").mapInPandas(task, f"doc_id {kind}, score double")
