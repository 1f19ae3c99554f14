"""Toxicity scores from logistic regression learned with FTRL-proximal updates.

Features are hashed word n-grams and skip-grams of the whole text, each counted
once. Every coordinate has its own learning rate, from the sum of its squared
gradients; the L1 term keeps most weights at zero, so that only the others are
stored (at most ``BUCKETS``, 12 bytes each) and sent to the tasks. Learning reads a
bounded sample of labelled rows (``TRAINING_ROWS``) in one task.

Only the text is an input of the score. Null texts count as empty; an empty text
gets the score of the bias alone. Repeated rows get equal scores. Rows without a
label, or with a null label, are not learned from. Without any, all scores are 0.5. An empty table
gives no scores. A very long text is hashed whole, in one row; other columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import held_out, slices, training_labels
from footfall.llm.words import HASHER, gram_hashes

TRAINING_ROWS = 16_000
#: Buckets in fewer documents of the sample are not learned.
LEAST_DOCUMENTS = 4
BUCKETS = 1 << 20
#: Offsets of the words that make a feature: single words, pairs, and pairs with gaps.
GRAMS = ((0,), (0, 1), (0, 2), (0, 3))
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.0
#: Label 1 is the rarer one; its examples count so many times.
POSITIVE_WEIGHT = 4.0
EPOCHS = 5

_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the grams of a text, in lower case, without marks."""
    words = _WORDS.findall((text or "").lower().encode("utf-8", "surrogatepass"))
    hashes = HASHER.array(words)
    grams = [gram_hashes(hashes, offsets, seed) for seed, offsets in enumerate(GRAMS, 1)]
    return np.unique((np.concatenate(grams) % np.uint64(BUCKETS)).astype(np.int64))


@dataclass
class Weights:
    """The non-zero weights, by bucket."""

    buckets: np.ndarray
    values: np.ndarray
    bias: float

    def scorer(self):
        dense = np.zeros(BUCKETS, np.float32)
        dense[self.buckets] = self.values

        def score(text: str | None) -> float:
            total = self.bias + float(dense[features(text)].sum())
            return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))

        return score


def learn(examples: list[tuple[np.ndarray, int]]) -> Weights:
    """FTRL-proximal over the examples, ``EPOCHS`` times, in an order that a fixed seed gives."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias_z = bias_n = 0.0

    def weights(z, n):
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / rate)

    def bias() -> float:
        return -bias_z * ALPHA / (BETA + np.sqrt(bias_n))

    if not examples:
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    documents = np.zeros(BUCKETS, np.int32)
    for at, _ in examples:
        documents[at] += 1
    examples = [(at[documents[at] >= LEAST_DOCUMENTS], label) for at, label in examples]
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            at, label = examples[i]
            w = weights(z[at], n[at])
            error = 1 / (1 + np.exp(-np.clip(w.sum() + bias(), -30, 30))) - label
            error *= POSITIVE_WEIGHT if label else 1.0
            step = error * error
            z[at] += error - (np.sqrt(n[at] + step) - np.sqrt(n[at])) / ALPHA * w
            n[at] += step
            old = bias()
            bias_z += error - (np.sqrt(bias_n + step) - np.sqrt(bias_n)) / ALPHA * old
            bias_n += step
    final = weights(z, n)
    kept = np.flatnonzero(final)
    return Weights(kept, final[kept].astype(np.float32), float(bias()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Weights:
    """Weights from at most ``rows`` labelled documents that are not held out.

    The ids are at most 16 bytes a row, hence broadcast. Buckets of the sample
    meet in one task as 32-bit numbers; only the weights reach the driver.
    """
    chosen = F.broadcast(training_labels(labels, "toxic", rows))
    sample = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").join(chosen, "doc_id")

    def hashed(batches):
        for batch in slices(batches):
            found = [features(text).astype(np.int32).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())],
                names=["doc_id", "label", "grams"],
            )

    def learned(batches):
        rows = []
        for batch in batches:
            rows += zip(*(column.to_pylist() for column in batch.columns))
        rows.sort(key=lambda row: (row[0], row[2]))
        result = learn([(np.frombuffer(grams, np.int32), label) for _, label, grams in rows])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([result.buckets.astype(np.int32).tobytes()], pa.binary()),
                pa.array([result.values.tobytes()], pa.binary()),
                pa.array([result.bias], pa.float64()),
            ],
            names=["buckets", "values", "bias"],
        )

    found = (
        sample.mapInArrow(hashed, "doc_id bigint, label int, grams binary")
        .repartition(1)
        .mapInArrow(learned, "buckets binary, values binary, bias double")
        .collect()
    )
    if not found:
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    return Weights(
        np.frombuffer(found[0]["buckets"], np.int32),
        np.frombuffer(found[0]["values"], np.float32),
        found[0]["bias"],
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    weights = fit(docs, labels)

    def scored(batches):
        score = weights.scorer()
        for batch in slices(batches):
            values = [score(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return rows.mapInArrow(scored, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
