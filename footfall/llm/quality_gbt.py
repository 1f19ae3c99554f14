"""Quality scores from gradient-boosted trees over document statistics.

Statistics are computed for whole texts in Arrow batches. Trees grow on binned
statistics with gradient and hessian histograms, in one task, from a bounded sample
of labelled rows (``TRAINING_ROWS``); they are then flattened into arrays of
features, bins, children and leaf values, which a batch of documents walks level by
level with array indexing.

Only the text is an input of the score. Null texts count as empty; empty texts get
the score of their statistics (all zero). Repeated rows get equal scores. Rows
without a label, or with a null label, are not used for training. Without a training
row every score is 0.5; with one class only, the smoothed share of that class. An empty
table gives no scores. A very long text is measured whole, in one row; other columns are left out of
the report and kept by ``good_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import free_name, held_out, slices, training_labels
from footfall.llm.words import HASHER, to_bytes

TRAINING_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
LEARNING_RATE = 0.15
LEAST_HESSIAN = 4.0
L2 = 1.0

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "lower", "upper", "digit", "space",
    "plain_marks", "other_marks", "high", "control", "byte_entropy", "distinct_words", "top_word",
    "same_as_previous", "distinct_pairs", "log_lines", "distinct_lines", "words_per_line",
    "short_words", "pipes", "brackets",
)



def _class_table() -> np.ndarray:
    """Byte to class: 0 lower, 1 upper, 2 digit, 3 space, 4 plain mark, 5 other mark, 6 high, 7 control."""
    table = np.full(256, 5)
    table[:32] = 7
    table[127] = 7
    table[128:] = 6
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[list(b" \t\n\r\x0b\x0c")] = 3
    table[list(b".,;:'\"!?()-")] = 4
    return table


_CLASSES = _class_table()


def statistics(text: str | None) -> np.ndarray:
    """The values of ``STATISTICS`` for one whole text."""
    raw = to_bytes(text)
    values = np.zeros(len(STATISTICS), np.float32)
    if not raw:
        return values
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASSES, weights=counts, minlength=8) / len(raw)
    present = counts[counts > 0] / len(raw)
    words = raw.split()
    lines = raw.split(b"\n")
    hashes = HASHER.array(words)
    values[0] = np.log1p(len(raw))
    values[1] = np.log1p(len(words))
    values[4:12] = shares
    values[12] = -(present * np.log2(present)).sum()
    values[17] = np.log1p(len(lines))
    values[18] = len(set(lines)) / len(lines)
    values[19] = len(words) / len(lines)
    values[21] = counts[ord("|")] / len(raw)
    values[22] = counts[list(b"<>[]{}=/\\")].sum() / len(raw)
    if words:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        _, times = np.unique(hashes, return_counts=True)
        values[2] = lengths.mean()
        values[3] = np.log1p(lengths.max())
        values[13] = len(times) / len(words)
        values[14] = times.max() / len(words)
        values[20] = (lengths <= 2).mean()
    if len(words) > 1:
        pairs = hashes[1:] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1]
        values[15] = (hashes[1:] == hashes[:-1]).mean()
        values[16] = len(np.unique(pairs)) / len(pairs)
    return values


@dataclass
class Forest:
    """Trees of equal depth in flat arrays: node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    edges: np.ndarray  # (statistics, BINS - 1) upper edges of bins
    features: np.ndarray  # (trees, inner nodes)
    bins: np.ndarray  # (trees, inner nodes); go right when the bin is greater
    leaves: np.ndarray  # (trees, leaves)
    base: float

    def binned(self, values: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, values[:, j], "left") for j, e in enumerate(self.edges)]
        return np.stack(columns, axis=1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.empty(0)
        binned = self.binned(values)
        rows = np.arange(len(values))
        total = np.full(len(values), self.base)
        inner = self.features.shape[1]
        for features, bins, leaves in zip(self.features, self.bins, self.leaves):
            node = np.zeros(len(values), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (binned[rows, features[node]] > bins[node])
            total += leaves[node - inner]
        return 1 / (1 + np.exp(-total))


def _best_split(grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    """Gain, statistic and bin of the best split of one node's histograms (statistics, BINS)."""
    left_g, left_h = grad.cumsum(1)[:, :-1], hess.cumsum(1)[:, :-1]
    all_g, all_h = grad[0].sum(), hess[0].sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + L2) + right_g**2 / (right_h + L2) - all_g**2 / (all_h + L2)
    gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
    at = int(gain.argmax())
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def _grow(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray):
    """One tree: features, bins and leaf values; a node without a gain sends all rows left."""
    count, width = binned.shape
    inner = 2**DEPTH - 1
    features, bins = np.zeros(inner, np.int64), np.full(inner, BINS)
    node = np.zeros(count, np.int64)
    slots = binned + np.arange(width) * BINS
    for level in range(DEPTH):
        first, nodes = 2**level - 1, 2**level
        at = ((node - first)[:, None] * (width * BINS) + slots).ravel()
        shape = (nodes, width, BINS)
        size = nodes * width * BINS
        grads = np.bincount(at, np.repeat(grad, width), size).reshape(shape)
        hesses = np.bincount(at, np.repeat(hess, width), size).reshape(shape)
        for i in range(nodes):
            gain, feature, split = _best_split(grads[i], hesses[i])
            if gain > 1e-6:
                features[first + i], bins[first + i] = feature, split
        node = 2 * node + 1 + (binned[np.arange(count), features[node]] > bins[node])
    leaf = node - inner
    leaves = -np.bincount(leaf, grad, 2**DEPTH) / (np.bincount(leaf, hess, 2**DEPTH) + L2)
    return features, bins, leaves * LEARNING_RATE


def train(values: np.ndarray, labels: np.ndarray) -> Forest:
    """Boosted trees for the log-odds of label 1."""
    width = len(STATISTICS)
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(values, cuts, axis=0).T if len(values) else np.zeros((width, BINS - 1))
    share = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    forest = Forest(edges, np.zeros((0, inner), int), np.zeros((0, inner), int), np.zeros((0, 2**DEPTH)), base)
    if len(set(labels.tolist())) < 2:
        return forest
    binned = forest.binned(values)
    total = np.full(len(values), base)
    grown = []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        features, bins, leaves = _grow(binned, chance - labels, chance * (1 - chance))
        node = np.zeros(len(values), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (binned[np.arange(len(values)), features[node]] > bins[node])
        total += leaves[node - inner]
        grown.append((features, bins, leaves))
    return Forest(edges, *(np.stack(x) for x in zip(*grown)), base)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Forest:
    """A forest from at most ``rows`` labelled documents that are not held out.

    The ids are at most 16 bytes a row, hence broadcast; statistics of the sample
    (some 100 bytes a row) meet in one task, and only the forest (trees x nodes
    numbers) reaches the driver.
    """
    chosen = F.broadcast(training_labels(labels, "quality", rows))
    sample = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").join(chosen, "doc_id")

    def measured(batches):
        for batch in slices(batches):
            values = [statistics(text).tolist() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(values, pa.list_(pa.float32()))],
                names=["doc_id", "label", "values"],
            )

    def trained(batches):
        rows = sorted((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))), key=repr)
        values = np.array([row[2] for row in rows], np.float32).reshape(-1, len(STATISTICS))
        forest = train(values, np.array([row[1] for row in rows], float))
        parts = (forest.edges, forest.features, forest.bins, forest.leaves, np.array(forest.base))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p.astype(float).ravel().tolist() for p in parts], pa.list_(pa.float64())),
                pa.array([list(p.shape) for p in parts], pa.list_(pa.int64())),
                pa.array(range(len(parts)), pa.int64()),
            ],
            names=["flat", "shape", "part"],
        )

    parts = (
        sample.mapInArrow(measured, "doc_id bigint, label int, values array<float>")
        .repartition(1)
        .mapInArrow(trained, "flat array<double>, shape array<bigint>, part bigint")
        .collect()
    )
    if not parts:
        return train(np.zeros((0, len(STATISTICS)), np.float32), np.zeros(0))
    edges, features, bins, leaves, base = (
        np.array(row.flat).reshape(row.shape) for row in sorted(parts, key=lambda row: row.part)
    )
    return Forest(edges, features.astype(int), bins.astype(int), leaves, float(base))


def with_score(df: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """``df`` with one more column, the score of its ``text``; other columns stay as they are."""

    def scored(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            values = np.array([statistics(text) for text in texts]).reshape(-1, len(STATISTICS))
            yield batch.append_column(name, pa.array(forest.scores(values), pa.float64()))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(scored, f"{types}, `{name}` double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    forest = fit(docs, labels)
    scored = with_score(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), forest)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with their own columns."""
    name = free_name(docs, "_quality")
    scored = with_score(docs, fit(docs, labels), name)
    return scored.where(F.col(name) >= threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
