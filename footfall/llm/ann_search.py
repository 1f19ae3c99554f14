"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, so that all have the greatest norm; the largest inner product is then
the smallest distance. They are rotated at random and dealt to the lists of the
nearest centroids. A query scans its ``probes`` nearest lists in blocks of columns: after each
block, a hypothesis test on the partial distances abandons candidates that are, but for
a small chance, farther than the best ``k`` so far; rotation makes any columns a fair
sample of all. Scores of what is left are computed on the original vectors, in double precision.

The number of lists follows the square root of the rows. Centroids are fitted on a bounded sample (``SAMPLE_ROWS``, by
hash), and the probes are measured there: as many lists are scanned as hold ``LIST_RECALL`` of the true
neighbours of up to ``MEASURED`` sample vectors. Every vector is
indexed. A long list is scanned in blocks of ``BLOCK_ROWS`` rows, and many queries of one list in blocks of
``BLOCK_QUERIES``, so that no task holds a whole list.

Vectors that are null, zero, or hold nulls or non-finite components take no part. Rows are searched, not ids: a row is no candidate
of its own, but one of another row with its id, and each row of a repeated id is a query. Vectors of different
lengths are spaces of their own, each with its index. A row with a null id is a candidate and no query. Components of any finite size
are scaled before they are placed. Ties go to the smaller id, nulls last. An empty table gives an empty one. Other
columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.llm.tables import stored

SAMPLE_ROWS = 20_000
LEAST_LISTS, MOST_LISTS = 16, 1024
#: Of the true neighbours in the sample, the share that lies in the lists scanned.
LIST_RECALL = 0.975
MEASURED = 256
COLUMNS = 16
#: Width of the test: a true neighbour is lost with a chance that falls with its square.
CERTAINTY = 2.1
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Queries whose distances stand in one matrix.
QUERIES_AT_ONCE = 128


@dataclass
class Index:
    """Centroids of the lists, after rotation, for vectors divided by ``scale``, the greatest component.

    ``norm`` is the greatest norm after that; ``probes`` lists are scanned for a query.
    """

    rotation: np.ndarray
    centroids: np.ndarray
    scale: float
    norm: float
    probes: int = 1

    def placed(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """With the further component (0 for queries), rotated, the greatest norm as 1."""
        scaled = vectors / self.scale / self.norm
        more = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
        return (np.column_stack([scaled, more]) @ self.rotation).astype(np.float32)

    def distances(self, placed: np.ndarray) -> np.ndarray:
        return (self.centroids**2).sum(axis=1) - 2 * placed @ self.centroids.T


def usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, embedding, length`` of the vectors that take part; ``row`` is a number of its own for each."""
    component_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(
        F.col("embedding").isNotNull() & F.forall("embedding", component_ok) & F.exists("embedding", lambda x: x != 0)
    )
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "embedding", F.size("embedding").alias("length")
    )


def measured_probes(index: Index, points: np.ndarray, k: int) -> int:
    """How many lists hold ``LIST_RECALL`` of the ``k`` nearest of some points among all of them."""
    asked = points[:: -(-len(points) // MEASURED)]
    k = min(k, len(points))
    best = np.argpartition(-(asked @ points.T), k - 1, axis=1)[:, :k]
    own = index.distances(index.placed(points)).argmin(axis=1)
    place = np.argsort(np.argsort(index.distances(index.placed(asked, queries=True)), axis=1, kind="stable"), axis=1)
    ranks = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(LIST_RECALL * len(ranks))))]) + 1


def fit(vectors: DataFrame, lists: int | None = None, k: int = 20) -> dict[int, Index]:
    """An index over usable ``vectors`` for each length."""
    largest = F.array_max(F.transform("embedding", F.abs))
    sizes = vectors.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("scale")).collect()
    if not sizes:
        return {}
    scale = F.element_at(F.create_map(*[F.lit(x) for row in sizes for x in (row.length, row.scale)]), F.col("length"))
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + (x / scale) * (x / scale))
    norms = {row.length: row.norm for row in vectors.groupBy("length").agg(F.max(F.sqrt(square)).alias("norm")).collect()}
    by_hash = Window.partitionBy("length").orderBy(F.xxhash64("vec_id", "row"), "row")
    sample = vectors.withColumn("_place", F.row_number().over(by_hash)).where(F.col("_place") <= SAMPLE_ROWS)
    samples = sample.select("length", "_place", "embedding").toArrow().sort_by([("length", "ascending"), ("_place", "ascending")])
    indexes = {}
    for row in sizes:
        own = samples.filter(pc.equal(samples["length"], row.length))["embedding"]
        points = np.stack([np.asarray(x, float) for x in own.to_pylist()])
        count = lists or min(max(int(np.sqrt(row.n) / 2), LEAST_LISTS), MOST_LISTS)
        indexes[row.length] = _fitted(points, float(row.scale), float(norms[row.length]), count, k)
    return indexes


def _fitted(points: np.ndarray, scale: float, norm: float, lists: int, k: int) -> Index:
    rng = np.random.default_rng(11)
    rotation, _ = np.linalg.qr(rng.normal(size=(points.shape[1] + 1, points.shape[1] + 1)))
    index = Index(rotation, np.zeros((1, points.shape[1] + 1), np.float32), scale, norm)
    placed = index.placed(points)
    distinct = np.unique(placed, axis=0)
    index.centroids = distinct[rng.permutation(len(distinct))[:lists]]
    for _ in range(10):
        nearest = index.distances(placed).argmin(axis=1)
        sums = np.zeros(index.centroids.shape)
        np.add.at(sums, nearest, placed)
        sizes = np.bincount(nearest, minlength=len(sums))
        filled = sizes > 0
        index.centroids[filled] = (sums[filled] / sizes[filled, None]).astype(np.float32)
    index.probes = measured_probes(index, points / scale / norm, k)
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def listed(vectors: DataFrame, indexes: dict[int, Index], probes: int | None, queries: bool) -> DataFrame:
    """``row, vec_id, embedding, length, list``: each vector with its list, each query with those to scan."""

    def place(batches):
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                index = indexes[int(length)]
                own = batch.filter(pa.array(lengths == length))
                distances = index.distances(index.placed(_matrix(own.column("embedding")), queries))
                count = min(probes or index.probes, distances.shape[1]) if queries else 1
                lists = np.argsort(distances, axis=1, kind="stable")[:, :count]
                rows = pa.array(np.repeat(np.arange(len(own)), count))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(rows) for c in own.columns), pa.array(lists.ravel(), pa.int64())],
                    names=["row", "vec_id", "embedding", "length", "list"],
                )

    return vectors.select("row", "vec_id", "embedding", "length").mapInArrow(
        place, "row bigint, vec_id bigint, embedding array<double>, length int, list bigint"
    )


def adaptive_scan(queries: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate), by place, that may be among the ``k`` nearest of the query.

    Distances grow block by block of columns. A candidate that every query has abandoned
    leaves the matrix, so later blocks are multiplied for fewer of them. A query's bound is the ``k``-th
    distance, in all columns, among the candidates nearest in the first block.
    """
    width = candidates.shape[1]
    kept = np.arange(len(candidates))
    near = (candidates**2).sum(axis=1).max() + (queries**2).sum(axis=1).max()
    partial = np.zeros((len(queries), len(kept)), np.float32)
    alive = np.ones(partial.shape, bool)
    bound = np.full((len(queries), 1), np.inf, np.float32)
    for start in range(0, width, COLUMNS):
        seen = min(start + COLUMNS, width)
        own, others = queries[:, start:seen], candidates[kept, start:seen]
        partial += (own**2).sum(axis=1)[:, None] + (others**2).sum(axis=1) - 2 * own @ others.T
        if start == 0 and len(kept) > k:
            likely = np.argpartition(partial, k - 1, axis=1)[:, :k]
            whole = ((candidates[likely] - queries[:, None, :]) ** 2).sum(axis=2)
            bound = whole.max(axis=1)[:, None]
        slack = 1.0 if seen == width else (1 + CERTAINTY / np.sqrt(seen)) ** 2
        alive &= partial * (width / seen) <= bound * slack + 1e-5 * near
        columns = alive.any(axis=0)
        if columns.mean() < 0.9:
            kept, partial, alive = kept[columns], partial[:, columns], alive[:, columns]
    if len(kept) > k:
        found = np.where(alive, partial, np.inf)
        alive &= partial <= np.partition(found, k - 1, axis=1)[:, k - 1 : k] + 1e-5 * near
    query, column = np.nonzero(alive)
    return query, kept[column]


def _scan_block(indexes: dict[int, Index], k: int):
    columns = ("query_row", "query_id", "vec_id", "score")

    def scan(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            index = indexes[int(rows.length.iloc[0])]
            row_numbers, query_numbers = rows.row.to_numpy(), queries.row.to_numpy()
            ids = rows.vec_id.astype("Int64")
            order_of_ids = ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64)
            original, asked = np.stack(rows.embedding.to_numpy()), np.stack(queries.embedding.to_numpy())
            placed, turned = index.placed(original), index.placed(asked, queries=True)
            for start in range(0, len(asked), QUERIES_AT_ONCE):
                # one more than k, as the query's own row is among them
                query, row = adaptive_scan(turned[start : start + QUERIES_AT_ONCE], placed, k + 1)
                query = query + start
                other = row_numbers[row] != query_numbers[query]
                query, row = query[other], row[other]
                scores = np.concatenate(
                    [np.empty(0)]
                    + [(original[row[i : i + 4096]] * asked[query[i : i + 4096]]).sum(axis=1) for i in range(0, len(row), 4096)]
                )
                order = np.lexsort((order_of_ids[row], -scores, query))
                query, row, scores = query[order], row[order], scores[order]
                first = np.searchsorted(query, query, "left")
                best = np.arange(len(query)) - first < k
                query, row = query[best], row[best]
                found.append(
                    pd.DataFrame(
                        {
                            "query_row": query_numbers[query],
                            "query_id": queries.vec_id.to_numpy()[query].astype(np.int64),
                            "vec_id": ids.iloc[row].to_numpy(),
                            "score": scores[best],
                        }
                    )
                )
        if not found:
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "Int64") for c in columns})
        return pd.concat(found).astype({"vec_id": "Int64"})

    return scan


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, probes: int | None = None, lists: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row whose id is divisible by ``every``.

    ``probes`` and ``lists`` take the place of the measured numbers.
    """
    rows = stored(usable(vectors))
    indexes = fit(rows, lists, k)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not indexes:
        return vectors.sparkSession.createDataFrame([], schema)
    places = stored(listed(rows, indexes, 1, queries=False))
    asked = stored(listed(rows.where(F.col("vec_id") % every == 0), indexes, probes, queries=True))
    own = ["length", "list"]
    blocks = places.groupBy(*own).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("bigint").alias("blocks"))
    chunks = asked.groupBy(*own).agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("bigint").alias("chunks"))
    sizes = F.broadcast(blocks.join(chunks, own))  # one row for each list
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = [*own, "block", "chunk"]
    candidates = places.join(sizes, own).select(*own, part("blocks").alias("block"), every_one("chunks").alias("chunk"), "row", "vec_id", "embedding")
    queries = asked.join(sizes, own).select(*own, every_one("blocks").alias("block"), part("chunks").alias("chunk"), "row", "vec_id", "embedding")
    found = (
        queries.groupBy(*key)
        .cogroup(candidates.groupBy(*key))
        .applyInPandas(_scan_block(indexes, k), "query_row bigint, query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
