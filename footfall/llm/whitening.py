"""Whitening of embeddings along their leading components.

Each entry ``c`` becomes the integer ``floor(64 c) + 1000000``. The fit list holds each distinct integer vector once. Its
sums are exact; its covariance is added up from the partial products of tasks, each centred before
multiplying. The matrix, whose size depends on the length of a vector alone, is brought to tridiagonal form by
Householder reflections on the driver; bisection with Sturm counts gives the leading eigenvalues, and inverse
iteration their vectors, made orthogonal again within clusters of close eigenvalues. The components go to the tasks,
which project all rows.

Rows whose vector is null or holds nulls or non-finite entries are dropped. Vectors of different lengths are spaces of their own,
with their own fit list and components. Repeated rows each give their rows; a null id stays null.
An empty vector has no components, and neither has a space without variance (a single distinct
vector); a component is left out where its eigenvalue is zero but for rounding. Ties between
eigenvalues leave the choice of orthogonal vectors free; all rows get the same. Entries beyond
2^62 / 64 are taken as that bound; a deviation that does not fit into 64 bits is null. An empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues closer than this share of the largest are a cluster.
CLUSTER = 1e-3
_ENTRY_TYPES = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<i8")}
_EPS = float(np.finfo(np.float64).eps)


# -- symmetric eigenproblem ---------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors of a symmetric matrix."""
    a, reflections = np.array(matrix, np.float64), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        below = np.linalg.norm(v[1:])
        if below == 0.0:
            reflections.append(np.zeros_like(v))
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2.0 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value of ``at``."""
    least = np.finfo(np.float64).tiny / _EPS
    pivot = diagonal[0] - at
    counts = (pivot < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        counts += pivot < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, many: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection."""
    n = len(diagonal)
    radius = np.zeros(n)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    spread = max(np.abs(diagonal).max() + radius.max(), np.finfo(np.float64).tiny) * 4 * _EPS
    low = np.full(many, (diagonal - radius).min() - spread)
    high = np.full(many, (diagonal + radius).max() + spread)
    wanted = n - 1 - np.arange(many)
    for _ in range(2000):
        middle = low + (high - low) / 2
        if not ((low < middle) & (middle < high)).any():
            break
        below = sturm_counts(diagonal, off, middle) > wanted
        high, low = np.where(below, middle, high), np.where(below, low, middle)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves with the tridiagonal matrix less ``value``: elimination with row exchanges."""
    n = len(diagonal)
    d, up, up2 = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * n
    steps = []
    for i in range(n - 1):
        below = float(off[i])
        swap = abs(below) > abs(d[i])
        if swap:
            factor = d[i] / below
            d[i], up[i], up2[i], row = below, d[i + 1], up[i + 1], up[i]
            d[i + 1], up[i + 1] = row - factor * d[i + 1], -factor * up[i + 1]
        else:
            factor = below / d[i] if d[i] else 0.0
            d[i + 1] -= factor * up[i]
        steps.append((swap, factor))
    d = [x if abs(x) > least else (least if x >= 0 else -least) for x in d]

    def solve(right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factor * b[i]
        for i in range(n - 1, -1, -1):
            total = b[i]
            if i + 1 < n:
                total -= up[i] * b[i + 1]
            if i + 2 < n:
                total -= up2[i] * b[i + 2]
            b[i] = total / d[i]
        return np.array(b)

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for the falling ``values``, as rows."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(), np.abs(off).max() if n > 1 else 0.0, np.finfo(np.float64).tiny)
    rng = np.random.default_rng(13)
    vectors, cluster = [], 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            cluster = k
        # equal values are moved apart a little, so that each solve has a direction of its own
        solve = _solver(diagonal, off, value - (k - cluster) * 10 * _EPS * size, _EPS * size)
        near = vectors[cluster:k]

        def orthogonal(v: np.ndarray) -> np.ndarray:
            for _ in range(2):
                for other in near:
                    v = v - (other @ v) * other
            return v / np.linalg.norm(v)

        v = orthogonal(rng.standard_normal(n))
        for _ in range(6):
            v = orthogonal(solve(v))
        vectors.append(v)
    return np.array(vectors).reshape(len(values), n)


def leading_components(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.zeros(0), np.zeros((0, len(matrix)))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(many, len(matrix)))
    values = values[values > len(matrix) * _EPS * max(values[0], 0.0)]
    vectors = inverse_iteration(diagonal, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[:, k + 1 :] -= 2.0 * np.outer(vectors[:, k + 1 :] @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return values * scale, vectors


# -- integer vectors ----------------------------------------------------------


@dataclass
class Space:
    """The vectors of one length: count, the sum as ``n * whole + rest``, and the components."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - S)^2``, exact."""
        distance = x - self.whole
        bound = self.n * (int(np.abs(distance).max(initial=0)) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            return ((self.n * distance - self.rest) ** 2).sum(axis=1).tolist()
        sums = [sum((self.n * d - r) ** 2 for d, r in zip(row, self.rest.tolist())) for row in distance.tolist()]
        return [total if total < 1 << 63 else None for total in sums]


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, length, width, x``: the usable vectors as integers of ``width`` bytes, less ``OFFSET``."""

    def convert(batches):
        for batch in batches:
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_numpy()
            entries = vectors.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            usable = np.ones(len(lengths), bool)
            usable[owner[~np.isfinite(entries)]] = False
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(entries * float(SCALE))
            scaled = np.clip(np.nan_to_num(scaled), -(2.0**62), 2.0**62).astype(np.int64)
            starts = np.concatenate([[0], lengths.cumsum()[:-1]]).astype(np.int64)
            taken, widths, packed = [], [], []
            for length in np.unique(lengths[usable]):
                rows = np.flatnonzero(usable & (lengths == length))
                x = scaled[starts[rows][:, None] + np.arange(length)]
                most = np.abs(x).max(axis=1, initial=0)
                for width, (low, high) in {2: (0, 1 << 15), 4: (1 << 15, 1 << 31), 8: (1 << 31, 1 << 63)}.items():
                    fits = (most >= low) & (most < high)
                    taken.append(rows[fits])
                    widths += [width] * int(fits.sum())
                    packed += [row.tobytes() for row in x[fits].astype(_ENTRY_TYPES[width])]
            taken = np.concatenate([np.empty(0, np.int64), *taken])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(taken)),
                    pa.array(lengths[taken], pa.int32()),
                    pa.array(widths, pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                names=["vec_id", "length", "width", "x"],
            )

    rows = embeddings.where(F.col(column).isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")
    )
    return rows.mapInArrow(convert, "vec_id bigint, length int, width int, x binary")


def _matrices(batch):
    """``(length, row numbers, x)`` for the rows of a batch that have one length and width."""
    lengths, widths = batch.column("length").to_numpy(), batch.column("width").to_numpy()
    packed = batch.column("x")
    for length, width in sorted(set(zip(lengths.tolist(), widths.tolist()))):
        if not length:
            continue
        rows = np.flatnonzero((lengths == length) & (widths == width))
        joined = b"".join(packed.take(pa.array(rows)).to_pylist())
        yield length, rows, np.frombuffer(joined, _ENTRY_TYPES[width]).reshape(-1, length).astype(np.int64) + OFFSET


def _sums(fit: DataFrame) -> dict[int, Space]:
    """Count and exact sums by length; one row for each dimension comes to the driver."""

    def partial(batches):
        totals, counts = {}, {}
        for batch in batches:
            for length, rows, x in _matrices(batch):
                # in two halves of 32 bits, so that no sum overflows
                low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
                own = [(h << 32) + lo for h, lo in zip(high.tolist(), low.tolist())]
                before = totals.get(length, [0] * length)
                totals[length] = [a + b for a, b in zip(before, own)]
                counts[length] = counts.get(length, 0) + len(rows)
        for length, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * length, pa.int32()),
                    pa.array(range(length), pa.int64()),
                    pa.array([counts[length]] * length, pa.int64()),
                    pa.array([str(value) for value in total], pa.string()),
                ],
                names=["length", "dimension", "n", "total"],
            )

    rows = fit.mapInArrow(partial, "length int, dimension bigint, n bigint, total string")
    sums = rows.groupBy("length", "dimension").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    )
    spaces = {}
    for (length, n), group in sums.toPandas().sort_values("dimension").groupby(["length", "n"]):
        parted = [divmod(int(total), int(n)) for total in group["total"]]
        whole, rest = np.array(parted, np.int64).T
        spaces[int(length)] = Space(int(n), whole, rest)
    return spaces


def _products(fit: DataFrame, columns: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """For each length, the sum over the fit list of the outer products of ``columns(length, x)``.

    A task sends one matrix for each length; rows of it are added up apart from each other.
    """

    def partial(batches):
        totals = {}
        for batch in batches:
            for length, _, x in _matrices(batch):
                m = columns(length, x)
                totals[length] = totals.get(length, 0.0) + m.T @ m
        for length, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * len(total), pa.int32()),
                    pa.array(range(len(total)), pa.int32()),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                names=["length", "i", "row"],
            )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows["row"].to_list()), axis=0)
        return pd.DataFrame({"length": rows["length"].iloc[:1], "i": rows["i"].iloc[:1], "row": [total]})

    rows = fit.mapInArrow(partial, "length int, i int, row array<double>")
    added = rows.groupBy("length", "i").applyInPandas(add, "length int, i int, row array<double>").toPandas()
    return {
        int(length): np.stack(group.sort_values("i")["row"].to_list()) for length, group in added.groupby("length")
    }


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """The spaces of ``integer_vectors``, by length; only those that have a component."""
    fit = stored(vectors.select("length", "width", "x").where("length > 0").distinct())
    spaces = _sums(fit)
    products = _products(fit, lambda length, x: spaces[length].centred(x))
    for length, product in products.items():
        space = spaces[length]
        covariance = (product + product.T) / 2 / space.n
        space.values, space.vectors = leading_components(covariance, components)
        space.trace = float(np.trace(covariance))
    spaces = {length: space for length, space in spaces.items() if len(space.values)}

    def with_one(length, x):
        if length not in spaces:
            return np.zeros((len(x), 1))
        return np.column_stack([spaces[length].whitened(x), np.ones(len(x))])

    for length, product in _products(fit, with_one).items():
        if length in spaces:
            mean = product[:-1, -1] / spaces[length].n
            error = product[:-1, :-1] / spaces[length].n - np.outer(mean, mean) - np.eye(len(mean))
            spaces[length].identity_error = float(np.abs(error).max())
    return spaces


def whitened(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    vectors = integer_vectors(embeddings, column)
    spaces = fitted(vectors, components)

    def project(batches):
        for batch in batches:
            for length, rows, x in _matrices(batch):
                if length not in spaces:
                    continue
                space = spaces[length]
                many = len(space.values)
                ids = batch.column("vec_id").take(pa.array(np.repeat(rows, many)))
                every = len(rows) * many
                deviations = pa.array(space.deviations(x), pa.int64()).take(
                    pa.array(np.repeat(np.arange(len(rows)), many))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, many + 1), len(rows)), pa.int32()),
                        pa.array(np.full(every, space.n), pa.int64()),
                        deviations,
                        pa.array(space.whitened(x).ravel(), pa.float64()),
                        pa.array(np.tile(space.values / space.trace, len(rows)), pa.float64()),
                        pa.array(np.full(every, space.identity_error), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(
        project,
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double,"
        " identity_error double",
    )
