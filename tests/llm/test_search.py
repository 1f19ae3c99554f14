"""Nearest neighbours: recall, exact scores, odd vectors."""

import numpy as np
import pytest

from footfall.llm import ann_search as A

DATA = "/root/testdata"


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_and_scores(spark, size):
    frame = spark.read.parquet(f"{DATA}/{size}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in frame.collect()}
    ids = np.array(sorted(rows))
    vectors = np.stack([rows[i] for i in ids])
    found = {}
    for r in A.nearest(frame).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.score == pytest.approx(float(rows[r.query_id] @ rows[r.vec_id]), abs=1e-12)
    recalls = []
    for i in ids[ids % 20 == 0]:
        scores = vectors @ rows[i]
        order = [j for j in ids[np.lexsort((ids, -scores))] if j != i][:20]
        recalls.append(len(set(order) & {j for j, _ in found[i]}) / 20)
        assert [s for _, s in found[i]] == sorted((s for _, s in found[i]), reverse=True)
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    assert np.mean(recalls) >= 0.9


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]),
            (120, [None, 1.0]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.0, 2.0])]
    rows += [(i, [1.0, 1.0]) for i in range(200, 230)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id bigint, embedding array<float>, list string, rank int")
    found = {}
    for r in A.nearest(frame).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {0, 20, 200, 220}
    assert sorted(found[0]) == [(k + 1, 200 + k, 1.0) for k in range(20)]
    assert [v for _, v, _ in sorted(found[200])][:3] == [20, 20, 201]
    assert A.nearest(frame.limit(0)).collect() == []
    few = frame.where("vec_id in (0, 20)")  # of the repeated id each row is a query, and a candidate of the other
    pairs = sorted((r.query_id, r.rank, r.vec_id) for r in A.nearest(few).collect())
    assert pairs == [(0, 1, 20), (0, 2, 20), (20, 1, 20), (20, 1, 20), (20, 2, 0), (20, 2, 0)]


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(3 + i % 3).tolist()) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for r in A.nearest(frame, every=20, k=5, probes=99).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    for i in range(0, 90, 20):
        near = sorted((-np.dot(rows[i][1], v), j) for j, v in rows if j != i and len(v) == len(rows[i][1]))
        assert found[i] == [j for _, j in near[:5]]


@pytest.mark.parametrize("size", [1e39, 1e160, 1e-200])
def test_vectors_of_extreme_norm_lose_no_neighbour(spark, size):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    rows[7] = (7, [size] + [0.0] * 7)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for r in A.nearest(frame, every=20, k=10, probes=99).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    for i in (0, 20, 40):
        near = sorted((-np.dot(rows[i][1], v), j) for j, v in rows if j != i)
        assert found[i] == [j for _, j in near[:10]]


def test_probes_follow_the_data():
    rng = np.random.default_rng(2)
    spread = rng.standard_normal((4000, 32))
    spread /= np.linalg.norm(spread, axis=1)[:, None]
    centres = rng.standard_normal((40, 32)) * 3
    grouped = centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 32)) * 0.05
    grouped /= np.linalg.norm(grouped, axis=1)[:, None]
    few, many = (A._fitted(points, np.abs(points).max(), 1 / np.abs(points).max(), 32, 20) for points in (grouped, spread))
    assert few.probes <= 6 < many.probes
