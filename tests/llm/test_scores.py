"""Classifiers: held-out accuracy, odd rows, no training rows."""

import zlib

import numpy as np
import pytest
from corpus_rows import TEXTS

from footfall.llm import quality_gbt as Q
from footfall.llm import toxicity_ftrl as X

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("score, label, threshold", [(Q.quality_scores, "quality", 0.5), (X.toxicity_scores, "toxic", 0.7)])
def test_odd_rows_get_scores(docs, no_docs, labels, score, label, threshold):
    rows = score(docs, labels).collect()
    assert len(rows) == len(TEXTS)
    by_id = {}
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= threshold)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[4] == by_id[5] and all(len(s) == 1 for s in by_id.values())
    assert score(no_docs, labels).collect() == []
    assert {r.score for r in score(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_toxicity_learns_marked_words():
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(300)]
    texts, marks = [], []
    for i in range(600):
        text = list(rng.choice(words, 40))
        if i % 5 == 0:
            text[int(rng.integers(40))] = str(rng.choice(["vile", "awful", "nasty"]))
        texts.append(" ".join(text))
        marks.append(int(i % 5 == 0))
    features = [X.features(t) for t in texts]
    weights = X.learn(list(zip(features[:450], marks[:450])))
    score = weights.scorer()
    got = [score(t) >= 0.7 for t in texts[450:]]
    assert np.mean(np.array(got) == np.array(marks[450:])) > 0.97
    assert len(weights.buckets) < 2000


def test_forest_walk_equals_a_plain_walk():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(500, len(Q.STATISTICS))).astype(np.float32)
    labels = (values[:, 0] * values[:, 1] > 0).astype(float)
    forest = Q.train(values, labels)
    binned = forest.binned(values)
    for row in range(0, 500, 50):
        total = forest.base
        for features, bins, leaves in zip(forest.features, forest.bins, forest.leaves):
            node = 0
            while node < len(features):
                node = 2 * node + 1 + int(binned[row, features[node]] > bins[node])
            total += leaves[node - len(features)]
        assert abs(1 / (1 + np.exp(-total)) - forest.scores(values[row : row + 1])[0]) < 1e-9
    assert ((forest.scores(values) >= 0.5) == labels).mean() > 0.9


def test_good_documents_keep_columns(docs, labels):
    assert Q.good_documents(docs, labels).columns == docs.columns
    assert Q.good_documents(docs, labels.limit(0)).count() == len(TEXTS)


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = X.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    assert len(toxic) > 100 and len(clean) > 1000
    above = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert above > 0.95 and np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_toxicity_learns_as_a_plain_loop_does(monkeypatch):
    monkeypatch.setattr(X, "LEAST_DOCUMENTS", 1)
    monkeypatch.setattr(X, "EPOCHS", 3)
    monkeypatch.setattr(X, "L1", 0.5)
    rng = np.random.default_rng(5)
    examples = [(np.unique(rng.integers(0, 30, 8)), int(rng.random() < 0.3)) for _ in range(60)]
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(i):
        if abs(z.get(i, 0.0)) <= X.L1:
            return 0.0
        return (np.sign(z[i]) * X.L1 - z[i]) / ((X.BETA + n[i] ** 0.5) / X.ALPHA + X.L2)

    def bias_weight():
        return -bias[0] * X.ALPHA / (X.BETA + bias[1] ** 0.5)

    order = np.random.default_rng(7)
    for _ in range(3):
        for e in order.permutation(len(examples)):
            at, label = examples[e]
            own, own_bias = {i: weight(i) for i in at.tolist()}, bias_weight()
            gradient = 1 / (1 + np.exp(-(sum(own.values()) + own_bias))) - label
            gradient *= X.POSITIVE_WEIGHT if label else 1.0
            for i, w in own.items():
                before = n.get(i, 0.0)
                n[i] = before + gradient**2
                z[i] = z.get(i, 0.0) + gradient - (n[i] ** 0.5 - before**0.5) / X.ALPHA * w
            before = bias[1]
            bias[1] += gradient**2
            bias[0] += gradient - (bias[1] ** 0.5 - before**0.5) / X.ALPHA * own_bias
    found = X.learn(examples)
    want = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(found.buckets.tolist(), found.values.tolist())) == pytest.approx(want, rel=1e-5)
    assert found.bias == pytest.approx(bias_weight(), rel=1e-9) and 0 < len(want) < 30


def test_best_split_is_that_of_all_splits():
    rng = np.random.default_rng(3)
    grad, hess = rng.normal(size=(6, 12)), rng.random((6, 12)) + 0.2
    grad[1:] *= grad[0].sum() / grad[1:].sum(axis=1)[:, None]  # each statistic bins the same rows
    hess[1:] *= hess[0].sum() / hess[1:].sum(axis=1)[:, None]
    best = (0.0, 0, 0)
    for feature in range(6):
        for at in range(11):
            g, h = grad[feature, : at + 1].sum(), hess[feature, : at + 1].sum()
            all_g, all_h = grad[0].sum(), hess[0].sum()
            if min(h, all_h - h) < Q.LEAST_HESSIAN:
                continue
            gain = g**2 / (h + Q.L2) + (all_g - g) ** 2 / (all_h - h + Q.L2) - all_g**2 / (all_h + Q.L2)
            if gain > best[0]:
                best = (gain, feature, at)
    assert Q._best_split(grad, hess)[1:] == best[1:]
