"""Near copies and repeated substrings against plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from corpus_rows import BASE, LONG, TEXTS, documents

from footfall.llm import minhash_dedup as M
from footfall.llm import substring_dedup as S
from footfall.llm.tables import connected


def word_set(text, width):
    words = (text or "").encode().lower().split()
    many = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    return frozenset(many or ([b" ".join(words)] if words else []))


def expected_components(rows, width, percent):
    sets = [word_set(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    result = []
    for i, (doc, _) in enumerate(rows):
        least = doc if doc is None else min(groups[root(i)])
        result.append((doc, len(sets[i]), least, doc is None or doc == least))
    return Counter(result)


def test_connected_is_union_find(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(500, i) for i in range(501, 600)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges + [(None, 1)], "a bigint, b bigint")
    assert {r.node: r.root for r in connected(frame).collect()} == {x: root(x) for x in parent}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    same = (M.signature(a) == M.signature(b)).mean()
    assert abs(same - 800 / 1200) < 0.12
    assert (M.signature(a) == M.signature(a[::-1])).all()


def test_components_of_odd_rows(docs):
    found = Counter(tuple(r) for r in M.components(docs, width=4).collect())
    assert found == expected_components(TEXTS, 4, 80)


def test_an_id_with_two_texts_names_two_documents(spark):
    rows = [(1, BASE), (1, LONG), (2, BASE + " end"), (3, LONG + " end"), (0, LONG + " more"), (4, "two words"), (4, "two words")]
    frame = documents(spark, rows)
    found = Counter(tuple(r) for r in M.components(frame, width=4).collect())
    assert found == expected_components(rows, 4, 80)
    kept = Counter((r.doc_id, r.text) for r in M.one_of_each(frame, width=4).collect())
    assert kept == Counter([rows[0], rows[4], rows[5], rows[6]])


def test_components_of_no_rows(no_docs):
    assert M.components(no_docs).collect() == []


def near_group(size, seed):
    """Copies of one text with growing numbers of edits, so that similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(seed)
    base = [f"g{seed}w{i}" for i in range(120)]
    rows = []
    for n in range(size):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"e{seed}x{n}x{at}"
        rows.append(" ".join(words))
    return rows


def test_large_bucket_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 2000)
    texts = near_group(90, 1) + near_group(20, 2)
    rows = [((i * 37) % 997, text) for i, text in enumerate(texts)]
    found = Counter(tuple(r) for r in M.components(documents(spark, rows, False), width=4).collect())
    assert found == expected_components(rows, 4, 80)


def test_one_of_each_keeps_columns(docs):
    kept = M.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 9, 9, 12, 14, 15, 16]


def brute_repeats(rows, size):
    raw = [(text or "").encode() for _, text in rows]
    count = Counter(b[i : i + size] for b in raw for i in range(len(b) - size + 1))
    result = Counter()
    for (doc, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        result[doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return result


PASSAGE = "".join(chr(97 + i * i % 26) for i in range(260)) + " ".join(str(i * i) for i in range(60))
EDGES = [
    *TEXTS,
    (21, "left one " + PASSAGE + " right one"),
    (22, "left two " + PASSAGE + " right two"),
    (23, PASSAGE[40:300]),
    (24, PASSAGE[:199]),
    (25, LONG[100:900] + BASE),
    (26, PASSAGE + PASSAGE),
]


def test_repeats_equal_brute_force(spark):
    found = S.repeat_report(documents(spark, EDGES)).collect()
    assert Counter(tuple(r) for r in found) == brute_repeats(EDGES, 200)


def test_repeats_of_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_PIECES", 1)
    found = S.repeat_report(documents(spark, EDGES, False)).collect()
    assert Counter(tuple(r) for r in found) == brute_repeats(EDGES, 200)


def test_repeats_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 333)
    rows = EDGES[-8:]
    found = [S.pieces((text or "").encode()) for _, text in rows]
    assert all((f[3] <= 333).all() for f in found)


def test_first_copy_stays(spark):
    passage = " ".join(str(i * i) for i in range(100))
    rows = [(1, "aa:" + passage), (2, "bb;" + passage)]
    kept = S.without_repeats(documents(spark, rows, False)).collect()
    assert sorted(len(r["_kept"]) for r in kept) == [3, 3 + len(passage)]


def test_repeats_of_no_rows(no_docs):
    assert S.repeat_report(no_docs).collect() == []


def naive_factors(raw, windows, depth):
    result = []
    for j, at in enumerate(windows):
        best = 0
        for other in windows[:j]:
            n = 0
            while n < depth and raw[at + n] == raw[other + n]:
                n += 1
            best = max(best, n)
        result.append(best)
    return result


def test_longest_previous_factors_equal_naive_ones():
    rng = np.random.default_rng(4)
    for letters, depth in ((2, 40), (3, 33), (1, 64), (200, 50), (2, 200)):
        raw = rng.integers(0, letters, 420).astype(np.uint8)
        raw[230:310] = raw[20:100]
        windows = np.flatnonzero(rng.random(len(raw) - depth) < 0.6)
        factors, source = S.longest_previous_factors(raw, windows, depth)
        assert factors.tolist() == naive_factors(raw, windows.tolist(), depth)
        for j in np.flatnonzero(factors).tolist():
            a, b, n = windows[j], windows[source[j]], factors[j]
            assert b < a and (raw[a : a + n] == raw[b : b + n]).all()


def test_previous_smaller():
    values = np.random.default_rng(8).permutation(500)
    want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(500)]
    assert S.previous_smaller(values).tolist() == want


def test_identical_rows_are_one_row_with_a_count(spark):
    rows = [(1, PASSAGE)] * 300 + [(None, PASSAGE[:150])] * 3 + [(2, "x" + PASSAGE)]
    docs = documents(spark, rows, False)
    found = S.repeat_report(docs).collect()
    assert Counter(tuple(r) for r in found) == brute_repeats(rows, 200)
    sizes = S.repeats(docs).selectExpr("size(found) n").collect()
    assert len(sizes) == 2 and max(r.n for r in sizes) < 20  # pieces of a row once, not once for each copy
