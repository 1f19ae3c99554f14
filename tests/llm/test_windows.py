"""Removal of repeated windows against plain Python."""

from collections import Counter, defaultdict

import numpy as np
from corpus_rows import BASE, LONG, TEXTS, documents

from footfall.llm import window_dedup as W


def expected(rows, width):
    firsts = defaultdict(list)
    split = [(i, (text or "").encode().split()) for i, text in rows]
    for doc, words in split:
        for at in range(len(words) - width + 1):
            if doc is not None:
                firsts[tuple(words[at : at + width])].append(doc)
    least = {window: min(docs) for window, docs in firsts.items()}
    result = []
    for doc, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            if doc is not None and least[tuple(words[at : at + width])] < doc:
                gone[at : at + width] = [True] * width
        spans, kept = [], []
        for at, word in enumerate(words):
            if not gone[at]:
                kept.append(word)
            elif at and gone[at - 1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((at, at + 1))
        result.append((doc, len(words), tuple(spans), b" ".join(kept).decode()))
    return Counter(result)


def found(docs, width, **options):
    rows = W.without_repeated_windows(docs, width, **options).collect()
    return Counter((r.doc_id, r.n_words, tuple((s.start, s.end) for s in r.removed), r.kept_text) for r in rows)


def test_odd_rows(docs, no_docs):
    want = expected(TEXTS, 13)
    assert found(docs, 13) == want
    assert found(docs, 13, chunk_bytes=2000) == want  # many chunks and buckets
    assert W.window_report(no_docs).count() == 0


def test_random_texts_of_few_words(spark):
    rng = np.random.default_rng(11)
    rows = [(int(i), " ".join(map(str, rng.integers(0, 2, rng.integers(0, 40))))) for i in rng.permutation(150)]
    rows += [(7, "0 1 0 0 1 1 0"), (7, "0 1 0 0 1 1 0"), (None, "0 1 0 0 1 1 0"), (-5, "1 1 1 0 0 1 0")]
    for width in (1, 5, 7):
        want = expected(rows, width)
        assert found(documents(spark, rows), width, chunk_bytes=500) == want
        assert found(documents(spark, rows), width) == want


def test_copies_and_a_very_long_text(spark):
    long = " ".join(f"x{i}" for i in range(120_000))
    rows = [(i, BASE) for i in range(5, 400)] + [(500, long), (3, "new " + long[:400_000]), (600, LONG), (2, LONG)]
    assert found(documents(spark, rows, extra=False), 13, chunk_bytes=20_000) == expected(rows, 13)


def test_hash_of_a_window_is_that_of_its_words():
    words = np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64)
    whole = W.window_hashes(words, 13)
    assert len(whole) == 488 and len(set(whole.tolist())) == 488
    for at in (0, 1, 200, 487):
        assert W.window_hashes(words[at : at + 13], 13)[0] == whole[at]
    assert not len(W.window_hashes(words[:12], 13))
