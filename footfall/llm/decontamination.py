"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over words: the masked-out positions may differ. Every place of
a benchmark item and of a document gives one hash for each mask; equal hashes are
joined, and around each hit the words are compared along its diagonal. An overlap is a
window of ``WINDOW`` words of which at least the share ``similarity`` is equal, so
substituted words are tolerated. The masks leave no window out: wherever two words of thirteen differ,
one of them still fits in somewhere. Items of fewer words than a window must occur whole.

A filter of fixed size over the item hashes keeps places without a hit out of the
shuffle; it grows with neither table, and the join is exact.

Words are what lies between ASCII white space, with A-Z in lower case. Null and empty
texts, of documents or items, overlap with nothing. Repeated rows give equal results,
once for each ``doc_id``; a null ``doc_id`` or ``item_id`` is carried through. Other
columns are left out of the report and kept by ``clean_documents``. An empty table of documents gives an empty one,
without items nothing overlaps. A very long text is searched whole, in one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import bitmap, in_bitmap, slices, stored
from footfall.llm.words import HASHER, ascii_words, gram_hashes

WINDOW = 13
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Removed texts are broadcast up to so many, at 16 bytes each; beyond, they are shuffled.
BROADCAST_ROWS = 200_000


def masks_for(short_lengths: list[int]) -> list[tuple[int, ...]]:
    """The spaced masks, and a full one for each length of short items."""
    return [*MASKS, *(tuple(range(n)) for n in sorted(short_lengths))]


def _seeds_of(words: list[bytes], masks: list[tuple[int, ...]]):
    """``(place, mask, hashes, first place)``: where seeds start, and the word hashes around."""
    hashes = HASHER.array(words)
    for number, mask in enumerate(masks):
        yield number, mask, hashes, gram_hashes(hashes, mask, seed=len(mask) * 1000 + mask[-1])


def _around(hashes: np.ndarray, place: int, mask: tuple[int, ...]) -> tuple[int, bytes]:
    """Words that windows holding the seed can reach: how many stand before it, and their hashes."""
    start = max(0, place + mask[-1] + 1 - WINDOW)
    return place - start, hashes[start : place + WINDOW].tobytes()


def item_seeds(benchmark: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """``seed, item_id, n_words, item_before, item_words`` for each seed of each item."""

    def seeds(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = ascii_words(text)
                for number, mask, hashes, grams in _seeds_of(words, masks):
                    if (number >= len(MASKS)) != (len(words) < WINDOW):
                        continue
                    if number >= len(MASKS) and len(mask) != len(words):
                        continue
                    for place, gram in enumerate(grams.view(np.int64).tolist()):
                        rows.append((gram, item, len(words), *_around(hashes, place, mask)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, row)) for row in rows], schema=pa.schema(list(zip(names, kinds)))
            )

    names = ["seed", "item_id", "n_words", "item_before", "item_words"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return benchmark.selectExpr("cast(item_id as bigint) item_id", "text").mapInArrow(
        seeds, "seed bigint, item_id bigint, n_words int, item_before int, item_words binary"
    )


def document_hits(docs: DataFrame, wanted: np.ndarray, masks: list[tuple[int, ...]]) -> DataFrame:
    """``seed, doc_id, text_hash, doc_before, doc_words`` for places whose hash passes the filter."""

    def hits(batches):
        for batch in slices(batches):
            columns = {name: [] for name in ("seed", "row", "before", "words")}
            for row, text in enumerate(batch.column("text").to_pylist()):
                for _, mask, hashes, grams in _seeds_of(ascii_words(text), masks):
                    if not len(grams):
                        continue
                    for place in np.flatnonzero(in_bitmap(wanted, grams)).tolist():
                        before, words = _around(hashes, place, mask)
                        columns["seed"].append(int(grams[place].view(np.int64)))
                        columns["row"].append(row)
                        columns["before"].append(before)
                        columns["words"].append(words)
            at = pa.array(columns["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns["seed"], pa.int64()),
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(columns["before"], pa.int32()),
                    pa.array(columns["words"], pa.binary()),
                ],
                names=["seed", "doc_id", "text_hash", "doc_before", "doc_words"],
            )

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "xxhash64(text) text_hash", "text")
    return rows.mapInArrow(
        hits, "seed bigint, doc_id bigint, text_hash bigint, doc_before int, doc_words binary"
    )


def equal_words(doc: np.ndarray, doc_before: int, item: np.ndarray, item_before: int, window: int) -> int:
    """The most equal words in a window along the diagonal through the seed; 0 if no window fits."""
    back = min(doc_before, item_before)
    doc, item = doc[doc_before - back :], item[item_before - back :]
    length = min(len(doc), len(item))
    if length < window:
        return 0
    same = np.concatenate([[0], (doc[:length] == item[:length]).cumsum()])
    return int((same[window:] - same[:-window]).max())


def overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``doc_id, item_id, text_hash, equal_words, window`` for each document and item that overlap."""
    lengths = benchmark.select(
        F.size(F.array_remove(F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " "), "")).alias("n")
    )
    short = [row.n for row in lengths.where(f"n > 0 and n < {WINDOW}").distinct().collect()]  # 12 at most
    masks = masks_for(short)
    seeds = stored(item_seeds(benchmark, masks))
    hits = document_hits(docs, bitmap(seeds, "seed"), masks)

    def checked(batches):
        for batch in slices(batches):
            best, windows = [], []
            for words, before, item, item_before, n in zip(
                *(batch.column(c).to_pylist() for c in ("doc_words", "doc_before", "item_words", "item_before", "n_words"))
            ):
                window = min(n, WINDOW)
                windows.append(window)
                best.append(equal_words(np.frombuffer(words, np.uint64), before, np.frombuffer(item, np.uint64), item_before, window))
            keep = [
                equal == window if window < WINDOW else equal >= similarity * window
                for equal, window in zip(best, windows)
            ]
            found = pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "item_id", "text_hash")),
                    pa.array(best, pa.int32()),
                    pa.array(windows, pa.int32()),
                ],
                names=["doc_id", "item_id", "text_hash", "equal_words", "window"],
            )
            yield found.filter(pa.array(keep, pa.bool_()))

    return (
        hits.join(seeds, "seed")
        .mapInArrow(checked, "doc_id bigint, item_id bigint, text_hash bigint, equal_words int, window int")
        .groupBy("doc_id", "item_id", "text_hash")
        .agg(F.max("equal_words").alias("equal_words"), F.max("window").alias("window"))
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with their own columns."""
    gone = overlaps(docs, benchmark, similarity).select(F.col("text_hash").alias("_gone")).distinct()
    gone = stored(gone)
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.xxhash64(docs["text"]) == gone["_gone"], "left_anti")
