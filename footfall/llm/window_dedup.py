"""Substring deduplication by Rabin-Karp hashes of every window of so many words.

A window is ``width`` consecutive words of one document. Its hash is a polynomial in the 64-bit
hashes of its words, modulo 2^64, taken from prefix sums, so the cost of a window does not grow with its width.
Each word is removed that lies in a window whose word sequence also starts in a document with
a smaller ``doc_id``; windows are judged on the input, and those of one document that
overlap merge into maximal intervals.

Documents are dealt out in chunks of about ``CHUNK_BYTES``, whose number grows with the corpus. A chunk
sends each distinct hash once, with the smallest id that has it there, to the hash's bucket; a bucket finds the smallest id
of all chunks and answers with one bit for each hash: whether a smaller id has it elsewhere. However many
documents share a window, a bucket hears of it once from a chunk, and no document is
listed. The texts are shuffled once, for both visits of a chunk.

Hashes of windows are 64 bits and are not compared as text: among ``n`` distinct windows ``n^2 / 2^65`` pairs
are taken for equal by chance (one in a few thousand runs at half a gigabyte).

Words are what stands between ASCII white space, unchanged. Null and empty texts have no words. Repeated rows
and rows that share an id are documents of their own, none smaller than the other. A row with a
null id is neither smaller nor greater than any: it keeps its text and removes nothing. A text with
fewer words than ``width`` has no window. An empty table gives an empty one. A very long text is
handled in one task, at some 60 bytes of memory for each word. Other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import HASHER, mix

WIDTH = 13
CHUNK_BYTES = 8 << 20

#: Base of the polynomial, odd and thus with an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of ``width`` words, given the words' hashes."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)

    def powers(base: int, many: int) -> np.ndarray:
        factors = np.full(many, np.uint64(base))
        factors[0] = 1
        return np.cumprod(factors)

    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(BASE, len(words)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(_INVERSE, count))


class Chunk:
    """The windows of some documents, and each distinct hash with the smallest id that has it.

    ``hashes`` are sorted, so two visits with the same documents in any order agree on them.
    """

    def __init__(self, rows: pa.Table, width: int):
        ids = rows.column("doc_id").combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        self.order = np.lexsort((ids, ~known))
        texts = rows.column("text").to_pylist()
        self.words = [(texts[i] or b"").split() for i in self.order]
        self.ids, known = ids[self.order], known[self.order]
        sizes = np.array([len(words) for words in self.words], np.int64)
        self.ends = sizes.cumsum()
        hashed = [HASHER.array(words) for words in self.words]
        hashed = window_hashes(np.concatenate(hashed) if hashed else np.empty(0, np.uint64), width)
        owner = np.repeat(np.arange(len(sizes)), sizes)[: len(hashed)]
        inside = (np.arange(len(hashed)) + width <= self.ends[owner]) & known[owner]
        self.starts = np.flatnonzero(inside)
        hashed, owner = hashed[inside], owner[inside]
        by_hash = np.argsort(hashed, kind="stable")  # documents are in order of id
        hashed = hashed[by_hash]
        first = np.ones(len(hashed), bool)
        first[1:] = hashed[1:] != hashed[:-1]
        self.hashes, self.least = hashed[first], self.ids[owner[by_hash[first]]]
        self.entry = np.empty(len(hashed), np.int64)
        self.entry[by_hash] = first.cumsum() - 1
        self.later = self.ids[owner] > self.least[self.entry]

    def bounds(self, buckets: int) -> np.ndarray:
        """Where the hashes of each bucket begin; one more at the end."""
        bucket = ((self.hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _planes(values: np.ndarray) -> bytes:
    """Eight-byte values as all first bytes, all second bytes and so on, which compress well if small."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _send(width: int, buckets: int):
    def send(rows: pa.Table) -> pa.Table:
        chunk, bounds = Chunk(rows, width), None
        bounds = chunk.bounds(buckets)
        filled = np.flatnonzero(bounds[1:] > bounds[:-1])
        hashes, ids = [], []
        for b in filled:
            part = slice(bounds[b], bounds[b + 1])
            hashes.append(_planes(np.diff(chunk.hashes[part], prepend=np.uint64(0))))
            ids.append(_planes(chunk.least[part]))
        number = rows.column("chunk")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(filled, pa.int32()),
                "chunk": pa.array([number] * len(filled), pa.int32()),
                "hashes": pa.array(hashes, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    return send


def _answer(rows: pa.Table) -> pa.Table:
    """For each chunk's hashes of a bucket, one bit: whether another chunk has it under a smaller id."""
    hashes = [np.cumsum(_values(x)) for x in rows.column("hashes").to_pylist()]
    ids = [_values(x).view(np.int64) for x in rows.column("ids").to_pylist()]
    ends = np.cumsum([len(x) for x in hashes])
    hashes, ids = np.concatenate(hashes), np.concatenate(ids)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(first))
    later = np.empty(len(ids), bool)
    later[order] = least[first.cumsum() - 1] < ids[order]
    bits = [np.packbits(part).tobytes() for part in np.split(later, ends[:-1])]
    return pa.table(
        {"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "later": pa.array(bits, pa.binary())}
    )


_REMOVED = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _remove(width: int, buckets: int):
    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(rows, width)
        bounds = chunk.bounds(buckets)
        elsewhere = np.zeros(len(chunk.hashes), bool)
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("later").to_pylist()):
            many = bounds[b + 1] - bounds[b]
            elsewhere[bounds[b] : bounds[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=many)
        starts = chunk.starts[chunk.later | elsewhere[chunk.entry]]
        total = int(chunk.ends[-1]) if len(chunk.ends) else 0
        depth = np.bincount(starts, minlength=total + 1) - np.bincount(starts + width, minlength=total + 1)
        gone = depth.cumsum()[:total] > 0
        kept, spans = [], []
        for words, end in zip(chunk.words, chunk.ends):
            own = gone[end - len(words) : end]
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
            parts, at = [], 0
            for a, b in zip(edges[::2], edges[1::2]):
                parts += words[at:a]
                at = b
            kept.append(b" ".join(parts + words[at:]))
        return pa.table(
            {
                "doc_id": rows.column("doc_id").take(pa.array(chunk.order)),
                "n_words": pa.array([len(words) for words in chunk.words], pa.int64()),
                "removed": pa.array(spans, pa.list_(_REMOVED)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return remove


def without_repeated_windows(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_words, removed, kept_text`` for each row of ``docs (doc_id, text)``.

    ``removed``: maximal intervals ``(start, end)`` of removed words, counted from 0, end exclusive.
    ``kept_text``: the other words, joined by one space.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = size // chunk_bytes + 1
    # repeated rows may lie in any chunk, so those of different tasks are spread
    place = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(chunks))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        place.cast("int").alias("chunk"),
    )
    sent = rows.groupBy("chunk").applyInArrow(
        _send(width, chunks), "bucket int, chunk int, hashes binary, ids binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(_answer, "chunk int, bucket int, later binary")
    found = (
        rows.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _remove(width, chunks),
            "doc_id bigint, n_words bigint, removed array<struct<start:bigint,end:bigint>>, kept binary",
        )
    )
    return found.select("doc_id", "n_words", "removed", F.col("kept").cast("string").alias("kept_text"))


def window_report(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Counts and a digest of what :func:`without_repeated_windows` keeps."""
    found = without_repeated_windows(docs, width, chunk_bytes)
    sizes = F.transform("removed", lambda span: span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, n: total + n).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_intervals"),
        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"),
    )
