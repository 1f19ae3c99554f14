"""Repeated substrings across whole texts, by longest-previous-factor arrays over suffix order.

Texts are UTF-8 bytes; matches never cross documents. A window (a start with ``min_bytes`` bytes behind it) is
repeated when its longest previous factor, the longest string there that also starts
earlier, reaches ``min_bytes``, or when it is the source of such a later one. Earlier matches alone give the later
copies, for removal that keeps the first; both give all copies.

One suffix order over all texts would be one global sort, so it is dealt out by content.
The least hash of ``GRAM``-byte strings within a window (its anchor) is the same wherever the window occurs,
hence equal windows meet under one anchor. Consecutive windows with one anchor form a piece:

1. anchors are counted; those that occur once in all documents are done with;
2. the pieces of the others are counted, equal rows as one; a piece that occurs again is repeated as a whole;
3. the differing pieces of an anchor (edges of repeated passages) are dealt out in batches of
   bounded size. A batch sorts the suffixes of their bytes by prefix doubling, up to ``min_bytes``; in that order
   the nearest neighbours of a window with smaller positions give its longest previous factor;
   an anchor with more than ``HOT_PIECES`` pieces is settled by counting 64-bit prints of single windows instead;
4. each document gets its repeated pieces, and loses the bytes that they cover.

An empty table gives an empty one. A very long text is cut into chunks of ``CHUNK`` windows.
Null and empty texts have no bytes and lose none. Repeated rows are documents of their own:
each is a copy of the other (with ``keep_first`` both count as the first). Null ids are carried
through. Other columns are kept by ``without_repeats`` and left out of the report.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import bitmap, bitmap_bit, bitmap_rows, bitmap_word, free_name, in_bitmap, slices, stored
from footfall.llm.words import mix, to_bytes

MIN_BYTES = 200
GRAM = 32
#: Windows of a text worked on at a time.
CHUNK = 1 << 22
PIECES_IN_BATCH = 1 << 12
HOT_PIECES = 50_000

_PLACE_BITS = np.uint64(24)
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240502).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < length:
            size = max(length, 1 << 14)
            up, down = np.full(size, np.uint64(_BASE)), np.full(size, np.uint64(pow(_BASE, -1, 1 << 64)))
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:length], self.down[:length]


_POWERS = _Powers()


class Prints:
    """Fingerprints of substrings of one chunk of bytes."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _POWERS.of(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[raw] * up[:-1], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Of each substring of ``length`` bytes."""
        return mix((self.sums[length:] - self.sums[:-length]) * self.down[: len(self.sums) - length])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of its least value, the first of equals."""
    places = np.arange(len(values), dtype=np.uint64)
    keys = (values >> _PLACE_BITS << _PLACE_BITS) | places
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    least = np.minimum(after[:count], before[width - 1 : width - 1 + count])
    return (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def pieces(raw: bytes, min_bytes: int = MIN_BYTES):
    """``anchor, piece, start, run`` arrays: runs of windows with one anchor, in order."""
    found = []
    for offset in range(0, max(0, len(raw) - min_bytes + 1), CHUNK):
        chunk = np.frombuffer(raw, np.uint8, min(CHUNK + min_bytes - 1, len(raw) - offset), offset)
        prints = Prints(chunk)
        grams = prints.all(GRAM)
        least = _leftmost_minima(grams, min_bytes - GRAM + 1)
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        run = np.diff(np.append(start, len(least)))
        anchor = grams[least[start]]
        piece = prints.between(start, start + run + min_bytes - 1) + mix((least[start] - start).astype(np.uint64))
        found.append((anchor.view(np.int64), piece.view(np.int64), start + offset, run))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(column) for column in zip(*found))


def _rows(docs: DataFrame) -> DataFrame:
    """``row, text``: a hash of id and text names a row."""
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")


def _anchor_counts(docs: DataFrame, min_bytes: int) -> DataFrame:
    def counted(batches):
        for batch in slices(batches):
            anchors, counts = [], []
            for text in batch.column("text").to_pylist():
                anchor, *_ = pieces(to_bytes(text), min_bytes)
                distinct, times = np.unique(anchor, return_counts=True)
                anchors.append(distinct)
                counts.append(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_joined(anchors)), pa.array(_joined(counts))], names=["anchor", "n"]
            )

    return docs.select("text").mapInArrow(counted, "anchor bigint, n bigint")


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, np.int64)


def _live_pieces(docs: DataFrame, live: np.ndarray, min_bytes: int) -> DataFrame:
    """``row, anchor, piece, run, starts`` for distinct pieces of a document whose anchor may occur again."""

    def found(batches):
        for batch in slices(batches):
            columns = [[] for _ in range(5)]
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                anchor, piece, start, run = pieces(to_bytes(text), min_bytes)
                keep = in_bitmap(live, anchor)
                if not keep.any():
                    continue
                anchor, piece, start, run = anchor[keep], piece[keep], start[keep], run[keep]
                order = np.lexsort((start, piece, anchor))
                anchor, piece, start, run = anchor[order], piece[order], start[order], run[order]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))
                first = np.flatnonzero(new)
                columns[0].append(np.full(len(first), row))
                columns[1].append(anchor[first])
                columns[2].append(piece[first])
                columns[3].append(run[first])
                columns[4] += np.split(start.astype(np.int32), first[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(_joined(c), pa.int64()) for c in columns[:4]),
                    pa.array(columns[4], pa.list_(pa.int32())),
                ],
                names=["row", "anchor", "piece", "run", "starts"],
            )

    return _rows(docs).mapInArrow(
        found, "row bigint, anchor bigint, piece bigint, run bigint, starts array<int>"
    )


#: Odd, and small enough that its product with a place in a text is a 64-bit number.
_PLACE_FACTOR = 2654435761


def _contents(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """``row, start, run, content`` of the wanted ``(row, start, run)`` and, by chance, of a few others."""
    rows = bitmap(wanted.select("row"), "row")
    place = F.col("row").bitwiseXOR(F.col("start") * F.lit(_PLACE_FACTOR))
    places = bitmap(wanted.select(place.alias("place")), "place")

    def candidates(batches):
        for batch in slices(batches):
            batch = batch.filter(pa.array(in_bitmap(rows, batch.column("row").to_numpy())))
            columns = [[], [], [], []]
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                raw = to_bytes(text)
                _, _, start, run = pieces(raw, min_bytes)
                keep = in_bitmap(places, np.int64(row) ^ (start * _PLACE_FACTOR))
                for s, r in zip(start[keep].tolist(), run[keep].tolist()):
                    columns[0].append(row)
                    columns[1].append(s)
                    columns[2].append(r)
                    columns[3].append(raw[s : s + r + min_bytes - 1])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["row", "start", "run", "content"],
            )

    return _rows(docs).mapInArrow(
        candidates, "row bigint, start bigint, run bigint, content binary"
    )


def _dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    ranks = np.empty(len(keys), np.uint64)
    ranks[order] = np.append(np.zeros(min(1, len(keys)), bool), sorted_[1:] != sorted_[:-1]).cumsum()
    return ranks


class SuffixOrder:
    """Ranks of all suffixes of some bytes by their first 8, 16, 32 ... bytes, at most ``depth``."""

    def __init__(self, raw: np.ndarray, depth: int):
        self.raw, self.depth = np.concatenate([raw, np.zeros(depth, np.uint8)]), depth
        word = np.zeros(len(raw), np.uint64)
        for k in range(8):
            word = word << np.uint64(8) | self.raw[k : k + len(raw)]
        self.levels = [(8, _dense(word))]
        while 2 * self.levels[-1][0] <= depth:
            length, ranks = self.levels[-1]
            self.levels.append((2 * length, self._doubled(ranks, length)))

    def _doubled(self, ranks: np.ndarray, shift: int) -> np.ndarray:
        """Ranks by twice as many bytes."""
        if len(ranks) >= 1 << 21:
            return _dense(self._pair(ranks, shift))
        # both ranks and the place fit into one number, so a plain sort orders the places
        bits, place = np.uint64(21), np.arange(len(ranks), dtype=np.uint64)
        keys = ranks << bits
        keys[: max(0, len(ranks) - shift)] |= ranks[shift:]
        keys = np.sort(keys << bits | place)
        place, keys = (keys & np.uint64((1 << 21) - 1)).astype(np.int64), keys >> bits
        doubled = np.empty(len(ranks), np.uint64)
        doubled[place] = np.append(np.zeros(min(1, len(keys)), bool), keys[1:] != keys[:-1]).cumsum()
        return doubled

    @staticmethod
    def _pair(ranks: np.ndarray, shift: int) -> np.ndarray:
        behind = np.zeros(len(ranks), np.uint64)
        behind[: max(0, len(ranks) - shift)] = ranks[shift:]
        return ranks << np.uint64(32) | behind

    def sorted(self, windows: np.ndarray) -> np.ndarray:
        """Numbers of the ``windows`` in the order of their first ``depth`` bytes, equal ones by position."""
        length, ranks = self.levels[-1]
        return np.argsort(self._pair(ranks, self.depth - length)[windows], kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The longest common prefix of pairs of suffixes, ``depth`` at most."""
        found = np.zeros(len(a), np.int64)
        for length, ranks in reversed(self.levels):
            padded = np.concatenate([ranks, np.zeros(self.depth, np.uint64)])
            fits = found + length <= self.depth
            found += length * (fits & (padded[a + found] == padded[b + found]))
        same = np.ones(len(a), bool)
        for _ in range(7):
            same &= (found < self.depth) & (self.raw[np.minimum(a + found, len(self.raw) - 1)] == self.raw[np.minimum(b + found, len(self.raw) - 1)])
            found += same
        return found


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest place before it with a smaller value, -1 if there is none.

    All places jump at once: whatever lies between a place and its candidate is greater than its value, so from a
    candidate that is greater too it may go on to the candidate's own.
    """
    found = np.arange(-1, len(values) - 1)
    active = np.arange(len(values))
    while len(active := active[(found[active] >= 0) & (values[found[active]] > values[active])]):
        found[active] = found[found[active]]
    return found


def longest_previous_factors(raw: np.ndarray, windows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the rising ``windows``, its longest previous factor and the number of the window where that starts.

    Factors are compared up to ``depth`` bytes; there are so many behind each window. -1 is the source of none.
    """
    suffixes = SuffixOrder(raw, depth)
    order = suffixes.sorted(windows)
    best, source = np.zeros(len(windows), np.int64), np.full(len(windows), -1)
    places = previous_smaller(order), len(order) - 1 - previous_smaller(order[::-1])[::-1]
    for near in places:
        has = np.flatnonzero((near >= 0) & (near < len(order)))
        own, other = order[has], order[near[has]]
        common = suffixes.common(windows[own], windows[other])
        longer = common > best[own]
        best[own[longer]], source[own[longer]] = common[longer], other[longer]
    return best, source


def repeated_windows(raw: np.ndarray, windows: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the rising ``windows``, whether it also occurs earlier and whether it does later."""
    factors, source = longest_previous_factors(raw, windows, min_bytes)
    earlier = factors >= min_bytes
    later = np.zeros(len(windows), bool)
    later[source[earlier]] = True
    return earlier, later


def _window_prints(content: bytes, anchor: int, min_bytes: int) -> np.ndarray:
    prints = Prints(np.frombuffer(content, np.uint8)).all(min_bytes)
    return prints ^ mix(np.array([anchor]).astype(np.uint64))


def _ordered_batch(min_bytes: int):
    def marks(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "start"], kind="stable")
        sizes = np.array([len(content) for content in rows.content])
        runs = sizes - min_bytes + 1
        begins = sizes.cumsum() - sizes
        windows = np.repeat(begins - (runs.cumsum() - runs), runs) + np.arange(runs.sum())
        raw = np.frombuffer(b"".join(rows.content), np.uint8)
        earlier, later = repeated_windows(raw, windows, min_bytes)
        cuts = runs.cumsum()[:-1]
        return pd.DataFrame(
            {
                "anchor": rows.anchor.to_numpy(),
                "piece": rows.piece.to_numpy(),
                "earlier": [np.packbits(x).tobytes() for x in np.split(earlier, cuts)],
                "later": [np.packbits(x).tobytes() for x in np.split(later, cuts)],
            }
        )

    return marks


def _by_windows(contents: DataFrame, min_bytes: int) -> DataFrame:
    """The marks of pieces of very frequent anchors, from one row for each window."""

    def windows(batches):
        for batch in batches:
            for anchor, piece, row, start, content in zip(
                *(batch.column(c).to_pylist() for c in ("anchor", "piece", "row", "start", "content"))
            ):
                keys = _window_prints(content, anchor, min_bytes).view(np.int64)
                count = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(count, x)) for x in (anchor, piece, row, start)),
                        pa.array(np.arange(count)),
                        pa.array(keys),
                    ],
                    names=["anchor", "piece", "row", "start", "at", "key"],
                )

    rows = contents.mapInArrow(
        windows, "anchor bigint, piece bigint, row bigint, start bigint, at bigint, key bigint"
    )
    first = F.struct("row", "start", "at")
    ends = rows.groupBy("key").agg(F.min(first).alias("lo"), F.max(first).alias("hi")).where("lo != hi")
    seen = rows.join(ends, "key").select(
        "anchor", "piece", "at", (first != F.col("lo")).alias("e"), (first != F.col("hi")).alias("l")
    )

    def packed(flag):
        bits = F.sort_array(F.collect_list(F.when(F.col(flag), F.col("at").cast("int"))))
        return bits.alias(flag)

    def pack(batches):
        for batch in batches:
            columns = []
            for name in ("e", "l"):
                found = []
                for places in batch.column(name).to_pylist():
                    bits = np.zeros(max(places, default=0) + 1, bool)
                    bits[places] = True
                    found.append(np.packbits(bits).tobytes())
                columns.append(pa.array(found, pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("piece"), *columns],
                names=["anchor", "piece", "earlier", "later"],
            )

    lists = seen.groupBy("anchor", "piece").agg(packed("e"), packed("l"))
    return lists.mapInArrow(pack, "anchor bigint, piece bigint, earlier binary, later binary")


def _marks(docs: DataFrame, live: DataFrame, min_bytes: int) -> DataFrame:
    """``anchor, piece, n, row1, start1, earlier, later`` for each distinct piece of live anchors."""
    groups = stored(
        live.groupBy("anchor", "piece").agg(
            F.sum(F.size("starts") * F.col("copies")).alias("n"),
            F.min("row").alias("row1"),
            F.min_by(F.col("starts")[0], "row").cast("bigint").alias("start1"),
            F.min("run").alias("run"),
        )
    )
    several = groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    edges = stored(
        groups.join(several, "anchor").select(
            "anchor", "piece", "k", "run", F.col("row1").alias("row"), F.col("start1").alias("start")
        )
    )
    contents = edges.join(_contents(docs, edges, min_bytes), ["row", "start", "run"])
    batches = max(1, edges.count() // PIECES_IN_BATCH)
    batch = F.pmod(F.xxhash64("anchor"), F.lit(batches))
    usual = (
        contents.where(f"k <= {HOT_PIECES}")
        .select(batch.alias("batch"), "anchor", "piece", "row", "start", "content")
        .dropDuplicates(["anchor", "piece"])
        .groupBy("batch")
        .applyInPandas(_ordered_batch(min_bytes), "anchor bigint, piece bigint, earlier binary, later binary")
    )
    hot = _by_windows(contents.where(f"k > {HOT_PIECES}").dropDuplicates(["anchor", "piece"]), min_bytes)
    return groups.join(usual.unionByName(hot), ["anchor", "piece"], "left")


def repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = True) -> DataFrame:
    """``row, found`` for documents with repeated windows: runs, their starts and the windows marked."""
    again = _anchor_counts(docs, min_bytes).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    # rows that are repeated whole have the same pieces: they are one row with a count
    live = _live_pieces(docs, bitmap(again, "anchor"), min_bytes).groupBy("row", "anchor", "piece", "run", "starts")
    live = stored(live.agg(F.count(F.lit(1)).alias("copies")))
    marks = stored(_marks(docs, live, min_bytes).where("n > 1 or earlier is not null"))
    joined = live.join(marks.drop("run"), ["anchor", "piece"])
    first = (F.col("row") == F.col("row1")).alias("first")
    return joined.groupBy("row").agg(
        F.collect_list(F.struct("run", "starts", "n", first, "earlier", "later")).alias("found")
    )


def _bits(packed: bytes | None, run: int) -> np.ndarray:
    marked = np.zeros(run, bool)
    bits = np.unpackbits(np.frombuffer(packed or b"", np.uint8))[:run]
    marked[: len(bits)] = bits
    return marked


def removed_ranges(found: pa.ListArray, min_bytes: int, keep_first: bool):
    """``document, start, end`` arrays of byte ranges to remove; documents by their place in ``found``.

    A piece that occurs again, or is not the first occurrence, goes as a whole; of the other
    pieces only the windows marked.
    """
    pieces_ = found.flatten()
    document = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
    run, n = (pieces_.field(name).to_numpy() for name in ("run", "n"))
    first = pieces_.field("first").to_numpy(zero_copy_only=False)
    starts = pieces_.field("starts")
    times = np.diff(starts.offsets.to_numpy())
    owner = np.repeat(np.arange(len(run)), times)
    start = starts.flatten().to_numpy().astype(np.int64)
    earliest = np.zeros(len(owner), bool)
    earliest[np.cumsum(times) - times] = True
    whole = ((n > 1) & (not keep_first))[owner] | ~(first[owner] & earliest)
    ranges = [(document[owner[whole]], start[whole], start[whole] + run[owner[whole]] + min_bytes - 1)]
    earlier, later = pieces_.field("earlier"), pieces_.field("later")
    partly = np.flatnonzero(~whole & earlier.is_valid().to_numpy(zero_copy_only=False)[owner])
    for i in partly.tolist():
        piece = int(owner[i])
        marked = _bits(earlier[piece].as_py(), int(run[piece]))
        if not keep_first:
            marked |= _bits(later[piece].as_py(), int(run[piece]))
        at = start[i] + np.flatnonzero(marked)
        ranges.append((np.full(len(at), document[piece]), at, at + min_bytes))
    return tuple(np.concatenate(column) for column in zip(*ranges))


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = True) -> DataFrame:
    """``docs`` with two more columns: ``_kept`` (bytes that stay) and ``_spans`` (removed runs).

    The two take the place of columns of the same names.
    """
    docs = docs.drop("_kept", "_spans")
    found = stored(repeats(docs, min_bytes, keep_first))
    own_row, own_found = free_name(docs, "_row"), free_name(docs, "_found")
    rows = docs.withColumn(own_row, F.xxhash64("doc_id", "text"))
    # texts without repeats skip the shuffle: a filter of fixed size tells most of them
    words = F.broadcast(bitmap_rows(found, "row").toDF("_word", "_mask"))
    in_filter = (bitmap_word(F.col(own_row)) == F.col("_word")) & bitmap_bit(F.col(own_row), F.col("_mask"))
    joined = (
        rows.join(words, in_filter, "left_semi")
        .join(found.toDF(own_row, own_found), own_row, "left")
        .unionByName(rows.join(words, in_filter, "left_anti"), allowMissingColumns=True)
    )

    def cut(batches):
        for batch in slices(batches):
            texts = [np.frombuffer(to_bytes(text), np.uint8) for text in batch.column("text").to_pylist()]
            column = batch.column(own_found)
            at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            document, start, end = removed_ranges(column.drop_null(), min_bytes, keep_first)
            order = np.argsort(document, kind="stable")
            start, end = start[order], end[order]
            bounds = np.searchsorted(document[order], np.arange(len(at) + 1))
            kept, spans = [raw.tobytes() for raw in texts], [0] * len(texts)
            for i, row in enumerate(at.tolist()):
                raw, own = texts[row], slice(bounds[i], bounds[i + 1])
                depth = np.bincount(start[own], minlength=len(raw) + 1) - np.bincount(end[own], minlength=len(raw) + 1)
                gone = depth.cumsum()[: len(raw)] > 0
                kept[row] = raw[~gone].tobytes()
                spans[row] = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            rest = batch.select([c for c in batch.schema.names if c not in (own_row, own_found)])
            yield rest.append_column("_kept", pa.array(kept, pa.binary())).append_column(
                "_spans", pa.array(spans, pa.int64())
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(cut, f"{types}, `_kept` binary, `_spans` bigint")


def repeat_report(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return without_repeats(docs, min_bytes, keep_first).select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("_kept")).alias("n_removed"),
        F.col("_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )
