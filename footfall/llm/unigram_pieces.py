"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their scores come from a public model file (of a BPE model, whose scores are ranks: tokenizers are not trained here). A text gets a
white-space marker in front, and one in place of each space; among all ways to cut it into pieces the one
with the greatest sum of scores is taken (of equal ones, that whose last differing piece is
longest). Characters that no piece covers are cut into byte pieces. Decoding
joins the pieces, puts bytes together again and turns markers back into spaces: it gives
the text exactly, also where the text holds the marker itself, which is then cut into bytes.

No piece but runs of markers holds a marker behind another character, so a text is cut in front of
each marker that follows another character, and the parts are independent. Parts are
encoded together, step by step as arrays, and remembered within bounds.

Null and empty texts have no pieces and decode to the empty text. Repeated rows get equal
results; null ids are carried through; other columns are left out of the report and kept by ``with_pieces``. An empty table
gives an empty one. A very long text without spaces is one part, as long as it is.
"""

from __future__ import annotations

import functools
import itertools
import re
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import slices
from footfall.llm.words import to_bytes

MARK = "▁"
#: A byte costs more than any piece, so bytes only stand where no piece does.
BYTE_SCORE = -1e6
#: Parts of a text remembered by one worker.
CACHED_PARTS = 1 << 17
#: Characters of the parts remembered.
CACHED_CHARACTERS = 1 << 21
#: Characters of texts, and of parts, encoded at a time.
BATCH_CHARACTERS = 1 << 20
#: Longer parts are encoded one by one: few have their length, and arrays need many to pay.
LONG_PART = 64
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class DoubleArrayTrie:
    """Keys of small integer symbols: ``base[node] + symbol`` is the child if ``check`` there is the node."""

    def __init__(self, keys: list[tuple[list[int], int]]):
        self.base = np.zeros(1 << 16, np.int32)
        self.check = np.full(1 << 16, -1, np.int32)
        self.value = np.full(1 << 16, -1, np.int32)
        self.check[0] = 0
        root: dict = {}
        for key, value in keys:
            node = root
            for symbol in key:
                node = node.setdefault(symbol, {})
            node[-1] = value
        free_from = 1
        pending = [(0, root)]
        while pending:
            at, node = pending.pop()
            symbols = sorted(s for s in node if s >= 0)
            if -1 in node:
                self.value[at] = node[-1]
            if not symbols:
                continue
            base = max(1, free_from - symbols[0])
            while True:
                self._reserve(base + symbols[-1] + 1)
                if all(self.check[base + s] < 0 for s in symbols):
                    break
                base += 1
            self.base[at] = base
            for s in symbols:
                self.check[base + s] = at
                pending.append((base + s, node[s]))
            while free_from < len(self.check) and self.check[free_from] >= 0:
                free_from += 1

    def _reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))
            self.value = np.append(self.value, np.full(more, -1, np.int32))

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of nodes, -1 where there is none; negative nodes and symbols have none."""
        to = self.base[nodes] + symbols
        ok = (nodes >= 0) & (symbols >= 0) & (to < len(self.check)) & (self.base[nodes] > 0)
        to = np.where(ok, to, 0)
        return np.where(ok & (self.check[to] == nodes), to, -1)


@dataclass
class Pieces:
    """A piece table: names, scores, the trie over characters, and the ids of byte pieces."""

    names: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    symbols: dict[str, int]
    trie: DoubleArrayTrie
    longest: int

    def encode_parts(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The parts in another order, their ids one after another, and how many each has.

        Parts of like lengths are worked on together.
        """
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(sizes, kind="stable")
        ordered = sizes[order]
        usual = int((sizes <= LONG_PART).sum())
        done: list[str] = []
        ids, counts = [], []
        alone = [parts[i] for i in order[usual:].tolist()]
        at = 0
        while at < usual:
            longest = min(LONG_PART, ordered[at] + 3)
            end = int(np.searchsorted(ordered, longest, "right"))
            end = min(end, at + max(1, BATCH_CHARACTERS // int(longest)))
            group = [parts[i] for i in order[at:end].tolist()]
            found, used, plain = self._viterbi(group)
            ids.append(found)
            counts.append(used)
            done += [part for part, ok in zip(group, plain) if ok]
            alone += [part for part, ok in zip(group, plain) if not ok]
            at = end
        single = [self._viterbi_alone(part) for part in alone]
        return (
            done + alone,
            np.concatenate([NO_IDS, *ids, *single]).astype(np.int32),
            np.concatenate([np.empty(0, np.int64), *counts, [len(x) for x in single]]).astype(np.int64),
        )

    def _codes(self, parts: list[str], sizes: np.ndarray, height: int) -> np.ndarray:
        """The symbols of the characters, a column for each part, -1 behind its end."""
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        column = np.repeat(np.arange(len(parts)), sizes)
        row = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes = np.full((height, len(parts)), -1, np.int32)
        codes[row, column] = self.symbol_table[points]
        return codes

    @functools.cached_property
    def symbol_table(self) -> np.ndarray:
        table = np.full(0x110000, -1, np.int32)
        for character, symbol in self.symbols.items():
            table[ord(character)] = symbol
        return table

    def _viterbi(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        count, width = len(parts), int(sizes.max())
        codes = self._codes(parts, sizes, width + self.longest)
        best = np.full((width + 1, count), -np.inf)
        best[0] = 0
        came = np.zeros((width + 1, count), np.int32)
        piece = np.full((width + 1, count), -1, np.int32)
        everyone = np.arange(count)
        for start in range(width):
            alive = everyone[sizes > start]
            score = best[start, alive]
            reach = score + BYTE_SCORE
            better = reach > best[start + 1, alive]
            rows = alive[better]
            best[start + 1, rows], came[start + 1, rows], piece[start + 1, rows] = reach[better], start, -1
            nodes = np.zeros(len(alive), np.int64)
            for length in range(1, self.longest + 1):
                nodes = self.trie.step(nodes, codes[start + length - 1, alive])
                keep = nodes >= 0
                alive, nodes, score = alive[keep], nodes[keep], score[keep]
                if not len(alive):
                    break
                ids = self.trie.value[nodes]
                is_piece = ids >= 0
                rows, found = alive[is_piece], ids[is_piece]
                reach = score[is_piece] + self.scores[found]
                better = reach > best[start + length, rows]
                rows = rows[better]
                best[start + length, rows] = reach[better]
                came[start + length, rows] = start
                piece[start + length, rows] = found[better]
        return self._traced(sizes, came, piece)

    def _traced(self, sizes, came, piece) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """The best ways, walked from all ends at once; and which parts need no bytes, for only these count."""
        everyone, end, steps = np.arange(len(sizes)), sizes.copy(), []
        in_bytes = np.zeros(len(sizes), bool)
        while end.any():
            active = end > 0
            ids = np.where(active, piece[end, everyone], NOTHING)
            in_bytes |= active & (ids == -1)
            steps.append(ids)
            end = np.where(active, came[end, everyone], 0)
        table = np.stack(steps[::-1], axis=1)[~in_bytes]
        used = table != NOTHING
        return table[used], used.sum(axis=1), (~in_bytes).tolist()

    def _viterbi_alone(self, part: str) -> np.ndarray:
        base, check, value, scores = self.plain
        codes = [self.symbols.get(c, -1) for c in part]
        best = [-np.inf] * (len(part) + 1)
        best[0] = 0.0
        came, piece = np.zeros(len(part) + 1, np.int64), np.full(len(part) + 1, -1)
        for start in range(len(part)):
            score = best[start]
            if score + BYTE_SCORE > best[start + 1]:
                best[start + 1], came[start + 1], piece[start + 1] = score + BYTE_SCORE, start, -1
            node = 0
            for end in range(start, min(len(part), start + self.longest)):
                to = base[node] + codes[end]
                if codes[end] < 0 or not base[node] or to >= len(check) or check[to] != node:
                    break
                node = to
                if value[node] >= 0 and score + scores[value[node]] > best[end + 1]:
                    best[end + 1] = score + scores[value[node]]
                    came[end + 1], piece[end + 1] = start, value[node]
        return self._trace(part, came, piece)

    @functools.cached_property
    def plain(self) -> tuple[list, list, list, list]:
        """The trie's arrays and the scores as lists, for one part at a time."""
        return self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist(), self.scores.tolist()

    def _trace(self, part: str, came: np.ndarray, piece: np.ndarray) -> np.ndarray:
        ids: list[int] = []
        end = len(part)
        while end:
            start = int(came[end])
            if piece[end] >= 0:
                ids.append(int(piece[end]))
            else:
                ids += [int(self.byte_ids[b]) for b in reversed(_plain(part[start:end]))]
            end = start
        return np.array(ids[::-1], np.int32)

    @functools.cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that pieces stand for, one after another, with starts and lengths by id."""
        raw = [to_bytes(name.replace(MARK, " ")) for name in self.names]
        for byte, i in enumerate(self.byte_ids):
            raw[i] = bytes([byte])
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths, lengths

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts whose ids lie between successive ``offsets``."""
        spelled, starts, lengths = self.spelled
        size = lengths[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = spelled[np.repeat(starts[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        cuts = ends[offsets].tolist()
        # the marker in front of each text is no part of it
        return [out[a + 1 : b].decode("utf-8", "surrogatepass") for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([0, len(ids)]))[0]

    @functools.cached_property
    def byte_of(self) -> dict[int, int]:
        return {int(i): byte for byte, i in enumerate(self.byte_ids)}

    @functools.cached_property
    def is_byte(self) -> np.ndarray:
        found = np.zeros(len(self.names), bool)
        found[self.byte_ids] = True
        return found


NO_IDS = np.empty(0, np.int32)
#: Where a shorter part has no further piece.
NOTHING = -2
#: Stands for a marker of the text itself while the text is cut; it is no character of a text.
_OWN_MARK = "\udfff"


def _plain(characters: str) -> bytes:
    return to_bytes(characters.replace(_OWN_MARK, MARK))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """The pieces of a model file of the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(count)]
    byte_ids = np.zeros(256, np.int64)
    usual = []
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            usual.append(i)
    frequency: dict[str, int] = {}
    for i in usual:
        for c in names[i]:
            frequency[c] = frequency.get(c, 0) + 1
    symbols = {c: n for n, c in enumerate(sorted(frequency, key=lambda c: (-frequency[c], c)))}
    trie = DoubleArrayTrie([([symbols[c] for c in names[i]], i) for i in usual])
    # a marker run can have a score that no sum of others reaches; bytes stay dearer
    scores = np.maximum(np.array([model.get_score(i) for i in range(count)]), BYTE_SCORE / 10)
    return Pieces(names, scores, byte_ids, symbols, trie, max(len(names[i]) for i in usual))


class Encoder:
    """Encodes texts with a bounded memory of their parts, whose ids stand in one array."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = NO_IDS
        self.ends = np.zeros(1, np.int64)
        self.characters = 0

    @staticmethod
    def parts(text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)
        return _PARTS.findall(marked)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the offsets between texts."""
        split = [self.parts(text) for text in texts]
        if len(self.number) > CACHED_PARTS or self.characters > CACHED_CHARACTERS:
            self._forget()
        new = list(set().union(*split).difference(self.number))
        if new:
            ordered, found, sizes = self.pieces.encode_parts(new)
            self.number.update(zip(ordered, range(len(self.number), len(self.number) + len(new))))
            self.ids = np.concatenate([self.ids, found])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.characters += sum(map(len, new))
        counts = [len(parts) for parts in split]
        every = itertools.chain.from_iterable(split)
        used = np.fromiter(map(self.number.__getitem__, every), np.int64, sum(counts))
        starts, sizes = self.ends[used], self.ends[used + 1] - self.ends[used]
        to = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(starts - to[:-1], sizes) + np.arange(to[-1])]
        if self.characters > CACHED_CHARACTERS:
            self._forget()  # long parts are not kept for the next task
        return ids, to[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, offsets = self.encode_all(texts)
        return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(load(path))


def _of_bounded_size(texts: list[str]):
    """Ranges of texts of about ``BATCH_CHARACTERS`` together."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARACTERS:
            yield start, at
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def with_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with ``piece_ids``, ``n_byte_pieces`` (byte pieces among them) and ``decoded``.

    New columns of a name that ``docs`` has already take its place.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    added = ("piece_ids", "n_byte_pieces", "decoded")
    kept = [f for f in docs.schema if f.name not in added]

    def encode(batches):
        worker = encoder(path)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for start, end in _of_bounded_size(texts):
                ids, offsets = worker.encode_all(texts[start:end])
                in_bytes = np.concatenate([[0], np.cumsum(worker.pieces.is_byte[ids])])
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(f.name) for f in kept),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(np.diff(in_bytes[offsets]), pa.int64()),
                        pa.array(worker.pieces.decode_all(ids, offsets), pa.string()),
                    ],
                    names=[*(f.name for f in kept), *added],
                )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    columns = [F.col(f"`{f.name}`") for f in kept]
    return docs.select(*columns).mapInArrow(
        encode, f"{types}, piece_ids array<int>, n_byte_pieces bigint, decoded string"
    )


def piece_report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_pieces, n_byte_pieces, pieces_sha256, exact`` for each row of ``docs``.

    ``exact``: whether decoding gave the text back.
    """
    found = with_pieces(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.size("piece_ids").cast("bigint").alias("n_pieces"),
        "n_byte_pieces",
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("pieces_sha256"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("exact"),
    )
