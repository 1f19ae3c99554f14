"""Token counts of whole texts, as a public tokenizer gives them.

Texts go through Arrow batches; only lengths come back. A text is split at safe
boundaries: a single space between two characters that are not white space always
starts a new piece of the byte-level pattern, so the counts of the parts add up to
that of the text. A part without such spaces is cut further where it is longer than ``LONG_PART``: between a letter or digit and
a sign, which the pattern never joins. Short parts seen before are remembered, up to ``CACHED_BYTES``; new ones are encoded in
batches of about ``BATCH_BYTES`` of UTF-8, so one long text takes no more memory than many
short ones. A run of letters alone has no safe boundary and is encoded whole, however long.

An empty table gives an empty one. Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each;
a null id stays null; other columns are left out.
"""

from __future__ import annotations

import functools
import os
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.tables import slices
from footfall.llm.words import to_bytes

BATCH_BYTES = 1 << 20
CACHED_BYTES = 16 << 20
#: Characters; longer parts are cut, and not remembered.
LONG_PART = 256
#: What an entry takes beside its text.
_ENTRY_BYTES = 120
_OTHER_SPACE = re.compile(r"[^\S ]")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_BEFORE_SIGN = re.compile(r"(?<=[^\W_])(?=[^\w\s])")


def safe_parts(text: str) -> list[str]:
    """Parts whose counts add up; each but the first stands for itself after a space."""
    padded = f"x{text}x"
    unsafe = "  " in text or any(
        padded[m.start()] == " " or padded[m.start() + 2] == " " for m in _OTHER_SPACE.finditer(text)
    )
    unsafe = unsafe or text.startswith(" ") or text.endswith(" ")
    return _SAFE_SPACE.split(text) if unsafe else text.split(" ")


def utf8_size(text: str) -> int:
    return len(text) if text.isascii() else len(to_bytes(text))


def cut_long(part: str) -> list[str]:
    """Pieces of a long part, of about ``LONG_PART`` characters where it has boundaries."""
    pieces, start = [], 0
    for boundary in _BEFORE_SIGN.finditer(part):
        if boundary.start() - start >= LONG_PART:
            pieces.append(part[start : boundary.start()])
            start = boundary.start()
    return [*pieces, part[start:]]


def bounded_batches(parts: list[str], limit: int):
    """Lists of consecutive parts of about ``limit`` bytes of UTF-8 each."""
    batch, size = [], 0
    for part in parts:
        own = utf8_size(part)
        if batch and size + own > limit:
            yield batch
            batch, size = [], 0
        batch.append(part)
        size += own
    if batch:
        yield batch


class PartCounter:
    """Lengths of encoded parts, with a bounded memory of parts seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.after_space: dict[str, int] = {}
        self.cached = 0
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def lengths(self, texts: list[str]) -> list[int]:
        found: list[int] = []
        for batch in bounded_batches(texts, BATCH_BYTES):
            found += map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))
        return found

    def counts(self, texts: list[str]) -> list[int]:
        result: list[int] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += utf8_size(text)
            if size >= BATCH_BYTES:
                result += self._of(group)
                group, size = [], 0
        return result + self._of(group)

    def _of(self, texts: list[str]) -> list[int]:
        split = [safe_parts(text) for text in texts]
        owners: list[int] = []
        alone: list[str] = []
        for at, parts in enumerate(split):
            first = parts.pop(0)
            long = [f" {part}" for part in parts if len(part) > LONG_PART]
            if long:
                split[at] = [part for part in parts if len(part) <= LONG_PART]
            for part in (first, *long):
                # a special string in the text must stay in one piece
                whole = len(part) <= LONG_PART or any(token in part for token in self.added)
                pieces = [part] if whole else cut_long(part)
                alone += pieces
                owners += [at] * len(pieces)
        totals = [0] * len(texts)
        for at, n in zip(owners, self.lengths(alone)):
            totals[at] += n
        if self.cached > CACHED_BYTES:
            self.after_space, self.cached = {}, 0
        new = list(set().union(*split).difference(self.after_space))
        self.after_space.update(zip(new, self.lengths([f" {part}" for part in new])))
        self.cached += sum(_ENTRY_BYTES + len(part) for part in new)
        known = self.after_space.__getitem__
        return [total + sum(map(known, parts)) for total, parts in zip(totals, split)]


@functools.lru_cache(maxsize=2)
def part_counter(path: str) -> PartCounter:
    return PartCounter(path)


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs (doc_id, text)``.

    ``tokenizer``: a byte-level BPE file of the tokenizers library, at the same
    path on all executors.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def count(batches):
        counter = part_counter(path)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            tokens = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(to_bytes(text)) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
