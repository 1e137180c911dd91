"""Packing of documents into sequences by balanced Karmarkar-Karp differencing.

A document becomes its token ids and a closing id. Whole windows of ``capacity`` ids are sequences of
their own; the rest of a document is cut into pieces of at most ``grain`` ids. The pieces of a group
are dealt, by falling size, into partial partitions of one piece for each window. The two partial
partitions with the widest imbalance are merged, the fullest window of one with the emptiest of the
other, until one partition is left: its windows are nearly equal. Should the fullest exceed the
capacity, the group is dealt anew with more windows.

Groups are runs of documents inside a Spark partition (about ``group`` windows of rests), so nothing
is shuffled, memory stays bounded, and a lost executor only repeats its partitions. A partition
wastes less than a window by its last, smaller group. Sequence ids are numbers within the partition,
with the partition's number in the high bits.

Cases: a null or empty text is the closing id alone. Equal rows are packed each for itself. Extra
columns are ignored. A text of any length is packed whole. An empty table gives no pieces.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeline.llm.tokens import LATIN_LETTERS, LATIN_NUMBERS, NOT_LATIN, byte_symbols

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)

_WORDS = re.compile(
    rf" ?[{LATIN_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{LATIN_NUMBERS}]+"
    rf"| ?[^\s{LATIN_LETTERS}{LATIN_NUMBERS}]+|\s+(?!\S)|\s+"
)
#: No pre-token goes on from a visible character to a space, so a text may be cut there.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_CUT_CHARS = 500_000
_REMEMBERED = 400_000


class _WordIds(dict):
    """Pre-token -> its ids as little-endian 32-bit integers; filled by the library's model."""

    def __init__(self, library):
        super().__init__()
        self.model = library.model
        self.symbols = {b: c for b, c in byte_symbols().items()}

    def __missing__(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin1").translate(self.symbols))
        self[word] = ids = np.array([t.id for t in tokens], "<u4").tobytes()
        return ids


class TextIds:
    """Token ids of texts as the ``tokenizers`` library gives them, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level vocabulary without a normalizer is expected")
        self.library = Tokenizer.from_file(path)
        special = "|".join(re.escape(t["content"]) for t in spec["added_tokens"])
        self.special = re.compile(special or r"(?!)")
        self.words = _WordIds(self.library)

    def __call__(self, text: str) -> bytes:
        """All ids, four bytes each."""
        return b"".join(map(self._part, _cut(text)))

    def _part(self, text: str) -> bytes:
        if NOT_LATIN.search(text) or self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) > _REMEMBERED:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, _WORDS.findall(text)))


def _cut(text: str) -> Iterator[str]:
    """The text in parts of about ``_CUT_CHARS`` that encode independently."""
    start = 0
    while len(text) - start > _CUT_CHARS and (found := _CUT.search(text, start + _CUT_CHARS)):
        yield text[start : found.start()]
        start = found.start()
    if text:
        yield text[start:]


@functools.lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    """One encoder for each Python worker and vocabulary."""
    return TextIds(path)


def difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each piece and the windows' fills, by balanced multiway differencing."""
    order = np.argsort(-sizes, kind="stable")
    rows = -(-len(sizes) // windows)
    dealt = np.full(rows * windows, -1)
    dealt[: len(sizes)] = order
    dealt = dealt.reshape(rows, windows)
    fills = np.where(dealt >= 0, sizes[dealt], 0)  # falling within each row
    # A partial partition: fills (falling) and, beside each, the pieces in that window.
    heap = [(int(f[-1] - f[0]), i, f, d[:, None]) for i, (f, d) in enumerate(zip(fills, dealt, strict=True))]
    heapq.heapify(heap)
    number = rows
    while len(heap) > 1:
        _, _, a, pieces_a = heapq.heappop(heap)
        _, _, b, pieces_b = heapq.heappop(heap)
        fill = a + b[::-1]
        sort = np.argsort(-fill, kind="stable")
        pieces = np.hstack([pieces_a, pieces_b[::-1]])[sort]
        fill = fill[sort]
        heapq.heappush(heap, (int(fill[-1] - fill[0]), number, fill, pieces))
        number += 1
    _, _, fill, pieces = heap[0]
    window = np.empty(len(sizes), np.int64)
    at, slot = np.nonzero(pieces >= 0)
    window[pieces[at, slot]] = at
    return window, fill


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece; as few windows as differencing fills without exceeding ``capacity``."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, fill = difference(sizes, windows)
        if fill[0] <= capacity:
            return window
        windows += max(1, windows // 500)


@dataclass
class _Packer:
    """Sequences of one Spark partition."""

    capacity: int
    grain: int
    group: int
    sequence: int
    whole: list[tuple] = field(default_factory=list)
    rests: list[tuple] = field(default_factory=list)
    held: int = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        tokens = len(ids) // 4
        full = tokens // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self.whole.append((doc_id, start, ids[4 * start : 4 * (start + self.capacity)], tokens))
        for start in range(full, tokens, self.grain):
            self.rests.append((doc_id, start, ids[4 * start : 4 * min(start + self.grain, tokens)], tokens))
        self.held += tokens - full

    def ready(self) -> bool:
        return self.held >= self.group * self.capacity or len(self.whole) >= self.group

    def flush(self) -> Iterator[pa.RecordBatch]:
        pieces, window = self.whole, np.arange(len(self.whole))
        if self.rests:
            sizes = np.array([len(p[2]) // 4 for p in self.rests])
            pieces = pieces + self.rests
            window = np.r_[window, len(self.whole) + windows_of(sizes, self.capacity)]
        if not pieces:
            return
        order = np.argsort(window, kind="stable")
        size = np.array([len(p[2]) // 4 for p in pieces])[order]
        window = window[order]
        ends = np.cumsum(size)
        first = np.r_[True, window[1:] != window[:-1]]
        before = (ends - size)[np.flatnonzero(first)[np.cumsum(first) - 1]]
        columns = zip(*(pieces[i] for i in order), strict=True)
        doc_id, start, ids, tokens = columns
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_id, pa.int64()),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(tokens, pa.int64()),
                pa.array(self.sequence + np.cumsum(first) - 1, pa.int64()),
                pa.array(ends - size - before, pa.int64()),
            ],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        self.sequence += int(first.sum())
        self.whole, self.rests, self.held = [], [], 0


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    grain: int = 256,
    group: int = 2048,
    closing_id: int = 0,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence.

    ``ids`` holds unsigned little-endian 32-bit integers. Every id of a document lies in exactly one
    piece; the pieces of a sequence lie behind each other from ``offset`` 0.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    closing = np.array([closing_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(path)
        packer = _Packer(capacity, grain, group, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), encode(text.as_py() or "") + closing)
                if packer.ready():
                    yield from packer.flush()
        yield from packer.flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
