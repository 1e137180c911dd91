"""Token counts by rank-synchronous array merging.

A byte-pair vocabulary with word ends is applied to many pre-tokens at once. They lie behind each
other in one flat array of symbol ids; in every round each pre-token's lowest-ranked pair is merged,
in all pre-tokens simultaneously, until no pair is left. What survives is counted. A merge makes only
pairs of higher rank, so all places of one pre-token's lowest pair may be merged in the same round
(from the left, where they overlap); a round only looks up the pairs beside a merge anew.

Normalising and cutting into pre-tokens follow the tokenizer file: composed characters, white space
runs to one space, lower case, then letters / single digits / other runs. Texts of plain Latin
characters are cut by one regular expression; any other text by the file's own normaliser and
pre-tokeniser, so rare scripts count alike.

Cases: null and empty texts have 0 tokens. A special string inside a text is one token, as the
library's default has it. Every input row gives one output row (repeated rows too); extra columns
are ignored. Very long texts are cut piece by piece, never truncated.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import map_batches

#: Characters whose normal form, lower case and class are the same for every Unicode version:
#: printable ASCII, tab and line ends, Latin-1 and Latin Extended-A (without the dotted capital I).
LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
NOT_LATIN = re.compile("[^\t\n\r -~\xa1-įı-ſ]")

_WORDS = re.compile(
    rf"[{LATIN_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{LATIN_NUMBERS}]|[^\s{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)

#: Pre-tokens cut at a time, and pre-tokens remembered with their count by a Python worker.
CHUNK, REMEMBERED = 100_000, 300_000

_NONE = np.int64(1 << 40)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class MergeTable:
    """Ranks of symbol pairs, and the symbols that they become, as sorted arrays."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.size = len(vocab)
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(symbols[b], -1) for b in range(256)])
        self.last = np.array([vocab.get(symbols[b] + end, -1) for b in range(256)])
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs])
        made = np.array([vocab[a + b] for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of, self.made_of = keys[order], order, made[order]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NONE``: no merge) and merged symbol of each pair."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.rank_of[at], _NONE), self.made_of[at]

    def counts(self, words: list[str]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        encoded = [w.encode() for w in words]
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        data = np.frombuffer(b"".join(encoded), np.uint8)
        out = length.copy()
        last = np.zeros(len(data), bool)
        last[np.cumsum(length)[length > 0] - 1] = True
        symbol = np.where(last, self.last[data], self.inner[data])
        word = np.repeat(np.arange(len(words)), length)
        rank, made = np.full(len(data), _NONE), np.zeros(len(data), np.int64)
        self._rank(symbol, word, rank, made, np.arange(len(data)))
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(word)])
            lowest = np.minimum.reduceat(rank, starts)
            open_ = lowest < _NONE
            out[word[starts]] = size
            if not open_.all():  # words without any pair left leave the arrays
                stay = np.repeat(open_, size)
                symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
                lowest, size = lowest[open_], size[open_]
                if not len(symbol):
                    break
            hit = rank == np.repeat(lowest, size)
            at = np.flatnonzero(hit)
            # Overlapping places (aaa) are neighbours: every second one of a run merges.
            first = np.r_[True, np.diff(at) != 1]
            within = np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            at = at[within % 2 == 0]
            symbol[at] = made[at]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay)[at] - 1
            symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
            self._rank(symbol, word, rank, made, np.union1d(moved, np.maximum(moved - 1, 0)))
        return out

    def _rank(self, symbol, word, rank, made, at) -> None:
        """Look up the pairs that begin at ``at``."""
        rank[at] = _NONE
        at = at[at + 1 < len(symbol)]
        at = at[word[at] == word[at + 1]]
        rank[at], made[at] = self.look_up(symbol[at], symbol[at + 1])


class TokenCounter:
    """Token counts of texts, with a bounded memory of pre-tokens met before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.table = MergeTable(path)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        special = [t["content"] for t in json.loads(Path(path).read_text(encoding="utf-8"))["added_tokens"]]
        longest_first = sorted(special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        symbols = byte_symbols()
        self.to_byte = {ord(c): chr(b) for b, c in symbols.items()}
        self.known: dict[str, int] = {}

    def _pieces(self, text: str) -> Iterator[str]:
        if NOT_LATIN.search(text) is None:
            yield from map(re.Match.group, _WORDS.finditer(text.lower()))
        else:
            for piece, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text)):
                yield piece.translate(self.to_byte).encode("latin1").decode()

    def _words(self, text: str) -> Iterator[list[str]]:
        """Lists of a text's pre-tokens."""
        if len(text) <= 10 * CHUNK and NOT_LATIN.search(text) is None:
            yield _WORDS.findall(text.lower())
        else:
            pieces = self._pieces(text)
            while words := list(itertools.islice(pieces, CHUNK)):
                yield words

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        total = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            parts = [text] if text else []
            if text and self.special.search(text):
                parts = self.special.split(text)
                total[i] += len(parts) - 1
            for words in itertools.chain.from_iterable(map(self._words, filter(None, parts))):
                held.append((i, words))
                size += len(words)
                if size >= CHUNK:
                    self._add(total, held)
                    held, size = [], 0
        self._add(total, held)
        return total

    def _add(self, total: list[int], held: list[tuple[int, list[str]]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({w for _, words in held for w in words if w not in self.known})
        if new:
            self.known.update(zip(new, self.table.counts(new).tolist(), strict=True))
        for i, words in held:
            total[i] += sum(map(self.known.__getitem__, words))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter for each Python worker and vocabulary."""
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, limit: int = 2048, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text; no shuffle.

    ``tokenizer`` is the path of the vocabulary file, present at the same place on every executor.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = counter(path).count(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    out = map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
