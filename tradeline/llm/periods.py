"""Periodic runs of words, found by multi-scale minimizers.

A run is a longest stretch of words with smallest period q (words q apart are equal) that holds at least
``REPEATS`` periods and ``LEAST`` words. Periods below ``LAGS`` are found by direct scans: the text is laid
against itself at every such lag. For the others there is a scale Q = LAGS, 2 LAGS, 4 LAGS ... with
Q <= q < 2 Q. At a scale every place has the hash of the 2 Q words from there, and a place is a minimizer
if its hash is the smallest of some window of Q places. In a run windows a period apart hold equal
hashes, so minima repeat at period distance; as the hashed words are longer than the period, no
place between them has the same hash. So the pairs of one minimizer and the next equal one, at a
distance from Q to 2 Q, are seeds for every run of the scale. A seed is compared word by word and extended to
both sides, so hashes decide nothing but where to look. A stretch found by several periods counts by the smallest.

Numbers of words are one array for many texts, with a number of its own between two texts, so that a
slice of texts takes the same few numpy calls as one text, at every scale. A text needs about 100
bytes for each of its words, in one task. Every text is handled by itself; nothing is shuffled.

Cases: a null or empty text, or one of white space only, has no word, no run and an empty collapsed text.
Words are what stands between ASCII white space and are compared as they are (case, accents). A text
without a run keeps its words, joined by one space. Repeated rows give equal rows, a null id stays null, extra columns are
ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import SLICE_CHARS, map_batches, text_slices

#: Fixed values of the task: periods and words that a run holds at least.
REPEATS, LEAST = 4, 6
#: Periods below are found by direct scans; the first scale.
LAGS = 8

_WORD = re.compile("[^\x20\x09-\x0d]+")
_SPACE = re.compile("[\x20\x09-\x0d]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)

Run = tuple[int, int, int]


def words_of(text: str, known: dict[str, int]) -> np.ndarray:
    """The words of a text by number; ``known`` gets the new ones."""
    parts, at = [], 0
    while at < len(text):
        space = _SPACE.search(text, min(at + SLICE_CHARS, len(text)))
        end = space.end() if space else len(text)
        parts.append([known.setdefault(w, len(known)) for w in _WORD.findall(text, at, end)])
        at = end
    if len(parts) == 1:
        return np.array(parts[0], np.int64)
    return np.concatenate([np.array(p, np.int64) for p in parts]) if parts else np.zeros(0, np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, size: int, best: np.ufunc, rest: int) -> np.ndarray:
    """The best of every window of ``size`` places: the end of one block and the start of the next.

    Windows begin at each place; beyond the end stands ``rest``.
    """
    n = len(x)
    blocks = np.full((-(-n // size) + 1) * size, rest, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, size)
    head = best.accumulate(blocks, axis=1).ravel()
    tail = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(tail[:n], head[size - 1 : size - 1 + n])


def minimizers(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places whose hash is the smallest of some whole window of ``size`` places."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, size, np.minimum, (1 << 64) - 1)[: n - size + 1]
    # A place is in the windows that begin up to size - 1 places before it.
    around = _sliding(np.r_[np.zeros(size - 1, np.uint64), least, np.zeros(size - 1, np.uint64)], size, np.maximum, 0)[:n]
    return np.flatnonzero(hashes == around)


def _stretch(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """Start and end of the places around ``at`` whose word equals the one ``lag`` further on."""
    n = len(words) - lag
    end, step = at, 64
    while end < n:
        part = words[end : min(end + step, n)] != words[end + lag : min(end + step, n) + lag]
        if part.any():
            end += int(part.argmax())
            break
        end, step = min(end + step, n), 2 * step
    start, step = at, 64
    while start > 0:
        low = max(start - step, 0)
        part = words[low:start] != words[low + lag : start + lag]
        if part.any():
            start -= int(part[::-1].argmax())
            break
        start, step = low, 2 * step
    return start, end


def runs(words: np.ndarray, longest: int) -> list[Run]:
    """start, length, period of every run in ``words``, by start and period.

    ``longest``: words of the longest text in ``words``; no run is longer.
    """
    found: dict[tuple[int, int], int] = {}

    def add(start: int, length: int, period: int) -> None:
        if length >= max(LEAST, REPEATS * period):
            found[start, length] = min(period, found.get((start, length), period))

    for lag in range(1, min(LAGS, longest // REPEATS + 1)):
        equal = np.zeros(len(words) - lag + 2, bool)
        np.equal(words[:-lag], words[lag:], out=equal[1:-1])
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        start, end = edge[::2], edge[1::2]
        long = end - start >= max(LEAST, REPEATS * lag) - lag
        for s, e in zip(start[long].tolist(), end[long].tolist(), strict=True):
            add(s, e - s + lag, lag)

    hashes, span, scale = _mix(words.astype(np.uint64) + _ODD), 1, LAGS
    while REPEATS * scale <= longest:
        while span < 2 * scale:
            hashes = _mix(hashes[:-span] * _ODD + hashes[span:])
            span *= 2
        places = minimizers(hashes, scale)
        order = np.argsort(hashes[places], kind="stable")
        ordered = places[order]
        lag = np.diff(ordered)
        seed = (hashes[ordered[1:]] == hashes[ordered[:-1]]) & (lag >= scale) & (lag < 2 * scale)
        at, lag = ordered[:-1][seed], lag[seed]
        done, end = 0, -1
        for place in np.lexsort((at, lag)).tolist():
            a, q = int(at[place]), int(lag[place])
            if q == done and a < end:
                continue
            start, end = _stretch(words, a, q)
            done = q
            add(start, end - start + q, q)
        scale *= 2
    return sorted((start, length, period) for (start, length), period in found.items())


def best(found: list[Run]) -> Run | None:
    """The run that repeats most often; of several the first, then that of the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None


def kept_words(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words lie in no run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _slice(texts: list[str]) -> list[tuple[list[Run], str, int]]:
    """Runs, collapsed text and number of words of each text."""
    known: dict[str, int] = {}
    numbers = [words_of(t, known) for t in texts]
    # A number of its own behind each text, equal to no word and no other end.
    joined = np.concatenate([np.append(w, -1 - i) for i, w in enumerate(numbers)])
    starts = np.cumsum([0, *(len(w) + 1 for w in numbers)])
    own: list[list[Run]] = [[] for _ in texts]
    for start, length, period in runs(joined, max(map(len, numbers))):
        i = int(np.searchsorted(starts, start, side="right")) - 1
        own[i].append((start - int(starts[i]), length, period))
    spelled = list(known)
    out = []
    for words, found in zip(numbers, own, strict=True):
        kept = words[kept_words(len(words), found)] if found else words
        out.append((found, " ".join([spelled[w] for w in kept.tolist()]), len(words)))
    return out


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by place), best (the run that repeats most
    often, null without one), text (without repeats) of every row."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [row for part in text_slices(batch.column(1).to_pylist()) for row in _slice(part)]
        rows = [dict(zip(("start", "length", "period"), r, strict=True)) for found, _, _ in done for r in found]
        ends = np.cumsum([0, *(len(found) for found, _, _ in done)])
        tops = [best(found) for found, _, _ in done]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for _, _, n in done], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows, run)),
                pa.array([t and dict(zip(("start", "length", "period"), t, strict=True)) for t in tops], run),
                pa.array([text for _, text, _ in done], pa.string()),
            ],
            ["doc_id", "n_words", "runs", "best", "text"],
        )

    fields = "struct<start:long,length:long,period:long>"
    schema = f"doc_id long, n_words long, runs array<{fields}>, best {fields}, text string"
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), find, schema)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: from every tenth document on (by h = crc32 of the id) the words from place a repeat
    with period p, where g = h / 10, a = g % n and p = 1 + (n - a) / (3 + g % 8); others stay as they are.
    A null id stays as it is."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = rows.where(F.coalesce(h % 10 == 0, F.lit(False)))
    others = rows.where(F.coalesce(h % 10 != 0, F.lit(True)))
    chosen = chosen.withColumn("words", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    chosen = chosen.withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(h / 10))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = F.expr("transform(sequence(0L, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))])")
    planted = chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text"))
    return planted.unionByName(others)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the most repeated run, and digests of all runs and of the collapsed text."""
    said = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(said, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
