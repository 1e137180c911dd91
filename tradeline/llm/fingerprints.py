"""Fingerprints of documents by a threshold-scaled sketch.

A text's shingles are all runs of ``SHINGLE`` code points, with ``SHINGLE - 1`` marks before and behind the text, so
that short texts have as many shingles as their ends allow. Every shingle is hashed, and the sketch is the
set of all hashes below a fixed fraction (1 / ``SCALE``) of their range. Which hashes stay depends on nothing but
the hash: the sketch of two texts together is the union of theirs, and a common shingle is in both sketches or
in neither. So the common share of sketches estimates resemblance, and the part of one sketch that lies in the other
estimates containment, however unequal the texts are.

A fingerprint is the hash of the whole text and its sketch, as text. Equal texts have equal fingerprints; a text too
short to keep any hash is told from others by the hash of the whole.

``against_next`` lays every document beside the next one by ascending id. Rows go to ranges of the key (id, hash of
text) cut at quantiles of a sample, one range to a partition, and are read there in order. A range also gets a silent
copy of the first row of the next range, and the last range that of the first. A key that fills whole ranges by
itself (repeated rows) is dealt over partitions of its own, each with a silent copy of its next. Texts are
shuffled once. The driver gets the sample's keys and two keys for each range; ranges are at most ``MOST_RANGES``.

Cases: a null text is empty; an empty text has an empty sketch. Without common hashes likeness is 0, for equal
fingerprints 1. Rows of one id are ordered by the hash of their text; repeated rows count as one document and
give equal rows. Rows with a null id come first. A single document is next to itself. Texts of any length are read whole,
a slice at a time. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tradeline.llm.common import SLICE_CHARS, cut, map_batches

#: Code points of a shingle, and the part of all hashes that stays is 1 / SCALE.
SHINGLE, SCALE = 24, 16
#: Characters of a range, ranges at most, and keys sampled for each range.
RANGE_CHARS, MOST_RANGES, SAMPLED = 64_000_000, 10_000, 50

#: The digits of six bits in a fingerprint.
_DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", np.uint8)
_MARK = 0x110000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Hashes below the threshold have 60 bits; these many are kept.
_BITS = 36


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of every run of 24 codes, from those of 8 and 16."""
    h = _mix(codes.astype(np.uint64) + _ODD)
    for step in (1, 2, 4):
        h = _mix(h[:-step] * _ODD + h[step:])
    return _mix(_mix(h[:-8] * _ODD + h[8:])[:-8] * _ODD + h[16:])


def sketch(text: str | None) -> np.ndarray:
    """The retained hashes of a text's shingles, rising."""
    if not text:
        return np.zeros(0, np.int64)
    found = []
    for at in range(0, len(text), SLICE_CHARS):
        # Each slice takes the shingles that begin in it; the first also those that begin in the marks.
        before = np.full(SHINGLE - 1 if at == 0 else 0, _MARK, np.uint32)
        part = text[at : at + SLICE_CHARS + SHINGLE - 1]
        own = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        lacking = min(len(text), at + SLICE_CHARS) + SHINGLE - 1 - at - len(own)
        h = _hashes(np.concatenate([before, own, np.full(lacking, _MARK, np.uint32)]))
        found.append(h[h < np.uint64((1 << 64) // SCALE)] >> np.uint64(60 - _BITS))
    return np.unique(np.concatenate(found)).view(np.int64)


def fingerprint(text: str | None, kept: np.ndarray) -> str:
    """The hash of the whole text and the retained hashes, six digits each."""
    digits = (kept[:, None] >> np.arange(_BITS - 6, -1, -6)) & 63
    return xxhash.xxh3_128_hexdigest((text or "").encode("utf-8", "surrogatepass")) + ":" + _DIGITS[digits].tobytes().decode()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Hashes in both of two sketches."""
    if not len(a) or not len(b):
        return 0
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[place] == b).sum())


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two texts by their sketches: the common share of all their hashes."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first text that the second holds, by their sketches."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0)), F.lit(0.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint, sketch (array of long) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, prints, kept = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            kept.append(sketch(text))
            sizes.append(len(text))
            prints.append(fingerprint(text, kept[-1]))
        ends = np.cumsum([0, *map(len, kept)])
        sketches = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept), pa.int64()))
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.string()), sketches]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "fingerprint", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "doc_id long, n_chars long, fingerprint string, sketch array<long>")


def merged(sketches: DataFrame, key: str) -> DataFrame:
    """``key``, hash: the sketch of all texts of a key together, one row for each hash.

    A third of all rows may have one key: hashes are made distinct before the shuffle, and no group is gathered.
    """
    return sketches.select(key, F.explode("sketch").alias("hash")).distinct()


@dataclass
class _Ranges:
    """Ranges of keys (id, hash): range i holds the keys above bound i - 1, up to bound i."""

    bounds: list[tuple[int, int]]
    #: Keys that are the bound of several ranges, and how many partitions each gets.
    hot: dict[tuple[int, int], int]

    def places(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        first = np.array([b[0] for b in self.bounds], np.int64)
        low, high = np.searchsorted(first, ids, side="left"), np.searchsorted(first, ids, side="right")
        for i in np.flatnonzero(low != high):
            low[i] = bisect.bisect_left(self.bounds, (int(ids[i]), int(hashes[i])))
        return low


def _ranges(keys: DataFrame, n: int, rows: int) -> _Ranges:
    share = min(1.0, SAMPLED * n / max(rows, 1))
    sample = keys.select("id", "hash")
    sample = sorted(map(tuple, (sample if share == 1.0 else sample.sample(share, 5)).collect()))
    cuts = [sample[i * len(sample) // n] for i in range(1, n)] if sample else []
    times: dict[tuple[int, int], int] = {}
    for key in cuts:
        times[key] = times.get(key, 0) + 1
    return _Ranges(sorted(times), {k: m for k, m in times.items() if m > 1})


def _in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) in ranges with silent rows: place, id, hash, tail, silent, doc_id, text."""
    spark = docs.sparkSession
    null_first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = docs.select(null_first.alias("id"), F.xxhash64("text").alias("hash"), "doc_id", "text")
    keys = cut(rows.select("id", "hash", F.length("text").alias("size")))
    facts = keys.agg(F.count("*").alias("rows"), F.sum("size").alias("chars")).first()
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n = min(MOST_RANGES, max(-(-(facts["chars"] or 0) // RANGE_CHARS), least))
    ranges = _ranges(keys, n, facts["rows"])

    @F.pandas_udf("int")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(ranges.places(ids.to_numpy(np.int64), hashes.to_numpy(np.int64)), dtype="int32")

    key = F.struct("id", "hash")
    edges = keys.select("id", "hash", place("id", "hash").alias("place"))
    edges = edges.groupBy("place").agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("place").collect()
    lows = [tuple(e["low"]) for e in edges]

    def after(key: tuple[int, int]) -> tuple[int, int]:
        """The smallest of the ranges' first keys that is larger, else the first of all."""
        return lows[i] if (i := bisect.bisect_right(lows, key)) < len(lows) else lows[0]

    copies = [(e["place"], True, *after(tuple(e["high"]))) for e in edges]
    size = len(ranges.bounds) + 1
    dealt = []
    for key_, times in ranges.hot.items():
        copies.append((ranges.bounds.index(key_), False, *key_))
        dealt.append((*key_, size, times))
        # A hot key is the last of its range, so what follows it is the first of a later one.
        copies += [(size + i, True, *after(key_)) for i in range(times)]
        size += times
    wanted = spark.createDataFrame(copies, "place int, tail boolean, id long, hash long")
    silent = rows.join(F.broadcast(wanted), ["id", "hash"])
    silent = silent.groupBy("place", "id", "hash", "tail").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    own = rows.withColumn("place", place("id", "hash"))
    if dealt:
        hot = spark.createDataFrame(dealt, "id long, hash long, from int, times int")
        own = own.join(F.broadcast(hot), ["id", "hash"], "left").withColumn(
            "place",
            F.coalesce(F.col("from") + F.pmod(F.monotonically_increasing_id(), F.col("times")).cast("int"), F.col("place")),
        )
    columns = ["place", "id", "hash", "tail", "silent", "doc_id", "text"]
    own = own.withColumns({"tail": F.lit(False), "silent": F.lit(False)}).select(*columns)
    return own.unionByName(silent.withColumn("silent", F.lit(True)).select(*columns)), size


class _Document:
    """A document in order, and how many rows it has that are no silent copies."""

    def __init__(self, key: tuple[int, int], doc_id: int | None, text: str):
        self.key, self.doc_id, self.text, self.rows = key, doc_id, text, 0
        self.sketch = sketch(text)

    def row(self, following: _Document) -> tuple:
        n = len(self.text)
        edited = self.text[: n - n // 4] + following.text[: n // 4]
        own, other = fingerprint(self.text, self.sketch), sketch(edited)
        both = common(self.sketch, other)
        return (
            self.doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, fingerprint(edited, other),
            1.0 if edited == self.text else both / max(1, len(self.sketch) + len(other) - both),
            self.like(following), both / len(self.sketch) if len(self.sketch) else float(edited == self.text),
        )

    def like(self, other: _Document) -> float:
        if self.text == other.text:
            return 1.0
        both = common(self.sketch, other.sketch)
        return both / max(1, len(self.sketch) + len(other.sketch) - both)


_RESULT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(), "kept_in_edited": pa.float64(),
}


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and their likeness to each other and to the next document.

    The edited text has the first code points of the next document in place of its last quarter.
    ``kept_in_edited``: estimated part of the text that the edited one holds.
    """
    rows, size = _in_order(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Document | None = None
        for batch in batches:
            done: list[tuple] = []
            for id_, hash_, tail, silent, doc_id, value in zip(*(batch.column(c) for c in columns), strict=True):
                key, text = (id_.as_py(), hash_.as_py()), value.as_py()
                if last is None or tail.as_py() or key != last.key or text != last.text:
                    now = _Document(key, doc_id.as_py(), text)
                    if last is not None and last.rows:
                        done += [last.row(now)] * last.rows
                    last = now
                last.rows += not silent.as_py()
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done, strict=True), _RESULT.values(), strict=True)], list(_RESULT)
                )

    columns = ["id", "hash", "tail", "silent", "doc_id", "text"]
    rows = rows.repartitionById(size, "place").sortWithinPartitions("tail", "id", "hash")
    return rows.select(*columns).mapInArrow(run, from_arrow_schema(pa.schema(list(_RESULT.items()))))
