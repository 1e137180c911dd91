"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Every whole text becomes ``STATISTICS`` numbers (lengths, shares of character classes, repetition).
Standardised, they are mapped to random Fourier features, which approximate a Gaussian kernel. Each
partition sums its part of the normal equations; the sums are added up by matrix row in Spark, and the
driver solves one system of fixed size for the ridge weights. Raw scores of other labelled rows are
counted in fixed bins, and pooling of adjacent violators makes the calibration curve.

Labels come only from rows whose crc32(id as text) mod 3 is not 1; a document that is labelled more
than once takes its mean label. Of these, hashes of the id deal four fifths to the regression and one
fifth to the calibration. The statistics are written once to the shared folder; texts are not shuffled.

Cases: a null text counts as empty and gets a score like any other. Labels that are null, or have no
document, are ignored. With labels of one kind only, or none, every score is the share of label 1
(0.5 without labels). A null id is not held out and not learned from. Equal rows score alike.
"""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import cut, map_batches

STATISTICS = (
    "characters words word_length word_length_spread long_words short_words distinct_words "
    "first_word_share repeated_neighbours distinct_triples upper digits spaces symbols sentence_marks "
    "other_marks not_ascii lines distinct_lines line_words sentence_words capitalised all_capitals "
    "byte_entropy letters_in_words"
).split()

_SENTENCE = re.compile(r"[.!?]+(?:\s|$)")
_BINS = 1024

_CLASS = np.zeros(256, np.int64)  # upper, digit, space, symbol, sentence mark, other mark, not ASCII
for _number, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b"#$%&*+<=>@\\^_`{|}~", b".!?", b"\"'(),-/:;[]"), 1
):
    _CLASS[list(_bytes)] = _number
_CLASS[128:] = 7


def statistics(text: str | None) -> np.ndarray:
    """The numbers of one text."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    histogram = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    n_bytes = histogram.sum()
    kinds = np.bincount(_CLASS, weights=histogram, minlength=8) / n_bytes
    share = histogram[histogram > 0] / n_bytes
    words = text.split()
    n = len(words)
    out[0], out[1] = np.log1p(len(text)), np.log1p(n)
    if n:
        length = np.fromiter(map(len, words), np.int64, n)
        out[2:6] = length.mean(), length.std(), (length > 12).mean(), (length < 4).mean()
        distinct = len(set(words))
        out[6] = np.log1p(distinct) / np.log1p(n)
        out[7] = words.count(words[0]) / n
        out[8] = sum(map(operator.eq, words, words[1:])) / n
        out[9] = len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1)
        out[21] = sum(map(str.istitle, words)) / n
        out[22] = sum(map(str.isupper, words)) / n
        out[24] = sum(map(str.isalpha, words)) / n
    out[10:17] = kinds[1:8]
    lines = [line for line in text.split("\n") if line.strip()]
    out[17] = np.log1p(len(lines))
    out[18] = len(set(lines)) / max(len(lines), 1)
    out[19] = np.log1p(n / max(len(lines), 1))
    out[20] = np.log1p(n / (len(_SENTENCE.findall(text)) + 1))
    out[23] = -(share * np.log2(share)).sum()
    return out


@dataclass
class Scorer:
    """A fitted model; ``knots`` and ``levels`` are the calibration curve."""

    mean: np.ndarray
    spread: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """Features, with a constant as the last."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        wave = np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.c_[wave, np.ones(len(x))]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores; a hundredth of the raw score keeps the order within a level."""
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.levels)
        return np.clip(0.99 * level + 0.01 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def pool(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic (rising) fit of ``value`` by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks[-1]
            blocks[-1] = [(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, len(STATISTICS))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, remainder (of its crc32 by 3), statistics (array) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t.as_py()) for t in batch.column(2)], np.float64)
        rows = pa.ListArray.from_arrays(np.arange(len(x) + 1) * len(STATISTICS), x.ravel())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), rows], ["doc_id", "remainder", "statistics"]
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.crc32(F.col(id_col).cast("string")) % 3).cast("int").alias("remainder"),
        F.col(text_col).alias("text"),
    )
    return map_batches(rows, run, "doc_id long, remainder int, statistics array<double>")


def normal_equations(rows: DataFrame, scorer: Scorer) -> np.ndarray:
    """Sums of features times (features, label) over ``rows`` (statistics, label).

    Partitions emit one row for each matrix row, and these are added up by matrix row, so what the
    driver gets has a fixed size.
    """
    size = len(scorer.phase) + 1

    def partial(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = scorer.fourier(_matrix(batch, "statistics"))
                total += z.T @ np.c_[z, batch.column("label").to_numpy(zero_copy_only=False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["place", "sums"]
        )

    def add(group: pa.Table) -> pa.Table:
        sums = group["sums"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, size + 1).sum(axis=0)
        return pa.table({"place": group["place"].slice(0, 1), "sums": pa.array([sums], pa.list_(pa.float64()))})

    schema = "place int, sums array<double>"
    parts = rows.select("statistics", "label").mapInArrow(partial, schema)
    found = parts.groupBy("place").applyInArrow(add, schema).orderBy("place").toArrow()
    if not found.num_rows:
        return np.zeros((size, size + 1))
    return np.array(found["sums"].to_pylist())


def fit(labelled: DataFrame, features: int = 256, ridge: float = 1e-3, seed: int = 7) -> Scorer:
    """A scorer of ``labelled`` (place: hash of the id, statistics, label)."""
    d = len(STATISTICS)
    columns = [F.col("statistics")[i] for i in range(d)]
    sums = labelled.agg(
        F.count("*"), F.avg("label"), *(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)
    ).first()
    n, share = sums[0], 0.5 if sums[1] is None else float(sums[1])
    mean = np.array(sums[2 : 2 + d], float) if n else np.zeros(d)
    spread = np.array(sums[2 + d :], float) if n else np.ones(d)
    rng = np.random.default_rng(seed)
    scorer = Scorer(
        mean, np.where(spread > 1e-9, spread, 1.0), rng.normal(0, 1 / np.sqrt(d), (d, features)),
        rng.uniform(0, 2 * np.pi, features), np.r_[np.zeros(features), share], np.array([0.0]), np.array([share]),
    )
    if not n or not 0 < share < 1:
        return scorer
    sums = normal_equations(labelled.where("pmod(place, 5) <> 0"), scorer)
    a, b = sums[:, :-1], sums[:, -1]
    if a[-1, -1] > 0:
        penalty = np.full(len(a), ridge * a[-1, -1] / features)
        penalty[-1] = 1e-9
        scorer.weights = np.linalg.solve(a + np.diag(penalty), b)
    bins = _binned(labelled.where("pmod(place, 5) = 0"), scorer)
    if not bins or not 0 < sum(r["ones"] for r in bins) < sum(r["n"] for r in bins):
        bins = _binned(labelled, scorer)
    weight = np.array([r["n"] for r in bins], float)
    levels = pool(np.array([r["ones"] for r in bins]) / weight, weight)
    scorer.knots, scorer.levels = np.array([r["raw"] for r in bins]), levels
    return scorer


def _binned(rows: DataFrame, scorer: Scorer) -> list:
    """Labels by bin of the raw score, at most ``_BINS`` rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = scorer.raw(_matrix(batch, "statistics"))
        place = np.clip((raw + 0.5) / 2 * _BINS, 0, _BINS - 1).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(raw), batch.column("label")], ["bin", "raw", "label"]
        )

    scored = map_batches(rows.select("statistics", "label"), run, "bin int, raw double, label double")
    return (
        scored.groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.avg("raw").alias("raw"))
        .orderBy("bin")
        .collect()
    )


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    stats = cut(document_statistics(docs, id_col, text_col))
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where("label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
    )
    labelled = stats.where("remainder <> 1").join(known, "doc_id")
    scorer = fit(labelled.select(F.xxhash64("doc_id").alias("place"), "statistics", "label"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = scorer.score(_matrix(batch, "statistics"))
        held_out = [r == 1 for r in batch.column("remainder").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(held_out), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    return map_batches(stats, run, "doc_id long, held_out boolean, score double, predicted int")
