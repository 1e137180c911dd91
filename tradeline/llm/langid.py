"""Language identification: family first, then one-versus-one support vector machines.

A text becomes square roots of the shares of its letter 1-, 2- and 3-grams, hashed into ``DIMS``
places. Linear support vector machines (squared hinge) first separate the language families from each
other, then the languages of the chosen family, one machine for each pair. A decision is the votes of
the pairs, then their margins; the score is the product of the two steps' confidences.

The machines are fitted on a sample: of each language the ``per_language`` rows with the smallest hash of
their id, whose features (not texts) are collected; more than ``DRIVER_PAIRS`` machines are fitted in
Spark tasks. Only ``text`` and ``lang`` of rows outside the held-out fold are used. Everything else reads all rows and whole texts.

Cases: a null text or one without a letter is ``und`` with score 0. Rows without a language or id are
not learned from; a null id is not held out. A language without a known family is a family of its own.
If no language can be learned every row is ``und``. Equal rows are predicted alike; extra columns are
ignored.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeline.llm.common import map_batches

UNDETERMINED = "und"

DIMS, DRIVER_PAIRS = 1 << 12, 100

#: ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indo-aryan": "hi bn mr ne pa gu ur",
    "semitic": "ar he am mt",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
_PART = 1_000_000


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], f"only {lang}")


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of hashed n-gram shares; None if the text has no letter."""
    if not text or not _LETTER.search(text):
        return None
    count = np.zeros(DIMS)
    for start in range(0, len(text), _PART):  # two characters overlap, so that no n-gram is lost
        part = text[max(0, start - 2) : start + _PART]
        clean = f" {_NOT_LETTERS.sub(' ', part.lower())} "
        code = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
        two = code[:-1] * np.uint32(2654435761) + code[1:]
        three = two[:-1] * np.uint32(2246822519) + code[2:]
        for n, gram in enumerate((code, two, three)):
            mixed = (gram + np.uint32(n)) * np.uint32(3266489917)
            count += np.bincount(mixed >> np.uint32(20), minlength=DIMS)
    vector = np.sqrt(count)
    return vector / np.linalg.norm(vector)


def fit_machine(x: np.ndarray, positive: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights (bias last) of a squared-hinge machine, by accelerated gradient steps; classes weigh alike."""
    x, given = np.ones((len(x), x.shape[1] + 1), np.float32), x
    x[:, :-1] = given
    y = np.where(positive, 1, -1).astype(np.float32)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)
    rate = 1 / (4.0 + penalty)  # |x|^2 is 2, the loss has curvature 2 |x|^2
    w = ahead = np.zeros(x.shape[1], np.float32)
    for step in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = -2 * ((share * slack * y) @ x) + np.float32(penalty) * ahead
        new = ahead - np.float32(rate) * gradient
        ahead = new + np.float32((step - 1) / (step + 2)) * (new - w)
        w = new
    return w


class Sample:
    """Feature vectors as places and shares; rows become dense where they are asked for."""

    def __init__(self, offsets: np.ndarray, places: np.ndarray, shares: np.ndarray):
        self.offsets, self.places, self.shares = offsets, places, shares

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), DIMS), np.float32)
        for i, row in enumerate(rows):
            own = slice(self.offsets[row], self.offsets[row + 1])
            x[i, self.places[own]] = self.shares[own]
        return x


def _fit_pair(x: np.ndarray | Sample, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    rows = np.r_[one, other]
    order = np.argsort(rows)
    return fit_machine(x[rows[order]], order < len(one))


def _fit_pairs(x: np.ndarray | Sample, at: dict, pairs: list[tuple], spark: SparkSession | None) -> list[np.ndarray]:
    """Weights for each pair of keys of ``at`` (rows of a class)."""
    if spark is None or len(pairs) <= DRIVER_PAIRS:
        return [_fit_pair(x, at[a], at[b]) for a, b in pairs]
    held = spark.sparkContext.broadcast((x, at, pairs))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, places, wanted = held.value
        found = [_fit_pair(rows, *(places[k] for k in wanted[i])).tobytes() for i in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "weights"])

    tasks = min(len(pairs), 4 * spark.sparkContext.defaultParallelism)
    fitted = map_batches(spark.range(0, len(pairs), 1, tasks), run, "id long, weights binary").toArrow().sort_by("id")
    held.destroy()
    return [np.frombuffer(w.as_buffer(), np.float32) for w in fitted["weights"]]


@dataclass
class Machines:
    """One-versus-one machines over named classes; ``weights`` has a column for each pair."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class number and confidence of each row."""
        if not self.pairs:
            return np.zeros(len(x), int), np.ones(len(x))
        margin = x @ self.weights[:-1] + self.weights[-1]
        sure = 1 / (1 + np.exp(-3 * np.clip(margin, -20, 20)))
        vote, trust = np.zeros((2, len(x), len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            vote[:, a] += margin[:, k] >= 0
            vote[:, b] += margin[:, k] < 0
            trust[:, a] += sure[:, k]
            trust[:, b] += 1 - sure[:, k]
        best = (vote + trust / (len(self.names) + 1)).argmax(axis=1)
        return best, trust[np.arange(len(x)), best] / (len(self.names) - 1)


@dataclass
class LanguageModel:
    """Machines between families and, by family, between its languages."""

    families: Machines
    within: dict[str, Machines]

    @classmethod
    def fit(cls, x: np.ndarray | Sample, langs: np.ndarray, spark: SparkSession | None = None) -> LanguageModel:
        groups = np.array([family(lang) for lang in langs])
        # Classes by the family that they are languages of, families by ''.
        at: dict[tuple[str, str], np.ndarray] = {}
        for lang in sorted(set(langs)):
            at[family(lang), lang] = np.flatnonzero(langs == lang)
        for group in sorted(set(groups)):
            at["", group] = np.flatnonzero(groups == group)
        names: dict[str, list[str]] = {}
        for group, name in at:
            names.setdefault(group, []).append(name)
        pairs = [((g, a), (g, b)) for g, own in names.items() for a, b in itertools.combinations(own, 2)]
        fitted = iter(_fit_pairs(x, at, pairs, spark))
        machines = {}
        for group, own in names.items():
            numbers = list(itertools.combinations(range(len(own)), 2))
            machines[group] = Machines(own, numbers, np.array([next(fitted) for _ in numbers]).T)
        return cls(machines.pop(""), machines)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group, score = self.families.decide(x)
        lang = np.empty(len(x), object)
        for number, name in enumerate(self.families.names):
            own = np.flatnonzero(group == number)
            if len(own):
                machines = self.within[name]
                best, sure = machines.decide(x[own])
                lang[own] = np.array(machines.names, object)[best]
                score[own] *= sure
        return lang, score


def learn(docs: DataFrame, per_language: int = 500, id_col: str = "doc_id") -> LanguageModel | None:
    """A model of the rows outside the held-out fold; None without any labelled text."""
    known = docs.select(
        F.col("lang"), F.col("text"), F.xxhash64(F.col(id_col).cast("string")).alias("place"), _remainder(id_col)
    ).where("lang is not null and remainder <> 2")
    by_place = Window.partitionBy("lang").orderBy("place")
    last = (
        known.select("lang", "place")
        .withColumn("rank", F.row_number().over(by_place))
        .where(F.col("rank") <= per_language)
        .groupBy("lang")
        .agg(F.max("place").alias("last"))
    )  # one row for each language
    sample = known.join(F.broadcast(last), "lang").where("place <= last").select("lang", "text", "place", F.xxhash64("text").alias("mix"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place, share, kept = [], [], []
        for i, text in enumerate(batch.column(1)):
            vector = features(text.as_py())
            if vector is not None:
                at = np.flatnonzero(vector)
                kept.append(i)
                place.append(at.astype(np.int32))
                share.append(vector[at].astype(np.float32))
        known = batch.select(["lang", "place", "mix"]).take(pa.array(kept, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [*known.columns, pa.array(place, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))],
            ["lang", "place", "mix", "places", "shares"],
        )

    rows = map_batches(sample, run, "lang string, place long, mix long, places array<int>, shares array<float>")
    # Rows with one id have one place; no more than the bound go to the driver.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "mix"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "places", "shares").toArrow()
    if not rows.num_rows:
        return None
    places, shares = rows["places"].combine_chunks(), rows["shares"].combine_chunks()
    x = Sample(places.offsets.to_numpy(), places.values.to_numpy(), shares.values.to_numpy())
    return LanguageModel.fit(x, np.array(rows["lang"].to_pylist(), object), docs.sparkSession)


def _remainder(id_col: str):
    return (F.crc32(F.col(id_col).cast("string")) % 4).alias("remainder")


def _predicted(texts: pa.Array, model: LanguageModel | None) -> tuple[list[str], list[float]]:
    """Language and score of each text, a few hundred feature vectors at a time."""
    lang, score = [], []
    for start in range(0, len(texts), 256):
        vectors = [features(t.as_py()) for t in texts.slice(start, 256)]
        known = [i for i, v in enumerate(vectors) if v is not None]
        names, sure = np.full(len(vectors), UNDETERMINED, object), np.zeros(len(vectors))
        if known and model is not None:
            names[known], sure[known] = model.predict(np.array([vectors[i] for i in known]))
        lang.extend(names)
        score.extend(sure)
    return lang, score


def identify(docs: DataFrame, per_language: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; the prediction needs no shuffle."""
    model = learn(docs, per_language, id_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _predicted(batch.column(2), model)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"],
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(_remainder(id_col) == 2, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, least_score: float = 0.25, per_language: int = 500, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs``, with all columns, that have a language with at least ``least_score``; no shuffle.

    The default is the score of two undecided steps, so only texts without any evidence go.
    """
    model = learn(docs, per_language, id_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _predicted(batch.column("row").field(text_col), model)
        keep = [name != UNDETERMINED and sure >= least_score for name, sure in zip(lang, score, strict=True)]
        return batch.filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.struct("*").alias("row"))  # names of any kind pass inside a struct
    return map_batches(rows, run, rows.schema).select("row.*")
