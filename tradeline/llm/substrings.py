"""Removal of repeated passages by sliding spans of sentences.

A text is cut into sentences, and these at commas, semicolons and colons, so that a passage of a few long
sentences holds several; a line end and a capital after a word without a full stop also begin a new
one, so that a passage pasted into the middle of a sentence is cut off. What then still has more than ``LONG``
words is cut behind those words whose hash is divisible by ``PICK``: by its content, so a passage without any marks
is cut alike wherever it stands.

Spans are runs of at least ``SENTENCES`` sentences that hold ``WORDS`` words, or one sentence that does: from every sentence the
shortest one forward, and up to every sentence the shortest one backward, so that the spans of a passage reach from
its first to its last whole sentence. Spans are hashed (lower case, white space aside) by prefix sums, whatever their
length. A span that occurs in several documents belongs to the smallest doc_id; sentences that it covers in any other
document are removed, as are sentences covered by a span's second or later place in one text. Passages below ``WORDS`` words
stay; one of more than 50 words holds spans even if it loses the sentences at both ends to the text around it.

The spans are made once and written to the shared folder. Only hashes and ids are joined over all documents. The owner of
a span is a minimum, combined before the shuffle, and spans meet their owner in an inner join that Spark can split, so a
passage shared by a third of all documents is no bottleneck. What is gathered for one document is bounded by its
text. Only documents with foreign or repeated spans are read again; their ids are broadcast if they are at most
``BROADCAST_IDS``, so that no other text is shuffled.

Cases: null and empty texts stay as they are and have no sentence. A null doc_id takes no part between
documents. Rows with the same doc_id count as one document, so they don't remove each other's spans.
Texts of any length are handled whole; extra columns are ignored (``clean_documents`` keeps them).
"""

from __future__ import annotations

import functools
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeline.llm.common import SLICE_CHARS, cut, few_files, map_batches, remove_folder, shared_folder

SENTENCES, WORDS, BROADCAST_IDS = 2, 35, 500_000
LONG, PICK = 8, 4

_END = re.compile(
    "\\s(?:(?<=\n)|(?<=[.!?…,;:][\\s])|(?<=[.!?…][\"'»”)][\\s])"
    "|(?<=[a-zß-öø-ÿ]\\s)(?=[A-ZÀ-ÖØ-Þ]))\\s*"
)
_BREAK = re.compile(r"\s")
#: Fixed by Unicode: which of the code points up to U+3000 are white space; the last place stands for all others.
_SPACE = np.array([*(chr(c).isspace() for c in range(0x3001)), False])
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _lowered(text: str) -> str:
    """Lower case, one character for one."""
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = "".join(c.lower()[0] for c in text)
    return lowered.replace("ς", "σ")


def _hashed(lowered: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word."""
    codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4")
    solid = np.zeros(len(codes) + 2, bool)
    solid[1:-1] = ~_SPACE[np.minimum(codes, len(_SPACE) - 1)]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)) * _powers(_BASE, len(codes)), out=total[1:])
    value = (total[end] - total[start]) * _powers(_INVERSE, len(codes))[start]
    return start, _mix(value + (end - start).astype(np.uint64))


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash (in lower case) of every word, and behind how many words each sentence ends."""
    parts, at = [], 0
    while at < len(text):
        space = _BREAK.search(text, min(at + SLICE_CHARS, len(text)))
        stop = space.end() if space else len(text)
        start, value = _hashed(_lowered(text[at:stop]))
        parts.append((start + at, value))
        at = stop
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start, value = (np.concatenate(p) for p in zip(*parts, strict=True))
    marks = np.array([*(m.end() for m in _END.finditer(text)), len(text)])
    ends = np.unique(np.searchsorted(start, marks))
    ends = ends[ends > 0]
    sizes = np.diff(ends, prepend=0)
    cut = np.repeat(sizes > LONG, sizes) & (value % np.uint64(PICK) == 0)
    cut[ends - 1] = True
    return start, value, np.flatnonzero(cut) + 1


def sentences(text: str) -> list[int]:
    """Starts of the sentences, and the end of the text; white space belongs to what stands before it."""
    if not text:
        return [0]
    start, _, ends = _words(text)
    return [0, *start[ends[:-1]].tolist(), len(text)]


@functools.lru_cache(maxsize=2)
def _all_powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of a usual text are kept."""
    return _all_powers(base, 1 << 17)[:n] if n <= 1 << 17 else _all_powers.__wrapped__(base, n)


def spans(text: str, least_sentences: int = SENTENCES, least_words: int = WORDS):
    """Number of sentences; hash, start and end (exclusive) of the spans, by start and end.

    From every sentence the shortest span forward, and up to every sentence the shortest one backward, of at least
    ``least_words`` words in ``least_sentences`` sentences. A sentence of ``least_words`` words is a span by itself.
    """
    _, hashes, ends = _words(text)
    n, words_up_to = len(ends), np.r_[0, ends]
    long = np.diff(words_up_to) >= least_words
    place = np.arange(n)
    after = np.searchsorted(words_up_to, words_up_to[:-1] + least_words)
    after = np.where(long, place + 1, np.maximum(after, place + least_sentences))
    before = np.searchsorted(words_up_to, words_up_to[1:] - least_words, side="right") - 1
    before = np.where(long, place, np.minimum(before, place + 1 - least_sentences))
    forward, backward = after <= n, before >= 0
    start = np.concatenate([place[forward], before[backward]])
    end = np.concatenate([after[forward], place[backward] + 1])
    start, end = np.divmod(np.unique(start * (n + 1) + end), n + 1)
    low, high = words_up_to[start], words_up_to[end]
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64)]
    value = (total[high] - total[low]) * _powers(_INVERSE, len(hashes) + 1)[low]
    value ^= (high - low).astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53)
    return n, _mix(value).view(np.int64), start, end


def remove(text: str | None, foreign: np.ndarray, least_sentences: int, least_words: int):
    """The text without repeated sentences, and how many of them went.

    ``foreign``: hashes of spans that belong to other documents.
    """
    if not text:
        return text, 0
    n, hashes, start, end = spans(text, least_sentences, least_words)
    _, first = np.unique(hashes, return_index=True)
    gone = np.ones(len(hashes), bool)
    gone[first] = False
    gone |= np.isin(hashes, foreign)
    if not gone.any():
        return text, 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start[gone], 1)
    np.add.at(edge, end[gone], -1)
    covered = np.cumsum(edge)[:n] > 0
    bounds = sentences(text)
    kept = "".join(text[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(~covered))
    return kept.rstrip(), int(covered.sum())


def span_rows(docs: DataFrame, least_sentences: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """span (hash), doc_id: every distinct span of each row of ``docs`` (doc_id, text).

    A text that repeats a span of its own has a row more, without a span.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, counts, repeats = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            hashes = spans(text.as_py() or "", least_sentences, least_words)[1]
            found.append(np.unique(hashes))
            counts.append(len(found[-1]))
            if counts[-1] < len(hashes):
                repeats.append(doc_id)
        ids = np.repeat(batch.column(0).to_numpy(), counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(np.concatenate(found)), pa.nulls(len(repeats), pa.int64())]),
                pa.concat_arrays([pa.array(ids), pa.array(repeats, pa.int64())]),
            ],
            ["span", "doc_id"],
        )

    return map_batches(docs.where("doc_id is not null"), run, "span long, doc_id long")


def _cleaned(rows: DataFrame, least_sentences: int, least_words: int) -> DataFrame:
    """``rows`` (doc_id, text, others) with cleaned ``text`` and ``n_removed``.

    Only documents with spans of other documents or repeated ones of their own are read again.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/spans-{uuid.uuid4().hex}"
    few_files(span_rows(rows.select("doc_id", "text"), least_sentences, least_words)).write.parquet(path)
    found = spark.read.schema("span long, doc_id long").parquet(path)
    owners = (
        found.groupBy("span")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other"))
        .where("span is not null and owner < other")
        .select("span", "owner")
    )
    foreign = found.join(owners, "span").where("doc_id <> owner").select("span", "doc_id")
    foreign = foreign.unionByName(found.where("span is null"))
    foreign = cut(foreign.groupBy(F.col("doc_id").alias("span_doc")).agg(F.collect_set("span").alias("foreign_spans")))
    remove_folder(spark, path)
    ids = foreign.select("span_doc")
    if foreign.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    same, unnamed = rows["doc_id"] == F.col("span_doc"), rows["doc_id"].isNull()
    touched = rows.join(ids, same, "left_semi").join(foreign, same).drop("span_doc")
    touched = touched.unionByName(rows.where(unnamed).withColumn("foreign_spans", F.array().cast("array<long>")))
    untouched = rows.where(~unnamed).join(ids, same, "left_anti").withColumn("n_removed", F.lit(0).cast("long"))
    others = [c for c in rows.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, removed = [], []
        for text, own in zip(batch.column("text"), batch.column("foreign_spans"), strict=True):
            kept, gone = remove(text.as_py(), own.values.to_numpy(), least_sentences, least_words)
            texts.append(kept)
            removed.append(gone)
        new = [pa.array(texts, pa.string()), pa.array(removed, pa.int64())]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *new], [*others, "text", "n_removed"])

    fields = [rows.schema[c] for c in others]
    new = [T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())]
    cleaned = map_batches(touched, run, T.StructType([*fields, *new]))
    return cleaned.unionByName(untouched.select(*cleaned.columns))


def remove_repeats(
    docs: DataFrame,
    least_sentences: int = SENTENCES,
    least_words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text (without repeated sentences), n_removed of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _cleaned(rows, least_sentences, least_words)


def clean_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned ``text`` (and ``n_chars``, if there); documents that lose all text go.

    The other columns stay as they are.
    """
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    done = _cleaned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), others, "text"), SENTENCES, WORDS)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(columns["n_chars"])
    return done.where("n_removed = 0 or text <> ''").select(*(columns[c].alias(c) for c in docs.columns))
