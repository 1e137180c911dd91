"""Near duplicates by b-bit MinHash with exact confirmation.

1. Every text becomes the set of its distinct shingles (64-bit hashes), a digest of that set, 256
   minima, and hashes of bands of four minima. Only the low ``BITS`` bits of the minima are kept,
   packed into longs. Equal sets become one class, by a combined aggregate.
2. Classes that share a band hash form a bucket. Each member is paired with the smallest of its bucket,
   not with all. Pairs whose similarity, estimated by bit counts and corrected for chance collisions,
   lies far below the threshold are dropped; the others are confirmed on full sets.
3. Buckets that still hold several components are then compared completely, but inside tasks: in blocks,
   members outside the bucket's largest component meet all members. First by packed signatures; members
   with a promising partner then meet again with their full sets. No pair of them becomes a row; only
   links leave a task, and members that are linked already are not compared again.
4. Links become components; a document carries the smallest id of its own.

A pair at the threshold shares no band with probability (1 - t^4)^32 = 5e-6 and fails the estimate's
margin (over four standard deviations) about as rarely. Hot buckets: aggregates combine before the
shuffle, inner joins can be split by Spark, and blocks and confirmations are dealt by salted keys.

Cases: a null or empty text, or one of white space, has no shingles and is linked with nothing; a text
of fewer words than a shingle is one shingle. A null doc_id takes part in nothing: component_id null,
kept. Equal rows share a class, so all rows that carry the smallest id are kept here (``keep_one``
then leaves one). Extra columns are ignored. Whole texts are hashed, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import cut, links_to_components, map_batches

WORDS, THRESHOLD = 5, 75  # a shingle's words; similarity in per cent
PERMUTATIONS, BITS, BANDS, ROWS = 256, 4, 32, 4
#: Estimates below this are never confirmed: the threshold less 4.6 standard deviations.
LEAST_ESTIMATE = 0.62
#: Rows of a confirmation group and of a signature block; pairs (two rows of numbers each) that may be broadcast.
GROUP, BLOCK, BROADCAST_PAIRS = 512, 1024, 200_000

_PER_LONG = 64 // BITS
_REMEMBERED = 300_000

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, PERMUTATIONS, np.uint32)
_PLACE = _rng.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def _forget() -> None:
    """Drop the hashes of words when a task ends."""
    _words.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at space and tab to carriage return.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > _REMEMBERED:
        _words.clear()
    value = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(value))
    n = len(value) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += value[i : i + n] * _PLACE[i]
    return np.unique(_mixed(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation, in blocks that stay in the processor's cache."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 512):
        values = _MULTIPLY[:, None] * x[None, start : start + 512]
        values += _ADD[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``_PER_LONG`` in a long."""
    bits = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, _PER_LONG)
    return (bits << (np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def band_hashes(low: np.ndarray) -> np.ndarray:
    """One hash for each band, with the band's number in it."""
    part = low[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    total = (part * _PLACE[:ROWS]).sum(axis=1, dtype=np.uint64)
    return _mixed(total + np.arange(BANDS, dtype=np.uint64) * _PLACE[8])


def signatures(docs: DataFrame, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest, signature, bands of every row (the last three null for an empty set)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count, digest, signature, bands = [], [], [], []
        for text in batch.column(1):
            hashes = shingles(text.as_py(), size)
            count.append(len(hashes))
            low = minima(hashes)
            digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
            signature.append(packed(low).view(np.int64) if len(hashes) else None)
            bands.append(band_hashes(low).view(np.int64) if len(hashes) else None)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.binary()),
                pa.array(signature, longs), pa.array(bands, longs),
            ],
            ["doc_id", "n_shingles", "digest", "signature", "bands"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_shingles long, digest binary, signature array<long>, bands array<long>"
    return map_batches(rows, run, schema, _forget)


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for minima that agree by chance."""
    places = sum(1 << (BITS * i) for i in range(_PER_LONG))

    def unequal(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        for shift in range(BITS.bit_length() - 1):
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, 1 << shift))
        return F.bit_count(differ.bitwiseAND(F.lit(places)))

    missed = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda total, x: total + x)
    chance = 2.0**-BITS
    return (1 - missed / F.lit(float(PERMUTATIONS)) - chance) / (1 - chance)


def confirm(docs: DataFrame, pairs: DataFrame, threshold: int = THRESHOLD, size: int = WORDS) -> DataFrame:
    """The ``pairs`` (a, b: ids in ``docs``) whose full sets reach the threshold, as u, v.

    Sets are built only for texts that occur in a pair, and meet in groups of about ``GROUP`` members
    with the set of their ``a``; a frequent ``a`` is repeated for each of its groups.
    """
    pairs = cut(pairs)
    heads = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    work = (
        pairs.join(heads, "a")
        .select(F.col("b").alias("node"), "a", F.expr("pmod(xxhash64(b), groups)").cast("int").alias("part"), F.lit(1).alias("side"))
        .unionByName(
            heads.select(
                F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("side")
            )
        )
    )
    if pairs.count() <= BROADCAST_PAIRS:  # at most two rows for each pair
        work = F.broadcast(work)

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, last, value = [], None, b""
        for text in batch.column(4):
            if last is None or text != last:  # rows of one text follow each other
                last, value = text, shingles(text.as_py(), size).tobytes()
            found.append(value)
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.binary())], ["node", "a", "part", "side", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, head = None, []
        for batch in batches:
            u, v = [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for node, a, part, side, hashes in zip(*columns, batch.column(4), strict=True):
                if (a, part) != group:
                    group, head = (a, part), []
                own = np.frombuffer(hashes.as_buffer(), np.uint64)
                if side == 0:
                    head.append(own.copy())
                elif any(_similar(h, own, threshold) for h in head):
                    u.append(a)
                    v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    texts = docs.select(F.col("doc_id").alias("node"), "text").join(work, "node")
    texts = texts.select("node", "a", "part", "side", "text")
    grouped = map_batches(texts, sets, "node long, a long, part int, side int, hashes binary", _forget)
    grouped = grouped.repartition("a", "part").sortWithinPartitions("a", "part", "side", "node")
    return grouped.mapInArrow(compare, "u long, v long")


def _similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < threshold * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _promising(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose sizes and estimate allow the threshold."""
    facts = classes.select("node", "n_shingles", "signature")
    for side in "ab":
        pairs = pairs.join(facts.toDF(side, f"n_{side}", f"s_{side}"), side)
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold
    return pairs.where(near & (estimate(F.col("s_a"), F.col("s_b")) >= LEAST_ESTIMATE)).select("a", "b")


def _against_smallest(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's smallest."""
    least = members.groupBy("key").agg(F.min("node").alias("a"))
    return members.join(least, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _labelled(members: DataFrame, components: DataFrame) -> DataFrame:
    """Bucket members (key, node) with their component so far, of buckets that hold several."""
    found = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        found.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key")
    )
    return found.join(mixed, "key")


#: What a block needs to know of a member.
_FACTS = ["node", "component", "n_shingles", "signature", "bands"]
_FACT_TYPES = "node long, component long, n_shingles long, signature array<long>, bands array<long>"
_PLACES = np.uint64(sum(1 << (BITS * i) for i in range(_PER_LONG)))
_MOST_UNEQUAL = int(PERMUTATIONS * (1 - 2.0**-BITS) * (1 - LEAST_ESTIMATE))


class _Held:
    """The members on one side of a block, and which of them may reach the threshold with another.

    Of the buckets that two members share only the first band's compares them.
    """

    def __init__(self, key: int, rows: list[tuple]):
        self.key = key
        self.nodes, self.components, self.sizes = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.signatures = np.array([r[3] for r in rows], np.int64).view(np.uint64)
        self.bands = np.array([r[4] for r in rows], np.int64)

    def near(self, component: int, size: int, signature: list[int], bands: list[int], threshold: int) -> np.ndarray:
        least, most = np.minimum(self.sizes, size), np.maximum(self.sizes, size)
        at = np.flatnonzero((self.components != component) & (100 * least >= threshold * most))
        own = np.array(bands, np.int64)
        at = at[(self.bands[at] == own).argmax(axis=1) == np.flatnonzero(own == self.key)[0]]
        differ = self.signatures[at] ^ np.array(signature, np.int64).view(np.uint64)
        for shift in range(BITS.bit_length() - 1):
            differ |= differ >> np.uint64(1 << shift)
        return at[np.bitwise_count(differ & _PLACES).sum(axis=1) <= _MOST_UNEQUAL]


def _blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """key, i, j, side and facts: members outside a bucket's largest component (side 0) meet all (side 1)."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("all_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK).cast("int").alias("few_blocks"),
    )
    rows = members.join(sizes, "key").join(classes.select("node", "n_shingles", "signature", "bands"), "node")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    few = rows.where("component <> largest").select(
        "key", dealt("few_blocks").alias("i"), spread("all_blocks").alias("j"), F.lit(0).alias("side"), *_FACTS
    )
    every = rows.select("key", spread("few_blocks").alias("i"), dealt("all_blocks").alias("j"), F.lit(1).alias("side"), *_FACTS)
    return few.unionByName(every)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "node")


def _taking_part(rows: DataFrame, threshold: int) -> DataFrame:
    """Those rows of the blocks that have a promising partner in their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, own, used = None, [], None, None
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["key", "i", "j", "side", *_FACTS]

        def first_side() -> list[tuple]:
            return [(*block, 0, *held[at]) for at in np.flatnonzero(used)] if own is not None else []

        def made(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else ((),) * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            out: list[tuple] = []
            for key, i, j, side, *facts in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if (key, i, j) != block:
                    out += first_side()
                    block, held, own = (key, i, j), [], None
                if side == 0:
                    held.append(facts)
                    continue
                if own is None and held:
                    own, used = _Held(key, held), np.zeros(len(held), bool)
                if own is not None:
                    at = own.near(*facts[1:], threshold)
                    if len(at):
                        used[at] = True
                        out.append((*block, 1, *facts))
            yield made(out)
        yield made(first_side())

    return rows.mapInArrow(run, f"key long, i int, j int, side int, {_FACT_TYPES}")


def _confirm_blocks(docs: DataFrame, rows: DataFrame, threshold: int, size: int) -> DataFrame:
    """u, v: links within blocks, confirmed on full sets; members linked already are not compared again."""
    rows = cut(rows)
    nodes = cut(rows.select("node").distinct())
    if nodes.count() <= BROADCAST_PAIRS:
        nodes = F.broadcast(nodes)

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t.as_py(), size).tobytes() for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "hashes"])

    texts = docs.select(F.col("doc_id").alias("node"), "text").join(nodes, "node")
    found = map_batches(texts, sets, "node long, hashes binary", _forget)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, hashes, own = None, [], [], None
        merged: dict[int, int] = {}

        def label(component: int) -> int:
            while component in merged:
                component = merged[component]
            return component

        for batch in batches:
            u, v = [], []
            columns = (batch.column(n).to_pylist() for n in ("key", "i", "j", "side", *_FACTS))
            for key, i, j, side, *facts, value in zip(*columns, batch.column("hashes"), strict=True):
                if (key, i, j) != block:
                    block, held, hashes, own = (key, i, j), [], [], None
                    merged.clear()
                value = np.frombuffer(value.as_buffer(), np.uint64)
                if side == 0:
                    held.append(facts)
                    hashes.append(value.copy())
                    continue
                if not held:
                    continue
                own = own or _Held(key, held)
                component = label(facts[1])
                for at in own.near(component, *facts[2:], threshold):
                    if own.components[at] != component and _similar(hashes[at], value, threshold):
                        u.append(int(own.nodes[at]))
                        v.append(facts[0])
                        merged[int(own.components[at])] = component
                        own.components[own.components == own.components[at]] = component
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return _together(rows.join(found, "node")).mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, threshold: int = THRESHOLD, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Components follow links of at least ``threshold`` per cent common shingles (at least 75, for
    which bands and margin are made).
    """
    if threshold < THRESHOLD:
        raise ValueError(f"bands are made for thresholds of {THRESHOLD} per cent or more")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = cut(signatures(docs, size))
    classes = cut(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("n_shingles", "signature", "bands")))
    )
    members = classes.select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(members.join(shared, "key").select("key", "node", "n"))

    pairs = _against_smallest(members)
    links = cut(confirm(docs, _promising(pairs, classes, threshold), threshold, size))
    components = cut(links_to_components(links))
    larger = members.where("n > 2").select("key", "node")
    blocks = _together(_blocks(cut(_labelled(larger, components)), classes))
    more = _confirm_blocks(docs, _taking_part(blocks, threshold), threshold, size)
    components = cut(links_to_components(links.unionByName(more)))

    labels = classes.select("digest", "node").join(components, "node", "left")
    labels = labels.select("digest", F.coalesce("component", "node").alias("label"))
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(labels, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _row_keys(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` (id not null) as row_key, row: one key for each different id and text.

    The text with the smallest hash has its id as key. Other texts of the same id have keys above all ids, so
    that they are documents of their own that come last.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("row_key"), F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    texts = rows.select("row_key", "text_hash")
    least = texts.groupBy("row_key").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
    least = cut(least.where("low < high").select("row_key", "low"))
    if least.isEmpty():
        return rows.select("row_key", "row")
    top = texts.agg(F.max("row_key")).first()[0]
    others = texts.join(least, "row_key").where("text_hash <> low").select("row_key", "text_hash").distinct()
    others = cut(others.withColumn("own_key", F.monotonically_increasing_id() + F.lit(top + 1)))
    joined = rows.join(others, ["row_key", "text_hash"], "left")
    return joined.select(F.coalesce("own_key", "row_key").alias("row_key"), "row")


def keep_one(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` without near copies: of each component one row, the one with the smallest id.

    Texts decide, not ids: different texts under one id are documents of their own, and each stays unless it is a near
    copy of another. Of equal rows of one id one stays. All columns of ``docs`` stay. Rows with a null id stay.
    """
    keyed = _row_keys(docs.where(F.col(id_col).isNotNull()), id_col)
    texts = keyed.select("row_key", F.col("row.text").alias("text"))
    kept = near_duplicates(texts, id_col="row_key").where("kept").select(F.col("doc_id").alias("row_key")).distinct()
    one = keyed.join(kept, "row_key").groupBy("row_key")
    one = one.agg(F.min_by("row", F.to_json(F.col("row").dropFields("text"))).alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
