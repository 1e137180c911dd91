import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, SF, awkward, empty, prose
from tradeline.llm import fingerprints, queries


def shingles(text):
    marked = "\0" * 23 + text + "\0" * 23
    return {marked[i : i + 24] for i in range(len(text) + 23)} if text else set()


def resemblance(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / max(1, len(a | b))


def edited_texts(rows):
    """doc_id, text, edited, next by position in the ordered list."""
    rows = sorted(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        quarter = len(text) // 4
        yield i, text, (text[:-quarter] if quarter else text) + after[:quarter], after


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op13_document_fingerprints"](spark, SF).collect()}
    assert len(got) == len(rows)
    errors = []
    for i, text, edited, after in edited_texts(rows):
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprints.fingerprint(text, fingerprints.sketch(text))
        assert r.edited_fingerprint == fingerprints.fingerprint(edited, fingerprints.sketch(edited))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        errors += [r.near_edited - resemblance(text, edited), r.near_next - resemblance(text, after)]
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.06


def test_sketch_keeps_a_fixed_share_of_all_shingles():
    text = "".join(random.Random(2).choices("abcdefghij ", k=100_000))
    kept = fingerprints.sketch(text)
    assert abs(len(kept) / len(shingles(text)) * fingerprints.SCALE - 1) < 0.05
    assert (np.diff(kept) > 0).all() and kept.max() < 1 << 36


def test_slices_give_the_sketch_of_the_whole(monkeypatch):
    texts = [prose(1), "x", "é" * 23, prose(2)[:24], prose(3)[:100]]
    whole = [fingerprints.sketch(t) for t in texts]
    for size in (1, 7, 24, 100):
        monkeypatch.setattr(fingerprints, "SLICE_CHARS", size)
        assert all((fingerprints.sketch(t) == w).all() for t, w in zip(texts, whole))


def test_a_part_is_contained_in_a_much_longer_text_and_sketches_merge(spark):
    part, other = prose(1, 60), prose(2, 60)
    whole = " ".join([prose(3, 800), part, prose(4, 800)])
    rows = [(1, part), (2, whole), (3, other), (4, prose(3, 800))]
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    pairs = found.alias("a").crossJoin(found.alias("b"))
    got = {
        (r.i, r.j): (r.c, r.n)
        for r in pairs.select(
            F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j"),
            fingerprints.containment(F.col("a.sketch"), F.col("b.sketch")).alias("c"),
            fingerprints.likeness(F.col("a.sketch"), F.col("b.sketch")).alias("n"),
        ).collect()
    }
    assert got[1, 2][0] > 0.97 and got[1, 2][1] < 0.1 and got[3, 2][0] < 0.1 and got[1, 1] == (1.0, 1.0)
    both = fingerprints.merged(found.where("doc_id in (1, 3)").withColumn("one", F.lit("k")), "one")
    want = np.union1d(fingerprints.sketch(part), fingerprints.sketch(other))
    assert sorted(r.hash for r in both.collect()) == want.tolist()


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_order_over_ranges_and_a_repeated_row(spark, monkeypatch, ranges):
    rng = random.Random(ranges)
    ids = rng.sample(range(-(10**12), 10**12), 120)
    rows = [(i, prose(k, 2)[: rng.randrange(200)]) for k, i in enumerate(ids)]
    hot = (sorted(ids)[rng.randrange(len(ids))], "the same row " * 20)
    rows = [r for r in rows if r[0] != hot[0]]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        df = spark.createDataFrame(rows + [hot] * 60, "doc_id long, text string").repartition(5)
        got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.against_next(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edited_texts([*rows, hot])]
    want += [r for r in want if r[0] == hot[0]] * 59
    assert sorted(got) == sorted(want)


def test_copies_and_single_documents(spark):
    text = prose(9)
    df = spark.createDataFrame([(3, text), (5, text), (9, text.upper())], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.against_next(df).collect()}
    assert got[3].near_next == 1 and got[3].fingerprint == got[5].fingerprint != got[9].fingerprint
    one = fingerprints.against_next(spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = fingerprints.against_next(docs).collect()
    assert len(rows) == docs.count() and sum(r.doc_id is None for r in rows) == 2
    blank = [r for r in rows if r.doc_id in (3, 4)]
    assert len({r.fingerprint for r in blank}) == 1 and all(r.n_chars == 0 for r in blank)
    assert all(r.edited_sha256 == hashlib.sha256(b"").hexdigest() for r in blank)
    assert [r for r in rows if r.doc_id == 1][0] == [r for r in rows if r.doc_id == 1][1]
    # Rows of id 1 and 2 have the same text.
    assert all(r.near_next == 1 for r in rows if r.doc_id == 1)
    plain = fingerprints.fingerprints(docs).collect()
    assert sorted((r.fingerprint for r in plain)) == sorted(r.fingerprint for r in rows)
    assert fingerprints.against_next(empty(spark, SCHEMA)).collect() == []
