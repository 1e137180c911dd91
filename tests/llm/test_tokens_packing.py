import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.data import SF, awkward, empty
from tradeline.llm import packing, queries, tokens

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
LIBRARY = {path: Tokenizer.from_file(path) for path in (WORD, BYTE)}

PARTS = ["the", "'s", "'LL", " ", "  ", "\n", "\t", "1", "234", "½", "é", "é", "ß", "İ", "Σς", "北京", "!!", "<|", "<|endoftext|>",
         "<|startoftext|>", "\x1c", "\x85", "\xa0", "aaaaaaa", "👍🏽", "_", "ﬁ", "-", "​"]
texts = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=25).map("".join)


def library_ids(path, text):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4))
def test_counts_are_the_library_s(some):
    assert tokens.counter(WORD).count(some) == [len(library_ids(WORD, t)) for t in some]


@settings(max_examples=300, deadline=None)
@given(texts)
def test_ids_are_the_library_s(text):
    assert np.frombuffer(packing.text_ids(BYTE)(text), "<u4").tolist() == library_ids(BYTE, text)


def test_a_cut_text_has_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "_CUT_CHARS", 30)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(PARTS + ["word "] * 20) for _ in range(80))
        assert np.frombuffer(packing.text_ids(BYTE)(text), "<u4").tolist() == library_ids(BYTE, text)


def test_long_runs_and_bounded_memory(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "CHUNK", 5)
    some = ["a" * 3000, "ab" * 999 + "c", "one two three four five six seven " * 5, "x"]
    assert tokens.TokenCounter(WORD).count(some) == [len(library_ids(WORD, t)) for t in some]


def test_token_query_on_whole_table(spark):
    rows = queries.QUERIES["op3_token_counts"](spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        n = len(library_ids(WORD, text[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 2048)


def test_awkward_rows_are_counted(spark):
    docs = awkward(spark)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs).collect())
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library_ids(WORD, r.text or ""))) for r in docs.collect())
    assert got == want
    assert tokens.count_tokens(empty(spark)).collect() == []


@pytest.mark.parametrize("windows", [1, 3, 40])
def test_differencing_places_every_piece(windows):
    sizes = np.random.default_rng(windows).integers(1, 257, 173)
    window, fill = packing.difference(sizes, windows)
    assert np.bincount(window, weights=sizes, minlength=windows).tolist() == fill.tolist()
    assert (np.diff(fill) <= 0).all()


def test_windows_rise_until_they_fit():
    sizes = np.array([200, 200, 200])  # two windows of 300 would do, but no two pieces fit
    window = packing.windows_of(sizes, 300)
    assert sorted(window) == [0, 1, 2]


def check_pieces(rows, text_of):
    """Pieces against the library's ids: complete, gapless, within capacity; returns the sequences' fills."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == text_of.keys()
    for doc_id, pieces in by_doc.items():
        want = np.array(library_ids(BYTE, text_of[doc_id]) + [0], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(want[at : at + p.length].tobytes())
            at += p.length
        assert at == len(want)
    fills = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        fills.append(at)
    assert max(fills) <= 1024
    return fills


def test_packing_query_on_whole_table(spark):
    rows = queries.QUERIES["op7_packing"](spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fills = check_pieces(rows, text)
    assert len(fills) <= -(-sum(fills) // 1024) + 8 + len(fills) * 0.01


def test_awkward_rows_are_packed(spark):
    docs = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    pieces = packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))
    check_pieces(pieces.collect(), {r.doc_id: r.text or "" for r in docs.collect()})
    every = packing.pack(awkward(spark)).collect()
    assert sum(p.start == 0 for p in every) == awkward(spark).count()
    assert packing.pack(empty(spark)).collect() == []


def test_small_groups_keep_sequences_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs, capacity=64, grain=16, group=4).withColumn("ids_crc32", F.crc32("ids"))
    fills = check_pieces(pieces.collect(), {r.doc_id: r.text or "" for r in docs.collect()})
    assert max(fills) <= 64
