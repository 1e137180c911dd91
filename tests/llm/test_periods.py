import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import SCHEMA, SF, awkward, empty
from tradeline.llm import periods, queries


def smallest_period(words):
    """By the longest border."""
    border = [0] * len(words)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1] if words else 0


def brute(words):
    """Every stretch of equal words at every lag, by the smallest period of the stretch itself."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and smallest_period(words[i : j + q]) == q:
                found.add((i, j - i + q, q))
            i = j + 1
    return sorted(found)


def brute_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    said = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (
        doc_id, len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2],
        hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = queries.QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(brute_row(r.doc_id, r.text) for r in rows)
    assert sum(r.n_runs > 0 for r in found) > 10 and max(r.period or 0 for r in found) >= 2 * periods.LAGS


def own_runs(words):
    return periods.runs(np.array(words, np.int64), len(words)) if words else []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_few_different_words(words):
    assert own_runs(words) == brute(words)


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False))
def test_planted_periods(rng):
    words = []
    for _ in range(rng.randrange(1, 5)):
        q = rng.randrange(1, 70)
        block = [rng.randrange(rng.choice([2, 5, 1000])) for _ in range(q)]
        words += (block * 9)[: rng.randrange(q, 9 * q + 1)] + [rng.randrange(1000) for _ in range(rng.randrange(4))]
    assert own_runs(words) == brute(words)


def test_periods_around_the_scales():
    rng = random.Random(3)
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 129, 255, 256, 511, 512]:
        for more in (-1, 0, 1):
            block = [rng.randrange(3) for _ in range(q)]
            words = [7, 8, 9] + (block * 5)[: max(6, 4 * q) + more] + [10, 11]
            assert own_runs(words) == brute(words)


def test_runs_stay_within_their_text(spark):
    rows = [(i, "a b c d e f g h i j " * 2) for i in range(20)] + [(50, "x y " * 50), (51, "y x " * 3)]
    got = {r.doc_id: r for r in periods.collapse_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].runs == [] and got[i].best is None and got[i].n_words == 20 for i in range(20))
    assert got[50].text == "x y" and tuple(got[50].best) == (0, 100, 2)
    assert got[51].runs == [] and got[51].text == "y x y x y x"


def test_a_very_long_text_is_cut_at_spaces_only(monkeypatch):
    text = " \t".join(["wörd%d" % (i % 37) for i in range(2000)])
    known: dict[str, int] = {}
    whole = periods.words_of(text, known)
    monkeypatch.setattr(periods, "SLICE_CHARS", 11)
    assert (periods.words_of(text, {}) == whole).all() and len(known) == 37


def test_awkward_rows(spark):
    docs = awkward(spark)
    plain = docs.select("doc_id", "text").collect()
    rows = periods.collapse_runs(docs).collect()
    assert len(rows) == len(plain)
    assert all(r.text == "" and r.n_words == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert sum(r.doc_id is None for r in rows) == 2
    got = periods.digests(periods.collapse_runs(periods.with_planted_runs(docs))).collect()
    want = [brute_row(r.doc_id, r.text) for r in plain if r.doc_id is not None]
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == sorted(want)
    none = periods.digests(periods.collapse_runs(periods.with_planted_runs(empty(spark, SCHEMA))))
    assert none.collect() == [] and none.columns[0] == "doc_id"
