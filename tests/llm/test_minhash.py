import random

import numpy as np
import pytest

from tests.llm.data import SCHEMA, SF, WORDS, awkward, empty, prose
from tradeline.llm import minhash, queries
from tradeline.llm.common import links_to_components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """doc_id -> (size of the set, smallest id reachable), every pair compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    want = brute(rows)
    assert got == want
    return want


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.QUERIES["op2_minhash_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randrange(1000))
    return " ".join(words)


def test_group_of_near_copies_around_one_that_is_not_the_smallest(spark):
    """Copies are alike to the original but often not to each other, and the original has a large id."""
    rng = random.Random(4)
    base = [rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(150)]
    rows = [(i, mutated(rng, base, rng.choice([1, 3, 4, 5, 8, 14]))) for i in range(260)]
    rows.append((900, " ".join(base)))
    rows += [(1000 + i, prose(i)) for i in range(60)]
    want = check(spark, rows)
    assert len({c for _, c in want.values()}) > 62  # some copies stay apart


def test_chain_is_one_component(spark):
    rng = random.Random(8)
    words, rows = [rng.choice(WORDS) + str(i) for i in range(120)], []
    for i in range(40):
        rows.append((100 - i, " ".join(words)))
        words = words[2:] + [f"new{i}a", f"new{i}b"]
    want = check(spark, rows)
    assert {c for _, c in want.values()} == {61}


def test_awkward_rows(spark):
    found = minhash.near_duplicates(awkward(spark)).collect()
    assert len(found) == awkward(spark).count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    for i in (3, 4, 5):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[7].n_shingles == 1
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert minhash.near_duplicates(empty(spark)).collect() == []


def test_keep_one_leaves_all_columns_and_one_row(spark):
    docs = awkward(spark)
    kept = minhash.keep_one(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 2
    assert minhash.keep_one(empty(spark, SCHEMA)).collect() == []


def test_texts_decide_and_not_ids(spark):
    a, b, c, d = (prose(k, 40) for k in range(4))
    near_a = a.replace(a.split()[30], "another", 1)
    rows = [(1, a), (2, b), (2, a), (3, c), (3, c), (4, near_a), (4, d), (5, d), (5, ""), (5, None), (6, b), (None, a)]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    texts = [r.text for r in kept if r.doc_id is not None]
    # One of a and near_a, b, c and d, and the rows without a shingle.
    assert sorted(t for t in texts if t) == sorted([a, b, c, d]) and len(texts) == 6
    ids = {r.text: r.doc_id for r in kept if r.text and r.doc_id is not None}
    assert ids[a] == 1 and ids[c] == 3 and ids[b] in (2, 6) and ids[d] in (4, 5)
    assert [r.text for r in kept if r.doc_id is None] == [a]


@pytest.mark.parametrize("share", [0.0, 0.5, 0.75, 0.9, 1.0])
def test_estimate_is_corrected_for_collisions(spark, share):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, int(2000 * share), np.uint64)
    rest = rng.integers(0, 1 << 63, 2 * (2000 - len(common)), np.uint64)
    half = len(rest) // 2
    a, b = np.r_[common, rest[:half]], np.r_[common, rest[half:]]
    signed = [minhash.packed(minhash.minima(x)).view(np.int64).tolist() for x in (a, b)]
    row = spark.createDataFrame([tuple(signed)], "a array<long>, b array<long>")
    got = row.select(minhash.estimate(row.a, row.b)).first()[0]
    assert abs(got - len(common) / (4000 - len(common))) < 0.11


def test_long_texts_are_hashed_in_blocks():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64))
    whole = np.minimum.reduce([minhash.minima(part) for part in np.array_split(hashes, 7)])
    assert (minhash.minima(hashes) == whole).all()


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 300)] + [(70, 70)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in links_to_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 800)}
    assert links_to_components(df.limit(0)).collect() == []
