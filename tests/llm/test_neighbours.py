import numpy as np
import pytest

from tests.llm.data import SF, empty
from tradeline.llm import neighbours, queries


def brute(rows, k=20, every=20):
    """query -> (id, score) of all candidates, nearest first."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order[:k]]
    return out


def result(found):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def recall(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert len(got[q]) == len(want[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_query_against_all_pairs(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = result(queries.QUERIES["op4_nearest_neighbours"](spark, sf)), brute(rows)
    assert recall(got, want) >= 0.93
    x = dict(rows)
    for q, found in got.items():
        for v, score in found:
            assert abs(score - np.dot(np.array(x[q], float), np.array(x[v], float))) < 1e-12


def test_lengths_differ_and_a_third_are_equal(spark, monkeypatch):
    """Norms vary, so the largest product is not the nearest by angle; small groups split the hot list."""
    monkeypatch.setattr(neighbours, "GROUP", 100)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(1500, 24)) * rng.uniform(0.2, 3, (1500, 1))
    x[rng.random(1500) < 0.34] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = result(neighbours.nearest(df)), brute(rows)
    assert recall(got, want) >= 0.93
    same = [q for q in want if rows[q][1] == rows[7][1]]
    assert same
    for q in same:  # nothing but equal vectors and longer ones; ties by id
        assert got[q] == want[q]


def test_few_candidates_are_all_returned(spark):
    rows = [(20 * i, [float(i + 1), 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(neighbours.nearest(df)) == brute(rows)


def test_awkward_vectors_take_no_part(spark):
    good = [(i, [1.0 + i, 2.0, -1.0]) for i in range(25)]
    bad = [
        (100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [1.0, float("nan"), 0.0]),
        (200, [float("inf"), 1.0, 1.0]), (220, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]),
    ]
    rows = [(i, v, 0.5, 1) for i, v in good + bad + good[:3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double, rank int")
    assert result(neighbours.nearest(df)) == brute(good)
    assert neighbours.nearest(empty(spark, "vec_id long, embedding array<float>")).collect() == []


def test_rotation_keeps_the_order_of_products():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(50, 8)), rng.normal(size=(1, 8))
    turn, _ = np.linalg.qr(rng.normal(size=(9, 9)))
    index = neighbours.Index(turn, float((x * x).sum(axis=1).max()), None, 1)
    distance = ((index.turned(x, False) - index.turned(q, True)) ** 2).sum(axis=1)
    assert (np.argsort(distance) == np.argsort(-(x @ q[0]))).all()


def test_groups_hold_small_lists_and_split_long_ones():
    index = neighbours.Index(None, 0, None, 1)
    sizes = np.array([10, 8000, 500, 30000, 5, 0, 7])
    neighbours.assign_groups(index, sizes)
    used = [set(range(f, f + s)) for f, s in zip(index.first, index.splits)]
    assert len(used[3]) == -(-30000 // neighbours.GROUP) and not any(used[3] & used[i] for i in (0, 1, 2, 4))
    load = {}
    for size, own in zip(sizes, used):
        for g in own:
            load[g] = load.get(g, 0) + size / len(own)
    assert max(load.values()) <= neighbours.GROUP
