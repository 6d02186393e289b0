import numpy as np
import pytest

from spectrine.llm import topk as T


def brute(rows, is_query, k):
    out = []
    for q, x in rows:
        if is_query(q):
            scores = sorted(((-int(np.dot(x, y)), c) for c, y in rows if c != q))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 30, 900])
def test_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(T, "QUERIES", 16)
    monkeypatch.setattr(T, "CANDIDATES", 200)
    rng = np.random.default_rng(n)
    data = rng.normal(scale=0.1, size=(n, 24)).astype(np.float32)
    if n > 100:
        data[50:90] = data[0]  # copies and ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    v = T.quantise(df)
    got = sorted(tuple(r) for r in T.top_k(v.where("id % 20 = 0"), v).collect())
    rows = [(i, np.floor(64 * x.astype(np.float64)).astype(np.int64)) for i, x in enumerate(data)]
    assert got == brute(rows, lambda i: i % 20 == 0, 20)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [1.0]), (8, [-1.0, 0.5]), (0, [1.0, 2.0]), (9, [1e6, 1e6]), (20, [3.0])]
    v = T.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(tuple(r) for r in T.top_k(v.where("id % 20 = 0"), v).collect())
    s = 64 * 64
    assert got == [(0, 1, 9, 3_000_000 * s), (0, 2, 1, 5 * s), (0, 3, 8, 0), (20, 1, 7, 3 * s)]


def test_large_components_and_empty_vectors_take_part(spark):
    rows = [(0, [2.0**26, 1.0]), (1, [1.0, 2.0**25]), (2, [-(2.0**24), 0.0]), (20, []), (21, [])]

    def search(rows):
        v = T.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        return sorted(tuple(r) for r in T.top_k(v.where("id % 20 = 0"), v).collect())

    s = 64 * 64
    assert search(rows) == [(0, 1, 1, (2**26 + 2**25) * s), (0, 2, 2, -(2**50) * s), (20, 1, 21, 0)]
    for wide in ([2.0**40, 0.0], [1e300, 0.0]):
        with pytest.raises(Exception, match="range of 64 bits"):
            search([(0, wide), (1, wide)])


def test_bounds_hold():
    rng = np.random.default_rng(0)
    q, c = rng.integers(-99, 99, (40, 50)).astype(float), rng.integers(-99, 99, (60, 50)).astype(float)
    before = None
    for parts in (1, 4, 16, 50):
        bound = T._stats(q, parts) @ T._stats(c, parts).T
        assert (bound + 1e-6 >= q @ c.T).all()
        if before is not None:
            assert bound.mean() <= before
        before = bound.mean()


def test_repeated_candidates_each_count(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0]), (1, [2.5])]
    v = T.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [tuple(r) for r in T.top_k(v.where("id % 20 = 0"), v, k=4).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 3 * 64 * 64), (0, 2, 1, 160 * 64), (0, 3, 1, 2 * 64 * 64), (0, 4, 1, 2 * 64 * 64)]


def test_bounds_prune_vectors_with_structure(spark, monkeypatch):
    monkeypatch.setattr(T, "SAMPLE", 256)
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(3000, 6)) * [9, 6, 4, 2, 1, 0.5]) @ rng.normal(size=(6, 64)) + rng.normal(scale=0.05, size=(3000, 64))
    v = T.quantise(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, embedding array<double>")).cache()
    queries = v.where("id % 50 = 0")
    left = {r.segments: r.survivors / r.pairs for r in T.pruning(queries, v, k=5).collect()}
    assert 1 >= left[1] >= left[4] >= left[16] >= left[32] and left[0] < 0.2
    got = sorted(tuple(r) for r in T.top_k(queries, v, k=5).collect())
    rows = [(i, np.floor(64 * x).astype(np.int64)) for i, x in enumerate(data)]
    assert got == brute(rows, lambda i: i % 50 == 0, 5)
