import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrine.llm import near_dup as N
from spectrine.llm.components import components
from spectrine.llm.scratch import Scratch


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n):
    s = [(i, shingle_set(t, n)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            both = len(s[a][1] & s[b][1])
            if both and 100 * both >= 80 * (len(s[a][1]) + len(s[b][1]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    root = {}
    for k, (i, _) in enumerate(s):
        root[find(k)] = min(root.get(find(k), i), i)
    return sorted((i, len(x), root[find(k)], root[find(k)] == i) for k, (i, x) in enumerate(s))


@pytest.mark.parametrize("n", [4, 5])
def test_brute_force(documents, words, n):
    rng = random.Random(n)
    rows = []
    for g in range(60):
        base = words(rng, rng.choice([1, 3, 6, 20, 60, 200])).split()
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.randrange(max(1, len(base) // 22) + 1)):
                own[rng.randrange(len(own))] = f"edit{rng.random()}"
            rows.append((rng.randrange(10**9), rng.choice([" ", "\n"]).join(own) if g % 2 else " ".join(own).upper()))
    chain = words(rng, 120).split()  # neighbours are linked, ends are not
    for k in range(8):
        rows.append((10**9 + 8 - k, " ".join(chain[4 * k :] + [f"tail{k}_{j}" for j in range(2 * k)])))
    passage = words(rng, 60)
    rows += [(2 * 10**9 + k, words(rng, 120) + " " + passage) for k in range(40)]
    got = sorted(tuple(r) for r in N.near_duplicates(documents(rows), words=n).collect())
    assert got == brute(rows, n)


def test_edges(edge, documents):
    rows = N.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.kept for r in rows) and {r.n_shingles for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    assert N.near_duplicates(edge.limit(0)).count() == 0
    kept = N.drop_near_duplicates(documents([(5, "same text here"), (3, "Same  text HERE"), (9, ""), (8, ""), (None, "same text here")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "9", "None"]


def test_signature_index_finds_all_pairs_within_the_distance(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-30000, 30000, N.VALUES).astype(int)
    rows = [(0, base.tolist())]
    for i in range(1, 200):
        other = base.copy()
        wrong = rng.choice(N.VALUES, N.DISTANCE, replace=False)
        other[wrong] += 1
        rows.append((i, other.tolist()))
    df = spark.createDataFrame(rows, "node long, sig array<smallint>").select("node", F.explode(N._keys()).alias("key"))
    own = {r.key for r in df.where("node = 0").collect()}
    hit = {r.node for r in df.collect() if r.key in own}
    assert hit == set(range(200))


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "t").collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {k: v for k, v in parent.items() if k != v}


def test_repeated_ids_are_judged_by_their_own_text(documents, words):
    rng = random.Random(11)
    base, other = words(rng, 60), words(rng, 60)
    rows = [(3, base), (7, base + " tail"), (7, other), (7, other), (9, other + " end"), (5, words(rng, 40)), (5, words(rng, 40)), (6, ""), (6, "")]
    df = documents(rows)
    got = sorted(tuple(r) for r in N.near_duplicates(df).collect())
    assert got == brute(rows, 5)
    kept = sorted((r.doc_id, r.text) for r in N.drop_near_duplicates(df).collect())
    assert kept == sorted([rows[0], (7, other), rows[5], rows[6], (6, ""), (6, "")])


def test_near_copies_under_one_id_leave_one_row(documents, words):
    text = words(random.Random(2), 80)
    df = documents([(4, text), (4, text + " x"), (4, text.upper()), (8, text)])
    out = N.drop_near_duplicates(df.withColumn("component", F.lit(1)).withColumn("row_id", F.lit(2)).withColumn("part", F.lit(3)))
    assert [(r.doc_id, r.component, r.row_id, r.part) for r in out.collect()] == [(4, 1, 2, 3)]


def test_parity_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 30, 500, 5000):
        a, b = (np.unique(rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)) for _ in range(2))
        b = np.unique(np.r_[a[: int(0.9 * n)], b[: n // 5]])
        differ = sum(int(x).bit_count() for x in (N.parity(a) ^ N.parity(b)).view(np.uint64))
        true = len(np.setxor1d(a, b))
        assert differ <= true and (n > 500 or differ >= 0.8 * true)


def test_a_group_of_perturbed_copies(spark, documents, words, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    rng = random.Random(4)
    base = words(rng, 90).split()
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(7)):
            own[rng.randrange(len(own))] = f"e{rng.random()}"
        rows.append((rng.randrange(10**6), " ".join(own)))
    assert sorted(tuple(r) for r in N.near_duplicates(documents(rows), words=4).collect()) == brute(rows, 4)


def test_skewed_lookup(spark, monkeypatch):
    from spectrine.llm import skew

    monkeypatch.setattr(skew, "MOST", 4)
    left = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id") % 7).alias("k"), "id", F.lit("x").alias("part"))
    right = left.groupBy("k").agg(F.count("*").alias("w")).where("k <> 3").withColumn("v", F.col("k") * 10)
    for how in ("inner", "left"):
        got = sorted((r.k, r.id, r.v, r.part) for r in skew.weighted_lookup(left, right, ["k"], "w", how=how, least=100).collect())
        want = sorted((r.k, r.id, r.v, r.part) for r in left.join(right.drop("w"), "k", how).collect())
        assert [str(x) for x in got] == [str(x) for x in want]
