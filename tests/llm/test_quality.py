import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrine.llm import quality as Q


@pytest.fixture(scope="module")
def corpus(spark, documents, words):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        good = i % 5 != 0
        text = words(rng, rng.randint(5, 300))
        if not good:
            kind = i % 3
            text = text.upper() if kind == 0 else " ".join(x + "%%%" for x in text.split()) if kind == 1 else " ".join(text.split()[:3] * 40)
        rows.append((i, text))
        if i % 2:
            labels.append((i, int(good)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int"), dict(zip(range(900), [i % 5 != 0 for i in range(900)], strict=True))


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    model = Q.train(docs, labels)
    rows = Q.classify(docs, model).withColumn("h", Q.held_out(F.col("doc_id"))).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(r.predicted == 1) == truth[r.doc_id] for r in rows if r.h]
    assert len(held) > 150 and np.mean(held) > 0.97
    again = Q.train(docs.repartition(7), labels)
    assert np.array_equal(again.w1, model.w1)
    assert model.converged and model.passes > 1


def test_positives_alone(corpus):
    docs, labels, truth = corpus
    model = Q.train(docs, labels.where("quality = 1"))
    assert 0.6 < model.prior < 0.95
    rows = Q.classify(docs, model, threshold=0.5).collect()
    assert np.mean([(r.predicted == 1) == truth[r.doc_id] for r in rows]) > 0.9


def test_edges(corpus, edge, spark):
    docs, labels, _ = corpus
    model = Q.train(docs, labels)
    rows = Q.classify(edge.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert Q.classify(edge.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    for bad in (labels.limit(0), odd):
        flat = Q.train(docs, bad)
        assert {r.score for r in Q.classify(docs.limit(5), flat).collect()} == {0.5}
    assert Q.train(edge.limit(0), labels).prior == 0.5


def test_newton_over_all_rows_equals_a_dense_fit(spark):
    rng = np.random.default_rng(4)
    p, u = rng.normal(0.7, 1, (300, Q.N_FEATURES)), rng.normal(0, 1, (2000, Q.N_FEATURES))
    figures = spark.createDataFrame([(i, i, x.tolist()) for i, x in enumerate(u.astype(np.float32))], "doc_id long, h long, x array<float>")

    def plain(x):
        return np.c_[x, np.ones(len(x))]

    z, every = plain(p), plain(u.astype(np.float32).astype(np.float64))

    def part(w, _):
        s = Q._sigmoid(-(z @ w))
        return 0.5 * np.logaddexp(0, -(z @ w)).mean(), -0.5 * (s @ z) / len(z), 0.5 * (z * (s * (1 - s))[:, None]).T @ z / len(z), True

    got, done = Q._newton(figures.repartition(5), plain, np.zeros(z.shape[1]), 0.5, part, 1e-3)
    assert done
    w = np.zeros(z.shape[1])
    for _ in range(20_000):  # brute force: plain descent on the same sum
        w -= 0.5 * (0.5 * (Q._sigmoid(every @ w) @ every) / len(every) - 0.5 * (Q._sigmoid(-(z @ w)) @ z) / len(z) + 1e-3 * w)
    assert np.allclose(got, w, atol=1e-4)
    refused, _ = Q._newton(figures, plain, w, 0.5, lambda w, _: (*part(w, _)[:3], False), 1e-3)
    assert np.array_equal(refused, w)


def test_all_moments(spark):
    rng = np.random.default_rng(5)
    u = rng.normal(3, 2, (500, Q.N_FEATURES)).astype(np.float32)
    figures = spark.createDataFrame([(i, i, x.tolist()) for i, x in enumerate(u)], "doc_id long, h long, x array<float>")
    mean, scale = Q._all_moments(figures.repartition(3))
    assert np.allclose(mean, u.mean(0), atol=1e-5) and np.allclose(scale, u.std(0), atol=1e-5)


def test_descent_over_all_rows_equals_a_dense_one(spark):
    rng = np.random.default_rng(6)
    p = rng.normal(0.8, 1, (200, Q.N_FEATURES))
    u = np.vstack([rng.normal(0.8, 1, (700, Q.N_FEATURES)), rng.normal(-0.6, 1.5, (500, Q.N_FEATURES))]).astype(np.float32)
    figures = spark.createDataFrame([(i, i, x.tolist()) for i, x in enumerate(u)], "doc_id long, h long, x array<float>")
    theta = rng.normal(0, 0.3, Q.N_FEATURES * Q.HIDDEN + 2 * Q.HIDDEN + 1)
    plain = lambda x: np.c_[x, np.ones(len(x))]
    prior, every = 0.55, u.astype(np.float64)

    def value(t):  # brute force: the risk over all rows, written out
        w1, b1, w2, b2 = Q._unpack(t)
        g = lambda x: np.tanh(x @ w1 + b1) @ w2 + b2
        return -prior * g(p).mean() + np.logaddexp(0, g(every)).mean() + 0.5e-4 * float(t @ t)

    def objective(sums):
        def at(t):
            mean, gradient = sums(t)
            h, g = Q._outputs(p, t)
            pull = Q._gradients(p, h, np.full(len(g), 1 / len(g)), t).sum(0)
            return mean - prior * g.mean() + 0.5e-4 * float(t @ t), gradient - prior * pull + 1e-4 * t, mean >= prior * np.logaddexp(0, g).mean()

        return at

    def dense(t):
        h, g = Q._outputs(every, t)
        return np.logaddexp(0, g).mean(), Q._gradients(every, h, Q._sigmoid(g), t).mean(0)

    got = objective(lambda t: Q._network_sums(figures, plain, t))(theta)
    assert abs(got[0] - value(theta)) < 1e-7
    for i in rng.integers(0, len(theta), 12):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        assert abs((value(theta + step) - value(theta - step)) / 2e-5 - got[1][i]) < 1e-6
    one, passes, done = Q._descend(objective(lambda t: Q._network_sums(figures, plain, t)), theta)
    two, _, _ = Q._descend(objective(dense), theta)
    assert done and passes > 3 and value(one) < value(theta)
    assert np.allclose(Q._outputs(every, one)[1], Q._outputs(every, two)[1], atol=1e-3)
    again, _, _ = Q._descend(objective(lambda t: Q._network_sums(figures.repartition(7), plain, t)), theta)
    assert np.array_equal(one, again)
