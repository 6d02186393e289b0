import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrine.errors import DataError
from spectrine.functions import kernels
from spectrine.operators import split


def table(spark, x, group=None):
    rows = [(i, r.tolist(), None if group is None else group[i]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "sample_id long, spectrum array<double>, kind string")


def brute(x, n_train):
    """All squared distances by differences, one choice after another."""
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    i, j = min(((i, j) for i in range(len(x)) for j in range(i + 1, len(x))), key=lambda p: (-d[p], p))
    chosen = [i, j][:n_train]
    while len(chosen) < n_train:
        rest = [k for k in range(len(x)) if k not in chosen]
        chosen.append(min(rest, key=lambda k: (-d[k, chosen].min(), k)))
    return chosen


def orders(df, part="train"):
    return [r.sample_id for r in df.where(F.col("partition") == part).orderBy("ord").collect()]


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e7])
def test_kernel_at_any_offset(offset):
    rng = np.random.default_rng(int(offset) % 97)
    for _ in range(12):
        x = rng.normal(size=(25, 4)) + offset
        centred = x - x.mean(0)
        assert kernels.kennard_stone(x, 18).tolist() == brute(centred, 18)
    assert kernels.kennard_stone(np.ones((5, 3)), 4).tolist() == [0, 1, 2, 3]
    assert kernels.kennard_stone(np.ones((1, 3)), 1).tolist() == [0]


@pytest.mark.parametrize("block", [3, 17, 64])
def test_passes_choose_as_one_task_does(spark, block):
    rng = np.random.default_rng(block)
    x = np.vstack([rng.normal(size=(90, 5)), np.repeat(rng.normal(size=(1, 5)), 30, axis=0), rng.normal(size=(40, 5)) * 0.01]) + 1e6
    x = x[rng.permutation(len(x))]
    df = table(spark, x).repartition(3)
    one, many = split.kennard_stone_split(df, 0.3), split.kennard_stone_split(df, 0.3, block=block)
    assert orders(many) == orders(one) == brute(x - x.mean(0), len(x) - 48)
    assert orders(many, "test") == orders(one, "test") == sorted(orders(one, "test"))
    assert many.count() == len(x)


def test_copies_only(spark):
    df = table(spark, np.ones((20, 3)))
    assert orders(split.kennard_stone_split(df, 0.5, block=4)) == list(range(10))


def test_large_groups_go_by_passes(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(80, 4))
    group = ["a"] * 50 + [None] * 20 + ["b"] * 10
    df = table(spark, x, group)
    got = split.kennard_stone_split(df, 0.25, group="kind", block=8, group_rows=15)
    want = split.kennard_stone_split(df, 0.25, group="kind")
    key = ["kind", "partition", "ord"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and set(key) < set(got.columns)
    with pytest.raises(DataError):
        split.kennard_stone_split(df, 0.25, group="kind", max_group=40)


def test_equal_distances_of_the_spectra_as_given(spark):
    """On a grid many distances are equal, which a shift by the mean must not tell apart."""
    x = np.random.default_rng(397).integers(0, 4, (18, 3)).astype(float)
    assert kernels.kennard_stone(x, 17).tolist() == brute(x, 17)
    x = np.random.default_rng(6).integers(0, 3, (150, 4)).astype(float) * 0.1
    df = table(spark, x).repartition(3)
    assert orders(split.kennard_stone_split(df, 0.2, block=20)) == orders(split.kennard_stone_split(df, 0.2)) == brute(x, 120)


def test_outliers_and_scales(spark):
    """Products in single precision only screen: a far row, tiny and huge values do not change the order."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(160, 5))
    for y in (np.vstack([x, [[1e9] * 5]]), x * 1e-170, x * 1e25, np.vstack([x * 1e-9, x + 50.0])):
        want = brute(y, len(y) - kernels.test_rows(len(y), 0.3))
        assert kernels.kennard_stone(y, len(want)).tolist() == want
    df = table(spark, np.vstack([x, [[1e9] * 5]])).selectExpr("'k' || lpad(sample_id, 4, '0') AS sample_id", "spectrum", "kind")
    got = orders(split.kennard_stone_split(df, 0.3, block=40))
    assert got == [f"k{i:04d}" for i in brute(np.vstack([x, [[1e9] * 5]]), 112)]
