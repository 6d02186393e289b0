import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrine.errors import DataError, DefinitionError
from spectrine.functions.columns import even_places
from spectrine.functions.kernels import MODES, kennard_stone, pls_from_moments, savgol_matrix
from spectrine.functions.kernels import test_rows as n_test_rows


@pytest.mark.parametrize("deriv", [0, 1, 2])
def test_interp_reproduces_polynomials(deriv):
    t = np.arange(30.0)
    poly = np.polynomial.Polynomial([1.0, -0.3, 0.02, 0.001])
    matrix, offset = savgol_matrix(30, 9, 3, deriv, "interp")
    want = poly(t) if deriv == 0 else poly.deriv(deriv)(t)
    np.testing.assert_allclose(matrix @ poly(t) + offset, want, atol=1e-9)


@pytest.mark.parametrize("mode", MODES[:4])
def test_boundary_modes_match_padding(mode):
    x, half, cval = np.random.default_rng(1).normal(size=20), 3, 0.7
    pad = {"mirror": "reflect", "nearest": "edge", "wrap": "wrap", "constant": "constant"}[mode]
    padded = np.pad(x, half, mode=pad, **({"constant_values": cval} if mode == "constant" else {}))
    inner, _ = savgol_matrix(26, 7, 2, 0, "interp")
    matrix, offset = savgol_matrix(20, 7, 2, 0, mode, cval)
    np.testing.assert_allclose(matrix @ x + offset, (inner @ padded)[half:-half], atol=1e-12)


@pytest.mark.parametrize("bad", [(10, 3, 0), (5, 5, 0), (7, 2, -1), (0, 0, 0)])
def test_savgol_refuses(bad):
    with pytest.raises(DefinitionError):
        savgol_matrix(20, *bad)
    with pytest.raises(DefinitionError):
        savgol_matrix(5, 11, 2, 0, "interp")


@settings(max_examples=25, deadline=None)
@given(st.integers(3, 25), st.integers(1, 4), st.integers(0, 1000))
def test_kennard_stone_is_greedy_maximin(n, p, seed):
    x = np.random.default_rng(seed).integers(0, 4, (n, p)).astype(float)
    order = kennard_stone(x, n - 1)
    assert len(set(order)) == n - 1
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert d[order[0], order[1]] == d.max()
    for k in range(2, len(order)):
        near = d[:, order[:k]].min(1)
        rest = [i for i in range(n) if i not in order[:k]]
        assert order[k] == max(rest, key=lambda i: (near[i], -i))


def test_split_sizes():
    assert n_test_rows(40, 0.3) == 12 and n_test_rows(10, 0.25) == 3 and n_test_rows(2, 0.9) == 1
    with pytest.raises(DataError):
        n_test_rows(1, 0.5)


def test_pls_of_full_rank_is_least_squares():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 4)) * [1, 10, 0.1, 3] + 5, rng.normal(size=50)
    models = pls_from_moments(50, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y, 4)
    beta = np.linalg.lstsq(np.c_[np.ones(50), x], y, rcond=None)[0]
    np.testing.assert_allclose(models[3].coefficients, beta[1:], atol=1e-8)
    assert models[3].intercept == pytest.approx(beta[0], abs=1e-8)


def test_pls_repeats_the_last_model_when_nothing_is_left():
    x = np.array([[0.0, 5.0], [1.0, 5.0], [2.0, 5.0], [3.0, 5.0]])
    y = 2 * x[:, 0] + 1
    models = pls_from_moments(4, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y, 2)
    np.testing.assert_allclose(models[1].coefficients, models[0].coefficients)
    np.testing.assert_allclose(x @ models[1].coefficients + models[1].intercept, y)
    with pytest.raises(DataError):
        pls_from_moments(4, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y, 3)


def test_even_places_follow_linspace():
    for n in range(1, 60):
        for k in range(1, n + 1):
            raw = {int(v) for v in np.linspace(0, n - 1, k)}
            got = even_places(n, k)
            assert len(got) == k and raw <= set(got) and got == sorted(got)
