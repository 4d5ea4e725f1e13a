"""Whitening against exact integer sums and an eigendecomposition, with ties, odd vectors and dependent dimensions."""
import math

import numpy as np
import pytest

from offerboard.llm import whitening
from offerboard.llm.common import settle

SCHEMA = "vec_id long, embedding array<float>, label int, id string, component string, n int"


def brute(rows):
    """(ids, x, n, S, eigenvalues, axes, deviations) in Python integers and numpy's symmetric solver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in good], object)
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in good], x, n, total, values[::-1], axes[:, ::-1], ((n * x - total) ** 2).sum(1)


def check(rows, got, width):
    ids, x, n, total, values, axes, deviations = brute(rows)
    width = min(width, 16)
    assert len(got) == len(ids) * width
    want = ((n * x - total).astype(float) / n) @ axes[:, :width] / np.sqrt(values[:width])
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    sign = np.ones(width)
    table = np.array([[by_id[i][k + 1].whitened for k in range(width)] for i in ids])
    sign = np.sign((table * want).sum(0))
    assert np.allclose(table, want * sign, rtol=1e-6, atol=1e-6)
    for i, d in zip(ids, deviations):
        assert {r.deviation for r in by_id[i].values()} == {d} and {r.n for r in by_id[i].values()} == {n}
    explained = [by_id[ids[0]][k + 1].explained for k in range(width)]
    assert np.allclose(explained, values[:width] / values.sum(), rtol=1e-6)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-8


@pytest.fixture(scope="module")
def s(spark):
    return settle(spark)


def frame(s, rows):
    return s.createDataFrame([(i, v, 1, "clash", "clash", 7) for i, v in rows], SCHEMA)


def test_against_integers_and_eigenvectors(s):
    rng = np.random.default_rng(3)
    scale = np.array([3, 1, 0.5, 0.2, 0.1, 2] * 4)
    rows = [(i, [float(c) for c in rng.standard_normal(24) * scale]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(200)]                     # a third of all rows are one vector
    rows += [(700, None), (701, []), (702, [float("nan")] * 24), (703, [float("inf")] * 24), (704, [None] * 24),
             (705, [1.0] * 5), (706, [3e38] * 24)]
    got = whitening.whiten(frame(s, rows)).collect()
    check(rows[:600], got, 24)


def test_dependent_and_constant_dimensions_give_the_components_there_are(s):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        a, b, c = (float(v) / 64 for v in rng.integers(-500, 500, 3))
        rows.append((i, [a, b, a + b, 2.0, c]))
    got = whitening.whiten(frame(s, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    assert max(r.identity_error for r in got) < 1e-8 and abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9


def test_no_component_without_spread_and_no_rows(s):
    assert whitening.whiten(frame(s, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])])).count() == 0
    empty = whitening.whiten(frame(s, [(1, None)]).limit(0))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert empty.count() == 0 and whitening.whiten(frame(s, [(1, None), (2, [])])).count() == 0


def test_null_and_repeated_ids_keep_their_rows(s):
    rows = [(1, [0.0, 1.0]), (1, [4.0, 1.5]), (None, [2.0, 9.0]), (None, [2.0, 9.0])]
    got = whitening.whiten(frame(s, rows)).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 4 and {r.n for r in got} == {3}


def test_large_entries_use_exact_integers(s):
    rows = [(i, [float(2.0 ** 50 * (i + 1)), float(i * i)]) for i in range(6)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame(s, rows)).collect()}
    _, _, n, _, _, _, deviations = brute(rows)
    assert n == 6 and all(got[i, 1].deviation is None for i, d in enumerate(deviations) if d >= 2 ** 63)
