import math
import random

import numpy as np
import pytest

from cratework.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int, n long, x string"


def make(session, rows, parts=3):
    return session.createDataFrame([(i, v, 0, 1, "extra") for i, v in rows], VECTORS).repartition(parts)


def expected(vectors, k=4):
    """Plain numpy: distinct rows, covariance by centring, eigenvectors."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = np.array(sorted({tuple(r) for r in x}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    off = fit - fit.mean(axis=0)
    e, v = np.linalg.eigh(off.T @ off / n)
    e, v = e[::-1], v[:, ::-1]
    white = (np.array(x) - fit.mean(axis=0)) @ v[:, :k] / np.sqrt(e[:k])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return n, deviation, white, e[:k] / e.sum()


def run(session, rows, k=4):
    whole = whitening.whole_vectors(make(session, rows))
    model = whitening.fit(whole, k)
    return model, whitening.whiten(whole, model).collect()


def test_equals_plain_numpy(session):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 12)) * np.geomspace(3, 0.2, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(500 + i, base[7].tolist()) for i in range(90)]  # a hot vector
    model, found = run(session, rows)
    n, deviation, white, explained = expected([v for _, v in rows])
    assert model.n == n == 120 and model.identity_error < 1e-9
    for at, (vec_id, _) in enumerate(rows):
        own = sorted((r for r in found if r.vec_id == vec_id), key=lambda r: r.component)
        assert [r.component for r in own] == [1, 2, 3, 4]
        assert {int(r.deviation) for r in own} == {deviation[at]}
        assert [abs(r.whitened) for r in own] == pytest.approx(np.abs(white[at]), abs=1e-9)
        assert [r.explained for r in own] == pytest.approx(explained, rel=1e-9)
    signs = np.sign([[r.whitened for r in found if r.vec_id == i and r.component == 1][0] for i in range(120)]) * np.sign(white[:120, 0])
    assert abs(signs.sum()) == 120  # one sign for all rows


def test_badly_conditioned_columns_stay_orthogonal(session):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 6)) * np.array([4000.0, 3000.0, 1.0, 0.5, 0.1, 0.05])
    model, _ = run(session, [(i, v.tolist()) for i, v in enumerate(base)], 6)
    _, _, _, explained = expected(base.tolist(), 6)
    assert len(model.components) == 6 and model.identity_error < 1e-6
    assert model.eigenvalues / model.trace == pytest.approx(explained, rel=1e-4)


def test_odd_rows(session):
    good = [(i, [0.1 * i, 1.0 - i * i, 2.0]) for i in range(5)]  # the last column never varies
    odd = [
        (10, None), (11, [1.0, None, 2.0]), (12, [1.0, float("nan"), 2.0]), (13, [1.0, float("inf"), 2.0]),
        (14, []), (15, [1.0]), (None, good[0][1]), (0, good[0][1]), (16, [-0.0, -0.001, 2.0]),
    ]
    model, found = run(session, good + odd)
    assert model.n == 6 and len(model.components) == 2
    assert sorted(((r.vec_id, r.component) for r in found), key=str) == sorted(
        [(i, c) for i in (None, 0, 0, 1, 2, 3, 4, 16) for c in (1, 2)], key=str
    )


def test_nothing_to_whiten(session):
    assert run(session, [])[1] == []
    assert run(session, [(1, None)])[1] == []
    assert run(session, [(1, [])])[1] == []
    model, found = run(session, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert model.n == 1 and found == []


def test_large_numbers_are_exact(session):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-(1 << 23), 1 << 23)) * 512 for _ in range(4)]) for i in range(40)]
    _, found = run(session, rows)
    _, deviation, _, _ = expected([v for _, v in rows])
    assert {r.vec_id: int(r.deviation) for r in found} == dict(enumerate(deviation))
    assert max(deviation) > 1 << 63


def test_query_columns():
    assert "op11_whitening" in queries.QUERIES
