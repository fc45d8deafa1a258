import collections
import random

import numpy as np
import pytest

from cratework.llm import mixing
from cratework.llm.common import words


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    done, rest, total = {}, set(order), sum(sizes.values())
    while rest:
        left, w = total - sum(done.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / w > most * sizes[s] + 1e-9]
        if not over:
            return done | {s: left * weight[s] / w for s in rest}
        for s in over:
            done[s] = most * sizes[s]
            rest.discard(s)
    return done


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing(session, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 50, 1000, 70_000]) for s in [*"abcdefgÄ", "B", None][: 3 + 2 * seed]}
    df = session.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n long, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


def test_mix_meets_targets(make_docs, corpus):
    rng = random.Random(3)
    rows = [(k, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["a", "b", "c", "d", None])) for k in range(3000)]
    rows += [(10_000 + k, "w " * 5, "hot") for k in range(2500)]
    df = make_docs(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and {r.copies for r in got} <= {0, 1, 2, 3}
    taken, count, total = collections.Counter(), collections.Counter(), collections.Counter(r[2] for r in rows)
    for r in got:
        taken[r.source] += r.size * r.copies
        count[r.source] += r.copies
        assert r.size == len(words(rows[r.doc_id][1] if r.doc_id < 3000 else "w " * 5))
    for r in {r.source: r for r in got}.values():
        assert abs(taken[r.source] - r.target) <= 8
        assert abs(count[r.source] - total[r.source] * r.target / r.source_size) <= 3
    again = mixing.mix(df).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    p, size = rng.random(400), rng.integers(0, 900, 400).astype(float)
    out = mixing.flight(p, np.vstack([np.ones(400), size]), rng.random(400))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)


def test_flight_is_unbiased():
    p = np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3])
    size = np.array([3.0, 1, 4, 1, 5, 9])
    rng = np.random.default_rng(1)
    mean = np.mean([mixing.flight(p, np.vstack([np.ones(6), size]), rng.random(6)) for _ in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_odd_rows(make_docs):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (2, None, "x"), (3, "", "empty"), (4, "d e f", "y")]
    df = make_docs(rows)
    got = mixing.mix(df).collect()
    assert len(got) == 6
    assert [r.copies for r in got if r.source == "empty"] == [0]
    applied = mixing.apply_mix(df)
    assert applied.columns == df.columns and applied.count() >= 1
    assert mixing.mix(df.limit(0)).count() == 0


def test_rows_without_id_are_taken_as_decided(make_docs):
    """Rows that cannot be told apart by doc_id still add up to their source's target."""
    rows = [(None, "w " * 50, "a") for _ in range(400)] + [(7, "w " * 50, "a") for _ in range(200)]
    rows += [(1000 + k, "w " * 50, "b") for k in range(100)]
    df = make_docs(rows)
    target = {r.source: r.target for r in mixing.mix(df).collect()}
    taken = collections.Counter()
    for r in mixing.apply_mix(df).collect():
        taken[r.source] += 50
    assert all(abs(taken[s] - target[s]) <= 50 * 3 for s in target)
