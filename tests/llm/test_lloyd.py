import hashlib
import math
import random

import numpy as np
import pytest

from cratework.llm import lloyd

VECTORS = "vec_id long, embedding array<float>, label int, x string, cluster int"


def make(session, rows, parts=3):
    return session.createDataFrame([(i, v, 0, "extra", 9) for i, v in rows], VECTORS).repartition(parts)


def expected(rows, size, count, rounds, scale=1024):
    """Lloyd in plain Python numbers."""
    kept = [
        (i, [math.floor(scale * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in order[:count]]

    def nearest(x):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
        return min(far), far.index(min(far))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for c in range(len(centres)):
            mine = [x for (_, x), label in zip(kept, own) if label == c]
            if mine:
                centres[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((i, nearest(x)[1], nearest(x)[0]) for i, x in kept), key=str), centres


@pytest.mark.parametrize(("size", "width", "block"), [(7, 3, 4), (5, 16, 1000), (8, 2, 1)])
def test_equals_plain_lloyd(session, size, width, block):
    rng = random.Random(size)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(size)]) for i in range(70)]
    rows += [(100 + i, rows[5][1]) for i in range(40)]  # a vector that a third of the rows share
    found, centres = lloyd.cluster(make(session, rows), size, count=4, rounds=5, shard_columns=width, block_rows=block)
    want, want_centres = expected(rows, size, 4, 5)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert centres.tolist() == want_centres


def test_far_vectors_leave_empty_centroids_alone(session):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(6, [5.0, -5.5])]  # equal centroids: the smaller number takes all
    found, centres = lloyd.cluster(make(session, rows), 2, count=5, rounds=3)
    want, want_centres = expected(rows, 2, 5, 3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert centres.tolist() == want_centres


def test_odd_rows_and_description(session):
    rows = [
        (1, [0.5, 0.25]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("-inf"), 1.0]),
        (None, [-0.5, -0.00001]), (1, [0.5, 0.25]), (7, [0.75, 1.5]), (8, []),
    ]
    found, centres = lloyd.cluster(make(session, rows), 2, count=3, rounds=2)
    want, _ = expected(rows, 2, 3, 2)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    about = lloyd.describe(found, centres).collect()
    assert len(about) == 4
    assert {r.inertia for r in about} == {sum(d for _, _, d in want)}
    for r in about:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster].tolist())).encode()).hexdigest()


def test_empty_table_and_large_numbers(session):
    found, centres = lloyd.cluster(make(session, []), 4)
    assert found.collect() == [] and len(centres) == 0 and lloyd.describe(found, centres).collect() == []
    with pytest.raises(OverflowError):
        lloyd.cluster(make(session, [(1, [1e9, 0.0])]), 2)


def test_the_table_of_units_is_dropped_again(session):
    lloyd.cluster(make(session, [(i, [float(i), float(-i)]) for i in range(20)]), 2, count=2, rounds=2)
    assert not session.sql("SHOW TABLES LIKE 'lloyd_*'").collect()
