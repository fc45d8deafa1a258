import random

import numpy as np
import pytest

from cratework.llm import minhash
from cratework.llm.common import Scratch
from tests.llm.conftest import sentence


def plain_set(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k, 0) + 1))


def plain_components(rows, percent=85):
    """By all pairs, with null ids as documents that name nothing."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                p, q = top(i), top(j)
                root[max(p, q)] = min(p, q)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=str)


def edited(rng, words, share):
    words = list(words)
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = f"w{rng.random():.6f}"
    return " ".join(words)


def families(seed, groups=4, each=25):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = sentence(rng, rng.randint(60, 300)).split(" ")
        rows += [(1000 * g + k, edited(rng, base, 0.001 * k)) for k in range(each)]
    rng.shuffle(rows)
    return rows


def run(make_docs, rows, **how):
    return sorted((tuple(r) for r in minhash.near_duplicates(make_docs(rows), **how).collect()), key=str)


def test_groups_equal_brute_force(make_docs, corpus):
    rows = [(d, t) for d, t, _ in corpus]
    assert run(make_docs, rows) == plain_components(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_at_every_distance(make_docs, seed):
    rows = families(seed)
    assert run(make_docs, rows) == plain_components(rows)


@pytest.mark.parametrize("how", [{"bucket_rows": 3}, {"unit_shingles": 700}, {"bucket_rows": 2, "unit_shingles": 300}])
def test_large_buckets_and_groups_lose_no_link(make_docs, how):
    rows = families(3, groups=2, each=30)
    assert run(make_docs, rows, **how) == plain_components(rows)


def test_odd_rows(make_docs):
    rng = random.Random(8)
    text = sentence(rng, 40)
    rows = [
        (7, text), (None, text.upper()), (3, text + "\n"), (None, "only here once more"), (4, "ONLY here  once more"), (None, None),
        (9, ""), (9, "two words"), (9, "two words"), (2, "two\twords "), (None, "alone"), (None, "alone"), (11, "x " * 9),
        (12, "x x x x x"), (13, "x x x x"), (14, sentence(rng, 20_000)),
    ]
    assert run(make_docs, rows) == plain_components_with_null(rows)


def plain_components_with_null(rows):
    """Rows without id and without a component's id are kept."""
    return sorted(((d, n, c, k or (d is None and c is None)) for d, n, c, k in plain_components(rows)), key=str)


def test_empty_table(make_docs):
    assert run(make_docs, []) == []


def test_links_at_exactly_the_threshold():
    sets = [np.arange(0, 17, dtype=np.uint64), np.arange(0, 20, dtype=np.uint64), np.arange(1, 20, dtype=np.uint64)]
    assert minhash.alike_in_unit(sets[:2], np.zeros(2, int), 85) == [(1, 0)]  # 17 of 20
    assert minhash.alike_in_unit(sets[:2], np.zeros(2, int), 86) == []
    assert minhash.alike_in_unit(sets, np.array([0, 0, 1]), 85) == [(2, 1)]  # across only


def test_exact_counts_equal_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(60)]
    root = list(range(60))
    for i, j in minhash.alike_in_unit(sets, np.zeros(60, int), 60):
        assert 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))
        p, q = root[i], root[j]
        root = [min(p, q) if r in (p, q) else r for r in root]
    for i in range(60):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j])):
                assert root[i] == root[j]


def test_minima_estimate_likeness():
    minima = minhash.Minima(26, 5)
    a, b = np.arange(0, 850, dtype=np.uint64), np.arange(0, 1000, dtype=np.uint64)
    spread = [np.unique(minhash.mix(s, 0x9E3779B97F4A7C15)) for s in (a, b)]
    found = minima.of(spread)
    assert abs((found[0] == found[1]).mean() - 0.85) < 0.15
    whole = [min((int(minima.a[3]) * (int(x) >> 32) + int(minima.b[3])) % (1 << 64) for x in s) >> 32 for s in spread]
    assert found[:, 3].tolist() == whole


def test_miss_chance_is_as_documented():
    assert (1 - 0.85**minhash.BAND_ROWS) ** minhash.BANDS < 1 / 4_000_000 * 1.05


def test_oversize_bucket_is_one_star(session):
    rows = [(k, 0, [5], b"\x00") for k in range(9)]
    nodes = session.createDataFrame(rows, "node long, n long, keys array<long>, marks binary")
    links = minhash.candidate_links(Scratch(session, "t"), nodes, 130, 85, bucket_rows=4).collect()
    assert sorted((r.u, r.v) for r in links) == [(k, 0) for k in range(1, 9)]
