import random

import numpy as np
import pytest
import xxhash

from cratework.llm import simhash


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(found, radius):
    parent = {d: d for d, _ in found}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(found):
        for b, y in found[:i]:
            if (x ^ y).bit_count() <= radius:
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {d: top(d) for d in parent}


def test_groups_equal_brute_force(make_docs, corpus):
    found = sorted((d, plain_fingerprint(t)) for d, t, _ in corpus)
    want = plain_components(found, 2)
    rows = simhash.near_duplicates(make_docs(corpus)).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == dict(found)
    assert {r.doc_id: r.component_id for r in rows} == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_slices_equal_popcount(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    sizes = np.array([1, 2, 64, 65, 130, 3])
    fp = np.concatenate([base[rng.integers(0, 4, n)] ^ (np.uint64(1) << rng.integers(0, 7, n).astype(np.uint64)) for n in sizes])
    want, at = set(), 0
    for n in sizes:
        want |= {(i, j) for i in range(at, at + n) for j in range(at, i) if int(fp[i] ^ fp[j]).bit_count() <= radius}
        at += n
    got = {(int(i), int(j)) for a, b in simhash.close_pairs(fp, sizes, radius) for i, j in zip(a, b)}
    assert got == want


def test_oversize_buckets_are_cut_further(session, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(24) for b in range(a)}  # one dense group
    chain = rng.getrandbits(64)
    fps |= {chain ^ ((1 << k) - 1) for k in range(0, 40, 2)}
    found = sorted((k, f) for k, f in enumerate(sorted(fps)))
    df = session.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    from cratework.llm.common import Scratch
    from cratework.llm.components import stars

    scratch = Scratch(session, "test")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in stars(scratch, simhash.links(scratch, df, 2)).collect()}
    want = plain_components(found, 2)
    groups: dict = {}
    for k, f in found:
        groups.setdefault(want[k], set()).add(f)
    got: dict = {}
    for f in fps:
        got.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_odd_rows(session, make_docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "only here it is"), (4, None), (5, ""), (6, "A B C D")]
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(make_docs(rows)).where("doc_id is not null").collect())
    assert got == [(1, 1), (1, 1), (4, 4), (5, 4), (6, 1)]
    kept = simhash.keep_one(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 4]
    assert simhash.near_duplicates(make_docs(rows).limit(0)).count() == 0
    assert simhash.fingerprint("a b") == xxhash.xxh64_intdigest(b"a b", 42) and simhash.fingerprint(" ") == 0


def test_different_texts_under_one_id_both_stay(make_docs):
    rows = [(5, "one two three four five"), (5, "quite another text stands here now"), (5, "one two three four five"), (6, "one two three four five")]
    kept = simhash.keep_one(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:2])
