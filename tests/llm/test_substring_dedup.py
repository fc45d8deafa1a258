import hashlib

import numpy as np
import pytest

from cratework.llm import substring_dedup as dedup
from cratework.llm.common import Scratch, words


def plain(rows, n):
    docs = sorted((d, words(t)) for d, t, *_ in rows)
    first = {}
    for d, w in docs:
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), (d, i))
    out = {}
    for d, w in docs:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] != (d, i):
                gone |= set(range(i, i + n))
        out[d] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


@pytest.mark.parametrize(("window", "start"), [(20, 10), (20, 5), (7, 7), (9, 2)])
def test_removed_words_equal_brute_force(make_docs, corpus, window, start):
    rows = dedup.remove_repeats(make_docs(corpus), window, start).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows} == plain(corpus, window)


def test_longer_levels_hold_longer_repeats(session, make_docs, corpus):
    _, levels = dedup.repeated_windows(Scratch(session, "t"), make_docs(corpus), 20, 10)
    assert sorted(levels)[:2] == [20, 40]
    docs = sorted((d, words(t)) for d, t, *_ in corpus)
    for length, level in levels.items():
        seen, want = {}, set()
        for d, w in docs:
            for i in range(len(w) - length + 1):
                if seen.setdefault(tuple(w[i : i + length]), (d, i)) != (d, i):
                    want.add((d, i))
        assert {(r.doc, p) for r in level.collect() for p in r.starts} == want


def test_odd_rows(make_docs):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long), (1, long), (2, None), (None, long), (3, "tail " + long), (4, "")]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in dedup.remove_repeats(make_docs(rows)).collect())
    assert got == [(-1, 30, 0), (1, 30, 0), (1, 30, 0), (2, 0, 0), (3, 31, 30), (4, 0, 0)]
    assert dedup.remove_repeats(make_docs(rows).limit(0)).count() == 0
    digest = dedup.digest_columns(dedup.remove_repeats(make_docs(rows))).where("doc_id = 4").first()
    assert digest.kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_hashes_by_doubling():
    h = np.arange(50, dtype=np.uint64) ** np.uint64(3)
    for n in (1, 2, 7, 20):
        w = dedup.windows(h, n)
        assert len(w) == 51 - n and w[3] == dedup.windows(h[3 : 3 + n], n)[0]
    assert len(dedup.windows(h[:3], 5)) == 0
