import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cratework.llm import decontaminate as leaks
from tests.llm.conftest import sentence


def best_edits(pattern, text):
    """Fewest edits between the pattern and any part of the text, by the whole table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
        best = min(best, row[-1])
    return best


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.choice("sid")
        if kind == "s":
            out[at] = "§"
        elif kind == "i":
            out.insert(at, "§")
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_found_equals_brute_force(session, make_docs, seed):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.randint(6, 30))) for k in range(8)]
    index = leaks.Index(items)
    rows = []
    for d in range(60):
        text = sentence(rng, rng.randint(3, 60))
        if d % 3 == 0:
            k = rng.randrange(8)
            part = leaks.normal(items[k][1])
            at = rng.randrange(len(text))
            text = text[:at] + " " + changed(rng, part, rng.randint(0, int(index.edits[k]) + 2)) + " " + text[at:]
        rows.append((d, text.upper() if d % 2 else text))
    bench = session.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in leaks.find_leaks(make_docs(rows), bench).collect()}
    want = {}
    for d, text in rows:
        for k, item in items:
            edits = best_edits(leaks.normal(item), leaks.normal(text))
            if edits <= index.edits[k]:
                want[d, k] = edits
    assert got.keys() == want.keys() and len(want) > 10
    for pair, edits in got.items():
        assert want[pair] <= edits <= index.edits[pair[1]]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc ", max_size=60), st.integers(2, 12))
def test_gram_hashes(text, q):
    codes = leaks.code_points(text)
    got = leaks.grams(codes, q)
    assert len(got) == max(0, len(codes) - q + 1)
    for k in range(len(got)):
        assert got[k] == leaks.grams(codes[k : k + q], q)[0]


def test_repetitive_and_long_texts(session, make_docs):
    bench = session.createDataFrame([(1, "ha ha ha ha ha ha ha ha end of it"), (2, "a normal item of some twenty words " * 3)], "item_id long, text string")
    rows = [(1, "ha " * 30_000), (2, "ha " * 3000 + "end of it"), (3, "word " * 50_000 + "a normal item of some twenty words " * 3)]
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(make_docs(rows), bench).collect()}
    assert got == {(2, 1), (3, 2)}


def test_odd_rows(session, make_docs):
    bench = session.createDataFrame([(1, None), (2, " "), (3, "tiny"), (None, "an item without any id at all, but long enough")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "a tiny thing"), (3, "a tiny thing"), (4, "tinyness"), (None, "see: an item without any id at all, but long enough!")]
    df = make_docs(rows)
    got = sorted(((r.doc_id or -1), (r.item_id or -1)) for r in leaks.find_leaks(df, bench).collect())
    assert got == [(-1, -1), (3, 3), (3, 3)]
    kept = leaks.without_leaks(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert leaks.find_leaks(df.limit(0), bench).count() == 0
    assert leaks.find_leaks(df, bench.limit(0)).count() == 0
    assert leaks.without_leaks(df, bench.limit(0)).count() == len(rows)


def test_blocks_of_the_benchmark(session, make_docs):
    items = [(k, sentence(random.Random(k), 20)) for k in range(30)]
    bench = session.createDataFrame(items, "item_id long, text string")
    parts = list(leaks.blocks(bench, chars=700))
    assert len(parts) > 3 and sorted(k for p in parts for k, _ in p) == list(range(30))
    assert np.isfinite(leaks.Index(items).least).all()
