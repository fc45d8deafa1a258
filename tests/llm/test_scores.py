import random

import numpy as np
import pytest

from cratework.llm import quality, toxicity
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def labelled(session, make_docs):
    rng = random.Random(2)
    docs, labels = [], []
    for k in range(300):
        text, good, toxic = sentence(rng, rng.randint(20, 80)), k % 4 != 0, k % 5 == 0
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), (text[:4] + " ") * 60, text.replace(" ", "%%% ")])
        if toxic:
            word = rng.choice(["blorko", "snivvel"])
            text += " " + rng.choice([word, word, word.replace("o", "0").replace("i", "1"), " ".join(word), word[:3] + word[3] * 4 + word[4:]])
        docs.append((k, text))
        labels.append((k, int(good), int(toxic), None))
    labels += [(1, 1, 0, None), (None, 1, 1, None), (5, None, None, None)]
    frame = session.createDataFrame(labels, "doc_id long, quality int, toxic int, score double")
    return make_docs([*docs, (900, None), (901, ""), (902, "z" * 200_000), (0, docs[0][1])]), frame, dict((r[0], r[1:3]) for r in labels[:300])


def test_quality_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    space = quality.fit(docs, labels, learn=lambda d: d % 3 != 0)
    got = {r.doc_id: r.score for r in quality.score(docs, space).collect()}
    held = [k for k in truth if k % 3 == 0]
    assert np.mean([(got[k] >= 0.7) == truth[k][0] for k in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and {900, 901, 902} <= got.keys()
    kept = quality.keep_good(docs, space, 0.7)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality.score(docs, space).where("score >= 0.7").collect())


def test_quality_statistics_cover_all_documents(labelled):
    docs, _, _ = labelled
    n, frequency = quality.corpus_frequencies(docs)
    counts = [quality.trigram_counts(quality.code_points(r.text or "")) > 0 for r in docs.select("text").collect()]
    assert n == docs.count() and frequency.tolist() == np.sum(counts, axis=0).tolist()


def test_quality_without_rows(labelled):
    docs, labels, _ = labelled
    space = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, space).collect()} == {0.5}
    assert quality.score(docs.limit(0), space).count() == 0
    assert quality.fit(docs.limit(0), labels).prior == 0.5


def test_cosines_are_exact():
    rng = np.random.default_rng(0)
    counts = rng.random((60, quality.TERMS)).astype(np.float32)
    labels = (rng.random(60) < 0.5).astype(np.float32)
    space = quality.Space(counts, labels, np.full(quality.TRIGRAMS, 5), 60, 12)
    query = rng.random((7, quality.TERMS)).astype(np.float32)
    got = space.scores(query, 5, 2.0)
    vectors = space.weigh(query) @ space.axes
    for row, v in zip(got, vectors):
        near = space.vectors @ (v / np.linalg.norm(v))
        best = np.argsort(near)[-5:]
        weight = np.clip(near[best], 0, 1) ** 2.0
        assert row == pytest.approx((weight * labels[best]).sum() / weight.sum(), abs=1e-4)


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    model = toxicity.fit(docs, labels, learn=lambda d: d % 3 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [k for k in truth if k % 3 == 0]
    assert np.mean([(got[k] >= 0.5) == truth[k][1] for k in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]


def test_toxicity_without_rows(labelled):
    docs, labels, _ = labelled
    model = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.limit(0), labels).prior == 0.0


def test_restored_words(session):
    rng = random.Random(4)
    text = " ".join(rng.choice(["stupid", "house", "garden", "worthless", "people", "the", "and", "letter"]) for _ in range(20_000))
    df = session.createDataFrame([(text,), (None,)], "text string")
    restorer = toxicity.Restorer(toxicity.letter_model(df))
    for odd, plain in {
        "st0pp3d": None, "stup1d": "stupid", "$tupid": "stupid", "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid",
        "stuuuupid": "stupid", "w0rthl3ss": "worthless", "STUP!D": "stupid", "letter": "letter", "p33ple": None,
    }.items():
        read = restorer.restore(f"the {odd} and")
        assert plain is None or read == f"the {plain} and"
    assert restorer.restore("the letter, 12 houses!! in 2024.") == "the letter, 12 houses!! in 2024."
    assert restorer.restore("") == "" and len(restorer.restore("a" * 100_000)) > 0


def test_letter_counts_equal_brute_force(session):
    rows = ["abc", None, "", "Ab,a"]
    df = session.createDataFrame([(t,) for t in rows], "text string")
    got = np.exp(toxicity.letter_model(df))
    assert got.shape == (64, 64, 64) and np.allclose(got.sum(axis=2), 1, atol=1e-3)
    assert got[1, 2, 3] > got[1, 2, 4]  # after "ab" came "c"


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    model = np.log(rng.random((64, 64, 64)).astype(np.float32))

    def paths(ways):
        if not ways:
            return [("", 0.0)]
        return [(a + b, x + y) for a, x in ways[0] for b, y in paths(ways[1:])]

    for place in ["s0!", "b.a.d.x", "l33t", "aaab", "p@@ss"]:
        best = None
        for read, cost in paths(toxicity.lattice(place)):
            a = b = 0
            for char in [*map(toxicity._letter, read), 0]:
                cost += float(model[a, b, char])
                a, b = b, char
            best = max(best, (cost, read)) if best else (cost, read)
        assert toxicity.decode(place, model) == best[1]


def test_restores_signs_at_the_end_and_mixed_spellings(session):
    rng = random.Random(6)
    words = ["idiot", "moron", "hate", "die", "ass", "a", "the", "house", "garden", "people", "and", "letter"]
    text = " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(20_000))
    restorer = toxicity.Restorer(toxicity.letter_model(session.createDataFrame([(text,)], "text string")))
    for odd, plain in {
        "a$$": "ass", "hat3": "hate", "di3": "die", "idi07": "idiot", "m 0 r 0 n": "moron", "i d i 0 t": "idiot",
        "1.d.1.0.t": "idiot", "a s s": "ass", "d.i.3": "die", "i d i o t!": "idiot!",
    }.items():
        assert restorer.restore(f"the {odd} and") == f"the {plain} and", odd
    for same in ("the!!", "2 0 1 0 1", "1.0.1", "100 and 455", "$$$", "the e.g. and"):
        assert restorer.restore(same) == same
    assert restorer.restore("THE!! house") == "the!! house"
    assert restorer.restore("the a$$$ and") == "the a$$$ and"


def test_labelled_copies_share_one_weight_and_none_is_dropped(session):
    """Copies that are 80 % alike weigh as one document; texts that share a passage weigh in full."""
    rng = random.Random(6)
    base, passage = sentence(rng, 100), sentence(rng, 30)
    rows = [(1, base, 1), (2, base, 0), (3, base + " end", 1), (4, sentence(rng, 80), 0)]
    rows += [(10 + k, sentence(rng, 60) + " " + passage + " " + sentence(rng, 60), 1) for k in range(6)]
    found = toxicity.with_weights(session.createDataFrame(rows, "doc_id long, text string, label int")).collect()
    weight = {(r.text, r.label): r.weight for r in found}
    assert len(found) == len(rows)
    assert [round(weight[t, y], 6) for _, t, y in rows] == [round(1 / 3, 6)] * 3 + [1.0] * 7


def test_labelled_texts_do_not_depend_on_the_run(session, make_docs):
    docs = make_docs([(1, "b"), (1, "a"), (2, None), (2, "c"), (3, None), (4, "x")])
    sample = session.createDataFrame([(1, 0), (2, 1), (3, 1), (9, 0)], "doc_id long, label int")
    assert sorted(map(tuple, quality.labelled_texts(docs, sample).select("doc_id", "text", "label").collect())) == [(1, "a", 0), (2, "c", 1), (3, None, 1)]
