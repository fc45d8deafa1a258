import random

import pytest

from cratework.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int"


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def make_docs(session):
    """Rows (doc_id, text[, source]) as a documents table with extra, clashing columns."""

    def make(rows, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]), "extra", 7) for r in rows
        ]
        return session.createDataFrame(full, DOCS).repartition(parts)

    return make


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("ba ke li mo nu ra se ti vo zu da fi go".split()) + rng.choice("xqwrtz") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source): copies, near copies, shared passages, empty, null, repeated and long texts."""
    rng = random.Random(5)
    rows = [[k, sentence(rng, rng.randint(1, 120)), rng.choice(["s1", "s2", "s3", "Ä", None])] for k in range(60)]
    passage = sentence(rng, 55)
    for k in (3, 17, 40):
        rows[k][1] += " " + passage + " " + sentence(rng, 9)
    rows[21][1] = passage + "\n" + passage
    rows[33][1] = rows[12][1]
    near = sentence(rng, 200).split(" ")
    for k in (44, 45, 46):
        near[k] = "changed"
        rows[k][1] = " ".join(near)
    rows[50][1], rows[51][1], rows[52][1] = "", None, " \t\n"
    rows[53][1] = "ab " * 400
    rows[54][1] = "Ünïcode  nbsp 中文字符 text 😀 " * 5
    rows[55][1] = "x" * 5000
    rows[56][1] = sentence(rng, 30_000)
    return [tuple(r) for r in rows]
