import collections
import os

import pytest

import corpus_pipeline
from cratework.llm import decontaminate, quality, simhash
from cratework.llm.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_ids"]
    kept = docs
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = session.createDataFrame(stage(session, kept, SF).collect(), docs.schema)
        assert kept.columns == docs.columns
        rows[name] = kept.collect()
        assert all(texts[r.doc_id] == r.text for r in rows[name])
    good = {r.doc_id for r in rows["quality_classifier"]}
    space = quality.fit(docs, session.read.parquet(f"{SF}/labels.parquet"))
    assert good == {r.doc_id for r in quality.score(docs, space).where("score >= 0.7").collect()}
    prints = {d: simhash.fingerprint(texts[d]) for d in sorted(good)}
    component = {}
    for d, fp in prints.items():
        near = [e for e in component if (prints[e] ^ fp).bit_count() <= 2]
        roots = {component[e] for e in near} | {d}
        for e in [*component]:
            if component[e] in roots:
                component[e] = min(roots)
        component[d] = min(roots)
    assert {r.doc_id for r in rows["simhash_near_dedup"]} == set(component.values())
    items = [decontaminate.normal(r.text) for r in session.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in rows["benchmark_decontamination"]}
    assert clean <= set(component.values())
    assert not any(i in decontaminate.normal(texts[d]) for d in clean for i in items)
    copies = collections.Counter(r.doc_id for r in rows["source_mix"])
    assert set(copies) <= clean and max(copies.values()) <= 3


def test_run(session):
    rows = corpus_pipeline.run(session, SF).orderBy("start").collect()
    assert rows and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(session, name):
    function, sql = QUERIES[name]
    problem, n, _ = compare(session, connect(SF), SF, function, sql)
    assert problem is None and n > 0
