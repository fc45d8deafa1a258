import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cratework.llm import token_ids
from cratework.llm.queries import END_ID, tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=9), max_size=9))
def test_codes_round_trip(documents):
    sizes = np.array([len(numbers) for numbers in documents], np.int64)
    control, data = token_ids.pack(np.array([n for numbers in documents for n in numbers], np.uint32), sizes)
    assert len(control) == sum(-(-len(numbers) // 4) for numbers in documents)
    assert token_ids.unpack(control, data, sizes).tolist() == [n for numbers in documents for n in numbers]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab ,.'sté́ Σİ<|>\n"))), max_size=4))
def test_ids_of_words_are_ids_of_the_text(tokenizer, texts):
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in token_ids.encode(PATH, texts)] == want


def test_special_marks(tokenizer):
    texts = ["a<|endoftext|>b", "plain, text. it's Done, no!! É, é... ÷. x÷. ab%%% CD*** e'' f''s g-h i- j_ k`", "J̌x ΑΣ, ΑΣ", "we'll 'tis ''s"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in token_ids.encode(PATH, texts)] == want


def test_files_round_trip(session, make_docs, corpus, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK_IDS", 500)
    folder = f"file://{tmp_path}/tokens"
    token_ids.write_ids(make_docs(corpus), folder, PATH, END_ID)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_ids.id_digests(token_ids.read_ids(session, folder)).collect()}
    start, want = 0, {}
    for d, t, _ in sorted(corpus, key=lambda r: r[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [END_ID]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    assert any(name.endswith(".rnkv") for name in os.listdir(tmp_path / "tokens" / "files"))


def test_odd_rows(session, make_docs, tmp_path):
    folder = f"file://{tmp_path}/a"
    token_ids.write_ids(make_docs([(None, "x"), (2, None), (2, "word"), (-1, "")]), folder, PATH, END_ID)
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in token_ids.read_ids(session, folder).collect())
    assert [r[1] for r in rows] == [None, -1, 2, 2] and [r[2] for r in rows][:2] == [2, 1]
    folder = f"file://{tmp_path}/b"
    token_ids.write_ids(make_docs([(1, "x")]).limit(0), folder, PATH, END_ID)
    assert token_ids.read_ids(session, folder).count() == 0
