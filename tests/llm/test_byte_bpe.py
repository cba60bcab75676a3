"""Byte-level BPE against the library whose ids it has to match, and a round trip."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from veildesk.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def expected():
    ranks = byte_bpe.read_ranks(PATH)
    coding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coding.encode_ordinary


@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=40) | st.text("ab 'sdl\n\t\x1c\x85\xa0 éß½²٣漢🎉12.,", max_size=30))
def test_ids_of_any_text(expected, text):
    bpe = byte_bpe.coder(PATH, PATTERN)
    ids = bpe.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected(text)
    assert bpe.decode(ids) == text.encode()


def test_memory_of_pre_tokens_is_bounded():
    bpe = byte_bpe.ByteBpe(PATH, PATTERN, remembered=10)
    texts = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(50)]
    assert all(bpe.decode(bpe.encode(t)) == t.encode() for t in texts)
    assert len(bpe._known) <= 10 and len(bpe._known._old) <= 10


def test_ranks_must_be_dense():
    with pytest.raises(ValueError):
        byte_bpe.model_proto({b"a": 0, b"b": 2})


def test_documents(spark, sf_dir, expected):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = np.array(expected(texts[row["doc_id"]]), "<u4").tobytes()
        assert row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_odd_rows(documents_of, odd_rows):
    docs = documents_of(odd_rows)
    found = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd_rows]
    assert sorted([(r[0], r["decoded_sha256"]) for r in found], key=key) == sorted(want, key=key)
    assert byte_bpe.round_trip(docs.where("1 = 0"), PATH, PATTERN).count() == 0


def test_encode_then_decode(documents_of, odd_rows):
    docs = documents_of(odd_rows)
    back = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    want = sorted((t or "").encode() for _, t in odd_rows)
    assert sorted(bytes(r["text_bytes"]) for r in back) == want
