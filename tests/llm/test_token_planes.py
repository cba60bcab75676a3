"""Token files against the tokenizers library, and round trips of the format."""

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from veildesk.llm import token_planes as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def expected():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


class Kept(io.BytesIO):
    def close(self):
        self.kept = self.getvalue()
        super().close()


@pytest.mark.parametrize("kind", [P.BYTES, P.BITS])
@pytest.mark.parametrize("block_ids", [1, 7, 64])
def test_format(kind, block_ids):
    rng = np.random.default_rng(block_ids)
    documents = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (0, 5, 1, 130, 64, 0, 63)]
    keys = [None, -5, 0, 1, 2**62, 7, 7]
    out = Kept()
    writer = P.PlaneWriter(out, kind, block_ids)
    for key, ids in zip(keys, documents, strict=True):
        writer.add(key, ids.astype("<u4").tobytes())
    writer.close()
    reader = P.PlaneReader(pa.PythonFile(io.BytesIO(out.kept), mode="r"))
    assert reader.ids == sum(map(len, documents))
    for (key, count, parts), want_key, want in zip(reader.documents(), keys, documents, strict=True):
        found = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        assert key == want_key and count == len(want) and (found == want).all()


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40) | st.text("ab 'sdl\n\t\x1c\x85\xa0 éß½²٣漢🎉<|endoftext|>", max_size=30))
def test_ids_of_any_text(expected, text):
    encode = P.once_per_worker(("test",), lambda: P.tokenizer_encoder(PATH, PATTERN))
    assert np.frombuffer(encode(text), "<u4").tolist() == expected(text)


def by_hand(rows, expected):
    start, out = 0, []
    for key, text in rows:
        ids = np.array([*expected(text), 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark, sf_dir, expected):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    found = sorted(tuple(r) for r in P.token_files(docs, PATH, PATTERN, 2).collect())
    assert found == by_hand(rows, expected)


def test_odd_rows(documents_of, odd_rows, expected):
    docs = documents_of(odd_rows)
    found = P.token_files(docs, PATH, PATTERN, 2, kind=P.BITS, block_ids=1000).collect()
    found = sorted((tuple(r) for r in found), key=lambda r: r[1])
    keys = [r[0] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()
    strip = lambda rows: sorted([(r[0], *r[2:]) for r in rows], key=repr)
    assert strip(found) == strip(by_hand(odd_rows, expected))
    assert P.token_files(docs.where("1 = 0"), PATH, PATTERN, 2).count() == 0


def test_added_tokens_have_their_own_ids(documents_of):
    tokenizer = Tokenizer.from_file(PATH)
    ids = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    token = next(iter(tokenizer.get_added_tokens_decoder().values())).content
    texts = [
        f"one {token} two", token, token * 3, f"{token}\n {token}é", f"x{token[:-1]} {token}", f"a  {token}  b",
        f"漢{token}🎉", "plain",
    ]
    encode = P.tokenizer_encoder(PATH, PATTERN)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids(text)
    rows = list(enumerate(texts))
    found = sorted(tuple(r) for r in P.token_files(documents_of(rows), PATH, PATTERN, 2).collect())
    assert found == by_hand(rows, ids)
