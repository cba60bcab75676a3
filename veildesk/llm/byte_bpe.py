"""Byte-level BPE with a sentencepiece model written straight from a rank file.

The model is a serialised ``ModelProto`` whose pieces are the vocabulary's byte strings, every
byte shown as one printable character, each scored by its negative rank. Sentencepiece's BPE
merges the pair whose merged piece scores highest, leftmost first, and that is the pair of
lowest rank. Normalisation is the identity. Pre-tokens are encoded one by one, so a pre-token
that is itself in the vocabulary keeps its own id, as rank-based encoders have it. Decoding
maps ids back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veildesk.llm.common import id_field, map_rows, once_per_worker

#: Distinct pre-tokens whose ids a worker remembers in each of two generations.
REMEMBERED = 400_000

# White space, letters and numbers among U+0000..U+00FF. Texts within this range
# are cut by the standard library's engine, which is faster than the one for all of Unicode.
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"


class PreTokens:
    """Cuts a text by a pattern written with \\p{L}, \\p{N} and \\s in the Unicode sense."""

    def __init__(self, pattern: str):
        self._any = regex.compile(
            _in_classes(pattern, r"\p{White_Space}", r"\p{L}", r"\p{N}"), regex.V0
        )
        self._narrow = re.compile(_in_classes(pattern, _SPACE, _LETTER, _NUMBER))

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._any.findall(text)
        return self._narrow.findall(text)


def _in_classes(pattern: str, space: str, letter: str, number: str) -> str:
    """Replace the three classes, inside and outside of brackets, by explicit members."""
    out, inside, i = [], False, 0
    named = {r"\s": space, r"\p{L}": letter, r"\p{N}": number}
    while i < len(pattern):
        if pattern.startswith(r"\S", i):
            out.append(f"[^{space}]")
            i += 2
            continue
        known = next((k for k in named if pattern.startswith(k, i)), None)
        if known:
            out.append(named[known] if inside else f"[{named[known]}]")
            i += len(known)
            continue
        inside = pattern[i] == "[" or inside and pattern[i] != "]"
        out.append(pattern[i])
        i += 1
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    """``base64 rank`` lines of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_characters() -> str:
    """One printable character for each byte, from U+0100 on, so none is special anywhere."""
    return "".join(map(chr, range(0x100, 0x200)))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _number_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model; ids are the ranks, one unknown piece follows them."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must count from 0 without a gap")
    shown = byte_characters()
    message = bytearray()
    for piece, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
        text = "".join(shown[b] for b in piece)
        score = np.float32(-rank).tobytes()  # a 32-bit float is exact up to 2**24
        message += _bytes_field(1, _bytes_field(1, text.encode()) + b"\x15" + score)
    unknown = _bytes_field(1, b"<unk>") + b"\x15" + np.float32(-len(ranks)).tobytes()
    message += _bytes_field(1, unknown + _number_field(3, 2))
    minus_one = (1 << 64) - 1
    trainer = _number_field(3, 2) + _number_field(4, len(ranks) + 1)  # model type BPE, size
    trainer += _number_field(40, len(ranks))
    trainer += b"".join(_number_field(n, minus_one) for n in (41, 42, 43))  # no bos, eos, pad
    normal = _bytes_field(1, b"identity") + b"".join(_number_field(n, 0) for n in (3, 4, 5))
    return bytes(message + _bytes_field(2, trainer) + _bytes_field(3, normal))


class ByteBpe:
    """Encoder and decoder over one rank file; built once per worker process."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import sentencepiece

        ranks = read_ranks(path)
        self._cut = PreTokens(pattern)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self._whole = {piece: np.uint32(rank).tobytes() for piece, rank in ranks.items()}
        self._bytes = [b""] * len(ranks)
        for piece, rank in ranks.items():
            self._bytes[rank] = piece
        self._shown = byte_characters()
        self._known = Memo(self._encode_piece, remembered)

    def _encode_piece(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self._whole.get(raw)
        if whole is not None:
            return whole
        shown = self._shown
        ids = self._model.encode("".join([shown[b] for b in raw]), out_type=int)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self._known.__getitem__, self._cut(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Memo(dict):
    """``make(key)`` for keys seen lately: two generations of at most ``limit`` keys.

    When the young generation is full it becomes the old one; a key that is used again moves
    back to the young one, so keys that are frequent stay while rare ones go.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        value = self._old.pop(key, None)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value


def coder(path: str, pattern: str) -> ByteBpe:
    return once_per_worker(("byte-bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, ids``: each whole text's token ids, little-endian unsigned 32-bit, as binary.

    A null text counts as empty and gives no ids; rows are kept as they come, repeated ids and
    null ids included. Only the two columns are read, so others may have any name.
    """
    schema = T.StructType([id_field(docs, id_col), T.StructField("ids", T.BinaryType())])

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        bpe = coder(path, pattern)
        for key, text in zip(ids, texts, strict=True):
            yield key, bpe.encode(text)

    return map_rows(docs.select(id_col, text_col), rows, schema)


def decode(
    encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``id_col, text_bytes``: the bytes that the ids stand for; null ids give no bytes."""
    schema = T.StructType([id_field(encoded, id_col), T.StructField("text_bytes", T.BinaryType())])

    def rows(keys: list, ids: list) -> Iterator[tuple]:
        bpe = coder(path, pattern)
        for key, one in zip(keys, ids, strict=True):
            yield key, bpe.decode(one or b"")

    return map_rows(encoded.select(id_col, ids_col), rows, schema)


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, decode the ids again and give both digests, without moving the ids.

    Returns ``id_col, n_tokens, ids_sha256, decoded_sha256``; nulls and repeated rows as in
    ``encode``, an empty text has 0 tokens and the digests of the empty string.
    """
    schema = T.StructType(
        [
            id_field(docs, id_col),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        bpe = coder(path, pattern)
        for key, text in zip(keys, texts, strict=True):
            ids = bpe.encode(text)
            back = hashlib.sha256(bpe.decode(ids)).hexdigest()
            yield key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), back

    return map_rows(docs.select(id_col, text_col), rows, schema)
