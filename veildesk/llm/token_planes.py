"""Token-id files: bit- or byte-plane shuffled blocks, compressed plane by plane.

A file holds the ids of consecutive documents as blocks of a fixed number of ids. A block is
transposed: plane k holds byte (or bit) k of every id, and each plane is compressed with
zstandard on its own. After the blocks come two indexes and a fixed-size footer::

    "VDTP"  planes...                     every block's planes, one after another
    chunk index   per block: offset, number of ids, stored length of each plane  (u64)
    document index   per document: number of ids, document id, 1 if it has an id  (u64)
    footer   chunk index offset, blocks, document index offset, documents,
             ids, plane kind, planes per block  (u64 each), "VDTP"

Documents go to files in ascending order of id by a range partition, and files are numbered by
their range, so a document's place among all ids follows from the counts of earlier files.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.byte_bpe import REMEMBERED, Memo, PreTokens
from veildesk.llm.common import map_rows, once_per_worker, open_folder, shared_folder
from veildesk.staging import staged

MAGIC = b"VDTP"
BLOCK_IDS = 1 << 16
BYTES, BITS = 0, 1
_FOOTER = "<7Q4s"
_LEVEL = 3


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids: 4 of bytes or 32 of bits, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == BYTES:
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], count: int, kind: int) -> np.ndarray:
    if kind == BYTES:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
        return np.ascontiguousarray(raw).view("<u4").reshape(-1)
    bits = np.stack(
        [np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes],
        axis=1,
    )
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


class PlaneWriter:
    """Appends documents to a stream; holds one block and the document counts."""

    def __init__(self, out, kind: int = BYTES, block_ids: int = BLOCK_IDS):
        self._out, self._kind, self._size = out, kind, block_ids
        self._waiting: list[bytes] = []
        self._n, self._at, self.ids = 0, len(MAGIC), 0
        self._chunks: list[tuple[int, ...]] = []
        self._documents: list[tuple[int, int, int]] = []
        self._packer = zstandard.ZstdCompressor(level=_LEVEL)
        out.write(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        """A document's token ids, little-endian unsigned 32-bit, under its own id."""
        count = len(ids) // 4
        self._documents.append((count, (key or 0) % (1 << 64), int(key is not None)))
        self.ids += count
        self._waiting.append(ids)
        self._n += count
        if self._n >= self._size:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self._waiting), "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % self._size
        for start in range(0, whole, self._size):
            block = ids[start : min(start + self._size, whole)]
            stored = [self._packer.compress(p) for p in to_planes(block, self._kind)]
            self._chunks.append((self._at, len(block), *map(len, stored)))
            for plane in stored:
                self._out.write(plane)
                self._at += len(plane)
        self._waiting, self._n = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        if self._n:
            self._flush(last=True)
        chunks = np.array(self._chunks, "<u8").tobytes()
        documents = np.array(self._documents, "<u8").tobytes()
        footer = struct.pack(
            _FOOTER,
            self._at, len(self._chunks), self._at + len(chunks), len(self._documents), self.ids,
            self._kind, 4 if self._kind == BYTES else 32, MAGIC,
        )
        self._out.write(chunks + documents + footer)
        self._out.close()


class PlaneReader:
    """Random access to blocks and documents of a file through its indexes."""

    def __init__(self, source):
        self._source = source
        size = source.size()
        length = struct.calcsize(_FOOTER)
        footer = struct.unpack(_FOOTER, source.read_at(length, size - length))
        chunk_at, chunks, document_at, documents, self.ids, self._kind, planes, magic = footer
        if magic != MAGIC:
            raise ValueError("not a token file")
        raw = source.read_at(chunks * (2 + planes) * 8, chunk_at)
        self.chunks = np.frombuffer(raw, "<u8").reshape(chunks, 2 + planes).astype(np.int64)
        raw = source.read_at(documents * 24, document_at)
        self.index = np.frombuffer(raw, "<u8").reshape(documents, 3).view(np.int64)
        self._unpacker = zstandard.ZstdDecompressor()

    def block(self, number: int) -> np.ndarray:
        at, count, *lengths = self.chunks[number].tolist()
        stored = self._source.read_at(sum(lengths), at)
        planes, start = [], 0
        for length in lengths:
            planes.append(self._unpacker.decompress(stored[start : start + length]))
            start += length
        return from_planes(planes, count, self._kind)

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """``id, count, parts``: a document's token ids, in parts as they lie in blocks."""
        number, block, used = -1, np.empty(0, np.uint32), 0
        for total, key, present in self.index.tolist():
            parts, count = [], total
            while count:
                if used == len(block):
                    number, used = number + 1, 0
                    block = self.block(number)
                part = block[used : used + count]
                parts.append(part)
                used += len(part)
                count -= len(part)
            yield key if present else None, total, parts


def tokenizer_encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> Callable:
    """``text -> ids`` by a byte-level tokenizer file of the tokenizers library.

    A text is cut at the file's added tokens first, as the library does, and they give their own
    ids. The pre-tokens between them depend on the pattern alone and are encoded independently of
    each other, so the library's model is asked once for each one that a worker has not met lately.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    added = {
        t.content: np.array([number], "<u4").tobytes()
        for number, t in plain_added_tokens(tokenizer).items()
    }
    # The leftmost and then the longest one, as the library's automaton finds them.
    marks = sorted(map(re.escape, added), key=len, reverse=True)
    split = re.compile(f"({'|'.join(marks)})").split if added else lambda text: [text]
    shown = byte_level_characters()
    cut = PreTokens(pattern)

    def one(piece: str) -> bytes:
        tokens = model.tokenize("".join([shown[b] for b in piece.encode()]))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    known = Memo(one, remembered)

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        out = []
        for piece in split(text):
            if piece in added:
                out.append(added[piece])
            else:
                out.extend(map(known.__getitem__, cut(piece)))
        return b"".join(out)

    return encode


def plain_added_tokens(tokenizer) -> dict:
    """``{id: token}`` of the added tokens; those that take in what stands beside them, or stand
    only at words' ends, are refused, as no cut by their strings alone finds them."""
    added = tokenizer.get_added_tokens_decoder()
    for token in added.values():
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"added token {token.content!r} depends on its neighbours")
    return added


def byte_level_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: visible Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


def write_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    end_id: int,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    kind: int = BYTES,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write every whole text's ids and ``end_id`` to files in ascending order of id.

    The id must be an integer column. Returns, staged, a row for each file: ``part, file, n_ids, n_documents``. A null text is an
    empty one and gives the end id alone; null ids come first; rows that share an id are
    ordered by the hash of their text, which also spreads an id that very many rows have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        encode = once_per_worker(
            ("tokenizer", path, pattern), lambda: tokenizer_encoder(path, pattern)
        )
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        name, writer, documents = f"part-{part:05d}-{uuid.uuid4().hex}.planes", None, 0
        for batch in batches:
            texts, keys = (c.to_pylist() for c in batch.columns)
            for text, key in zip(texts, keys, strict=True):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    writer = PlaneWriter(out, kind, block_ids)
                writer.add(key, encode(text) + end)
                documents += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "n_ids": [writer.ids], "n_documents": [documents]}
            )

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    ranged = docs.select(text_col, id_col).repartitionByRange(parts, *order)
    schema = "part bigint, file string, n_ids bigint, n_documents bigint"
    return staged(ranged.sortWithinPartitions(*order).mapInArrow(run, schema), "token-files")


def read_tokens(files: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: its id, ``start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it; the checksum covers its ids as
    little-endian unsigned 32-bit integers, the end id among them. A task reads a file block by
    block. Only one row for each file, with its number of ids, passes through the driver.
    """
    found = files.orderBy("part").collect()
    starts = np.cumsum([0, *(r["n_ids"] for r in found)]).tolist()
    named = [(r["file"], start) for r, start in zip(found, starts, strict=False)]
    spark = files.sparkSession
    given = spark.createDataFrame(named, "file string, start bigint").repartition(max(1, len(named)))
    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def rows(names: list, firsts: list) -> Iterator[tuple]:
        system, root = open_folder(folder)
        for name, start in zip(names, firsts, strict=True):
            with system.open_input_file(f"{root}/{name}") as source:
                for key, count, parts in PlaneReader(source).documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4", copy=False).tobytes(), crc)
                    yield key, start, count, crc
                    start += count

    return map_rows(given, rows, schema)


def token_files(
    docs: DataFrame,
    path: str,
    pattern: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    kind: int = BYTES,
    block_ids: int = BLOCK_IDS,
    folder: str | None = None,
) -> DataFrame:
    """Write the documents' ids (``write_tokens``) and read them back (``read_tokens``)."""
    folder = folder or shared_folder(docs.sparkSession, "token-planes")
    files = write_tokens(docs, path, pattern, end_id, folder, id_col, text_col, kind, block_ids)
    return read_tokens(files, folder, id_col)
