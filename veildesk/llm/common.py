"""What the operators share: column choice, word cutting, Arrow maps, shared-folder files."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.staging import scratch_path

#: Words of a text whose A-Z are lower-cased: digits, a-z and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and cut the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, in UTF-8."""
    return _WORD.findall(text.encode().lower()) if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have yet, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def map_rows(
    df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: T.StructType
) -> DataFrame:
    """Run ``rows(*columns as lists)`` over Arrow batches; each call yields output tuples.

    Memory is bounded by one Arrow batch of the input and one piece of the output.
    """
    fields = list(schema.names)
    kinds = [_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for row in rows(*(c.to_pylist() for c in batch.columns)):
                found.append(row)
                if len(found) >= 5_000:
                    yield _batch(found, fields, kinds)
                    found = []
            if found:
                yield _batch(found, fields, kinds)

    return df.mapInArrow(run, schema)


def _batch(found: Sequence[tuple], fields: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, fields)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def once_per_worker(key: tuple, make: Callable[[], object]):
    """``make()``, kept for later tasks of this worker process.

    Tasks get this package by value, so what a module of it remembers lasts for one task only;
    a module of the worker's own outlives them. ``key`` must name all that ``make`` depends on.
    """
    kept = vars(sys.modules.setdefault("_veildesk_worker", types.ModuleType("_veildesk_worker")))
    if key not in kept:
        kept[key] = make()
    return kept[key]


def id_field(df: DataFrame, name: str) -> T.StructField:
    """The id column's own type under its own name, nulls allowed."""
    return T.StructField(name, df.schema[name].dataType, True)


def text_hash(text: Column) -> Column:
    """128 bits that stand for a text; rows with equal texts share every verdict on the text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, as a URI that executors can open."""
    path = scratch_path(spark, label)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI, from any task or the driver."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
