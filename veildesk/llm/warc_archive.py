"""WARC archives with an index written first and coalesced range reads.

Writing: every record is a gzip member of its own, so each can be read by offset and length.
A task writes one archive and returns, per record, file, offset, length, URL and digest; these
rows are the index, and it alone names the archives, so what a lost attempt wrote is never
read. Of records with equal payloads one is the response and the others are revisits.

Reading: the selected index rows are sorted by file and offset, neighbours are merged into one
range read of bounded size, and the records in it are parsed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import map_rows, open_folder, shared_folder
from veildesk.staging import staged

# The format's version line, its revisit profile and the base-32 alphabets.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIGITS32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LEVEL = 1
#: Neighbouring records are read at once if at most this many bytes lie between them.
GAP = 64 << 10
#: Bytes of one range read, more only for a single record that is longer.
RANGE = 4 << 20
INDEX = (
    "file string, offset bigint, length bigint, url string, payload_digest string,"
    " record_type string, page_id bigint, payload_bytes bigint"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary column, 32 characters."""
    digest = F.sha1(payload)
    # 160 bits are four numbers of 40 bits, eight base-32 digits each.
    digits = [
        F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in range(1, 41, 10)
    ]
    return F.translate(F.concat(*digits), _DIGITS32, _BASE32)


def records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with payload, digest and whether each is the one to keep of equal payloads.

    Equal payloads are found by digest; the largest page id wins, a null id only if there is no
    other. Rows go to partitions by digest and id, so a payload that a third of the pages share
    is spread over all of them. ``n_same`` counts rows that repeat both.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    whole = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        sha1_base32(payload).alias("payload_digest"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )
    each = whole.where(F.col("payload_bytes") >= min_bytes)
    same = each.groupBy("payload_digest", "page_id").agg(F.count("*").alias("n_same"))
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("has"), F.col("page_id"), F.col("n_same")))
    top = (
        same.groupBy("payload_digest").agg(best.alias("best"))
        .select("payload_digest", F.col("best.page_id").alias("page_id"), F.col("best.n_same").alias("n_same"))
    )
    top = staged(top, "responses")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One key column without nulls, so that the join keeps the partitions that are dealt here.
    key = F.concat_ws(":", "payload_digest", "page_id")
    left = whole.withColumn("key", key).repartition(parts, "key").alias("w")
    right = top.select(key.alias("key"), "n_same").repartition(parts, "key").alias("t")
    return left.join(right, F.col("w.key") == F.col("t.key"), "left").select(
        "w.page_id", "w.url", "w.payload_digest", "w.payload_bytes", "t.n_same",
        # Revisits leave their payload behind.
        F.when(
            F.col("t.n_same").isNotNull() | (F.col("w.payload_bytes") < min_bytes), F.col("w.payload")
        ).alias("payload"),
    )


def record_bytes(
    page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None
) -> bytes:
    """One record; without a payload it is a revisit, which still tells the digest and size."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}|{payload is None}")
    header = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if payload is None else b"response"),
        f"WARC-Record-ID: <urn:uuid:{name}>".encode(),
        f"WARC-Target-URI: {_one_line(url)}".encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"X-Payload-Bytes: {size}".encode(),
    ]
    if page_id is not None:
        header.append(f"X-Page-Id: {page_id}".encode())
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if payload is None:
        header.append(b"WARC-Profile: " + PROFILE.encode())
    else:
        block += payload
    header += [
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: " + str(len(block)).encode(),
    ]
    return b"\r\n".join(header) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return "".join("%%%02X" % ord(c) if c in "\r\n" else c for c in url or "")


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and the payload after the HTTP header of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, _, value = line.partition(b": ")
        fields[name.decode().lower()] = value.decode()
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``records`` as one archive a task and return the index, staged.

    Of rows that repeat digest and id, which lie in one partition, the first becomes the
    response; a task remembers only digests for which that happens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, at, repeated = None, 0, set()
        schema = pa.schema(
            [
                ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                ("url", pa.string()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("page_id", pa.int64()),
                ("payload_bytes", pa.int64()),
            ]
        )
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    digest, payload = row["payload_digest"], row["payload"]
                    if payload is not None and (row["n_same"] or 0) > 1:
                        payload = None if digest in repeated else payload
                        repeated.add(digest)
                    member = _member(
                        record_bytes(row["page_id"], row["url"], digest, row["payload_bytes"], payload)
                    )
                    if out is None:
                        files.create_dir(path, recursive=True)
                        out = files.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(member)
                    kind = "revisit" if payload is None else "response"
                    index.append(
                        (name, at, len(member), row["url"], digest, kind, row["page_id"], row["payload_bytes"])
                    )
                    at += len(member)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*index), schema, strict=True)]
                if index:
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
        finally:
            if out is not None:
                out.close()

    return staged(rows.mapInArrow(run, INDEX), "warc-index")


def coalesced(
    rows: list[tuple[int, int]], gap: int = GAP, most: int = RANGE
) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """``start, end, [(offset, length)]`` of merged reads, from ranges sorted by offset."""
    start = end = None
    inside: list[tuple[int, int]] = []
    for offset, length in rows:
        if inside and (offset - end > gap or offset + length - start > most):
            yield start, end, inside
            inside = []
        if not inside:
            start = end = offset
        inside.append((offset, length))
        end = max(end, offset + length)
    if inside:
        yield start, end, inside


def read_records(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Parse the records that ``index`` selects, by coalesced range reads of its archives.

    Returns ``page_id, url, record_type, payload_digest, payload_bytes`` and, on request,
    ``payload``. The digest is computed anew from the payload that was read; a response whose
    digest or size differs from what its header says fails the job.
    """
    schema = (
        "page_id bigint, url string, record_type string, payload_digest string,"
        " payload_bytes bigint" + (", payload binary" if payloads else "")
    )
    fields = T._parse_datatype_string(schema)

    def rows(files: list, offsets: list, lengths: list) -> Iterator[tuple]:
        system, path = open_folder(folder)
        order = sorted(zip(files, offsets, lengths, strict=True))
        at = 0
        while at < len(order):
            name, end = order[at][0], at
            while end < len(order) and order[end][0] == name:
                end += 1
            with system.open_input_file(f"{path}/{name}") as archive:
                for start, stop, inside in coalesced([r[1:] for r in order[at:end]]):
                    chunk = archive.read_at(stop - start, start)
                    for offset, length in inside:
                        member = chunk[offset - start : offset - start + length]
                        yield _parsed(zlib.decompress(member, 31), payloads)
            at = end

    chosen = index.select("file", "offset", "length")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return map_rows(ordered, rows, fields)


def _parsed(record: bytes, payloads: bool) -> tuple:
    fields, payload = parse(record)
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(fields["x-payload-bytes"])
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
    page = fields.get("x-page-id")
    row = (None if page is None else int(page), fields["warc-target-uri"], kind, digest, size)
    return (*row, payload if kind == "response" else None) if payloads else row


def archive_pages(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record per page, read all archives back, and tell each page's record.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``: the payload is
    the html in UTF-8, a null one is empty. Of records with equal payloads of at least
    ``min_bytes`` the one with the largest page id is the response, the others are revisits
    that refer to it; null ids are smallest. Rows that repeat the winner's id and payload are
    revisits too, referring to the same id. Smaller payloads are all responses.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    index = write_archives(records(pages, min_bytes), folder)
    read = staged(read_records(index, folder), "warc-records")
    responses = read.where("record_type = 'response'").where(F.col("payload_bytes") >= min_bytes)
    target = responses.select(
        F.col("payload_digest").alias("digest"), F.col("page_id").alias("refers_to")
    )
    revisits = read.where("record_type = 'revisit'").join(
        target, F.col("payload_digest") == F.col("digest"), "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    kept = read.where("record_type = 'response'").select(
        *columns, F.lit(None).cast("bigint").alias("refers_to")
    )
    return kept.unionAll(revisits.select(*columns, "refers_to"))
