"""WARC archives: round trip, revisits and range reads."""

import base64
import hashlib

import pytest

from veildesk.llm import warc_archive as W
from veildesk.llm.common import shared_folder


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def by_hand(pages, least=0):
    """Expected rows; for rows that repeat id and payload one is the response."""
    out, winners, used = [], {}, set()
    for page, html in pages:
        size = len((html or "").encode())
        if size >= least:
            rank = (page is not None, page or 0)
            winners[digest(html)] = max(winners.get(digest(html), rank), rank)
    for page, html in pages:
        d, size = digest(html), len((html or "").encode())
        top = winners.get(d)
        target = top[1] if top and top[0] else None
        small = size < least
        kind = "response" if small or (page == target and d not in used) else "revisit"
        if kind == "response" and not small:
            used.add(d)
        out.append((page, size, d, kind, target if kind == "revisit" else None))
    return out


def check(spark, rows, least=0):
    schema = "page_id long, url string, html string, key string, n_same long, payload string"
    given = [(p, f"http://h{i}.example/{i}", h, "x", 7, "y") for i, (p, h) in enumerate(rows)]
    pages = spark.createDataFrame(given, schema).repartition(4)
    found = [tuple(r) for r in W.archive_pages(pages, least).collect()]
    assert sorted(found, key=repr) == sorted(by_hand(rows, least), key=repr)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    found = [tuple(r) for r in W.archive_pages(pages).collect()]
    assert sorted(found) == sorted(by_hand(rows))


def test_odd_rows(spark):
    rows = [
        (1, "a"), (2, "a"), (3, None), (4, ""), (5, "é" * 200_000), (6, "b\r\n\r\nWARC/1.1\r\n"),
        (7, "a"), (7, "a"), (7, "c"), (None, "a"), (None, "only null"), (None, "only null"),
    ]
    check(spark, rows)
    check(spark, rows, least=2)
    check(spark, [])
    check(spark, [(i, "same") for i in range(300)])


def test_selected_records_and_payloads(spark):
    rows = [(i, f"http://x.example/{i}\r\nline", f"<p>{i % 5}</p>" * 50) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_folder(spark, "warc")
    index = W.write_archives(W.records(pages, 0), folder)
    assert index.count() == 40 and index.where("record_type = 'response'").count() == 5
    some = W.read_records(index.where("record_type = 'response'"), folder, payloads=True)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in some.collect()} == {
        (i, f"<p>{i % 5}</p>" * 50) for i in range(35, 40)
    }
    assert {r["url"] for r in some.collect()} == {f"http://x.example/{i}%0D%0Aline" for i in range(35, 40)}


def test_ranges_are_coalesced():
    ranges = [(0, 10), (10, 10), (25, 5), (1000, 10), (1010, 5000), (6010, 1)]
    found = list(W.coalesced(ranges, gap=5, most=100))
    assert [(a, b) for a, b, _ in found] == [(0, 30), (1000, 1010), (1010, 6010), (6010, 6011)]
    assert [r for _, _, inside in found for r in inside] == ranges


def test_a_damaged_record_is_noticed():
    record = W.record_bytes(1, "u", digest("abc"), 3, b"abc")
    assert W._parsed(record, True) == (1, "u", "response", digest("abc"), 3, b"abc")
    with pytest.raises(ValueError):
        W._parsed(record.replace(b"abc", b"abd"), True)
