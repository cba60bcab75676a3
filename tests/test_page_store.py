"""Stored export pages: what a read opens, and where it ends."""

import json

import pytest
from pyspark.sql import functions as F

from veildesk.sources import page_store
from veildesk.sources.exports import read_paged_export
from veildesk.sources.page_store import last_page, read_stored_export, store_pages
from veildesk.staging import scratch_path

USERS = {"users": "id long, name string"}


def page(no, items, more):
    body = {"items": [{"id": i} for i in items], "users": [{"id": no, "name": f"u{no}"}]}
    return no, json.dumps(body | ({"next_page": "x"} if more else {}))


@pytest.fixture(scope="module")
def stored(spark):
    """Pages 0 to 99, three items each, in ranges of ten; the export ends with page 42."""
    rows = [page(n, range(3 * n, 3 * n + 3), n != 42) for n in range(60)]
    rows += [(n, "this is not JSON") for n in range(60, 100)]
    path = scratch_path(spark, "pages")
    df = spark.createDataFrame(rows, "page_no long, body string").repartition(7)
    store_pages(df.where("page_no < 50"), path, "items", 10)
    store_pages(df.where("page_no >= 50"), path, "items", 10)
    return path


def ranges_read(df):
    name = F.regexp_extract(F.input_file_name(), "page_range=([0-9]+)", 1)
    return {int(r[0]) for r in df.select(name).distinct().collect()}


def test_pages_behind_the_end_are_pruned(spark, stored):
    assert last_page(spark, stored) == (4, 42)
    export = read_stored_export(spark, stored, "items", "id long", USERS)
    assert ranges_read(export.items) == {0, 1, 2, 3, 4}
    plan = export.items._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(page_range" in plan and "page_range" in plan and "<= 4" in plan
    assert sorted(r.id for r in export.items.collect()) == list(range(129))
    assert sorted(r.id for r in export.sideloads["users"].collect()) == list(range(43))


@pytest.mark.parametrize("limit", [1, 3, 4, 30, 31, 128, 129, 500])
def test_a_limit_ends_at_its_page(spark, stored, limit):
    rows = [page(n, range(3 * n, 3 * n + 3), n != 42) for n in range(60)]
    plain = read_paged_export(spark.createDataFrame(rows, "page_no long, body string"), "items", "id long", USERS, limit)
    found = read_stored_export(spark, stored, "items", "id long", USERS, limit)
    assert sorted(found.items.collect()) == sorted(plain.items.collect())
    assert sorted(found.sideloads["users"].collect()) == sorted(plain.sideloads["users"].collect())
    last = min((limit - 1) // 3, 42)
    assert last_page(spark, stored, limit) == (last // 10, last)


def test_bodies_are_not_read_to_find_the_end(spark, stored):
    narrow = spark.read.parquet(stored).agg(F.min(F.when(~F.col("continues"), F.col("page_no"))))
    assert "body" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_no_pages_and_no_end(spark):
    path = scratch_path(spark, "pages")
    store_pages(spark.createDataFrame([], "page_no long, body string"), path, "items")
    assert last_page(spark, path) is None
    assert read_stored_export(spark, path, "items", "id long").items.count() == 0
    store_pages(spark.createDataFrame([page(0, [1], True), page(1, [], True)], "page_no long, body string"), path, "items")
    assert last_page(spark, path) == (0, 1)
    assert [r.id for r in read_stored_export(spark, path, "items", "id long").items.collect()] == [1]


def test_a_read_lists_the_folders_once(spark, stored, monkeypatch):
    listed = []
    monkeypatch.setattr(page_store, "_stored", lambda s, path, own=page_store._stored: listed.append(path) or own(s, path))
    assert read_stored_export(spark, stored, "items", "id long", USERS).items.count() == 3 * 43
    assert listed == [stored]
