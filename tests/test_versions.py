"""Stored ticket tables: what a change set rewrites, and what it must leave alone."""

import os
import time

import pytest
from pyspark.sql import functions as F

from veildesk.operators import changes
from veildesk.operators import versions as V
from veildesk.staging import dealt, scratch_path, staged

TICKET = "id long, subject string, status string, priority string, type string, tags array<string>"
VALUE = "ticket_id long, field_id long, pos long, value string"
COMMENT = "id long, ticket_id long, seq long, author_id long, public boolean, created_at timestamp, body string, html_body string"
PATCH = "ticket_id long, seq long, status string, comment string"


@pytest.fixture
def stored(spark):
    tickets = [(i, f"t{i}", "new", None, None, ["a"]) for i in range(400)]
    values = [(i, 10, 0, "x") for i in range(0, 400, 2)]
    comments = [(1000 + i, i, 0, None, True, None, f"body {i}", None) for i in range(400)]
    comments += [(5000 + i, None, 0, None, True, None, "no ticket", None) for i in range(50)]
    return V.TicketTables.create(
        scratch_path(spark, "tables"),
        spark.createDataFrame(tickets, TICKET),
        spark.createDataFrame(values, VALUE),
        spark.createDataFrame(comments, COMMENT),
        buckets=16,
    )


def listing(stored):
    root = stored.path.removeprefix("file://")
    return {
        bucket: {f for f in os.listdir(f"{root}/{bucket}") if f.endswith(".parquet")}
        for bucket in os.listdir(root) if bucket.startswith("bucket=")
    }


def in_folder(spark, stored, bucket):
    ids = spark.range(400).where(V._bucket(F.col("id"), F.col("id"), stored.buckets) == bucket)
    return sorted(r["id"] for r in ids.collect())


def test_tables_come_back(spark, stored):
    again = V.TicketTables(spark, stored.path)
    assert again.buckets == 16
    assert (again.tickets.count(), again.custom_values.count(), again.comments.count()) == (400, 200, 450)
    assert again.tickets.columns == [c.split()[0] for c in TICKET.split(", ")]


def test_a_patch_rewrites_its_folder_only(spark, stored):
    four = in_folder(spark, stored, 3)[:4]  # 1 % of the tickets
    patches = [(i, 0, "solved", "done") for i in four]
    before = listing(stored)
    done = stored.update(spark.createDataFrame(patches, PATCH))
    after = listing(stored)
    assert done.buckets == [3] and before["bucket=3"].isdisjoint(after["bucket=3"])
    assert {b for b in before if before[b] != after[b]} == {"bucket=3"}
    solved = {r["id"] for r in stored.tickets.where("status = 'solved'").collect()}
    said = {r["ticket_id"] for r in stored.comments.where("body = 'done' and seq = 1").collect()}
    assert solved == said == set(four) == {r["id"] for r in done.touched.collect()}
    assert (stored.tickets.count(), stored.custom_values.count(), stored.comments.count()) == (400, 200, 454)


def test_folders_of_a_change_set_are_read_alone(spark, stored):
    plan = stored._part("ticket", [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    read = stored._part("ticket", [3]).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) == 1 and "bucket=3/" in read[0].f


def test_a_failed_change_leaves_the_tables(spark, stored, monkeypatch):
    before = listing(stored)
    bad = F.udf(lambda x: 1 // 0, "string")
    monkeypatch.setattr(V, "_laid_out", lambda rows: rows.withColumn("part", bad("part")))
    with pytest.raises(Exception):
        stored.update(spark.createDataFrame([(5, 0, "solved", "done")], PATCH))
    assert listing(stored) == before and stored.tickets.where("status = 'solved'").count() == 0


def test_folders_are_rewritten_in_rounds_and_exchanged_at_the_end(spark, stored, monkeypatch):
    laid_out, asked = V._laid_out, []
    bad = F.udf(lambda x: 1 // 0, "string")

    def written(rows, fails_at=None):
        asked.append(listing(stored))
        rows = laid_out(rows)
        return rows.withColumn("part", bad("part")) if len(asked) == fails_at else rows

    patches = spark.createDataFrame([(i, 0, "solved", "done") for i in range(0, 400, 3)], PATCH)
    before = listing(stored)
    monkeypatch.setattr(V, "_laid_out", lambda rows: written(rows, 3))
    with pytest.raises(Exception):
        stored.update(patches)
    assert len(asked) == 3 and listing(stored) == before
    assert not [f for f in os.listdir(stored.path.removeprefix("file://")) if f.startswith(".new")]
    asked.clear()
    monkeypatch.setattr(V, "_laid_out", written)
    done = stored.update(patches)
    # 16 folders, 4 at a time, and until the last are written the table is as it was.
    assert len(done.buckets) == 16 and len(asked) == 4 and all(now == before for now in asked)
    assert all(before[b].isdisjoint(files) for b, files in listing(stored).items())
    assert not [f for f in os.listdir(stored.path.removeprefix("file://")) if f.startswith(".new")]
    solved = {r["id"] for r in stored.tickets.where("status = 'solved'").collect()}
    said = {r["ticket_id"] for r in stored.comments.where("body = 'done' and seq = 1").collect()}
    assert solved == said == set(range(0, 400, 3))
    assert (stored.tickets.count(), stored.custom_values.count(), stored.comments.count()) == (400, 200, 584)


def test_a_write_leaves_no_shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting)
    rows = staged(spark.range(1_000).repartition(5, "id").groupBy(F.col("id") % 7).count(), "x")
    for _ in range(50):  # they are deleted in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(setting) == was and rows.count() == 7


def test_comments_are_added_without_a_rewrite(spark, stored):
    kind = "id long, ticket_id long, pos long, author_id long, body string, html_body string, is_public boolean, created_at timestamp"
    before = listing(stored)
    stored.add_comments(spark.createDataFrame([(1, 7, 0, 9, "hi", None, None, None), (2, 7, 1, 9, "", "<p>", False, None)], kind))
    after = listing(stored)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and before[changed[0]] < after[changed[0]]
    rows = stored.comments.where("ticket_id = 7").orderBy("seq").collect()
    assert [(r.seq, r.public, r.body, r.html_body) for r in rows] == [
        (0, True, "body 7", None), (1, True, "hi", None), (2, False, None, "<p>"),
    ]


def test_patches_of_equal_or_no_order(spark, stored):
    patches = [
        (1, 0, "hold", None), (1, 0, "solved", None),  # nothing says which is last
        (2, None, "hold", "a"), (2, None, "solved", "b"),
        (3, 5, "hold", "same"), (3, 5, "hold", "same"),  # sent twice
        (4, 1, "hold", None), (4, 2, "solved", None),
        (5, None, "open", None), (900, 0, "open", None), (None, 0, "open", None), (6, 0, "odd", None),
    ]
    for rows in (patches, patches[::-1]):
        done = stored.update(spark.createDataFrame(rows, PATCH))
        problems = sorted((r.ticket_id or 0, r.problem) for r in done.rejected.collect())
        assert problems == [
            (0, "unknown ticket"), (1, "repeated seq"), (1, "repeated seq"), (2, "repeated seq"),
            (2, "repeated seq"), (6, "status: odd"), (900, "unknown ticket"),
        ]
        now = {r.id: r.status for r in stored.tickets.where("id between 1 and 6").collect()}
        assert now == {1: "new", 2: "new", 3: "hold", 4: "solved", 5: "open", 6: "new"}
    places = stored.comments.groupBy("ticket_id", "seq").count().where("ticket_id is not null and count > 1")
    assert places.count() == 0
    assert stored.update(spark.createDataFrame([], PATCH)).buckets == []


def test_macros(spark, stored):
    actions = spark.createDataFrame([(1, 0, "status", "pending"), (1, 1, "comment", "by macro")], "macro_id long, pos int, field string, value string")
    uses = spark.createDataFrame([(8, 1, 0), (900, 1, 0)], "ticket_id long, macro_id long, seq long")
    done = stored.apply_macros(actions, uses)
    assert [r.ticket_id for r in done.applied.collect()] == [8]
    assert [r.ticket_id for r in done.rejected.collect()] == [900]
    assert stored.tickets.where("id = 8").first().status == "pending"
    assert stored.comments.where("ticket_id = 8 and body = 'by macro'").count() == 1


def test_a_task_gets_no_more_rows_when_the_input_grows(spark):
    rows = spark.range(1_000).select("id", (F.col("id") % 7).alias("x"))
    once = dealt(rows, ["id"], rows=10).distinct()
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [id#" in plan and ", 100" in plan
    assert once._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1
    sizes = once.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert once.count() == 1_000 and sizes < 40


def test_patches_are_dealt_by_rows_and_counted_once(spark):
    tickets = spark.createDataFrame([(1,), (2,)], "id bigint")
    given = [(1, 1, "open"), (1, 1, "open"), (1, 2, "open"), (1, 2, "solved"), (3, 1, "open"), (2, None, "open")]
    patches = spark.createDataFrame(given, "ticket_id bigint, seq bigint, status string")
    checked = changes._checked(tickets, patches)
    found = {(r.ticket_id, r.seq, r.status, r.problem) for r in checked.collect()}
    assert checked.count() == 5 and found == {
        (1, 1, "open", None), (1, 2, "open", "repeated seq"), (1, 2, "solved", "repeated seq"),
        (3, 1, "open", "unknown ticket"), (2, 0, "open", None),
    }
