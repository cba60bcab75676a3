"""Sources, projections and change sets on literal rows."""

import pytest
from pyspark.sql import functions as F

from veildesk.checks.tables import table
from veildesk.operators import activity, changes, directory, tickets, views
from veildesk.schemas import ATTACHMENT
from veildesk.sources.attachments import read_attachment_files, with_attachment_names
from veildesk.sources.exports import (
    comment_table,
    number_or_null,
    read_paged_export,
    read_resource,
    sideload_index,
    ticket_tables,
    typed_array,
)
from veildesk.staging import left_lookup, scratch_path

PAGES = [
    (1, '{"items":[{"id":1},{"id":2}],"users":[{"id":9,"name":"a"}],"meta":{"has_more":true},"links":{"next":"u"}}'),
    (2, '{"items":[{"id":3},{"id":4}],"users":[{"id":9,"name":"b"},{"id":8,"name":"c"}],"next_page":"v"}'),
    (3, '{"users":[{"id":7,"name":"d"}],"next_page":"w"}'),
    (4, '{"items":[{"id":5}],"meta":{"has_more":true},"links":{}}'),
    (5, '{"items":[{"id":6}]}'),
]


def export(spark, pages=PAGES, limit=None):
    df = spark.createDataFrame(pages, "page_no long, body string")
    return read_paged_export(df, "items", "id long", {"users": "id long, name string"}, limit)


def ids(df):
    return [r.id for r in df.orderBy("page_no", "pos").collect()]


def test_export_stops_where_links_stop(spark):
    out = export(spark)
    assert ids(out.items) == [1, 2, 3, 4, 5]
    assert ids(out.sideloads["users"]) == [9, 9, 8, 7]


def test_export_limit_keeps_side_rows_of_the_last_page(spark):
    out = export(spark, limit=3)
    assert ids(out.items) == [1, 2, 3]
    assert ids(out.sideloads["users"]) == [9, 9, 8]
    assert ids(export(spark, limit=2).sideloads["users"]) == [9]
    assert ids(export(spark, limit=50).items) == [1, 2, 3, 4, 5]


def test_export_fails_on_broken_pages(spark):
    with pytest.raises(Exception):
        export(spark, [(1, "{not json")]).items.collect()


def test_fields_of_another_type_are_null(spark):
    body = """{"tickets":[
        {"id":1,"tags":"abc","subject":5,"custom_fields":[{"id":3,"value":"v"},{"id":"4","value":true}]},
        {"id":2,"tags":["a",7],"group_id":"12","requester_id":9,"custom_fields":{}},
        {"id":1,"tags":[],"subject":"again"}, "no ticket", null],
        "users":[{"id":9,"name":"Ann","active":"yes"}]}"""
    made = ticket_tables(spark.createDataFrame([(1, body)], "page_no long, body string"))
    rows = {r.id: r for r in made["tickets"].collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].subject, rows[1].tags) == ("again", [])
    assert (rows[2].tags, rows[2].group_id, rows[2].requester_id) == (["a", "7"], None, 9)
    assert made["custom_values"].count() == 0
    user = made["users"].first()
    assert (user.id, user.name, user.active) == (9, "Ann", None)
    first = body.replace(""",
        {"id":1,"tags":[],"subject":"again"}""", "")
    made = ticket_tables(spark.createDataFrame([(1, first)], "page_no long, body string"))
    row = made["tickets"].where("id = 1").first()
    assert (row.subject, row.tags) == ("5", None)
    values = [(r.ticket_id, r.field_id, r.pos, r.value) for r in made["custom_values"].collect()]
    assert sorted(values, key=str) == [(1, 3, 0, "v"), (1, None, 1, "true")]
    page = '{"comments":[{"id":5,"attachments":[{"id":1,"size":"12"},{"id":2,"size":12}]},{"id":6,"attachments":4}]}'
    made = comment_table(spark.createDataFrame([(7, 0, page)], "ticket_id long, page_no long, body string"))
    flat = [(r.ticket_id, r.seq, r.pos, r.size) for r in tickets.attachments_flat(made).collect()]
    assert flat == [(7, 0, 0, None), (7, 0, 1, 12)]


def test_last_record_per_id_wins(spark):
    rows = sideload_index(export(spark).sideloads["users"], ["page_no", "pos"])
    assert {r.id: r.name for r in rows.collect()} == {9: "b", 8: "c", 7: "d"}


def test_json_numbers_only(spark):
    df = spark.createDataFrame([('{"a":12}',), ('{"a":"12"}',), ('{"a":null}',), ("{}",)], "b string")
    size = F.try_variant_get("resource", "$.a", "variant")
    rows = read_resource(df, "b").select(number_or_null(size).alias("n")).collect()
    assert [r.n for r in rows] == [12, None, None, None]


def test_attachment_names(spark):
    rows = [
        ("https://h/x/y.png", None, "y.png"),
        ("https://h/x/y?name=a%20b.txt&z=1", None, "a b.txt"),
        ("https://h/x/y?name=%zz", None, "%zz"),
        ("https://h/x/y", None, "attachment"),
        ("https://h.example", None, "attachment"),
        ("https://h/x/y.png", 'inline; filename="q r.pdf"', "q r.pdf"),
        ("https://h/x/y.png", "inline; filename*=UTF-8''q%20r.pdf", "q r.pdf"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "u string, d string")
    out = with_attachment_names(df, "u", "d").collect()
    assert [r.file_name for r in out] == [r[2] for r in rows]


def test_attachment_files_are_listed_without_content(spark):
    path = scratch_path(spark, "files")
    spark.createDataFrame([("abc",)], "t string").coalesce(1).write.text(path)
    files = read_attachment_files(spark, path)
    assert "content" not in files.columns
    assert files.where(F.endswith("file_name", F.lit(".txt"))).first().held_back
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id long, user_id long")
    users = spark.createDataFrame([(5, "ann"), (None, "none")], "id long, name string")
    out = left_lookup(left, users, "user_id", {"name": "user"}).orderBy("id").collect()
    assert [r.user for r in out] == ["ann", None, None]


def test_comment_body_and_visibility(spark):
    df = spark.createDataFrame(
        [(1, None, "", "plain", None), (1, None, None, " plain ", False), (1, None, None, None, True)],
        "id long, author_id long, body string, plain_body string, public boolean",
    )
    users = spark.createDataFrame([], "id long, name string")
    rows = tickets.comment_rows(df, users).collect()
    assert sorted((r.body, r.public) for r in rows) == [("", True), ("", True), ("plain", False)]


def test_sparse_and_long_threads_stay_whole(spark):
    users = spark.createDataFrame([(1, "ann")], "id long, name string")
    comments = spark.range(25).select(
        F.col("id"), F.lit(7).cast("bigint").alias("ticket_id"), (F.col("id") * 100_000).alias("seq"),
        F.lit(1).cast("bigint").alias("author_id"), F.lit(None).cast("boolean").alias("public"),
        F.lit("t").alias("created_at"), F.lit("b").alias("body"), F.lit(None).cast("string").alias("plain_body"),
        F.lit(None).cast("string").alias("html_body"), F.array().cast(f"array<{ATTACHMENT}>").alias("attachments"),
    )
    header = spark.createDataFrame([(7,), (8,)], "id long")
    rows = {r.id: r for r in tickets.nested(tickets.Detail(header, tickets.thread(comments, users))).collect()}
    assert [c.seq for c in rows[7].conversation] == [i * 100_000 for i in range(25)]
    assert rows[8].conversation is None and rows[8].attachments == []


def test_limits_only_on_request(spark):
    rows = spark.range(3000)
    assert views.view_tickets(rows, F.lit(True)).agg(F.count("*"), F.max("returned")).first()[:] == (3000, 3000)
    assert [r[:] for r in views.view_tickets(rows, F.lit(True), 2).collect()] == [(0, 2), (1, 2)]
    owned = rows.select("id", (F.col("id") % 3).alias("o"), (F.col("id") % 500).alias("created_at"))
    every = activity.newest_tickets(owned.repartition(7), "o")
    assert every.count() == 3000
    first = every.where("rank <= 4").select("id", "o", "rank")
    assert sorted(first.collect()) == sorted(activity.newest_tickets(owned, "o", 4).select("id", "o", "rank").collect())
    assert {r.returned for r in every.collect()} == {1000}


def test_one_user(spark):
    users = spark.createDataFrame(
        [(1, "Ann", "a@b.co", "agent", None, None, None)],
        "id long, name string, email string, role string, organization_id long, active boolean, created_at string",
    )
    assert directory.get_users(users, [1]).first().active is False
    assert directory.me(users, 1).first().email == "a@b.co"


TICKETS = "id long, status string, priority string, type string, assignee_id long, group_id long, tags array<string>"
PATCHES = (
    "ticket_id long, seq long, status string, priority string, assignee_id long, tags array<string>, "
    "custom_fields array<struct<id:bigint,value:string>>, comment string, comment_public boolean"
)


def test_update_rules(spark):
    table = spark.createDataFrame(
        [(1, "new", "low", None, 5, 6, ["a"]), (2, "new", None, None, None, None, ["b"])], TICKETS
    )
    values = spark.createDataFrame(
        [(1, 10, 0, "x"), (1, 11, 1, "y")], "ticket_id long, field_id long, pos long, value string"
    )
    patches = spark.createDataFrame(
        [
            (1, 0, "open", "", 9, None, [(11, None), (12, "z")], "", None),
            (1, 1, "", None, None, [], None, "hello", None),
            (2, 0, "bogus", "high", None, None, None, "lost", None),
            (2, 1, None, "urgent", None, None, None, "note", False),
            (3, 0, "open", None, None, None, [(10, "q")], "to nobody", None),
            (None, 0, "open", None, None, None, None, None, None),
        ],
        PATCHES,
    )
    done = changes.update_tickets(table, values, patches)
    rows = {r.id: r for r in done.tickets.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].status, rows[1].priority, rows[1].assignee_id, rows[1].group_id) == ("open", "low", 9, 6)
    assert rows[1].tags == []
    assert (rows[2].status, rows[2].priority, rows[2].tags) == ("new", "urgent", ["b"])
    fields = {(r.ticket_id, r.field_id): (r.value, r.pos) for r in done.custom_values.collect()}
    assert fields[1, 10] == ("x", 0) and fields[1, 11] == (None, 1) and fields[1, 12][0] == "z"
    assert {(r.body, r.is_public) for r in done.comments.collect()} == {("hello", True), ("note", False)}
    assert sorted(r.problem for r in done.rejected.collect()) == ["status: bogus", "unknown ticket", "unknown ticket"]
    assert {r.id for r in done.touched.collect()} == {1, 2}
    assert {r.ticket_id for r in done.custom_values.collect()} == {1}
    thread = spark.createDataFrame([(1, 5, "old")], "ticket_id long, seq long, body string")
    done = changes.update_tickets(table, values, patches, thread)
    assert sorted((r.ticket_id, r.seq, r.body) for r in done.thread.collect()) == [
        (1, 5, "old"), (1, 7, "hello"), (2, 1, "note"),
    ]
    details = table.select("id")
    assert changes.changed_details(details.union(spark.range(5, 6)), done.touched).count() == 2


def test_macros_change_only_their_columns(spark):
    table = spark.createDataFrame([(1, "new", "low", None, 5, 6, ["a"])], TICKETS)
    values = spark.createDataFrame([], "ticket_id long, field_id long, pos long, value string")
    actions = spark.createDataFrame(
        [
            (4, 0, "status", "solved"), (4, 1, "tags", "x, y"), (4, 2, "requester_id", "77"),
            (4, 3, "custom_fields_3", "v"), (4, 4, "comment", "bye"), (5, 0, "tags", ""),
            (4, 5, "status", "hold"),
        ],
        "macro_id long, pos long, field string, value string",
    )
    uses = spark.createDataFrame([(1, 4, 0), (9, 4, 0)], "ticket_id long, macro_id long, seq long")
    applied, done = changes.apply_macros(table, values, actions, uses)
    row = done.tickets.first()
    assert (row.status, row.tags, row.priority) == ("hold", ["x", "y"], "low")
    assert [r.ticket_id for r in applied.collect()] == [1]
    assert "requester" not in applied.first().applied
    assert [r.ticket_id for r in done.custom_values.collect()] == [1]
    assert [r.body for r in done.comments.collect()] == ["bye"]
    assert [r.problem for r in done.rejected.collect()] == ["unknown ticket"]
    cleared = uses.withColumn("macro_id", F.lit(5).cast("bigint"))
    _, done = changes.apply_macros(table, values, actions, cleared)
    assert done.tickets.first().tags == []


def test_comments_are_appended_in_order(spark):
    old = spark.createDataFrame(
        [(1, 7, 0, 3, True, "t", "a", None)],
        "id long, ticket_id long, seq long, author_id long, public boolean, created_at string, body string, html_body string",
    )
    new = spark.createDataFrame(
        [(2, 7, 0, 3, "b", None, None, "t"), (3, 7, 1, 3, "c", "<p>c</p>", False, "t"), (4, 8, 0, 3, "d", "", None, "t")],
        "id long, ticket_id long, pos long, author_id long, body string, html_body string, is_public boolean, created_at string",
    )
    rows = {r.id: r for r in changes.add_comments(old, new).collect()}
    assert [(rows[i].seq, rows[i].public, rows[i].body) for i in (2, 3, 4)] == [
        (1, True, "b"), (2, False, None), (0, True, "d"),
    ]


@pytest.mark.parametrize("chunk", ["minute", "hour", "day"])
def test_metrics_do_not_depend_on_the_chunk(spark, sf_dir, chunk):
    events = table(spark, sf_dir, "audits")
    whole = activity.ticket_metrics(events, "year")
    assert activity.ticket_metrics(events, chunk).exceptAll(whole).count() == 0


def test_only_arrays_are_arrays_and_no_schema_of_a_page_is_made(spark):
    bodies = ['{"a":[1,"x",{"b":2}]}', '{"a":[]}', '{"a":"[1]"}', '{"a":{"0":1}}', '{"a":3}', '{"a":true}', '{"a":null}', "{}", '{"a":[null]}']
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string").repartition(2)
    found = rows.select("i", typed_array(F.try_variant_get(F.parse_json("body"), "$.a", "variant")).alias("v"))
    sizes = {r.i: r.n for r in found.select("i", F.when(F.col("v").isNotNull(), F.size("v")).alias("n")).collect()}
    assert sizes == {0: 3, 1: 0, 2: None, 3: None, 4: None, 5: None, 6: None, 7: None, 8: 1}
    assert "schema_of_variant" not in found._jdf.queryExecution().optimizedPlan().toString()
