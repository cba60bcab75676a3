"""Checked queries over the ticket model: sources, projections, joins, aggregates, changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veildesk.checks.tables import duck, table
from veildesk.functions.text import needs_scan
from veildesk.operators import activity, changes, directory, search, tickets, versions, views
from veildesk.plans.redaction import Policy
from veildesk.sources import page_store
from veildesk.sources.attachments import attachment_manifest, with_attachment_names
from veildesk.sources.exports import (
    comment_table,
    read_paged_export,
    read_resource,
    resource_field,
    sideload_index,
    ticket_tables,
)
from veildesk.staging import dealt, scratch_path, staged

BASE = "https://desk.example.com"
TICKET_ITEM = (
    "id bigint, subject string, status string, priority string, requester_id bigint, "
    "tags array<string>"
)

#: What a folder of the stored ticket tables holds.
TICKETS_IN_A_FOLDER = 100_000

QUERIES: dict = {}
ORACLES: dict = {}


def check(sql: str | None = None):
    """Register a query under its function name, with its oracle."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = duck(sql)
        return fn

    return add


def _tags(column: str = "tags"):
    return F.array_join(column, ",").alias("tags")


def _text(column: str):
    return F.col(column).cast("string").alias(column)


# ------------------------------------------------------------------- sources


def ticket_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as export pages of 100 with their requesters at the side; the last page has no
    continuation."""
    rows = table(spark, sf_dir, "tickets").withColumn("page_no", F.floor(F.col("id") / 100))
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("requester_id"), F.col("c_name").alias("name")
    )
    tags = F.when(F.col("id") % 13 == 5, F.lit('"abc"')).otherwise(F.to_json("tags"))
    item = F.to_json(
        F.struct(
            "id", "subject", "status", "priority", "type", "requester_id", "assignee_id", "group_id",
            F.col("created_at").cast("string").alias("created_at"),
            F.col("updated_at").cast("string").alias("updated_at"),
            F.parse_json(F.coalesce(tags, F.lit("null"))).alias("tags"),
        )
    )
    side = F.struct(
        F.col("requester_id").alias("id"),
        F.concat("name", F.lit(" p"), F.col("page_no").cast("string")).alias("name"),
    )
    last = rows.agg(F.max("page_no")).scalar()
    grouped = (
        rows.join(users, "requester_id", "left")
        .groupBy("page_no")
        .agg(
            F.array_sort(F.collect_list(F.struct("id", item.alias("item")))).alias("tickets"),
            F.array_sort(F.collect_set(side)).alias("users"),
        )
    )
    links = F.to_json(
        F.struct(
            "users",
            F.struct((F.col("page_no") < last).alias("has_more")).alias("meta"),
            F.struct(F.lit(f"{BASE}/next").alias("next")).alias("links"),
        )
    )
    body = F.concat(
        F.lit('{"tickets":['), F.array_join("tickets.item", ","), F.lit("],"), F.substring(links, 2, 1 << 30)
    )
    return staged(grouped.select("page_no", body.alias("body")), "pages")


def _export(spark, sf_dir):
    pages = ticket_pages(spark, sf_dir)
    return read_paged_export(pages, "tickets", TICKET_ITEM, {"users": "id bigint, name string"})


_EXPORTED = """
    select cast(floor(id / 100) as bigint) as page_no,
           row_number() over (partition by floor(id / 100) order by id) - 1 as pos,
           id, subject, status, requester_id,
           case when id % 13 <> 5 then array_to_string(tags, ',') end as tags
    from {tickets}"""


@check(_EXPORTED)
def read_paged_export_(spark, sf_dir):
    return _export_items(_export(spark, sf_dir).items)


@check(_EXPORTED)
def read_stored_export_(spark, sf_dir):
    """The same pages stored by range, behind them a tail that a read must not reach."""
    pages, path = ticket_pages(spark, sf_dir), scratch_path(spark, "stored-pages")
    tail = pages.select((F.col("page_no") + 1_000_000_000).alias("page_no"), F.lit("no page").alias("body"))
    page_store.store_pages(pages.unionByName(tail), path, "tickets", pages_in_a_range=16)
    users = {"users": "id bigint, name string"}
    return _export_items(
        page_store.read_stored_export(spark, path, "tickets", TICKET_ITEM, users).items
    )


def _export_items(items):
    return items.select(
        "page_no", F.col("pos").cast("bigint").alias("pos"), "id", "subject", "status",
        "requester_id", _tags(),
    )


@check("""
    select requester_id as id, concat(c_name, ' p', cast(max(floor(id / 100)) as bigint)) as name
    from {tickets} join customer on requester_id = c_custkey
    group by requester_id, c_name""")
def sideload_index_(spark, sf_dir):
    return sideload_index(_export(spark, sf_dir).sideloads["users"], ["page_no", "pos"])


@check("""
    select event_id, cast(json_extract(props, '$.k') as bigint) as k,
           json_type(props, '$.k') is not null as has_k
    from events""")
def read_resource_(spark, sf_dir):
    rows = read_resource(table(spark, sf_dir, "events"), "props")
    k = resource_field(F.col("resource"), "$.k", "bigint")
    return rows.select("event_id", k.alias("k"), k.isNotNull().alias("has_k"))


@check("""
    select page_id as id, case when page_id % 2 = 0 then 'text/html' end as content_type,
           case when page_id % 10 > 0 then cast(length(html) as bigint) end as size,
           concat('cv ', case when email is null then 'none' else '[EMAIL_ADDRESS]' end,
                  ' (final).pdf') as file_name,
           true as held_back
    from pages left join {users} on id = page_id""")
def attachment_manifest_(spark, sf_dir):
    people = table(spark, sf_dir, "users").select("id", "email")
    files = table(spark, sf_dir, "attachments").join(people, "id", "left")
    named = files.withColumn(
        "file_name", F.concat(F.lit("cv "), F.coalesce("email", F.lit("none")), F.lit(" (final).pdf"))
    )
    out = attachment_manifest(named, ["id"], "file_name", Policy(pseudonyms=False))
    return out.select("id", "content_type", "size", "file_name", "held_back")


@check(r"""
    select page_id,
           case when regexp_matches(url, '^https?://[^/]+[^?#]*/[^/?#]*\.[^/?#]*(\?|#|$)')
                then regexp_extract(url, '/([^/?#]+)/?(?:[?#].*)?$', 1)
                else 'attachment' end as from_url,
           concat('Report ', page_id, '+.pdf') as from_query,
           concat('page ', page_id, '.html') as from_header
    from pages""")
def attachment_filename(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumns(
        {
            "download": F.concat(
                F.regexp_replace("url", "[?#].*", ""),
                F.format_string("?a=b&name=Report%%20%d+.pdf&x=1", "page_id"),
            ),
            "header": F.format_string(
                "attachment; filename*=UTF-8''page%%20%d.html; size=1", "page_id"
            ),
        }
    )
    named = with_attachment_names(pages, "url", out="from_url")
    named = with_attachment_names(named, "download", out="from_query")
    named = with_attachment_names(named, "download", "header", out="from_header")
    return named.select("page_id", "from_url", "from_query", "from_header")


# ------------------------------------------------------ projections and filters

_NAMED = """
    from {tickets} t left join {users} r on r.id = t.requester_id
    left join {users} a on a.id = t.assignee_id
    left join {users} s on s.id = t.submitter_id
    left join {groups} g on g.id = t.group_id
    left join {organizations} o on o.id = t.organization_id"""


def _ticket_rows(spark, sf_dir, given=None):
    return tickets.ticket_rows(
        table(spark, sf_dir, "tickets") if given is None else given,
        table(spark, sf_dir, "users"),
        table(spark, sf_dir, "groups"),
        BASE,
    )


@check(f"""
    select t.id, '{BASE}/agent/tickets/' || t.id as url, subject, status, priority, type,
           r.name as requester, a.name as assignee, g.name as group_name,
           cast(t.created_at as varchar) as created_at, cast(t.updated_at as varchar) as updated_at,
           case when t.id % 13 = 5 then '' else coalesce(array_to_string(tags, ','), '') end as tags
           {_NAMED}""")
def ticket_rows(spark, sf_dir):
    """From export pages, some of whose tags are no array."""
    given = ticket_tables(ticket_pages(spark, sf_dir))["tickets"]
    return _ticket_rows(spark, sf_dir, given).select(
        "id", "url", "subject", "status", "priority", "type", "requester", "assignee",
        F.col("group").alias("group_name"), _text("created_at"), _text("updated_at"), _tags(),
    )


@check("""
    select c.id, ticket_id, seq, author_id, u.name as author,
           public is distinct from false as public, html_body,
           case when body is not null then substr(body, 2, length(body) - 2)
                else coalesce(plain_body, '') end as body
    from {comments} c left join {users} u on u.id = author_id""")
def comment_rows(spark, sf_dir):
    return tickets.comment_rows(
        table(spark, sf_dir, "comments"), table(spark, sf_dir, "users")
    ).select("id", "ticket_id", "seq", "author_id", "author", "public", "html_body", "body")


def comments_with_files(spark, sf_dir):
    """Comments with their attachments nested, as an export holds them."""
    files = with_attachment_names(table(spark, sf_dir, "attachments"), "content_url")
    nested = files.groupBy("ticket_id", "seq").agg(
        F.array_sort(
            F.collect_list(
                F.struct("pos", "id", "file_name", "content_url", "content_type", "size")
            )
        ).alias("files")
    )
    comments = table(spark, sf_dir, "comments").join(nested, ["ticket_id", "seq"], "left")
    bare = F.transform(
        "files",
        lambda f: F.struct(
            f["id"], f["file_name"], f["content_url"], f["content_type"], f["size"]
        ),
    )
    no_files = F.filter(bare, lambda _: F.lit(False))
    return comments.withColumn(
        "attachments",
        F.coalesce(
            bare,
            no_files,
            F.array().cast(
                "array<struct<id:bigint,file_name:string,content_url:string,"
                "content_type:string,size:bigint>>"
            ),
        ),
    ).drop("files")


def comment_pages(spark, sf_dir):
    """Comments as JSON pages of four per ticket; some sizes are text, as bad exports have them."""

    def file(f):
        size = F.coalesce(f["size"].cast("string"), F.lit("null"))
        odd = F.concat(F.lit('"'), size, F.lit('"'))
        return F.struct(
            f["id"].alias("id"), f["file_name"].alias("file_name"),
            f["content_url"].alias("content_url"), f["content_type"].alias("content_type"),
            F.parse_json(F.when(f["id"] % 7 == 3, odd).otherwise(size)).alias("size"),
        )

    item = F.to_json(
        F.struct(
            "id", "author_id", "public", "body", "plain_body", "html_body",
            F.transform("attachments", file).alias("attachments"),
        )
    )
    pages = (
        comments_with_files(spark, sf_dir)
        .groupBy("ticket_id", F.floor(F.col("seq") / 4).alias("page_no"))
        .agg(F.array_sort(F.collect_list(F.struct("seq", item.alias("item")))).alias("items"))
    )
    body = F.concat(F.lit('{"comments":['), F.array_join("items.item", ","), F.lit("]}"))
    return pages.select("ticket_id", "page_no", body.alias("body"))


@check("""
    select a.ticket_id, cast(floor(a.seq / 4) as bigint) * 1048576 + place as seq, a.pos, a.id,
           content_url, content_type, case when a.id % 7 <> 3 then size end as size
    from {attachments} a
    join (select ticket_id, seq, row_number() over (partition by ticket_id, floor(seq / 4)
                                                    order by seq) - 1 as place
          from {comments}) c on c.ticket_id = a.ticket_id and c.seq = a.seq""")
def attachments_flat(spark, sf_dir):
    return tickets.attachments_flat(comment_table(comment_pages(spark, sf_dir))).select(
        "ticket_id", "seq", F.col("pos").cast("bigint").alias("pos"), "id", "content_url",
        "content_type", "size",
    )


@check("""
    select id, name, email, role, organization_id, coalesce(active, false) as active, created_at
    from {users}""")
def user_summary(spark, sf_dir):
    return directory.user_summary(table(spark, sf_dir, "users"))


def _field_defs(spark, sf_dir):
    defs = table(spark, sf_dir, "field_defs")
    words = F.split("option_names", " ")
    options = F.transform(
        words, lambda w: F.struct(F.upper(w).alias("name"), w.alias("value"))
    )
    return defs.withColumn("options", options).drop("option_names")


@check("""
    select id, coalesce(title, raw_title) as title, type, true as active,
           coalesce(required, false) as required, cast(pos as integer) as pos,
           list_extract(string_split(option_names, ' '), pos + 1) as value
    from (select *, unnest(case when option_names is null then [null]
              else range(len(string_split(option_names, ' '))) end) as pos
          from {field_defs} where active)""")
def ticket_fields(spark, sf_dir):
    fields = directory.ticket_fields(_field_defs(spark, sf_dir))
    return fields.select(
        "id", "title", "type", "active", "required", F.posexplode_outer("options").alias("pos", "o")
    ).select("id", "title", "type", "active", "required", "pos", F.col("o.value").alias("value"))


@check("""
    select id, title, true as active, description from {macros} where active""")
def list_macros(spark, sf_dir):
    return directory.list_macros(table(spark, sf_dir, "macros"))


_TITLED = """
    (select ticket_id, field_id, pos, value, coalesce(f.title, f.raw_title) as title
     from {custom_values} v left join {field_defs} f on f.id = v.field_id
     where value is not null and value <> '')"""


def _titled(spark, sf_dir):
    return tickets.custom_fields(
        table(spark, sf_dir, "custom_values"), table(spark, sf_dir, "field_defs")
    )


@check(f"select ticket_id, field_id, pos, title, value from {_TITLED}")
def custom_fields(spark, sf_dir):
    return _titled(spark, sf_dir).select("ticket_id", "field_id", "pos", "title", "value")


@check(f"""
    select ticket_id, arg_min(value, pos) as product from {_TITLED}
    where lower(title) like '%product%' group by ticket_id""")
def ticket_product(spark, sf_dir):
    return tickets.ticket_product(_titled(spark, sf_dir))


def _view_table(spark, sf_dir):
    return table(spark, sf_dir, "groups").select(
        "id", F.concat(F.lit("Tickets of "), "name").alias("title"), (F.col("id") % 4 > 0).alias("active")
    )


def _view_predicates(spark, sf_dir):
    """One view per group (25 at any scale): its unsolved tickets."""
    return {
        key: (F.col("group_id") == key) & (F.col("status") != "solved")
        for key in range(25)
    }


_VIEW_COUNTS = """
    (select g.id as view_id, count(t.id) as value from {groups} g
     left join {tickets} t on t.group_id = g.id and t.status <> 'solved' group by g.id)"""


@check(f"""
    select id, concat('Tickets of ', name) as title, true as active, value as count
    from {{groups}} left join {_VIEW_COUNTS} on view_id = id where id % 4 > 0""")
def list_views(spark, sf_dir):
    counts = views.count_by_view(table(spark, sf_dir, "tickets"), _view_predicates(spark, sf_dir))
    return views.list_views(_view_table(spark, sf_dir), counts)


@check(f"""
    select t.id, subject, priority, r.name as requester, a.name as assignee,
           count(*) over () as returned {_NAMED}
    where status = 'open' and priority = 'urgent'""")
def view_tickets(spark, sf_dir):
    urgent = (F.col("status") == "open") & (F.col("priority") == "urgent")
    return views.view_tickets(_ticket_rows(spark, sf_dir), urgent).select(
        "id", "subject", "priority", "requester", "assignee", "returned"
    )


@check("""
    select id, name, email, role, organization_id, coalesce(active, false) as active, created_at
    from {users}
    where lower(name) like '%002%' or lower(email) like '%002%' or phone like '%002%'""")
def user_search(spark, sf_dir):
    return directory.user_search(table(spark, sf_dir, "users"), "002")


# Fixed value in the SQL: the form of an ISO timestamp, which needs no scan.
@check(r"""
    select source, id, regexp_matches(text, '[\p{L}\p{N}]') and not regexp_full_match(text,
        '\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)?') as needs_scan
    from (select 'document' as source, doc_id as id, text from documents
          union all select 'page', page_id, html from pages
          union all select 'turn', conv_id * 100 + turn, text from conversations
          union all select 'time', event_id,
              replace(cast(date_trunc('second', ts) as varchar), ' ', 'T') || 'Z' from events
          union all select 'day', event_id, substr(cast(ts as varchar), 1, 10) from events
          union all select 'marks', doc_id, regexp_replace(text, '[^ .,;:!?]', '', 'g')
              from documents)""")
def needs_scan_(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(F.lit("page"), "page_id", "html")
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("turn"), F.col("conv_id") * 100 + F.col("turn"), "text"
    )
    events = table(spark, sf_dir, "events")
    second = F.date_trunc("second", "ts").cast("string")
    times = events.select(
        F.lit("time"), "event_id", F.concat(F.replace(second, F.lit(" "), F.lit("T")), F.lit("Z"))
    )
    days = events.select(F.lit("day"), "event_id", F.substring(F.col("ts").cast("string"), 1, 10))
    marks = docs.select(F.lit("marks"), "id", F.regexp_replace("text", "[^ .,;:!?]", ""))
    rows = docs
    for other in (pages, turns, times, days, marks):
        rows = rows.union(other)
    return rows.select("source", "id", needs_scan(F.col("text")).alias("needs_scan"))


# --------------------------------------------------------------------- joins


@check(f"""
    select t.id, r.name as requester, a.name as assignee, s.name as submitter,
           g.name as group_name, o.name as organization {_NAMED}""")
def resolve_names(spark, sf_dir):
    named = tickets.resolve_names(
        table(spark, sf_dir, "tickets"),
        table(spark, sf_dir, "users"),
        table(spark, sf_dir, "groups"),
        table(spark, sf_dir, "organizations"),
    )
    return named.select(
        "id", "requester", "assignee", "submitter", F.col("group").alias("group_name"), "organization"
    )


@check(f"""
    select id, concat('Tickets of ', name) as title, id % 4 > 0 as active,
           case when id % 5 > 0 then value end as count
    from {{groups}} left join {_VIEW_COUNTS} on view_id = id""")
def view_counts(spark, sf_dir):
    counts = views.count_by_view(table(spark, sf_dir, "tickets"), _view_predicates(spark, sf_dir))
    given = counts.where(F.col("view_id") % 5 > 0)
    return views.view_counts(_view_table(spark, sf_dir), given).select(
        "id", "title", "active", "count"
    )


@check("""
    select field_id, title, count(*) as n_values
    from (select v.field_id, coalesce(f.title, f.raw_title) as title
          from {custom_values} v left join {field_defs} f on f.id = v.field_id)
    group by all""")
def field_titles(spark, sf_dir):
    values = table(spark, sf_dir, "custom_values")
    titles = tickets.field_titles(table(spark, sf_dir, "field_defs"))
    return (
        values.join(titles, values.field_id == titles.id, "left")
        .groupBy("field_id", "title")
        .agg(F.count("*").alias("n_values"))
    )


def details(spark, sf_dir, ticket_table=None, custom_values=None, comments=None):
    return tickets.ticket_detail(
        ticket_table if ticket_table is not None else table(spark, sf_dir, "tickets"),
        table(spark, sf_dir, "users"),
        table(spark, sf_dir, "groups"),
        table(spark, sf_dir, "organizations"),
        table(spark, sf_dir, "field_defs"),
        custom_values if custom_values is not None else table(spark, sf_dir, "custom_values"),
        comments if comments is not None else comments_with_files(spark, sf_dir),
        BASE,
    )


def _thread(column="conversation"):
    return F.array_join(
        F.transform(
            column,
            lambda c: F.concat_ws(
                ":",
                c["seq"].cast("string"),
                F.coalesce(c["author"], F.lit("-")),
                c["public"].cast("string"),
                F.md5(c["body"]),
            ),
        ),
        " ",
    )


@check(f"""
    with threads as (
        select ticket_id, count(*) as n_comments, string_agg(concat_ws(':', seq,
               coalesce(u.name, '-'), cast(public is distinct from false as varchar),
               md5(case when body is not null then substr(body, 2, length(body) - 2)
                   else coalesce(plain_body, '') end)), ' ' order by seq) as thread
        from {{comments}} c left join {{users}} u on u.id = author_id group by ticket_id),
    files as (
        select a.ticket_id, string_agg(cast(a.id as varchar), ',' order by a.seq, a.pos) as files
        from {{attachments}} a
        join {{comments}} c on c.ticket_id = a.ticket_id and c.seq = a.seq group by a.ticket_id),
    fields as (
        select ticket_id, string_agg(field_id || '=' || title || '=' || value, ';' order by pos)
                   as fields,
               arg_min(value, pos) filter (lower(title) like '%product%') as product
        from {_TITLED} group by ticket_id)
    select t.id, '{BASE}/agent/tickets/' || t.id as url, subject, description, status,
           coalesce(array_to_string(tags, ','), '') as tags, r.name as requester,
           a.name as assignee, s.name as submitter, g.name as group_name,
           o.name as organization, fields, product, thread, n_comments,
           coalesce(files, '') as files {_NAMED}
    left join threads on threads.ticket_id = t.id left join files on files.ticket_id = t.id
    left join fields on fields.ticket_id = t.id""")
def ticket_detail(spark, sf_dir):
    field = F.transform(
        "custom_fields",
        lambda f: F.concat_ws("=", f["id"].cast("string"), f["title"], f["value"]),
    )
    return tickets.nested(details(spark, sf_dir)).select(
        "id", "url", "subject", "description", "status", _tags(), "requester", "assignee",
        "submitter", F.col("group").alias("group_name"), "organization",
        F.array_join(field, ";").alias("fields"), "product", _thread().alias("thread"),
        F.when(F.col("conversation").isNotNull(), F.size("conversation").cast("bigint")).alias(
            "n_comments"
        ),
        F.coalesce(
            F.array_join(F.transform("attachments", lambda f: f["id"].cast("string")), ","),
            F.lit(""),
        ).alias("files"),
    )


@check("""
    select ticket_id, seq, c.id, u.name as author, public is distinct from false as public,
           case when body is not null then substr(body, 2, length(body) - 2)
                else coalesce(plain_body, '') end as body,
           coalesce(n_files, 0) as n_files
    from {comments} c left join {users} u on u.id = author_id
    left join (select ticket_id, seq, count(*) as n_files from {attachments} group by all) f
    using (ticket_id, seq)""")
def ticket_thread(spark, sf_dir):
    return details(spark, sf_dir).thread.select(
        "ticket_id", "seq", "id", "author", "public", "body",
        F.size("attachments").cast("bigint").alias("n_files"),
    )


@check("""
    select a.id, ticket_id, author_id, u.name as author, event
    from {audits} a left join {users} u on u.id = author_id""")
def audit_authors(spark, sf_dir):
    return activity.audit_authors(
        table(spark, sf_dir, "audits"), table(spark, sf_dir, "users")
    ).select("id", "ticket_id", "author_id", "author", "event")


# ---------------------------------------------------------------- aggregates


@check("""
    select unnest([1, 2, 3, 4])::bigint as view_id, unnest([
        count(*) filter (status = 'open'),
        count(*) filter (status = 'open' and priority = 'urgent'),
        count(*) filter (status = 'solved'),
        count(*) filter (priority is null)]) as value
    from {tickets}""")
def count_by_view(spark, sf_dir):
    status, priority = F.col("status"), F.col("priority")
    return views.count_by_view(
        table(spark, sf_dir, "tickets"),
        {
            1: status == "open",
            2: (status == "open") & (priority == "urgent"),
            3: status == "solved",
            4: priority.isNull(),
        },
    )


def _newest_sql(owner: str) -> str:
    return f"""
        select id, {owner}, rank, count(*) over (partition by {owner}) as returned
        from (select id, {owner}, row_number() over (partition by {owner}
                  order by created_at desc, id) as rank
              from {{tickets}} where {owner} is not null)"""


@check(_newest_sql("requester_id"))
def requester_tickets(spark, sf_dir):
    rows = activity.requester_tickets(table(spark, sf_dir, "tickets"))
    return rows.select("id", "requester_id", F.col("rank").cast("bigint").alias("rank"), "returned")


@check(_newest_sql("organization_id"))
def organization_tickets(spark, sf_dir):
    rows = activity.organization_tickets(table(spark, sf_dir, "tickets"))
    return rows.select(
        "id", "organization_id", F.col("rank").cast("bigint").alias("rank"), "returned"
    )


@check("""
    select ticket_id, rank, a.id, author_id, name as author, pos,
           case pos when 0 then event when 1 then props end as body
    from (select *, unnest(case when id % 11 = 0 then [null] else [0, 1] end) as pos
          from (select *, row_number() over (partition by ticket_id order by created_at, id)
                    as rank from {audits})) a left join {users} u on u.id = author_id""")
def audit_trail(spark, sf_dir):
    audits = table(spark, sf_dir, "audits").withColumn(
        "events",
        F.when(
            F.col("id") % 11 > 0,
            F.array(
                F.create_map(F.lit("body"), F.col("event")),
                F.create_map(F.lit("body"), F.col("props")),
            ),
        ),
    )
    return activity.audit_trail(audits, table(spark, sf_dir, "users")).select(
        "ticket_id", F.col("rank").cast("bigint").alias("rank"), "id", "author_id", "author",
        "pos", F.col("event")["body"].alias("body"),
    )


@check("""
    with e as (
        select *, epoch_us(created_at) as us,
               lead(epoch_us(created_at)) over w - epoch_us(created_at) as gap,
               last_value(case when event in ('solved', 'reopened') then event end ignore nulls)
                   over (partition by ticket_id order by created_at, id
                         rows between unbounded preceding and 1 preceding) as before,
               row_number() over w as n
        from {audits} window w as (partition by ticket_id order by created_at, id)),
    s as (select ticket_id, max(n) as last_n from e where event = 'solved' group by ticket_id),
    m as (
        select ticket_id, min(us) as created,
               min(us) filter (event = 'agent_reply') as replied,
               max(us) filter (event = 'solved') as solved,
               count(*) filter (event = 'agent_reply') as replies,
               count(*) filter (event = 'reopened' and before = 'solved') as reopens,
               coalesce(sum(gap) filter (event = 'requester_reply'), 0) as rw,
               coalesce(sum(gap) filter (event = 'agent_reply'), 0) as aw,
               coalesce(sum(gap) filter (event = 'agent_reply' and n < last_n), 0) as aw_solved
        from e left join s using (ticket_id) group by ticket_id)
    select ticket_id, cast(replied - created as double) / 1000000 as first_reply_time,
           cast(solved - created as double) / 1000000 as full_resolution_time,
           cast(solved - created - aw_solved as double) / 1000000 as agent_resolution_time,
           cast(reopens as bigint) as reopens, cast(replies as bigint) as replies,
           cast(aw as double) / 1000000 as assignee_wait_time,
           cast(rw as double) / 1000000 as requester_wait_time
    from m""")
def ticket_metrics(spark, sf_dir):
    return activity.ticket_metrics(table(spark, sf_dir, "audits"))


@check(f"""
    select 'ticket' as result_type, id, '{BASE}/agent/tickets/' || id as url, subject as name
    from {{tickets}} where priority = 'urgent'
    union all select 'user', id, null, name from {{users}} where active
    union all select 'group', id, null, name from {{groups}} where contains(name, '1')
    union all select 'organization', id, '{BASE}/org/' || id, name from {{organizations}}""")
def search_(spark, sf_dir):
    orgs = table(spark, sf_dir, "organizations").withColumn(
        "url", F.concat(F.lit(f"{BASE}/org/"), F.col("id").cast("string"))
    )
    found = search.search(
        {
            "ticket": search.Source(table(spark, sf_dir, "tickets"), F.col("priority") == "urgent"),
            "user": search.Source(table(spark, sf_dir, "users"), F.col("active")),
            "group": search.Source(
                table(spark, sf_dir, "groups"), F.contains("name", F.lit("1"))
            ),
            "organization": search.Source(orgs, F.lit(True)),
        },
        BASE,
    )
    raw = F.coalesce(F.get_json_object("raw", "$.subject"), F.get_json_object("raw", "$.name"))
    return found.select("result_type", "id", "url", raw.alias("name"))


# --------------------------------------------------------------- change sets


@check("""
    select id, ticket_id, seq, author_id, public, body, html_body from {comments}
    union all
    select 1000000000 + event_id, user_id,
           coalesce((select max(turn) from conversations where conv_id = user_id), -1)
               + 1 + event_id,
           user_id, coalesce(case when event_id % 3 = 0 then false end, true),
           case when event_id % 4 > 0 then event_type end,
           case when event_id % 4 = 0 then concat('<p>', event_type, '</p>') end
    from events""")
def add_comment(spark, sf_dir):
    comments = table(spark, sf_dir, "comments").drop("plain_body")
    return changes.add_comments(comments, _new_comments(spark, sf_dir)).select(
        "id", "ticket_id", "seq", "author_id", "public", "body", "html_body"
    )


def _new_comments(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        (F.lit(1_000_000_000) + F.col("event_id")).alias("id"),
        F.col("user_id").alias("ticket_id"),
        F.col("event_id").alias("pos"),
        F.col("user_id").alias("author_id"),
        F.col("event_type").alias("body"),
        F.when(
            F.col("event_id") % 4 == 0, F.concat(F.lit("<p>"), "event_type", F.lit("</p>"))
        ).alias("html_body"),
        F.when(F.col("event_id") % 3 == 0, F.lit(False)).alias("is_public"),
        F.col("ts").alias("created_at"),
    )


_PATCHES = """
    (select case when event_id % 10 = 9 then user_id + 100000000 else user_id end as ticket_id,
            event_id as seq, case when event_id % 8 = 0 then concat(event_type, ' noted') end
                as comment,
            case event_type when 'click' then 'open' when 'view' then '' when 'error' then 'bogus'
                 when 'signup' then 'closed' end as status,
            case event_id % 3 when 0 then 'urgent' when 1 then '' end as priority,
            case when event_id % 7 = 0 then 'task' end as type,
            case when event_id % 2 = 0 then user_id end as assignee_id,
            case when event_id % 4 = 0 then split(concat(event_type, ',late'), ',') end as tags,
            case when event_id % 6 = 0 then 10 + event_id % 5 end as field_id,
            case when event_id % 12 > 0 then event_type end as field_value
     from {events})"""


def _field_text(values: DataFrame) -> DataFrame:
    pair = F.concat_ws("=", F.col("field_id").cast("string"), F.coalesce("value", F.lit("~")))
    return values.groupBy("ticket_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("pos", "field_id", pair.alias("p"))))["p"], ";").alias(
            "fields"
        )
    )


_ACTIONS = """
    (select p_partkey as macro_id, 0 as pos, 'status' as field,
            case when p_size > 25 then 'solved' else 'open' end as value
     from {part} where p_size > 10
     union all select p_partkey, 5, 'status', 'hold' from {part} where p_size % 4 = 0
     union all select p_partkey, 6, 'comment', concat('macro ', p_name) from {part}
     where p_size % 3 = 0
     union all select p_partkey, 1, 'priority', case when p_size > 40 then 'high' else 'low' end
     from {part} where p_type <> 'ECONOMY'
     union all select p_partkey, 2, 'tags', concat(p_brand, ',', lower(p_type)) from {part}
     where p_brand < 'Brand#2'
     union all select p_partkey, 3, 'requester_id', '1' from {part}
     union all select p_partkey, 4, 'custom_fields_11', p_brand from {part} where p_size < 30)"""
_APPLIED = """
    (select case when l_orderkey % 50 = 7 then l_orderkey + 100000000 else l_orderkey end
                as ticket_id, cast(l_linenumber as bigint) as seq, min(l_partkey) as macro_id
     from {lineitem} group by l_orderkey, l_linenumber)"""


_UPDATED = f"""
    with given as (select *, ticket_id not in (select id from {{tickets}}) as unknown
                   from {_PATCHES}),
    valid as (select * from given where status is distinct from 'bogus' and not unknown),
    folded as (
        select ticket_id, arg_max(status, seq) filter (status <> '') as status,
               arg_max(priority, seq) filter (priority <> '') as priority,
               arg_max(type, seq) filter (type <> '') as type,
               arg_max(assignee_id, seq) filter (assignee_id is not null) as assignee_id,
               arg_max(tags, seq) filter (tags is not null) as tags
        from valid group by ticket_id),
    new as (
        select ticket_id, field_id, arg_max(struct_pack(v := field_value), seq).v as value
        from valid where field_id is not null group by ticket_id, field_id),
    merged as (
        select coalesce(o.ticket_id, n.ticket_id) as ticket_id,
               coalesce(o.field_id, n.field_id) as field_id,
               coalesce(o.pos, 4294967296) as pos,
               case when n.ticket_id is not null then n.value else o.value end as value
        from {{custom_values}} o full join new n
             on n.ticket_id = o.ticket_id and n.field_id = o.field_id),
    fields as (
        select ticket_id, string_agg(field_id || '=' || coalesce(value, '~'), ';'
                                     order by pos, field_id) as fields
        from merged group by ticket_id),
    said as (
        select ticket_id, seq, body, public is distinct from false as public from {{comments}}
        union all
        select ticket_id, coalesce((select max(turn) from conversations
                                    where conv_id = ticket_id), -1) + 1 + seq, comment, true
        from valid where comment is not null),
    thread as (select ticket_id, count(*) as n_comments, count_if(public) as n_public,
                      arg_max(body, seq) filter (body is not null) as last_comment, max(seq) as last_seq
               from said group by ticket_id),
    bad as (select ticket_id, count(*) as n_rejected, count_if(unknown) as n_unknown
            from given where status = 'bogus' or unknown group by ticket_id)
    select coalesce(t.id, r.ticket_id) as id, coalesce(f.status, t.status) as status,
           coalesce(f.priority, t.priority) as priority, coalesce(f.type, t.type) as type,
           coalesce(f.assignee_id, t.assignee_id) as assignee_id,
           coalesce(array_to_string(coalesce(f.tags, t.tags), ','), '') as tags, fields,
           coalesce(n_rejected, 0) as n_rejected, coalesce(n_unknown, 0) as n_unknown,
           n_comments, n_public, last_comment, last_seq, f.ticket_id is not null as touched
    from {{tickets}} t left join folded f on f.ticket_id = t.id
    left join fields on fields.ticket_id = t.id left join thread on thread.ticket_id = t.id
    full join bad r on r.ticket_id = t.id"""


def _applications(spark, sf_dir):
    """Written once, as they are counted, looked up by folder and made into patches."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    uses = spark.sql(f"select * from {_APPLIED}", lineitem=dealt(lines, ["l_orderkey"]))
    return staged(uses, "applications")


def _patches(spark, sf_dir):
    given = spark.sql(
        f"select * from {_PATCHES}", events=table(spark, sf_dir, "events")
    )
    return given.withColumn(
        "custom_fields",
        F.when(
            F.col("field_id").isNotNull(),
            F.array(F.struct(F.col("field_id").alias("id"), F.col("field_value").alias("value"))),
        ),
    ).drop("field_id", "field_value")


@check(_UPDATED)
def update_tickets(spark, sf_dir):
    done = changes.update_tickets(
        table(spark, sf_dir, "tickets"),
        table(spark, sf_dir, "custom_values"),
        _patches(spark, sf_dir),
        table(spark, sf_dir, "comments"),
    )
    return _updated(spark, sf_dir, done.tickets, done.custom_values, done.thread, done)


@check(_UPDATED)
def update_stored_tickets(spark, sf_dir):
    """The same patches on stored tables, of which only the folders they fall into are rewritten."""
    stored = _stored(spark, sf_dir)
    done = stored.update(_patches(spark, sf_dir))
    return _updated(spark, sf_dir, stored.tickets, stored.custom_values, stored.comments, done)


@check(f"""
    with acts as (
        select macro_id, arg_max(value, pos) filter (field = 'status') as status,
               max(value) filter (field = 'comment') as said
        from {_ACTIONS} group by macro_id),
    uses as (select u.ticket_id, u.seq, a.status, a.said from {_APPLIED} u
             join acts a on a.macro_id = u.macro_id
             where u.ticket_id in (select id from {{tickets}})),
    folded as (select ticket_id, arg_max(status, seq) filter (status is not null) as status,
                      count(said) as n_said from uses group by ticket_id),
    added as (select user_id, count(*) as n from events group by user_id),
    old as (select ticket_id, count(*) as n from {{comments}} group by ticket_id)
    select t.id, coalesce(f.status, t.status) as status,
           coalesce(old.n, 0) + coalesce(n_said, 0) + coalesce(added.n, 0) as n_comments
    from {{tickets}} t left join folded f on f.ticket_id = t.id
    left join old on old.ticket_id = t.id left join added on added.user_id = t.id""")
def change_stored_tickets(spark, sf_dir):
    """Macros and then comments on stored tables; the second only adds rows."""
    stored = _stored(spark, sf_dir)
    stored.apply_macros(
        spark.sql(f"select * from {_ACTIONS}", part=table(spark, sf_dir, "part")),
        _applications(spark, sf_dir),
    )
    stored.add_comments(_new_comments(spark, sf_dir))
    said = stored.comments.groupBy(F.col("ticket_id").alias("id")).agg(F.count("*").alias("n"))
    return stored.tickets.join(said, "id", "left").select(
        "id", "status", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_comments")
    )


def _stored(spark, sf_dir):
    all_tickets = table(spark, sf_dir, "tickets")
    return versions.TicketTables.create(
        scratch_path(spark, "ticket-tables"),
        all_tickets,
        table(spark, sf_dir, "custom_values"),
        table(spark, sf_dir, "comments"),
        buckets=max(8, all_tickets.count() // TICKETS_IN_A_FOLDER),
    )


def _updated(spark, sf_dir, tickets, custom_values, thread, done):
    rejected = done.rejected.groupBy("ticket_id").agg(F.count("*").alias("n_rejected"))
    missing = done.rejected.join(
        table(spark, sf_dir, "tickets").select(F.col("id").alias("ticket_id")), "ticket_id", "left_anti"
    ).groupBy("ticket_id").agg(F.count("*").alias("n_unknown"))
    said = F.coalesce("public", F.lit(True))
    said_by = thread.groupBy("ticket_id").agg(
        F.count("*").alias("n_comments"),
        F.count_if(said).alias("n_public"),
        F.max_by("body", F.when(F.col("body").isNotNull(), F.col("seq"))).alias("last_comment"),
        F.max("seq").alias("last_seq"),
    )
    touched = done.touched.select(F.col("id").alias("ticket_id"), F.lit(True).alias("touched"))
    return (
        tickets.withColumnRenamed("id", "ticket_id")
        .join(_field_text(custom_values), "ticket_id", "left")
        .join(said_by, "ticket_id", "left")
        .join(touched, "ticket_id", "left")
        .join(rejected.join(missing, "ticket_id", "left"), "ticket_id", "full")
        .select(
            F.col("ticket_id").alias("id"), "status", "priority", "type", "assignee_id",
            F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"), "fields",
            F.coalesce("n_rejected", F.lit(0)).cast("bigint").alias("n_rejected"),
            F.coalesce("n_unknown", F.lit(0)).cast("bigint").alias("n_unknown"),
            "n_comments", "n_public", "last_comment", "last_seq",
            F.coalesce("touched", F.lit(False)).alias("touched"),
        )
    )


@check(f"""
    with valid as (select * from {_PATCHES} where status is distinct from 'bogus'
                   and ticket_id in (select id from {{tickets}})),
    folded as (
        select ticket_id as id, arg_max(status, seq) filter (status <> '') as status,
               arg_max(assignee_id, seq) filter (assignee_id is not null) as assignee_id,
               count(comment) as n_said
        from valid group by ticket_id),
    old as (select ticket_id, count(*) as n from {{comments}} group by ticket_id)
    select f.id, coalesce(f.status, t.status) as status, r.name as requester, a.name as assignee,
           '{BASE}/agent/tickets/' || f.id as url, coalesce(n, 0) + n_said as n_comments
    from folded f join {{tickets}} t on t.id = f.id left join {{users}} r on r.id = t.requester_id
    left join {{users}} a on a.id = coalesce(f.assignee_id, t.assignee_id)
    left join old on old.ticket_id = f.id""")
def updated_details(spark, sf_dir):
    """The detail that a write returns: touched tickets only, with their whole threads."""
    done = changes.update_tickets(
        table(spark, sf_dir, "tickets"),
        table(spark, sf_dir, "custom_values"),
        spark.sql(f"select * from {_PATCHES}", events=table(spark, sf_dir, "events")).drop(
            "field_id", "field_value"
        ),
        comments_with_files(spark, sf_dir),
    )
    detail = details(spark, sf_dir, done.tickets, done.custom_values, done.thread)
    header = changes.changed_details(detail.header, done.touched)
    counts = detail.thread.groupBy(F.col("ticket_id").alias("id")).agg(
        F.count("*").alias("n_comments")
    )
    return header.join(counts, "id", "left").select(
        "id", "status", "requester", "assignee", "url",
        F.coalesce("n_comments", F.lit(0)).cast("bigint").alias("n_comments"),
    )


@check(f"""
    with acts as (
        select macro_id, arg_max(value, pos) filter (field = 'status') as status,
               max(value) filter (field = 'priority') as priority,
               max(value) filter (field = 'tags') as tags,
               max(value) filter (field = 'custom_fields_11') as f11,
               max(value) filter (field = 'comment') as said
        from {_ACTIONS} group by macro_id),
    uses as (select u.*, a.status, a.priority, a.tags, a.f11, a.said
             from {_APPLIED} u join acts a on a.macro_id = u.macro_id),
    folded as (
        select ticket_id, arg_max(status, seq) filter (status is not null) as status,
               arg_max(priority, seq) filter (priority is not null) as priority,
               arg_max(tags, seq) filter (tags is not null) as tags,
               arg_max(f11, seq) filter (f11 is not null) as f11,
               count(said) as n_said, arg_max(said, seq) filter (said is not null) as last_said
        from uses group by ticket_id),
    old as (select ticket_id, count(*) as n, arg_max(body, seq) filter (body is not null) as last_body
            from {{comments}} group by ticket_id)
    select u.ticket_id, u.macro_id, u.seq, u.status as applied_status,
           u.priority as applied_priority, u.f11 as applied_field, t.id is null as rejected,
           coalesce(f.status, t.status) as status, coalesce(f.priority, t.priority) as priority,
           coalesce(f.tags, array_to_string(t.tags, ','), '') as tags,
           coalesce(f.f11, v.value) as field_11, t.requester_id,
           coalesce(old.n, 0) + n_said as n_comments,
           coalesce(f.last_said, old.last_body) as last_comment
    from uses u join folded f on f.ticket_id = u.ticket_id join {{tickets}} t on t.id = u.ticket_id
    left join {{custom_values}} v on v.ticket_id = t.id and v.field_id = 11
    left join old on old.ticket_id = t.id
    union all
    select u.ticket_id, null, u.seq, null, null, null, true, null, null, null, null, null, null, null
    from uses u where u.ticket_id not in (select id from {{tickets}})""")
def apply_macros(spark, sf_dir):
    actions = spark.sql(f"select * from {_ACTIONS}", part=table(spark, sf_dir, "part"))
    uses = _applications(spark, sf_dir)
    applied, done = changes.apply_macros(
        table(spark, sf_dir, "tickets"),
        table(spark, sf_dir, "custom_values"),
        actions,
        uses,
        table(spark, sf_dir, "comments"),
    )
    field = done.custom_values.where(F.col("field_id") == 11).select(
        "ticket_id", F.col("value").alias("field_11")
    )
    final = done.tickets.select(
        F.col("id").alias("ticket_id"), "status", "priority",
        F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"), "requester_id",
    )
    thread = done.thread.groupBy("ticket_id").agg(
        F.count("*").alias("n_comments"), F.max_by("body", F.when(F.col("body").isNotNull(), F.col("seq"))).alias("last_comment")
    )
    good = (
        applied.join(final, "ticket_id")
        .join(field, "ticket_id", "left")
        .join(thread, "ticket_id", "left")
        .select(
            "ticket_id", "macro_id", "seq",
            F.get_json_object("applied", "$.status").alias("applied_status"),
            F.get_json_object("applied", "$.priority").alias("applied_priority"),
            F.get_json_object("applied", "$.custom_fields[0].value").alias("applied_field"),
            F.lit(False).alias("rejected"), "status", "priority", "tags", "field_11",
            "requester_id", F.coalesce("n_comments", F.lit(0)).cast("bigint").alias("n_comments"),
            "last_comment",
        )
    )
    bad = done.rejected.select("ticket_id", "seq", F.lit(True).alias("rejected"))
    return good.unionByName(bad, allowMissingColumns=True)


# Names that clash with the operators they check.
for _name in [name for name in QUERIES if name.endswith("_")]:
    QUERIES[_name[:-1]] = QUERIES.pop(_name)
    ORACLES[_name[:-1]] = ORACLES.pop(_name)
