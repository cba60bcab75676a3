"""Ticket, comment and custom-field tables and the nested ticket detail."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.functions.text import strip_space
from veildesk.staging import left_lookup


def ticket_link(base_url: str, key: Column) -> Column:
    return F.concat(F.lit(f"{base_url}/agent/tickets/"), key.cast("string"))


def resolve_names(
    tickets: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    organizations: DataFrame | None = None,
    roles: tuple[str, ...] = ("requester", "assignee", "submitter"),
) -> DataFrame:
    """Names of the people, group and organisation of a ticket; unknown ids give null."""
    out = tickets
    for role in roles:
        out = left_lookup(out, users, f"{role}_id", {"name": role})
    out = left_lookup(out, groups, "group_id", {"name": "group"})
    if organizations is not None:
        out = left_lookup(out, organizations, "organization_id", {"name": "organization"})
    return out


def ticket_rows(
    tickets: DataFrame, users: DataFrame, groups: DataFrame, base_url: str
) -> DataFrame:
    named = resolve_names(tickets, users, groups, roles=("requester", "assignee"))
    return named.select(
        "id",
        ticket_link(base_url, F.col("id")).alias("url"),
        "subject",
        "status",
        "priority",
        "type",
        "requester",
        "assignee",
        "group",
        "created_at",
        "updated_at",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    )


def comment_rows(comments: DataFrame, users: DataFrame) -> DataFrame:
    """Comments with author names. Public unless exactly false; an empty body stays empty."""
    named = left_lookup(comments, users, "author_id", {"name": "author"})
    return named.withColumns(
        {
            "public": F.coalesce("public", F.lit(True)),
            "body": strip_space(F.coalesce("body", "plain_body", F.lit(""))),
        }
    ).drop("plain_body")


def attachments_flat(comments: DataFrame) -> DataFrame:
    """One row per attachment, numbered by comment and by place in the comment."""
    return comments.select(
        "ticket_id", "seq", F.posexplode("attachments").alias("pos", "file")
    ).select("ticket_id", "seq", "pos", "file.*")


def field_titles(field_defs: DataFrame) -> DataFrame:
    return field_defs.select("id", F.coalesce("title", "raw_title").alias("title"))


def custom_fields(values: DataFrame, field_defs: DataFrame) -> DataFrame:
    """Custom values that say something (not null, not empty) with their field's title."""
    said = values.where(F.col("value").isNotNull() & (F.col("value") != ""))
    return left_lookup(said, field_titles(field_defs), "field_id", {"title": "title"})


def ticket_product(titled: DataFrame) -> DataFrame:
    """Value of each ticket's first custom field whose title mentions "product"."""
    return (
        titled.where(F.col("title").rlike("(?i)product"))
        .groupBy("ticket_id")
        .agg(F.min_by("value", "pos").alias("product"))
    )


@dataclass(frozen=True)
class Detail:
    """``header``: one row per ticket; ``thread``: one row per comment, (ticket_id, seq)."""

    header: DataFrame
    thread: DataFrame


_EVENT = (
    "seq", "id", "author", "author_id", "public", "created_at", "body", "html_body", "attachments"
)


def thread(comments: DataFrame, users: DataFrame) -> DataFrame:
    """Comments of all tickets with author names and attachments, keyed (ticket_id, seq)."""
    return comment_rows(comments, users).select("ticket_id", *_EVENT)


def ticket_detail(
    tickets: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    organizations: DataFrame,
    field_defs: DataFrame,
    custom_values: DataFrame,
    comments: DataFrame,
    base_url: str,
) -> Detail:
    """Names, fields and product of each ticket, and the thread as a table of its own.

    A thread has no bound, so it stays flat; ``nested`` puts it into the tickets on request.
    Fields are grouped by ticket before they are joined, so no join multiplies rows;
    ``custom_values`` has one value per ticket and field, which bounds its group by the
    number of field definitions.
    """
    titled = custom_fields(custom_values, field_defs)
    fields = titled.groupBy("ticket_id").agg(
        F.array_sort(
            F.collect_list(F.struct("pos", F.col("field_id").alias("id"), "title", "value"))
        ).alias("custom_fields"),
        F.min_by("value", F.when(F.col("title").rlike("(?i)product"), F.col("pos"))).alias(
            "product"
        ),
    )
    named = resolve_names(tickets.drop("custom_fields"), users, groups, organizations)
    header = named.join(fields.withColumnRenamed("ticket_id", "id"), "id", "left").select(
        "id",
        ticket_link(base_url, F.col("id")).alias("url"),
        "subject",
        "description",
        "status",
        "priority",
        "type",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        "requester",
        "assignee",
        "submitter",
        "group",
        "organization",
        "created_at",
        "updated_at",
        "custom_fields",
        "product",
    )
    return Detail(header, thread(comments, users))


def nested(detail: Detail) -> DataFrame:
    """One row per ticket with its whole conversation and all attachments inside.

    For tickets whose threads fit in a row, a selection of them for example.
    """
    conversations = detail.thread.groupBy(F.col("ticket_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(*_EVENT))).alias("conversation")
    )
    files = F.flatten(F.transform("conversation", lambda c: c["attachments"]))
    none = F.array().cast(detail.thread.schema["attachments"].dataType)
    return detail.header.join(conversations, "id", "left").withColumn(
        "attachments", F.coalesce(files, none)
    )
