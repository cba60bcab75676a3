"""Change sets: comments, sparse updates and macros applied to whole tables.

Nothing is changed in place. Each function returns the new versions of the tables it
touches, for the caller to write and swap in; ``versions`` keeps stored tables and rewrites
only the part of them that a change touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veildesk.schemas import MACRO_COLUMNS, TICKET_PRIORITIES, TICKET_STATUSES, TICKET_TYPES
from veildesk.staging import dealt, staged

# A field set for the first time comes after the ticket's existing fields.
_NEW_FIELD = 1 << 32

# A ticket's patches are dealt together, unless they are more than about so many.
_TOGETHER = 1 << 10

_TEXT_COLUMNS = ("subject", "status", "priority", "type")
_ID_COLUMNS = ("custom_status_id", "assignee_id", "group_id")
_LIST_COLUMNS = ("tags", "collaborator_ids", "follower_ids")
_TYPES = {
    **dict.fromkeys(_TEXT_COLUMNS, "string"),
    **dict.fromkeys(_ID_COLUMNS, "bigint"),
    "tags": "array<string>",
    "collaborator_ids": "array<bigint>",
    "follower_ids": "array<bigint>",
    "custom_fields": "array<struct<id:bigint,value:string>>",
    "comment": "string",
}
# What else a patch may carry: who comments, and under which id and time.
_PATCH = {
    "seq": "bigint",
    "comment_public": "boolean",
    "comment_id": "bigint",
    "author_id": "bigint",
    "created_at": "timestamp",
}


@dataclass(frozen=True)
class Changes:
    """New table versions, rejected patches and the ids touched.

    ``comments`` holds the comments that the patches append, in the columns ``add_comments``
    takes; ``thread`` is the whole comment table with them, if one was given.
    """

    tickets: DataFrame
    custom_values: DataFrame
    comments: DataFrame
    rejected: DataFrame
    touched: DataFrame
    thread: DataFrame | None = None


def add_comments(
    comments: DataFrame, new: DataFrame, last_in: DataFrame | None = None
) -> DataFrame:
    """Append comments, public unless said otherwise; an HTML body replaces the text.

    ``new`` has ``id, ticket_id, pos, author_id, body, html_body, is_public, created_at``
    with ``pos`` the order within the batch and ticket. Places continue after the ticket's
    last comment, found by one aggregate limited to the touched tickets; ``last_in`` is where
    to look for it, ``comments`` by default.
    """
    last = (
        (comments if last_in is None else last_in).join(new.select("ticket_id").distinct(), "ticket_id", "left_semi")
        .groupBy("ticket_id")
        .agg(F.max("seq").alias("_last"))
    )
    has_html = F.coalesce("html_body", F.lit("")) != ""
    rows = new.join(last, "ticket_id", "left").select(
        "id",
        "ticket_id",
        (F.coalesce("_last", F.lit(-1)) + 1 + F.col("pos")).cast("bigint").alias("seq"),
        "author_id",
        F.coalesce("is_public", F.lit(True)).alias("public"),
        "created_at",
        F.when(~has_html, F.col("body")).alias("body"),
        F.when(has_html, F.col("html_body")).alias("html_body"),
    )
    return comments.unionByName(rows, allowMissingColumns=True)


def _present(column: str) -> Column:
    """Whether a patch sets a column: texts that are empty do not count."""
    col = F.col(column)
    return col.isNotNull() & (col != "") if _TYPES[column] == "string" else col.isNotNull()


def _problem() -> Column:
    """The first bad enumeration value of a patch, or null."""
    checks = [
        F.when(_present(name) & ~F.col(name).isin(*allowed), F.concat(F.lit(f"{name}: "), name))
        for name, allowed in (
            ("status", TICKET_STATUSES),
            ("priority", TICKET_PRIORITIES),
            ("type", TICKET_TYPES),
        )
    ]
    return F.coalesce(*checks)


def _complete(patches: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in _TYPES.items()
        if name not in patches.columns
    }
    for name, kind in _PATCH.items():
        if name not in patches.columns:
            missing[name] = F.lit(None).cast(kind)
    return patches.withColumns(missing).withColumn("seq", F.coalesce("seq", F.lit(0)))


def _checked(tickets: DataFrame, patches: DataFrame) -> DataFrame:
    """Complete patches with their ``problem``, written once and dealt by ticket.

    Everything an update makes starts from these rows, so they are neither derived nor
    validated again, and the folds by ticket find a ticket's patches together. A patch that was
    sent twice counts once. Different patches of a ticket with the same ``seq``, or without one,
    have no order that could settle them, so all of them are rejected.
    """
    patches = _complete(patches).withColumn("_run", F.floor(F.col("seq") / _TOGETHER))
    patches = dealt(patches, ["ticket_id", "_run"]).distinct()
    alike = F.count("*").over(Window.partitionBy("ticket_id", "_run", "seq"))
    known = tickets.select(F.col("id").alias("ticket_id"), F.lit(True).alias("_known"))
    unknown = F.when(F.col("_known").isNull(), F.lit("unknown ticket"))
    shared = F.when(F.col("_alike") > 1, F.lit("repeated seq"))
    return staged(
        patches.withColumn("_alike", alike)
        .join(known, "ticket_id", "left")
        .withColumn("problem", F.coalesce(_problem(), unknown, shared))
        .drop("_known", "_alike", "_run"),
        "patches",
    )


def update_tickets(
    tickets: DataFrame,
    custom_values: DataFrame,
    patches: DataFrame,
    thread: DataFrame | None = None,
) -> Changes:
    """Apply sparse patches (``ticket_id, seq`` and the columns to set).

    Absent (null) columns and empty texts are ignored, lists replace, an empty list
    clears, custom fields are set one by one by id, a comment is appended to ``thread``,
    public by default. Patches of one ticket apply in ``seq`` order: the last value given for
    a column wins, so they are folded to one row per ticket before the join. A patch with a
    bad enumeration value is rejected whole, and so is one of an unknown ticket, and one whose
    ``seq`` another patch of its ticket has.
    """
    checked = _checked(tickets, patches)
    return _apply(tickets, custom_values, checked, thread)


def _apply(
    tickets: DataFrame, custom_values: DataFrame, checked: DataFrame, thread: DataFrame | None
) -> Changes:
    rejected = checked.where(F.col("problem").isNotNull()).select("ticket_id", "seq", "problem")
    valid = checked.where(F.col("problem").isNull())

    columns = [c for c in _TYPES if c in tickets.columns and c not in ("custom_fields", "comment")]
    folded = valid.groupBy("ticket_id").agg(
        *[
            F.max_by(name, F.when(_present(name), F.col("seq"))).alias(f"_{name}")
            for name in columns
        ]
    )
    joined = tickets.join(folded.withColumnRenamed("ticket_id", "id"), "id", "left")
    updated = joined.withColumns(
        {name: F.coalesce(f"_{name}", name) for name in columns}
    ).select(*tickets.columns)

    comments = valid.where(_present("comment")).select(
        F.col("comment_id").alias("id"),
        "ticket_id",
        F.col("seq").alias("pos"),
        "author_id",
        F.col("comment").alias("body"),
        F.lit(None).cast("string").alias("html_body"),
        F.coalesce("comment_public", F.lit(True)).alias("is_public"),
        "created_at",
    )
    return Changes(
        updated,
        _upsert_fields(custom_values, valid),
        comments,
        rejected,
        folded.select(F.col("ticket_id").alias("id")),
        None if thread is None else add_comments(thread, comments),
    )


def _upsert_fields(custom_values: DataFrame, valid: DataFrame) -> DataFrame:
    """Custom values (``ticket_id, field_id, pos, value``) with the patched ones replaced."""
    new = (
        valid.select("ticket_id", "seq", F.posexplode("custom_fields").alias("at", "f"))
        .groupBy("ticket_id", F.col("f.id").alias("field_id"))
        .agg(
            F.max_by(F.struct("f.value", F.col("at").alias("at")), F.struct("seq", "at")).alias(
                "_new"
            )
        )
    )
    return custom_values.join(new, ["ticket_id", "field_id"], "full").select(
        "ticket_id",
        "field_id",
        F.coalesce("pos", F.lit(_NEW_FIELD) + F.col("_new.at")).alias("pos"),
        F.when(F.col("_new").isNotNull(), F.col("_new.value"))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def macro_patches(actions: DataFrame, applications: DataFrame) -> DataFrame:
    """Patches that a macro makes on each ticket it is applied to.

    ``actions`` has ``macro_id, pos, field, value`` (lists as comma-separated text, a custom
    field as ``custom_fields_<id>``); ``applications`` has ``ticket_id, macro_id, seq`` and
    what else a patch carries about its comment. Only the columns a macro may change are taken
    over. Actions run in order of ``pos``, so the last one on a field decides.
    """
    # One value per macro and field, so that a macro's group is as small as its field list.
    actions = actions.groupBy("macro_id", "field").agg(F.max_by("value", "pos").alias("value"))
    custom_id = F.regexp_extract("field", "\\Acustom_fields_([0-9]+)\\z", 1)
    values = {}
    for name in MACRO_COLUMNS:
        kind = _TYPES[name]
        if name == "custom_fields":
            entry = F.struct(custom_id.cast("bigint").alias("id"), F.col("value").alias("value"))
            found = F.array_sort(F.collect_list(F.when(custom_id != "", entry)))
            values[name] = F.when(F.size(found) > 0, found)
            continue
        text = F.max(F.when(F.col("field") == name, F.col("value")))
        if name in _LIST_COLUMNS:
            parts = F.when(text == "", F.array().cast("array<string>")).otherwise(
                F.split(text, " *, *")
            )
            values[name] = F.when(text.isNotNull(), parts.cast(kind))
        else:
            values[name] = text.cast(kind)
    patch = actions.groupBy("macro_id").agg(
        *[value.alias(name) for name, value in values.items()]
    )
    return applications.join(patch, "macro_id")


def apply_macros(
    tickets: DataFrame,
    custom_values: DataFrame,
    actions: DataFrame,
    applications: DataFrame,
    thread: DataFrame | None = None,
) -> tuple[DataFrame, Changes]:
    """What each application set, as JSON, and the resulting table versions.

    An application to an unknown ticket, or one that sets a bad value, is rejected.
    """
    checked = _checked(tickets, macro_patches(actions, applications))
    applied = checked.where(F.col("problem").isNull()).select(
        "ticket_id", "macro_id", "seq", F.to_json(F.struct(*MACRO_COLUMNS)).alias("applied")
    )
    return applied, _apply(tickets, custom_values, checked, thread)


def changed_details(details: DataFrame, touched: DataFrame) -> DataFrame:
    """The detail rows of the touched tickets only, as every write returns them."""
    return details.join(touched, "id", "left_semi")
