"""What happened on tickets: newest tickets per owner, audit trails, service times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veildesk.staging import left_lookup, ranked

CHUNKS = ("minute", "hour", "day", "month", "year")


def newest_tickets(tickets: DataFrame, owner: str, limit: int | None = None) -> DataFrame:
    """Each owner's tickets, newest first, with their rank and the number returned.

    With a limit the rank filter sits on the window, so Spark keeps at most ``limit`` rows per
    owner in every task before the shuffle. Without one the ranks come from a range partition.
    Either way an owner of a third of all tickets is no hot spot.
    """
    owned = tickets.where(F.col(owner).isNotNull())
    order = [F.col("created_at").desc(), F.col("id")]
    if limit is None:
        top = ranked(owned, [owner], order, "rank")
    else:
        newest = W.partitionBy(owner).orderBy(*order)
        top = owned.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit)
    counts = owned.groupBy(owner).agg(F.count("*").alias("returned"))
    if limit is not None:
        counts = counts.withColumn("returned", F.least("returned", F.lit(limit).cast("bigint")))
    return top.join(counts, owner).select(*tickets.columns, "rank", "returned")


def requester_tickets(tickets: DataFrame, limit: int | None = None) -> DataFrame:
    return newest_tickets(tickets, "requester_id", limit)


def organization_tickets(tickets: DataFrame, limit: int | None = None) -> DataFrame:
    return newest_tickets(tickets, "organization_id", limit)


def audit_authors(audits: DataFrame, users: DataFrame) -> DataFrame:
    return left_lookup(audits, users, "author_id", {"name": "author"})


def audit_trail(audits: DataFrame, users: DataFrame, limit: int | None = None) -> DataFrame:
    """The audits of each ticket in order (the first ``limit``), one row per event."""
    order = ["created_at", "id"]
    if limit is None:
        first = ranked(audits, ["ticket_id"], [F.col(c) for c in order], "rank")
    else:
        place = F.row_number().over(W.partitionBy("ticket_id").orderBy(*order))
        first = audits.withColumn("rank", place).where(F.col("rank") <= limit)
    return audit_authors(first, users).select(
        "ticket_id",
        "rank",
        "id",
        "created_at",
        "author_id",
        "author",
        F.posexplode_outer("events").alias("pos", "event"),
    )


def ticket_metrics(events: DataFrame, chunk: str = "day") -> DataFrame:
    """Service times per ticket from its events, in seconds.

    ``events`` has ``ticket_id, id, created_at, event``; order is (created_at, id), and a
    ticket is created at its first event. First reply: to the first ``agent_reply``.
    Replies: number of those. Reopens: ``reopened`` events whose previous status event
    (``solved`` or ``reopened``) is ``solved``. Full resolution: to the last ``solved``.
    Requester wait: sum of the gaps from each ``requester_reply`` to the next event;
    assignee wait: the same from each ``agent_reply``. Agent resolution: full resolution
    less the assignee wait before the last ``solved``.

    A window per ticket would send all events of a busy ticket to one task. Windows here
    cover one ticket and one ``chunk`` of time. What crosses a chunk border is only its
    first time and its last event, so those are settled on one summary row per chunk.
    """
    if chunk not in CHUNKS:
        raise ValueError(f"chunk must be one of {', '.join(CHUNKS)}")
    event, at, place = F.col("event"), F.col("at"), F.struct("at", "id")
    timed = events.select(
        "ticket_id",
        "id",
        "event",
        F.unix_micros(F.col("created_at").cast("timestamp")).alias("at"),
        F.date_trunc(chunk, F.col("created_at").cast("timestamp")).alias("chunk"),
    )
    whole = W.partitionBy("ticket_id", "chunk")
    inside = whole.orderBy("at", "id")
    status = F.when(event.isin("solved", "reopened"), event)
    seen = timed.withColumns(
        {
            "gap": F.lead("at").over(inside) - at,
            "status_before": F.last(status, ignorenulls=True).over(
                inside.rowsBetween(W.unboundedPreceding, -1)
            ),
            "last_solved": F.max(F.when(event == "solved", place)).over(whole),
        }
    )
    chunks = seen.groupBy("ticket_id", "chunk").agg(
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.max_by("event", place).alias("last_event"),
        F.min_by("event", F.when(status.isNotNull(), place)).alias("first_status"),
        F.max_by("event", F.when(status.isNotNull(), place)).alias("last_status"),
        F.min(F.when(event == "agent_reply", at)).alias("replied_at"),
        F.max(F.when(event == "solved", at)).alias("solved_at"),
        F.count_if(event == "agent_reply").alias("replies"),
        F.count_if((event == "reopened") & (F.col("status_before") == "solved")).alias("reopens"),
        _total(F.when(event == "requester_reply", F.col("gap"))).alias("requester_wait"),
        _total(F.when(event == "agent_reply", F.col("gap"))).alias("assignee_wait"),
        _total(
            F.when((event == "agent_reply") & (place < F.col("last_solved")), F.col("gap"))
        ).alias("wait_to_solved"),
    )

    by_chunk = W.partitionBy("ticket_id").orderBy("chunk")
    before = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    border = F.coalesce(F.lead("first_at").over(by_chunk) - F.col("last_at"), F.lit(0))
    joined = chunks.withColumns(
        {
            "border": border,
            "status_before": F.last("last_status", ignorenulls=True).over(before),
        }
    ).withColumns(
        {
            "requester_wait": F.col("requester_wait") + _if_last("requester_reply"),
            "assignee_wait": F.col("assignee_wait") + _if_last("agent_reply"),
            "reopens": F.col("reopens")
            + F.when(
                (F.col("first_status") == "reopened") & (F.col("status_before") == "solved"), 1
            ).otherwise(0),
        }
    )
    waited = F.coalesce(F.sum("assignee_wait").over(before), F.lit(0)) + F.col("wait_to_solved")
    totals = (
        joined.withColumn("waited", waited)
        .groupBy("ticket_id")
        .agg(
            F.min("first_at").alias("created"),
            F.min("replied_at").alias("replied"),
            F.max("solved_at").alias("solved"),
            F.sum("replies").alias("replies"),
            F.sum("reopens").alias("reopens"),
            F.sum("requester_wait").alias("requester_wait"),
            F.sum("assignee_wait").alias("assignee_wait"),
            F.max_by("waited", F.when(F.col("solved_at").isNotNull(), F.col("chunk"))).alias(
                "waited"
            ),
        )
    )
    resolution = F.col("solved") - F.col("created")
    return totals.select(
        "ticket_id",
        _seconds(F.col("replied") - F.col("created")).alias("first_reply_time"),
        _seconds(resolution).alias("full_resolution_time"),
        _seconds(resolution - F.col("waited")).alias("agent_resolution_time"),
        "reopens",
        "replies",
        _seconds(F.col("assignee_wait")).alias("assignee_wait_time"),
        _seconds(F.col("requester_wait")).alias("requester_wait_time"),
    )


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _if_last(event: str) -> Column:
    return F.when(F.col("last_event") == event, F.col("border")).otherwise(F.lit(0))


def _seconds(micros: Column) -> Column:
    return micros / F.lit(1_000_000)
