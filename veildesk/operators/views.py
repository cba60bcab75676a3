"""Views: named ticket filters given as Column predicates, keyed by view id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_view(tickets: DataFrame, predicates: Mapping[int, Column]) -> DataFrame:
    """Tickets per view, all views in one scan; only one row per task is shuffled."""
    counts = tickets.agg(
        *[F.count_if(predicate).alias(f"v{key}") for key, predicate in predicates.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(key).cast("bigint").alias("view_id"), F.col(f"v{key}").alias("value"))
            for key in predicates
        ]
    )
    return counts.select(F.inline(rows))


def view_counts(views: DataFrame, counts: DataFrame) -> DataFrame:
    """Views with their count, null where there is none."""
    return views.join(
        counts.select(F.col("view_id").alias("id"), F.col("value").alias("count")), "id", "left"
    )


def list_views(views: DataFrame, counts: DataFrame) -> DataFrame:
    return view_counts(views.where("active"), counts).select("id", "title", "active", "count")


def view_tickets(rows: DataFrame, predicate: Column, limit: int | None = None) -> DataFrame:
    """A view's tickets, the first by id if limited, each with the number returned."""
    found = rows.where(predicate)
    if limit is not None:
        found = found.orderBy("id").limit(limit)
    return found.withColumn("returned", found.agg(F.count("*")).scalar())
