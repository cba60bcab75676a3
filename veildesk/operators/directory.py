"""Users, ticket fields and macros."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_COLUMNS = ("id", "name", "email", "role", "organization_id", "active", "created_at")


def user_summary(users: DataFrame) -> DataFrame:
    return users.withColumn("active", F.coalesce("active", F.lit(False))).select(*USER_COLUMNS)


def get_users(users: DataFrame, ids: list[int]) -> DataFrame:
    """Summaries of a few users; the id filter reaches the scan."""
    return user_summary(users.where(F.col("id").isin(ids)))


def me(users: DataFrame, key: int) -> DataFrame:
    return users.where(F.col("id") == key).select("id", "name", "email", "role")


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or the first ``limit`` by id."""
    return rows if limit is None else rows.orderBy("id").limit(limit)


def user_search(users: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """Users whose name, e-mail or phone contains the text; the first by id if limited."""
    wanted = F.lit(query.lower())
    hit = F.lit(False)
    for column in ("name", "email", "phone"):
        hit = hit | F.coalesce(F.contains(F.lower(column), wanted), F.lit(False))
    return _first(user_summary(users.where(hit)), limit)


def ticket_fields(field_defs: DataFrame, active_only: bool = True) -> DataFrame:
    """Field definitions with their options; inactive ones are left out by default."""
    active = F.coalesce("active", F.lit(False))
    chosen = field_defs.where(active) if active_only else field_defs
    return chosen.select(
        "id",
        F.coalesce("title", "raw_title").alias("title"),
        "type",
        active.alias("active"),
        F.coalesce("required", F.lit(False)).alias("required"),
        F.coalesce("options", F.filter("options", lambda _: F.lit(False)), F.array()).alias(
            "options"
        ),
    )


def field_options(fields: DataFrame) -> DataFrame:
    """The catalogue of valid values: one row per field and option."""
    return fields.select(
        F.col("id").alias("field_id"), "title", F.posexplode("options").alias("pos", "option")
    ).select("field_id", "title", "pos", "option.name", "option.value")


def list_macros(macros: DataFrame, limit: int | None = None) -> DataFrame:
    """Active macros; the first by id if limited."""
    active = macros.where(F.coalesce("active", F.lit(False)))
    return _first(active.select("id", "title", "active", "description"), limit)
