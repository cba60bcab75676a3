"""Paged JSON exports: one row per page in a bronze table ``page_no, body``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.schemas import COMMENT, TICKET, USER, struct_body

_LAST = (1 << 62) - 1
_PAGE = 1 << 20  # more than the places of a page


@dataclass(frozen=True)
class Export:
    """Items with ``page_no, pos``, and each side array the same way."""

    items: DataFrame
    sideloads: dict[str, DataFrame]


def read_paged_export(
    pages: DataFrame,
    item_key: str,
    item: str,
    sideloads: dict[str, str] | None = None,
    limit: int | None = None,
) -> Export:
    """Concatenate the item arrays of an export in page order.

    Reading ends at the first page without a continuation, or at the page that reaches
    ``limit``; the side arrays of that page are kept whole. Both ends are one-row
    subqueries, so pages are never put in order or numbered across the cluster; only a
    ``limit`` sorts, as a top-n. A page that is not JSON fails the job; a field of another
    JSON type than its column's is null, as ``typed`` says, and its neighbours stay.
    """
    end = pages.where(~_continues(F.col("body"))).agg(F.min("page_no")).scalar()
    read = pages.where(F.col("page_no") <= F.coalesce(end, F.lit(_LAST)))
    items = _exploded(read, item_key, item)
    if limit is not None:
        items = items.orderBy("page_no", "pos").limit(limit)
        reached = items.agg(F.when(F.count("*") >= limit, F.max("page_no"))).scalar()
        read = read.where(F.col("page_no") <= F.coalesce(reached, F.lit(_LAST)))
    sides = {name: _exploded(read, name, ddl) for name, ddl in (sideloads or {}).items()}
    return Export(items, sides)


def _continues(body: Column) -> Column:
    """Whether a page says that another follows, from three fields of its text."""

    def given(path: str) -> Column:
        return F.coalesce(F.get_json_object(body, path), F.lit("")) != ""

    more = F.coalesce(F.get_json_object(body, "$.meta.has_more"), F.lit("")) == "true"
    return (more & given("$.links.next")) | given("$.next_page")


def _exploded(read: DataFrame, key: str, columns: str) -> DataFrame:
    rows = typed_array(F.try_variant_get(F.parse_json("body"), f"$.{key}", "variant"))
    schema = T._parse_datatype_string(f"struct<{struct_body(columns)}>")
    return read.select("page_no", F.posexplode(rows).alias("pos", "row")).select(
        "page_no",
        "pos",
        *[
            typed(F.try_variant_get("row", f"$.{f.name}", "variant"), f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def typed_array(value: Column) -> Column:
    """A JSON array as an array of variants; null if it is anything else.

    Its schema is not asked for: that would read the value, a whole page, a second time.
    """
    return F.try_variant_get(value, "$", "array<variant>")


def typed(value: Column, kind: T.DataType) -> Column:
    """A variant as a column type, null where the JSON is of another type.

    Numbers, booleans and arrays must be such in the JSON: "12" is no number, "abc" no array.
    A string column takes strings and also numbers and booleans, as text.
    """
    if isinstance(kind, T.LongType):
        return number_or_null(value)
    if isinstance(kind, T.BooleanType):
        return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    if isinstance(kind, T.ArrayType):
        return F.transform(typed_array(value), lambda v: typed(v, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [
            typed(F.try_variant_get(value, f"$.{f.name}", "variant"), f.dataType).alias(f.name)
            for f in kind.fields
        ]
        is_object = F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))
        return F.when(is_object, F.struct(*fields))
    return F.try_variant_get(value, "$", kind.simpleString())


def ticket_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """Tickets, custom values and users from ticket pages, in the columns of the model.

    Of copies of a ticket or user on several pages the last one counts.
    """
    export = read_paged_export(pages, "tickets", TICKET, {"users": USER})
    order = ["page_no", "pos"]
    tickets = sideload_index(export.items, order)
    values = tickets.select(
        F.col("id").alias("ticket_id"), F.posexplode("custom_fields").alias("pos", "f")
    )
    return {
        "tickets": tickets.drop("custom_fields"),
        "custom_values": values.select(
            "ticket_id", F.col("f.id").alias("field_id"), F.col("pos").cast("bigint").alias("pos"),
            F.col("f.value").alias("value"),
        ),
        "users": sideload_index(export.sideloads["users"], order),
    }


def comment_table(pages: DataFrame) -> DataFrame:
    """Comments from pages ``ticket_id, page_no, body`` of many tickets, keyed (ticket_id, seq).

    ``seq`` orders a ticket's comments by page and place; it need not be without gaps.
    """
    rows = typed_array(F.try_variant_get(F.parse_json("body"), "$.comments", "variant"))
    schema = T._parse_datatype_string(f"struct<{struct_body(COMMENT)}>")
    at = pages.select("ticket_id", "page_no", F.posexplode(rows).alias("pos", "row"))
    return at.select(
        "ticket_id",
        (F.col("page_no") * _PAGE + F.col("pos")).cast("bigint").alias("seq"),
        *[
            typed(F.try_variant_get("row", f"$.{f.name}", "variant"), f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def sideload_index(rows: DataFrame, order: Sequence[str], key: str = "id") -> DataFrame:
    """One record per id, the last in ``order``; copies are folded before the shuffle."""
    kept = [c for c in rows.columns if c not in order and c != key]
    last = F.max_by(F.struct(*kept), F.struct(*order)).alias("row")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(last).select(key, "row.*")


def read_resource(df: DataFrame, body: str, out: str = "resource") -> DataFrame:
    """Any resource as a typed-on-read value; text that is not JSON fails the job."""
    return df.withColumn(out, F.parse_json(body))


def resource_field(resource: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(resource, path, kind)


def number_or_null(value: Column) -> Column:
    """A JSON number as bigint; any other JSON type, even "12", is null."""
    numeric = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(numeric, F.try_variant_get(value, "$", "bigint"))
