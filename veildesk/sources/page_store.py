"""Export pages stored by range of their numbers, so that a read stops at the export's end.

Each page is stored with what decides how far to read: whether another follows, and how many
items it has. These narrow columns are read first, without the bodies; the answer is a page
number, and the scan of the bodies then prunes every range of pages behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veildesk.sources.exports import Export, _continues, read_paged_export

_PAGES = "page_no bigint, continues boolean, n_items bigint, body string, page_range bigint"


def store_pages(
    pages: DataFrame, path: str, item_key: str, pages_in_a_range: int = 1_000, mode: str = "append"
) -> None:
    """Write pages ``page_no, body`` to the table under ``path``, a folder for each range.

    A large range is written by several tasks. Pages that are not JSON are stored as well, as
    pages without items that nothing follows; reading one of them fails.
    """
    array = F.get_json_object("body", f"$.{item_key}")
    rows = pages.select(
        F.col("page_no").cast("bigint").alias("page_no"),
        F.coalesce(_continues(F.col("body")), F.lit(False)).alias("continues"),
        F.coalesce(F.json_array_length(array), F.lit(0)).cast("bigint").alias("n_items"),
        "body",
        F.floor(F.col("page_no") / pages_in_a_range).cast("bigint").alias("page_range"),
    )
    rows = rows.hint("rebalance", "page_range").sortWithinPartitions("page_range", "page_no")
    rows.write.mode(mode).partitionBy("page_range").parquet(path)


def last_page(spark: SparkSession, path: str, limit: int | None = None) -> tuple[int, int] | None:
    """``page_range, page_no`` of the page that a read ends with; None if there are no pages.

    That is the first page that nothing follows, or the last one there is, or the page whose
    items reach ``limit``. Ranges are counted first, then the pages of one range.
    """
    return _last_page(_stored(spark, path), limit)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored pages; every call lists all folders, so a read makes one."""
    return spark.read.schema(_PAGES).parquet(path)


def _last_page(stored: DataFrame, limit: int | None) -> tuple[int, int] | None:
    narrow = stored.drop("body")
    end = F.min(F.when(~F.col("continues"), F.struct("page_no", "page_range")))
    ends = narrow.agg(end.alias("end"), F.max(F.struct("page_no", "page_range")).alias("last")).first()
    found = ends["end"] or ends["last"]
    if found is None or limit is None:
        return found and (found["page_range"], found["page_no"])
    read = narrow.where(
        (F.col("page_range") <= found["page_range"]) & (F.col("page_no") <= found["page_no"])
    )
    ranges = read.groupBy("page_range").agg(F.sum("n_items").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("page_range")).alias("total")
    # One row for each range of pages: few, whatever the pages hold.
    reached = ranges.select("page_range", "n", so_far).where(F.col("total") >= limit)
    first = reached.orderBy("page_range").first()
    if first is None:
        return found["page_range"], found["page_no"]
    missing = limit - (first["total"] - first["n"])
    so_far = F.sum("n_items").over(Window.orderBy("page_no"))
    inside = read.where(F.col("page_range") == first["page_range"])
    page = inside.withColumn("total", so_far).where(F.col("total") >= missing).agg(F.min("page_no"))
    return first["page_range"], page.first()[0]


def read_stored_export(
    spark: SparkSession,
    path: str,
    item_key: str,
    item: str,
    sideloads: dict[str, str] | None = None,
    limit: int | None = None,
) -> Export:
    """``read_paged_export`` of stored pages; bodies behind the end are not read."""
    stored = _stored(spark, path)
    page_range, page_no = _last_page(stored, limit) or (-1, -1)
    bodies = stored.where(
        (F.col("page_range") <= page_range) & (F.col("page_no") <= page_no)
    )
    return read_paged_export(bodies.select("page_no", "body"), item_key, item, sideloads, limit)
