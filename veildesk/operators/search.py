"""Search over several entity types at once, one result shape for all."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.operators.tickets import ticket_link


@dataclass(frozen=True)
class Source:
    """A searched table and the predicate that selects its hits."""

    rows: DataFrame
    predicate: Column


def search(
    sources: Mapping[str, Source], base_url: str, limit: int | None = None
) -> DataFrame:
    """Hits tagged with their type; tickets link to the agent page, others keep their url.

    The raw record is kept whole as JSON. Each predicate is pushed to its own scan; a
    limit is a top-n over (type, id), and without one nothing is sorted.
    """
    hits = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [_hits(kind, source, base_url) for kind, source in sources.items()],
    )
    return hits if limit is None else hits.orderBy("result_type", "id", "raw").limit(limit)


def _hits(kind: str, source: Source, base_url: str) -> DataFrame:
    rows = source.rows.where(source.predicate)
    numeric = dict(rows.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint", "double", "float")
    key = (F.col("id") if numeric else F.lit(None)).cast("bigint")
    if kind == "ticket":
        url = F.when(key.isNotNull(), ticket_link(base_url, key))
    elif "url" in rows.columns:
        url = F.col("url")
    else:
        url = F.lit(None).cast("string")
    return rows.select(
        F.lit(kind).alias("result_type"),
        key.alias("id"),
        url.alias("url"),
        F.to_json(F.struct(*rows.columns)).alias("raw"),
    )
