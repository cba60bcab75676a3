"""Attachments: names and sizes are listed, contents are held back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veildesk.functions.urls import attachment_name
from veildesk.plans.redaction import Policy, sanitize_df


def read_attachment_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored files by path and length; the content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("size"),
            F.lit(True).alias("held_back"),
        )
    )


def attachment_manifest(
    attachments: DataFrame,
    keys: Sequence[str],
    name: str = "file_name",
    policy: Policy | None = Policy(pseudonyms=False),
) -> DataFrame:
    """Attachment rows with sanitised names. Files cannot be redacted, so while a policy
    is in force every row is marked as held back and carries no content."""
    if policy is None:
        return attachments.withColumn("held_back", F.lit(False))
    return sanitize_df(attachments, keys, [name], policy).withColumn("held_back", F.lit(True))


def with_attachment_names(
    df: DataFrame, url: str, disposition: str | None = None, out: str = "file_name"
) -> DataFrame:
    header = F.col(disposition) if disposition else None
    return df.withColumn(out, attachment_name(F.col(url), header))
