"""Numbered placeholders: one per distinct value, stable across runs and batches."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.functions.text import SPACE
from veildesk.schemas import VAULT
from veildesk.staging import ranked

# Fixed value: marks that, like white space, do not tell two spellings of a value apart.
_MARKS = "_.\\-"
_SEPARATORS = re.compile(f"[{SPACE}{_MARKS}]+")
_ASCII_SEPARATORS = "\\t\\n\\x0B\\f\\r " + _MARKS


@F.pandas_udf(T.StringType())
def pseudonym_key(value: pd.Series) -> pd.Series:
    """NFKC, lower case, separators as one space, trimmed (Spark has no NFKC function)."""

    def normal(text):
        if text is None:
            return None
        return _SEPARATORS.sub(" ", unicodedata.normalize("NFKC", text).lower()).strip(" ")

    return value.map(normal)


def empty_vault(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VAULT)


def distinct_values(occurrences: DataFrame) -> DataFrame:
    """(value, type, seen) of each value's first occurrence; map-side combined, so a value
    that makes up much of the data still reaches the shuffle as one row per task."""
    return occurrences.groupBy("value").agg(
        F.min_by("type", "seen").alias("type"), F.min("seen").alias("seen")
    )


def keyed(values: DataFrame) -> DataFrame:
    """Add ``key`` to distinct values: in the JVM for ASCII, where NFKC changes nothing, and by
    ``pseudonym_key`` for the others."""
    ascii_only = F.col("value").rlike("\\A[\\x00-\\x7F]*+\\z")
    plain = F.trim(F.regexp_replace(F.lower("value"), f"[{_ASCII_SEPARATORS}]++", " "))
    return (
        values.where(ascii_only).withColumn("key", plain)
        .unionByName(values.where(~ascii_only).withColumn("key", pseudonym_key("value")))
    )


def first_seen(values: DataFrame) -> DataFrame:
    """(key, type, seen) of each key's first value, from rows of ``key, type, seen``."""
    return values.groupBy("key").agg(
        F.min_by("type", "seen").alias("type"), F.min("seen").alias("seen")
    )


def highest_numbers(vault: DataFrame) -> DataFrame:
    """``type, highest`` number given out."""
    return vault.groupBy("type").agg(F.max("n").alias("highest"))


def number_values(
    seen: DataFrame, vault: DataFrame, highest: DataFrame | None = None
) -> DataFrame:
    """Vault rows for the keys in ``seen`` that ``vault`` does not have yet.

    Numbers continue after the highest one of each type, in order of ``seen``. ``ranked``
    gives them without a task for a whole type. A caller that keeps the highest numbers needs
    to pass only the part of the vault that may hold the keys.
    """
    # The few new keys meet the large vault as the right side of a semi join, which Spark
    # can broadcast; the vault is then read but not shuffled.
    known = vault.select("key").join(seen.select("key"), "key", "left_semi")
    fresh = seen.join(known, "key", "left_anti")
    taken = highest_numbers(vault) if highest is None else highest
    numbered = (
        ranked(fresh, ["type"], [F.col("seen")], "_rank")
        .join(taken, "type", "left")
        .withColumn("n", (F.coalesce("highest", F.lit(0)) + F.col("_rank")).cast("bigint"))
    )
    return numbered.select("key", "type", "n", numbered_placeholder("type", "n"))


def numbered_placeholder(kind: str, n: str):
    return F.format_string("[%s_%d]", F.col(kind), F.col(n)).alias("placeholder")


def entity_counts(occurrences: DataFrame) -> DataFrame:
    """Distinct values per type, each value counted under the type it was first seen with."""
    values = first_seen(keyed(distinct_values(occurrences)))
    return values.groupBy("type").agg(F.count("*").alias("n_values"))
