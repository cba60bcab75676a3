"""Checked streams: each runs over all its input in several micro-batches, then ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veildesk.checks.redaction import GAZETTEER, MERGED, PLAIN, _KEY, _redacted_sql, texts
from veildesk.checks.tables import duck, table
from veildesk.functions.detectors import GazetteerDetector
from veildesk.plans.redaction import Policy
from veildesk.staging import scratch_path
from veildesk.streaming.sanitize import (
    detection_table,
    stream_detect_once as detect_once,
    stream_pseudonyms as pseudonyms,
    stream_sanitize as sanitize,
    vault_table,
)

QUERIES: dict = {}
ORACLES: dict = {}

BATCHES = 3
FILE_ROWS = 50_000


def check(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = duck(sql)
        return fn

    return add


def arriving(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a stream of files of bounded size, taken in about three micro-batches.

    Each partition of ``df`` leaves a shorter file, so the files are counted when they are there.
    """
    path, rows = scratch_path(spark, "arriving"), df.count()
    per_file = max(1, min(FILE_ROWS, rows // (4 * BATCHES)))
    df.write.option("maxRecordsPerFile", per_file).parquet(path)
    files = len(spark.read.schema(df.schema).parquet(path).inputFiles())
    per_batch = max(1, -(-files // BATCHES))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


@check(f"""
    select id as doc_id, text, true as plain
    from {_redacted_sql("'[' || t || ']'")} where source = 'document'
    union all
    select id, text, false
    from {_redacted_sql("'[' || t || ']'")} where source = 'document'""")
def stream_sanitize(spark, sf_dir):
    """Both modes; numbers are compared by ``stream_pseudonyms``, so they are taken out here."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    arrived, done = arriving(spark, docs), []
    for policy in (PLAIN, Policy()):
        out = scratch_path(spark, "sink")
        sanitize(
            arrived, ["doc_id"], ["text"], policy, out,
            scratch_path(spark, "progress"), vault_table(scratch_path(spark, "vault")),
        ).awaitTermination()
        done.append(spark.read.schema(docs.schema).parquet(out).drop("batch"))
    numbered = done[1].withColumn("text", F.regexp_replace("text", "_[0-9]+\\]", "]"))
    return done[0].withColumn("plain", F.lit(True)).union(numbered.withColumn("plain", F.lit(False)))


@check(f"""
    select type, count(*) as n_values, count(*) as n_placeholders, max(n) as highest
    from (select *, row_number() over (partition by type) as n
          from (select key, split_part(split_part(clean, '[', 2), '_', 1) as type
                from (select distinct {_KEY.format(v="substr(text, s + 1, e - s)")} as key,
                             '[' || t as clean from {MERGED})))
    group by type""")
def stream_pseudonyms(spark, sf_dir):
    vault = vault_table(scratch_path(spark, "vault"))
    pseudonyms(
        arriving(spark, texts(spark, sf_dir)), ["source", "id"], ["text"], Policy(), vault,
        scratch_path(spark, "sink"), scratch_path(spark, "progress"),
    ).awaitTermination()
    return (
        vault.all(spark)
        .groupBy(F.split("type", "_")[0].alias("type"))
        .agg(
            F.count_distinct("key").alias("n_values"),
            F.count_distinct("placeholder").alias("n_placeholders"),
            F.max("n").alias("highest"),
        )
    )


@check(f"""
    select count(*) as n_detected, count(*) as n_texts,
           count(*) filter (regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}])({"|".join(GAZETTEER)})($|[^\\p{{L}}\\p{{N}}])'))
               as n_with_spans
    from (select distinct text from documents)""")
def stream_detect_once(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    found = detection_table(scratch_path(spark, "detections"))
    detect_once(
        arriving(spark, docs), "text", GazetteerDetector(GAZETTEER), found,
        scratch_path(spark, "progress"),
    ).awaitTermination()
    return found.all(spark).agg(
        F.count("*").alias("n_detected"),
        F.count_distinct("digest").alias("n_texts"),
        F.count_if(F.size("spans") > 0).alias("n_with_spans"),
    )
