"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veildesk.llm import (
    byte_bpe,
    decontamination,
    dimension_scan,
    language_id,
    license_templates,
    quality_hosts,
    secret_tests,
    simhash_vptree,
    spelling_variants,
    sql,
    term_treap,
    token_planes,
    warc_archive,
    weak_quality,
)
from veildesk.llm.common import table

#: Path and pattern are parameters of the operators; these are the production values.
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: Share of the places of words that are damaged before spelling variants are looked for.
SLIP_EVERY = 199


def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.score_quality(table(spark, sf_dir, "documents"))


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan(table(spark, sf_dir, "documents")).drop("spans")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(documents, BYTE_BPE, public_tokenizers.PATTERN)


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_tests.scan(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"))


def token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_planes.token_files(documents, TOKENIZER, public_tokenizers.PATTERN, END_ID)


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_hosts.judge(table(spark, sf_dir, "documents"))
    return judged.drop("n_lines", "host", "host_rate")


def ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_treap.ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.coalesce(F.pmod("vec_id", F.lit(100)) == 0, F.lit(False))
    return dimension_scan.nearest(table(spark, sf_dir, "embeddings"), asks)


def spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(
        table(spark, sf_dir, "documents"), slip_every=SLIP_EVERY
    )


QUERIES = {
    "op1_language_id": language_identification,
    "op2_quality_classifier": quality_classifier,
    "op3_license_scans": license_scans,
    "op4_warc": warc,
    "op5_byte_bpe": byte_bpe_round_trip,
    "op6_secret_scans": secret_scans,
    "op7_simhash_near_dedup": simhash_near_dedup,
    "op8_token_id_output": token_id_output,
    "op9_benchmark_decontamination": benchmark_decontamination,
    "op10_quality_rules": quality_rules,
    "op11_ranked_lexical_search": ranked_lexical_search,
    "op12_nearest_neighbours": nearest_neighbours,
    "op13_spelling_variants": spelling_variant_grouping,
}
ORACLES: dict[str, str] = {
    "op3_license_scans": sql.LICENSE_SCANS,
    "op4_warc": sql.WARC,
    "op9_benchmark_decontamination": sql.DECONTAMINATION,
    "op10_quality_rules": sql.QUALITY_RULES,
    "op11_ranked_lexical_search": sql.RANKED_SEARCH,
    "op13_spelling_variants": sql.SPELLING_VARIANTS,
}
