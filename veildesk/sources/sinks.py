"""Writers that let nothing out unredacted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from veildesk.plans.redaction import Policy, Sanitized, sanitize
from veildesk.plans.vault import empty_vault
from veildesk.schemas import VAULT
from veildesk.staging import run_folder


def write_sanitized(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy = Policy(),
    file_format: str = "parquet",
    vault: DataFrame | None = None,
    mode: str = "errorifexists",
    vault_path: str | None = None,
) -> Sanitized:
    """Redact and write as one job; a failing detector fails it before the commit, so the
    target holds either the redacted table or nothing.

    With ``vault_path`` the vault after the run is written there, before the table: whatever
    fails after that, no placeholder stands in the table that the vault does not know. What the
    job staged on its way goes at its end, so without a path the numbered vault is not returned.
    """
    spark = df.sparkSession
    with run_folder(spark):
        done = sanitize(df, keys, columns, policy, vault)
        if vault_path is not None:
            done.vault.write.mode("overwrite").parquet(vault_path)
        done.frame.write.mode(mode).format(file_format).save(path)
    schema = done.frame.schema
    frame = spark.read.schema(schema).format(file_format).load(path)
    if vault_path is None:
        return Sanitized(frame, empty_vault(spark) if vault is None else vault)
    return Sanitized(frame, spark.read.schema(VAULT).parquet(vault_path))
