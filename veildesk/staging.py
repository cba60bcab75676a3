"""Shared-folder staging and the skew-aware lookup join used across the library."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NULL_KEY_SALTS = 256
#: Rows that one task of ``dealt`` gets.
ROWS_IN_A_TASK = 250_000
#: Records that one file of ``staged_records`` gets.
ROWS_IN_A_FILE = 10_000
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


_OWN_ROOT: list[str] = []
_RUN: ContextVar[str | None] = ContextVar("veildesk_run", default=None)


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and tasks are one machine, may leave it unset; it then
    gets a folder that goes with the process. On a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _OWN_ROOT:
        own = tempfile.TemporaryDirectory(prefix="veildesk-")
        atexit.register(own.cleanup)
        _OWN_ROOT.append(own.name)
    return _OWN_ROOT[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, inside the run's folder if there is a run."""
    run = _RUN.get() or f"{staging_root(spark)}/veildesk"
    return f"{run}/{uuid.uuid4().hex}/{label}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside lies in one folder, which goes at the end, also on failure.

    Only for work that is finished inside: a DataFrame that leaves must not read staged data.
    """
    path = f"{staging_root(spark)}/veildesk/run-{uuid.uuid4().hex}"
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run made, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several later steps, or where it must not change when a
    task is run again. The files survive the loss of executors, and their sizes let
    Spark choose broadcast or shuffle joins from facts instead of estimates.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_records(df: DataFrame, label: str) -> DataFrame:
    """``staged`` for records that costly work per row follows: in files of few rows.

    A scan deals files to tasks by bytes, with a price for each file, and cannot cut a small
    one; a million short records that lie in one file are read by one task. Files of so many
    rows are dealt evenly, whatever the partitions of ``df``, without a shuffle.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.option("maxRecordsPerFile", ROWS_IN_A_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a write inside shuffles goes when the write ends, and not when the driver happens to
    collect its garbage; until then a job's shuffles would lie on disk beside those of the next.

    Spark settles this when it plans the write; the setting is the session's own again after.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


@contextmanager
def deep_expressions(spark: SparkSession) -> Iterator[None]:
    """Spark resolves nested lambdas level by level and gives up after a number of passes; a
    whole redaction in one expression, over nested columns, can need more than the default.

    A DataFrame is resolved when it is made, so the setting is the session's own again after.
    """
    setting, passes = "spark.sql.analyzer.maxIterations", 400
    before = spark.conf.get(setting, None)
    if int(before or 100) < passes:
        spark.conf.set(setting, str(passes))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each group from 1 in ``order``, without a task for a whole group.

    The rows are range-partitioned by group and order and written once; a row's place in its
    partition plus the group's counts in earlier partitions is its number. The table of counts
    has at most one row per partition and group that meets in it, and Spark sees its size.
    """
    ids, part, place = f"_{name}_id", f"_{name}_part", f"_{name}_place"
    rows = staged(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn(ids, F.monotonically_increasing_id()),
        "ranked",
    ).withColumns(
        {
            part: F.shiftright(ids, _ROW_BITS),
            place: F.col(ids).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    counts = rows.groupBy(*group, part).agg(F.count("*").alias("_n"), F.min(place).alias("_first"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    offsets = staged(counts.select(*group, part, base.alias("_base")), "rank-offsets")
    same = F.col(f"r.{part}") == F.col(f"o.{part}")
    for column in group:
        same = same & F.col(f"r.{column}").eqNullSafe(F.col(f"o.{column}"))
    return rows.alias("r").join(offsets.alias("o"), same).select(
        *[F.col(f"r.`{c}`") for c in df.columns], (F.col(place) + F.col("_base")).alias(name)
    )


def dealt(df: DataFrame, keys: Sequence[str], rows: int = ROWS_IN_A_TASK) -> DataFrame:
    """``df`` dealt by ``keys`` into as many partitions as its number of rows asks for.

    Adaptive execution merges partitions by their bytes in the shuffle, and a hash table holds
    many times these; here a task's rows, and so its tables, stay as many when the input grows.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *keys)


def with_found(df: DataFrame, name: str, found: Column) -> DataFrame:
    """Add the array ``found`` and keep the rows where it is not empty.

    A filter on a computed column is pushed below the column and computes it a second
    time; a generator computes it once.
    """
    return df.select(
        "*", F.explode(F.filter(F.array(found), lambda f: F.size(f) > 0)).alias(name)
    )


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str | Column,
    columns: dict[str, str],
    right_key: str = "id",
) -> DataFrame:
    """Left equi-join that adds ``columns`` ({right column: new name}) to ``left``.

    No side is broadcast by hint: Spark broadcasts ``right`` if its size is under the
    session's threshold and shuffles otherwise. In the shuffled form rows without a key
    can match nothing, so they are spread over ``NULL_KEY_SALTS`` buckets instead of all
    landing in one task; hot non-null keys are split by adaptive skew-join handling,
    which applies because the preserved side is the left one.
    """
    names = set(left.columns)
    key_col = F.col(key) if isinstance(key, str) else key
    spread = F.when(
        key_col.isNull(), F.pmod(F.xxhash64(*sorted(_hashable(left))), F.lit(NULL_KEY_SALTS))
    ).otherwise(F.lit(0).cast("bigint"))
    probe = left.withColumns({"_lookup_key": key_col, "_lookup_salt": spread})
    build = right.select(
        F.col(right_key).alias("_lookup_key"),
        F.lit(0).cast("bigint").alias("_lookup_salt"),
        *[F.col(src).alias(dst) for src, dst in columns.items()],
    )
    kept = [c for c in left.columns if c not in columns.values()]
    if len(kept) < len(names):
        probe = probe.drop(*columns.values())
    return probe.join(build, ["_lookup_key", "_lookup_salt"], "left").drop(
        "_lookup_key", "_lookup_salt"
    )


def _hashable(df: DataFrame) -> list[str]:
    """Scalar columns to derive the salt from (maps cannot be hashed, long texts are slow)."""
    fixed = ("bigint", "int", "timestamp", "timestamp_ntz", "double", "date", "boolean")
    names = [name for name, kind in df.dtypes if kind in fixed]
    return names or [name for name, kind in df.dtypes if kind == "string"]
