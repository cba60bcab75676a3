"""Redaction of arriving records with Structured Streaming.

Every micro-batch runs the batch plan, in a staging folder that goes with the batch. What
outlives a batch lies in Spark's state store, in RocksDB on the executors with a changelog in
the query's checkpoint: placeholder numbers by value key, digests of detected texts. A batch
reads and writes the state of its own keys only, so what it writes follows its new keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from veildesk.functions.detectors import Detector, detector_digest, run_detector
from veildesk.plans.redaction import (
    Policy,
    merged_cells,
    named_values,
    put_back,
    sanitize_df,
    with_rows,
)
from veildesk.plans.vault import (
    empty_vault,
    first_seen,
    highest_numbers,
    number_values,
    numbered_placeholder,
)
from veildesk.schemas import SPANS
from veildesk.staging import run_folder, scratch_path, staged

_DETECTIONS = f"digest string, detector string, spans {SPANS}"
_TOLD = "of string, key string, ask string, type string, n bigint"
_AVAILABLE = {"availableNow": True}
_STORE = "spark.sql.streaming.stateStore"
_ROCKSDB = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Only the changes of a batch go to the checkpoint; snapshots are made in the background.
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB; they copy the session's settings
    at their start, so the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    for name, value in _ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class _Numbers(StatefulProcessor):
    """The number of a key: rows with ``n`` tell it, rows with ``ask`` are answered with it."""

    def init(self, handle) -> None:
        self.known = handle.getValueState("number", "type string, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asks: list = []
        kind, n, told = None, None, False
        if self.known.exists():
            kind, n = self.known.get()
        for batch in rows:
            asks += batch["ask"].dropna().tolist()
            for new_kind, new in zip(*(batch.loc[batch["n"].notna(), ["type", "n"]].T.values)):
                if n is None or new > n:
                    kind, n, told = new_kind, int(new), True
        if told:
            self.known.update((kind, n))
        if asks and n is not None:
            found = {"of": key[0], "key": key[1], "ask": asks, "type": kind, "n": n}
            yield pd.DataFrame(found)

    def close(self) -> None:
        pass


class Vault:
    """Placeholders by value key, numbered on from batch to batch.

    ``told`` is the vault as a table, to which a batch adds its new keys. A stateful query over
    it, with its state in ``state``, knows the number of every key and the highest of each type;
    a batch puts its keys as questions into ``asks``, runs the query over what is new there and
    in ``told``, and numbers only the keys without an answer. Told numbers never change: a batch
    that runs again finds those that it told before, or gives the same ones.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def all(self, spark: SparkSession) -> DataFrame:
        """The whole vault; a key that was told twice has the same number both times."""
        told = spark.read.schema(_TOLD).parquet(self._folder(spark, "told"))
        rows = told.where("of = 'key'").select("key", "type", "n").distinct()
        return rows.select("key", "type", "n", numbered_placeholder("type", "n"))

    def _folder(self, spark: SparkSession, name: str) -> str:
        path = f"{self.path}/{name}"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
        return path

    def numbered(self, values: DataFrame) -> DataFrame:
        """Vault rows of the keys in ``values`` (``key, type, seen``, a row for each key);
        keys that the vault does not have yet are numbered in order of ``seen`` and added."""
        spark, ask = values.sparkSession, uuid.uuid4().hex
        none = F.lit(None).cast("bigint").alias("n")
        keys = values.select(F.lit("key").alias("of"), "key", F.lit(ask).alias("ask"), "type", none)
        types = values.select("type").distinct().select(
            F.lit("type").alias("of"), F.col("type").alias("key"), F.lit(ask).alias("ask"), "type", none
        )
        keys.unionAll(types).write.mode("append").parquet(self._folder(spark, "asks"))
        answers = self._answers(spark, ask)
        known = answers.where("of = 'key'").select("key", "type", "n")
        highest = answers.where("of = 'type'").select("type", F.col("n").alias("highest"))
        known = known.select("key", "type", "n", numbered_placeholder("type", "n"))
        fresh = values.join(known.select("key"), "key", "left_anti")
        new = staged(number_values(fresh, empty_vault(spark), highest), "numbered")
        told = new.select(F.lit("key").alias("of"), "key", F.lit(None).cast("string").alias("ask"), "type", "n")
        top = highest_numbers(new).select(
            F.lit("type").alias("of"), F.col("type").alias("key"),
            F.lit(None).cast("string").alias("ask"), "type", F.col("highest").alias("n"),
        )
        told.unionAll(top).write.mode("append").parquet(self._folder(spark, "told"))
        return known.unionByName(new)

    def _answers(self, spark: SparkSession, ask: str) -> DataFrame:
        reader = spark.readStream.schema(_TOLD)
        asks = reader.option("cleanSource", "delete").parquet(self._folder(spark, "asks"))
        told = reader.option("cleanSource", "off").parquet(self._folder(spark, "told"))
        found = (
            told.unionByName(asks)
            .groupBy("of", "key")
            .transformWithStateInPandas(_Numbers(), _TOLD, "Append", "None")
        )
        out = scratch_path(spark, "answers")

        def save(rows: DataFrame, number: int) -> None:
            rows.where(F.col("ask") == ask).write.mode("overwrite").parquet(f"{out}/run={number}")

        with _rocksdb(spark):
            query = (
                found.writeStream.foreachBatch(save)
                .option("checkpointLocation", f"{self.path}/state")
                .outputMode("append")
                .trigger(**_AVAILABLE)
                .start()
            )
        query.awaitTermination()
        return spark.read.schema(_TOLD).parquet(out)


class Detections:
    """Detections by text digest, without the texts: one row for each text and detector that was
    run on it, in the folder of the batch that it arrived in."""

    def __init__(self, path: str) -> None:
        self.path = path

    def all(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{_DETECTIONS}, batch bigint").parquet(self.path).drop("batch")

    def of(self, spark: SparkSession, detector: Detector) -> DataFrame:
        """``digest, spans`` of one detector; one that was changed has none yet."""
        own = self.all(spark).where(F.col("detector") == detector_digest(detector))
        return own.select("digest", "spans")

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def _start(
    stream: DataFrame, work: Callable, checkpoint: str, trigger: Mapping | None
) -> StreamingQuery:
    def in_folder(batch: DataFrame, number: int) -> None:
        with run_folder(batch.sparkSession):
            work(batch, number)

    return (
        stream.writeStream.foreachBatch(in_folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or _AVAILABLE))
        .start()
    )


def stream_sanitize(
    stream: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    out: str,
    checkpoint: str,
    vault: Vault | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Redact arriving rows; same result as the batch plan.

    Numbers must go on from batch to batch, so a policy with numbered placeholders needs a
    ``vault``. ``trigger`` is what ``writeStream.trigger`` takes; by default what is available.
    """
    if policy.pseudonyms:
        if vault is None:
            raise ValueError("numbered placeholders need a vault that outlives the batches")
        return stream_pseudonyms(
            stream, keys, columns, policy, vault, out, checkpoint, trigger=trigger
        )

    def work(batch: DataFrame, number: int) -> None:
        # A batch is a few files, which are a task each; its rows are dealt to all tasks first.
        done = sanitize_df(batch.hint("rebalance"), keys, columns, policy)
        done.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(stream, work, checkpoint, trigger)


def stream_pseudonyms(
    stream: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    vault: Vault,
    out: str,
    checkpoint: str,
    first_batch: int = 0,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Redact arriving rows with placeholders that stay the same from batch to batch.

    The vault may have been used by earlier streams, one at a time; ``first_batch`` then keeps
    the folders of ``out`` apart.
    """

    def work(batch: DataFrame, number: int) -> None:
        batch = with_rows(batch)
        merged = staged(merged_cells(batch, keys, columns, policy), "merged")
        values = named_values(merged)
        names = staged(vault.numbered(first_seen(values)), "names")
        done = put_back(batch, keys, columns, policy, merged, values, names)
        done.write.mode("overwrite").parquet(f"{out}/batch={number + first_batch}")

    return _start(stream, work, checkpoint, trigger)


def vault_table(path: str) -> Vault:
    return Vault(path)


def detection_table(path: str) -> Detections:
    return Detections(path)


def stream_detect_once(
    stream: DataFrame,
    column: str,
    detector: Detector,
    detections: Detections,
    checkpoint: str,
    trigger: Mapping | None = None,
    event_time: str | None = None,
    within: str = "1 day",
) -> StreamingQuery:
    """Run the detector only on texts that it has not met before.

    Which texts were met is known by their digests, in the state store. With ``event_time`` a
    digest is forgotten once the watermark, ``within`` behind the latest event, has passed the
    event it came with, so the state holds the texts of that much time; rows later than the
    watermark are dropped. Without one every digest is kept. State belongs to the detector's
    digest, so one that was changed starts anew. Null texts are not detected.
    """
    mark = detector_digest(detector)
    once = ["digest", "detector"]
    texts = stream.where(F.col(column).isNotNull()).select(
        F.col(column).alias("text"),
        F.sha2(F.col(column), 256).alias("digest"),
        F.lit(mark).alias("detector"),
        *([F.col(event_time).alias("event_time")] if event_time else []),
    )
    if event_time:
        fresh = texts.withWatermark("event_time", within).dropDuplicatesWithinWatermark(once)
    else:
        fresh = texts.dropDuplicates(once)

    def work(batch: DataFrame, number: int) -> None:
        found = run_detector(batch.select("digest", "text"), detector)
        detections.write(found.select("digest", F.lit(mark).alias("detector"), "spans"), number)

    with _rocksdb(stream.sparkSession):
        return _start(fresh, work, checkpoint, trigger)
