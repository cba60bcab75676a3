"""Detections kept between runs, so that a text is detected once and not once a run.

A row is the digest of a text, the detector that answered and its spans; texts themselves are
not kept. A run reads the answers of its own detector only (a folder each), sends the detector
the texts that have none, and adds theirs as a run of its own. Answers belong to the digest of a
detector's code and settings: one that was changed starts with none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veildesk.functions.detectors import Detector, detector_digest, run_detector
from veildesk.schemas import SPANS
from veildesk.staging import delete_folder, staged

_SCHEMA = f"digest string, spans {SPANS}, run string"


@dataclass(frozen=True)
class DetectionMemo:
    """The memo under ``path``, made by its first run.

    ``keep`` bounds it to the answers of the latest so many runs of a detector (all by default):
    what is older goes, and is detected anew if it comes again. Runs over one memo take turns.
    """

    path: str
    keep: int | None = None

    def answers(self, spark: SparkSession, detector: Detector) -> DataFrame:
        """``digest, spans, run`` of one detector."""
        folder, runs = self._folder(detector), self._runs(spark, detector)
        if not runs:
            return spark.createDataFrame([], _SCHEMA)
        return spark.read.schema(_SCHEMA).parquet(*[f"{folder}/run={r}" for r in runs]).drop(
            "run"
        ).withColumn("run", F.regexp_extract(F.input_file_name(), "/run=([^/]+)/", 1))

    def detect(self, texts: DataFrame, detector: Detector) -> DataFrame:
        """``digest, text, spans`` of distinct ``digest, text``: remembered or detected now.

        New answers are written before anything is returned; a detector that fails leaves the
        memo as it was.
        """
        spark = texts.sparkSession
        texts = staged(texts.select("digest", "text"), "distinct-texts")
        known = self.answers(spark, detector)
        fresh = texts.join(known.select("digest"), "digest", "left_anti")
        new = staged(run_detector(fresh, detector).select("digest", "spans"), "new-detections")
        number = max((int(r.split("-")[0]) for r in self._runs(spark, detector)), default=0) + 1
        new.write.parquet(f"{self._folder(detector)}/run={number:06d}-{uuid.uuid4().hex}")
        # The known answers go on from where they are; old runs leave only after their use.
        found = known.select("digest", "spans").join(texts.select("digest"), "digest", "left_semi")
        both = staged(found.unionByName(new), "detections")
        self._forget(spark, detector)
        # Two runs at once may have answered the same text, with the same spans.
        once = both.groupBy("digest").agg(F.first("spans").alias("spans"))
        return texts.join(once, "digest").select("digest", "text", "spans")

    def _folder(self, detector: Detector) -> str:
        return f"{self.path}/detector={detector_digest(detector)}"

    def _runs(self, spark: SparkSession, detector: Detector) -> list[str]:
        """Names of the detector's finished runs, oldest first."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self._folder(detector))
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        done = [
            f.getPath().getName().removeprefix("run=")
            for f in system.listStatus(folder)
            if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))
        ]
        return sorted(done)

    def _forget(self, spark: SparkSession, detector: Detector) -> None:
        if self.keep is not None:
            for run in self._runs(spark, detector)[: -self.keep or None]:
                delete_folder(spark, f"{self._folder(detector)}/run={run}")
