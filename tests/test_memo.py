"""The memo of detections: who is asked, what is kept, what is forgotten."""

import sys
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veildesk.functions.detectors import GazetteerDetector
from veildesk.plans import redaction as R
from veildesk.plans.memo import DetectionMemo
from veildesk.staging import scratch_path

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Counting(GazetteerDetector):
    """Notes every text that it is asked about in a file; fails on a word, if told."""

    log: str = ""
    fail: str = ""

    def detect(self, model, texts):
        if self.fail and any(self.fail in t for t in texts):
            raise RuntimeError("broken")
        with open(self.log, "a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return super().detect(model, texts)


def frame(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id long, body string")


def clean(df, policy):
    return [r.body for r in R.sanitize_df(df, ["id"], ["body"], policy).orderBy("id").collect()]


def asked(log):
    return sorted(log.read_text().split("\n")[:-1]) if log.exists() else []


def test_a_second_run_asks_for_nothing(spark, tmp_path):
    log = tmp_path / "log"
    memo = DetectionMemo(scratch_path(spark, "memo"))
    policy = R.Policy(pseudonyms=False, detector=Counting({"Ann": "X"}, log=str(log)), memo=memo)
    first, second = frame(spark, ["to Ann", "to Bob", "to Ann"]), frame(spark, ["to Bob", "to Ann", "of Ann", None])
    assert clean(first, policy) == ["to [X]", "to Bob", "to [X]"]
    assert asked(log) == ["to Ann", "to Bob"]
    assert clean(first, policy) == ["to [X]", "to Bob", "to [X]"] and len(asked(log)) == 2
    assert clean(second, policy) == ["to Bob", "to [X]", "of [X]", None]
    assert asked(log) == ["of Ann", "to Ann", "to Bob"]
    # Another run of the report asks for nothing either.
    R.redaction_report(second, ["id"], ["body"], policy).collect()
    assert len(asked(log)) == 3
    # One that was changed is asked for all, and does not see the other's answers.
    other = R.Policy(pseudonyms=False, detector=Counting({"Bob": "Y"}, log=str(log)), memo=memo)
    assert clean(second, other) == ["to [Y]", "to Ann", "of Ann", None]
    assert len(asked(log)) == 6
    assert "text" not in memo.answers(spark, policy.detector).columns


def test_a_failed_run_leaves_the_memo(spark, tmp_path):
    memo = DetectionMemo(scratch_path(spark, "memo"))
    bad = Counting({"Ann": "X"}, log=str(tmp_path / "log"), fail="Bob")
    policy = R.Policy(pseudonyms=False, detector=bad, memo=memo)
    with pytest.raises(Exception):
        clean(frame(spark, ["to Ann", "to Bob"]), policy)
    assert memo.answers(spark, bad).count() == 0
    assert clean(frame(spark, ["to Ann"]), policy) == ["to [X]"]


def test_a_bounded_memo_forgets_old_runs(spark, tmp_path):
    log = tmp_path / "log"
    detector = Counting({"Ann": "X"}, log=str(log))
    memo = DetectionMemo(scratch_path(spark, "memo"), keep=2)
    for run in range(4):
        texts = R.distinct_texts(frame(spark, [f"Ann {run}", "Ann always"]).withColumnRenamed("body", "text"))
        assert memo.detect(texts, detector).where(F.size("spans") == 1).count() == 2
    left = memo.answers(spark, detector)
    assert left.select("run").distinct().count() == 2 and left.count() <= 4
    # What every run met was asked for again only once its own run had gone.
    assert asked(log).count("Ann always") == 2


@pytest.mark.parametrize("pseudonyms", [False, True])
def test_report_and_redaction_come_from_one_detection(spark, tmp_path, pseudonyms):
    log = tmp_path / "log"
    policy = R.Policy(
        pseudonyms=pseudonyms, detector=Counting({"Ann": "X", "Bob": "FINANCIAL_AMOUNT"}, log=str(log)),
        allow=["b.co"],
    )
    df = frame(spark, ["Ann to a@b.co", "to Bob", "Ann to a@b.co", None, "", "of Ann"])
    done, report = R.sanitize_with_report(df, ["id"], ["body"], policy)
    cleaned = [r.body for r in done.frame.orderBy("id").collect()]
    counts = sorted(tuple(r) for r in report.collect())
    assert asked(log) == ["Ann to a@b.co", "of Ann", "to Bob"]
    assert counts == sorted(tuple(r) for r in R.redaction_report(df, ["id"], ["body"], policy).collect())
    assert (1, "FINANCIAL_AMOUNT", 1, 1, 0) in counts
    assert cleaned == clean(df, policy)
    assert done.frame.columns == df.columns
