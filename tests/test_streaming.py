"""State across micro-batches and across streams."""

import os
import sys
from dataclasses import dataclass
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veildesk.checks.streams import arriving
from veildesk.functions.detectors import GazetteerDetector
from veildesk.plans.redaction import Policy
from veildesk.sources.sinks import write_sanitized
from veildesk.staging import scratch_path, staging_root
from veildesk.streaming import sanitize as S

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def files(spark, rows, n):
    path = scratch_path(spark, "in")
    df = spark.createDataFrame(rows, "id long, body string")
    df.repartitionByRange(n, "id").write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_placeholders_outlive_a_stream(spark):
    vault, out = S.vault_table(scratch_path(spark, "vault")), scratch_path(spark, "out")
    rows = [(i, f"mail user{i % 4}@x.org") for i in range(12)]
    S.stream_pseudonyms(
        files(spark, rows, 3), ["id"], ["body"], Policy(), vault, out, scratch_path(spark, "a")
    ).awaitTermination()
    more = [(i, f"user{i % 6}@x.org again") for i in range(12, 24)]
    S.stream_pseudonyms(
        files(spark, more, 2), ["id"], ["body"], Policy(), vault, out, scratch_path(spark, "b"), 100
    ).awaitTermination()
    keys = vault.all(spark)
    assert (keys.count(), keys.select("key").distinct().count()) == (6, 6)
    assert sorted(r.n for r in keys.collect()) == [1, 2, 3, 4, 5, 6]
    done = spark.read.parquet(out)
    per_user = done.groupBy((F.col("id") % 4 * (F.col("id") < 12).cast("int")).alias("u"))
    first = done.where("id < 12").withColumn("u", F.col("id") % 4)
    assert first.groupBy("u").agg(F.count_distinct("body").alias("n")).where("n > 1").count() == 0
    assert per_user is not None and done.where(F.contains("body", F.lit("@"))).count() == 0


def ask(spark, vault, keys):
    rows = [(k, "P", i) for i, k in enumerate(keys)]
    found = vault.numbered(spark.createDataFrame(rows, "key string, type string, seen int"))
    return {r.key: r.n for r in found.collect()}


def test_a_repeated_batch_gives_the_same_numbers(spark):
    vault = S.vault_table(scratch_path(spark, "vault"))
    assert ask(spark, vault, ["a", "c"]) == {"a": 1, "c": 2}
    assert ask(spark, vault, ["b", "a"]) == {"b": 3, "a": 1}
    assert ask(spark, vault, ["b", "a"]) == {"b": 3, "a": 1}
    assert ask(spark, S.vault_table(vault.path), ["d", "c"]) == {"d": 4, "c": 2}
    assert sorted((r.key, r.n, r.placeholder) for r in vault.all(spark).collect()) == [
        ("a", 1, "[P_1]"), ("b", 3, "[P_3]"), ("c", 2, "[P_2]"), ("d", 4, "[P_4]"),
    ]


def test_a_batch_that_fails_before_it_told_is_numbered_again(spark, monkeypatch):
    vault = S.vault_table(scratch_path(spark, "vault"))
    ask(spark, vault, ["a"])
    with monkeypatch.context() as broken:
        broken.setattr(S, "number_values", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ask(spark, vault, ["b", "c"])
    assert ask(spark, vault, ["b", "c"]) == {"b": 2, "c": 3}


def written(path, *folders):
    return sum(
        os.path.getsize(os.path.join(d, f))
        for folder in folders for d, _, names in os.walk(f"{path}/{folder}") for f in names
    )


def test_bytes_written_follow_the_new_keys(spark):
    path = scratch_path(spark, "vault")
    vault, told, state = S.vault_table(path), [0], [0]
    for batch in range(5):
        new = 0 if batch == 4 else 300
        keys = [f"key {batch} {i}" for i in range(new)] + [f"key 0 {i}" for i in range(20)]
        assert len(ask(spark, vault, keys)) == new + 20 * (batch > 0) or batch == 0
        told.append(written(path, "told"))
        state.append(written(path, "state"))
    steps = [b - a for a, b in zip(told, told[1:])]
    assert max(steps[1:4]) < 1.2 * min(steps[:4]) and steps[4] < 0.5 * steps[3]
    # The last run told nothing new, so its changelog holds the 300 keys of the one before.
    assert state[5] - state[4] < 1.5 * (state[3] - state[2])


def test_numbered_streams_need_a_vault(spark):
    stream = files(spark, [(1, "a@b.co")], 1)
    with pytest.raises(ValueError):
        S.stream_sanitize(stream, ["id"], ["body"], Policy(), "out", "progress")


def test_a_batch_of_one_file_is_dealt_to_many_tasks(spark):
    filler = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"/{i}")), 256) for i in range(4)])
    df = spark.range(40_000).select("id", F.concat(F.lit("mail a@b.co "), filler).alias("body"))
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    df.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("id long, body string").parquet(path)
    policy = Policy(pseudonyms=False)
    S.stream_sanitize(stream, ["id"], ["body"], policy, out, scratch_path(spark, "p")).awaitTermination()
    done = spark.read.parquet(out)
    assert done.groupBy(F.input_file_name()).count().count() >= 4
    assert done.where("body like 'mail [EMAIL_ADDRESS] %'").count() == 40_000


@pytest.mark.parametrize("partitions", [1, 5, 8])
def test_checked_streams_arrive_in_three_batches(spark, partitions):
    df = spark.range(0, 1000, 1, partitions)
    seen = []
    arriving(spark, df).writeStream.foreachBatch(lambda rows, _: seen.append(rows.count())).option(
        "checkpointLocation", scratch_path(spark, "p")
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and sum(seen) == 1000


def test_detections_belong_to_a_detector(spark):
    rows = [(i, f"Ann {i % 5}") for i in range(20)]
    table = S.detection_table(scratch_path(spark, "detections"))
    progress = scratch_path(spark, "progress")
    detectors = [GazetteerDetector({"Ann": "X"}), GazetteerDetector({"Ann": "Y"})]
    source = files(spark, rows, 1)
    for number, detector in enumerate(detectors):
        own = S.detection_table(f"{table.path}/run={number}")
        S.stream_detect_once(
            source, "body", detector, own, f"{progress}/{number}", trigger={"availableNow": True}
        ).awaitTermination()
        found = own.of(spark, detector)
        assert {s.type for r in found.collect() for s in r.spans} == {"XY"[number]}
        assert found.count() == 5 and "text" not in found.columns
        assert own.of(spark, detectors[1 - number]).count() == 0


@dataclass(frozen=True)
class Counting(GazetteerDetector):
    """Notes every text that it is asked about in a file."""

    log: str = ""

    def detect(self, model, texts):
        with open(self.log, "a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return super().detect(model, texts)


def test_state_within_a_time_stays_level(spark, tmp_path):
    path = scratch_path(spark, "in")
    kind = "body string, at timestamp"
    spark.createDataFrame([], kind).write.parquet(path)
    detector = Counting({"Ann": "X"}, log=str(tmp_path / "log"))
    table, progress = S.detection_table(scratch_path(spark, "detections")), scratch_path(spark, "p")
    start, sizes = datetime(2024, 1, 1), []
    for batch in range(20):
        at = start + timedelta(hours=batch)
        rows = [(f"Ann {batch} {i}", at) for i in range(10)]
        # Copies of texts of the hour before, inside the bound, some with an earlier time.
        rows += [(f"Ann {batch - 1} {i}", at - timedelta(minutes=30)) for i in range(5) if batch]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
        query = S.stream_detect_once(
            spark.readStream.schema(kind).parquet(path), "body", detector, table, progress,
            event_time="at", within="2 hours",
        )
        query.awaitTermination()
        sizes += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators][-1:]
    asked = (tmp_path / "log").read_text().split("\n")[:-1]
    assert sorted(asked) == sorted(f"Ann {b} {i}" for b in range(20) for i in range(10))
    assert len(sizes) == 20 and max(sizes[5:]) <= 50 and table.of(spark, detector).count() == 200


def test_staging_goes_with_the_run(spark):
    before = listing(spark)
    out = scratch_path(spark, "out")
    S.stream_pseudonyms(
        files(spark, [(1, "mail a@b.co")], 1), ["id"], ["body"], Policy(),
        S.vault_table(scratch_path(spark, "vault")), out, scratch_path(spark, "c"),
    ).awaitTermination()
    df = spark.createDataFrame([(1, "mail a@b.co")], "id long, body string")
    write_sanitized(df, scratch_path(spark, "w"), ["id"], ["body"], vault_path=scratch_path(spark, "v"))
    with pytest.raises(Exception):
        write_sanitized(df, scratch_path(spark, "w"), ["nope"], ["body"], Policy(pseudonyms=False, scope=["id"]))
    assert not [p for p in listing(spark) - before if "run-" in p]


def listing(spark):
    root = f"{staging_root(spark)}/veildesk"
    return set(os.listdir(root.removeprefix("file://"))) if os.path.isdir(root.removeprefix("file://")) else set()
