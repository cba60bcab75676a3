"""Hashed byte n-grams, bounded samples and linear models trained on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import map_rows

#: Hash space of the n-grams; a model's size depends on it and on the number of classes only.
DIMENSIONS = 1 << 12
_SHIFT = np.uint32(32 - 12)
_CHUNK = 1 << 20
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def hashed_ngrams(raw: bytes) -> np.ndarray:
    """Unit vector of the square roots of hashed byte bi- and trigram counts, in chunks."""
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, max(1, len(raw) - 1), _CHUNK):
        x = np.frombuffer(raw[at : at + _CHUNK + 2], np.uint8).astype(np.uint32)
        two = x[:-1] * _A ^ x[1:] * _B
        three = two[:-1] ^ x[2:] * _C
        # The two bytes that a chunk shares with the next are counted there.
        last = at + _CHUNK >= len(raw) - 1
        counts += np.bincount((three if last else three[:_CHUNK]) >> _SHIFT, minlength=DIMENSIONS)
        counts += np.bincount((two if last else two[:_CHUNK]) >> _SHIFT, minlength=DIMENSIONS)
    vector = np.sqrt(counts.astype(np.float32))
    norm = float(np.sqrt(counts.sum()))
    return vector / norm if norm else vector


def hash_limits(hashed: DataFrame, each: int) -> dict:
    """Per ``group``, the hash ``h`` up to which it has ``each`` distinct ones, or all it has.

    Groups are classes, so the driver holds one number for each class.
    """
    by_hash = Window.partitionBy("group").orderBy("h")
    limits = (
        hashed.select("group", "h").distinct()
        .withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= each)
        .groupBy("group").agg(F.max("h").alias("limit")).collect()
    )
    return {r["group"]: r["limit"] for r in limits}


def bounded_sample(rows: DataFrame, group: Column, text: Column, each: int) -> DataFrame:
    """``group, text``: per group, the ``each`` distinct texts of smallest hash, if it has that many.

    Which texts these are depends on the texts alone. Hashes are ranked first, without texts.
    """
    hashed = rows.select(group.alias("group"), F.xxhash64(text).alias("h"), text.alias("text"))
    limits = hash_limits(hashed, each)
    if not limits:
        return hashed.where("1 = 0").select("group", "text")
    limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
    return (
        hashed.where(F.col("h") <= limit[F.col("group")])
        .groupBy("group", "h").agg(F.first("text").alias("text")).select("group", "text")
    )


def packed(vector: np.ndarray) -> bytes:
    return vector.astype(np.float16).tobytes()


def unpacked(found: list[tuple]) -> tuple[list, np.ndarray]:
    """Groups and feature rows from ``(group, packed features)``, in an order of their own."""
    found = sorted((group, bytes(features)) for group, features in found)
    matrix = np.frombuffer(b"".join(f for _, f in found), np.float16).astype(np.float32)
    return [g for g, _ in found], matrix.reshape(len(found), DIMENSIONS)


def features_of(sample: DataFrame, prepare) -> tuple[list, np.ndarray]:
    """Groups and feature rows of a bounded sample, on the driver."""
    schema = T.StructType(
        [
            T.StructField("group", sample.schema["group"].dataType),
            T.StructField("features", T.BinaryType()),
        ]
    )

    def rows(groups: list, texts: list) -> Iterator[tuple]:
        for group, text in zip(groups, texts, strict=True):
            yield group, packed(hashed_ngrams(prepare(text)))

    return unpacked([tuple(r) for r in map_rows(sample, rows, schema).collect()])


def train_svm(
    x: np.ndarray, positive: np.ndarray, rounds: int = 300, decay: float = 1e-3
) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM: subgradient steps, both classes weighing the
    same, the last half of the steps averaged."""
    sign = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    pull = (sign * share).astype(np.float32)
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    weights, mean = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float64)
    for step in range(1, rounds + 1):
        short = sign * (x @ weights) < 1
        rate = 1 / (decay * (step + 10))
        weights = (1 - rate * decay) * weights + rate * (pull * short) @ x
        if step > rounds // 2:
            mean += weights
    return (mean / (rounds - rounds // 2)).astype(np.float32)


def train_logistic(
    x: np.ndarray, target: np.ndarray, rounds: int = 400, rate: float = 20.0, decay: float = 1e-4
) -> np.ndarray:
    """Weights and, last, the bias of a logistic scorer for soft targets between 0 and 1."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    weights = np.zeros(x.shape[1], np.float32)
    for _ in range(rounds):
        gap = target - sigmoid(x @ weights)
        weights += rate * (gap.astype(np.float32) @ x / len(x) - decay * weights)
    return weights


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
