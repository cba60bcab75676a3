"""Turn per-token class scores into labels, as expressions over an array of logits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veildesk.functions.text import let


def pii_probability(logits: Column, outside: int = 0) -> Column:
    """1 - P(outside) under a softmax over the logits."""

    def score(values: Column) -> Column:
        top = F.array_max(values)
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        return F.lit(1.0) - F.exp(F.get(values, F.lit(outside)) - top) / total

    return let(F.transform(logits, lambda x: x.cast("double")), score)


def best_class(logits: Column, outside: int = 0) -> Column:
    """Index of the highest class other than ``outside``; the lowest index on a tie."""
    ranked = F.transform(
        logits,
        lambda x, i: F.when(
            i != outside, F.struct(x.cast("double").alias("score"), (-i).alias("back"))
        ),
    )
    return -F.array_max(ranked)["back"]


def token_label(
    logits: Column, labels: Sequence[str], outside: int = 0, threshold: float = 0.5
) -> Column:
    """``O`` below the threshold, else the likeliest label without its position prefix."""
    names = F.array(*[F.lit(name) for name in labels])
    label = F.regexp_replace(F.get(names, best_class(logits, outside)), "\\A[BIES]-", "")
    return F.when(pii_probability(logits, outside) >= threshold, label).otherwise(F.lit("O"))
