"""Quality classifier from weak labels.

Heuristic labellers vote junk, good or nothing on every document. Expectation-maximisation
over the counts of vote patterns estimates, for each labeller, how it votes on good and on junk
documents, without any true label; the pattern counts are a sufficient statistic, so all
documents count and only the patterns, at most 3 to the number of labellers, reach the driver.
The posterior of a document's pattern is its label, and on a bounded sample of labelled texts a
hashed linear scorer learns to give that label from the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import id_field, map_rows
from veildesk.llm.linear import (
    hash_limits,
    hashed_ngrams,
    packed,
    sigmoid,
    train_logistic,
    unpacked,
)
from veildesk.staging import staged

#: Texts the scorer is trained on, half of them good and half junk by their posteriors.
SAMPLE_ROWS = 2_400
JUNK, SILENT, GOOD = 0, 1, 2
#: A pattern is surely junk below this posterior, and surely good above the complement.
SURE = 0.2


class Shape:
    """Counts that the labellers look at, taken once from a whole text."""

    def __init__(self, text: str | None):
        text = text or ""
        self.words = words = text.split()
        self.n = len(words)
        self.letters = sum(map(str.isalpha, text)) if not text.isascii() else _ascii_letters(text)
        self.upper = sum(text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        self.symbols = sum(text.count(c) for c in "#*$%&<>")
        self.shouts = text.count("!")
        self.bars = text.count("|")
        self.marks = sum(text.count(c) for c in ".,;:?")
        self.adjacent = sum(map(eq, words, words[1:]))
        self.distinct = len(set(words))
        self.chars = sum(map(len, words))
        lines = [x for x in text.split("\n") if x.strip()]
        self.lines, self.distinct_lines = len(lines), len(set(lines))


def _ascii_letters(text: str) -> int:
    return sum(text.count(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _vote(applies: bool, junk: bool) -> int:
    return (JUNK if junk else GOOD) if applies else SILENT


def labellers(s: Shape) -> tuple[int, ...]:
    """The votes, each on a ground of its own, silent where a text is too short for it.

    They overlap, so that every kind of junk has more than one labeller, and none needs to be
    right for all kinds.
    """
    n = s.n
    return (
        _vote(n >= 3, s.symbols > 0.3 * n),
        _vote(n >= 5, 2 * s.upper > s.letters),
        _vote(n >= 5, s.shouts > 0.3 * n),
        _vote(n >= 3, s.bars > 0.3 * n),
        _vote(n >= 3, 20 * (s.symbols + s.shouts + s.bars) > s.chars),
        _vote(n >= 5, s.adjacent > 0.3 * n),
        _vote(n >= 30, 5 * s.distinct < n),
        _vote(s.lines >= 4, 2 * s.distinct_lines < s.lines),
        _vote(n >= 20, s.marks == 0),
        _vote(n >= 20, s.letters < 0.7 * s.chars),
    )


def pattern_of(votes: Sequence[int]) -> int:
    return sum(v * 3**k for k, v in enumerate(votes))


def votes_of(pattern: int, count: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(count)]


def estimate(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, pseudo: float = 0.5
) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good documents, ``P(junk vote | class, not silent)``, each pattern's posterior.

    ``patterns`` has a row of votes for each pattern; classes are junk and good, in this order.
    Silence tells nothing. It starts from documents with any vote for junk against those with
    none, so the class it calls junk is the one the labellers mean.
    """
    total = counts.sum()
    junk, voted = (patterns == JUNK).astype(float), (patterns != SILENT).astype(float)
    good = np.where(junk.any(1), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack((counts * (1 - good), counts * good))
        share = (weight.sum(1) + pseudo) / (total + 2 * pseudo)
        table = (weight @ junk + pseudo) / (weight @ voted + 2 * pseudo)
        odds = np.log(share)[:, None] + np.log(table) @ junk.T + np.log1p(-table) @ (voted - junk).T
        new = sigmoid(odds[1] - odds[0])
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return float(share[1]), table, good


def posteriors(voted: DataFrame) -> dict[int, float]:
    """``{pattern: posterior of good}`` from a ``pattern`` column over all documents."""
    found = voted.groupBy("pattern").count().orderBy("pattern").collect()
    if not found:
        return {}
    n = len(labellers(Shape("")))
    patterns = np.array([votes_of(r["pattern"], n) for r in found])
    _, _, good = estimate(patterns, np.array([r["count"] for r in found], float))
    return {r["pattern"]: float(g) for r, g in zip(found, good, strict=True)}


def _sample(hashed: DataFrame, voted: DataFrame, label: dict[int, float], each: int):
    """Labels and features of ``each`` distinct texts a side that are surely good or junk.

    The texts are those of smallest hash; a text that occurs many times is taken once.
    """
    side = {p: int(g > 0.5) for p, g in label.items() if not SURE < g < 1 - SURE}
    if not side:
        return unpacked([])
    # At most 3 to the number of labellers rows.
    sides = voted.sparkSession.createDataFrame(list(side.items()), "pattern int, `group` int")
    limits = hash_limits(voted.join(F.broadcast(sides), "pattern"), each)
    schema = T.StructType(
        [
            T.StructField("group", T.IntegerType()),
            T.StructField("h", T.LongType()),
            T.StructField("features", T.BinaryType()),
        ]
    )
    highest = max(limits.values())

    def rows(texts: list, hashes: list) -> Iterator[tuple]:
        seen = set()
        for text, h in zip(texts, hashes, strict=True):
            if text and h not in seen:
                group = side.get(pattern_of(labellers(Shape(text))))
                if group is not None and h <= limits[group]:
                    seen.add(h)
                    yield group, h, packed(hashed_ngrams(_raw(text)))

    found = map_rows(hashed.where(F.col("h") <= highest), rows, schema)
    first = found.groupBy("group", "h").agg(F.first("features").alias("features"))
    return unpacked([tuple(r) for r in first.select("group", "features").collect()])


def _raw(text: str) -> bytes:
    return b" " + text.encode() + b" "


def score_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = 0.5,
) -> DataFrame:
    """``id_col, posterior, score, kept`` for every document, from its whole text.

    ``posterior`` is the weak label's probability of good, ``score`` the linear scorer's, and
    ``kept`` holds if their mean is above ``threshold``. A null text is an empty one; it gets its
    pattern's posterior and the score 0. Rows are kept as they come, with repeated and null ids.
    If all patterns lie on one side there is nothing to train, and the score is the posterior.
    """
    voted_schema = T.StructType(
        [T.StructField("pattern", T.IntegerType()), T.StructField("h", T.LongType())]
    )

    def vote(texts: list, hashes: list) -> Iterator[tuple]:
        for text, h in zip(texts, hashes, strict=True):
            yield pattern_of(labellers(Shape(text))), h

    hashed = docs.select(F.col(text_col), F.xxhash64(text_col).alias("h"))
    voted = staged(map_rows(hashed, vote, voted_schema), "votes")
    label = posteriors(voted)
    groups, x = _sample(hashed, voted, label, sample_rows // 2)
    target = np.array(groups, float)
    weights = train_logistic(x, target) if 0 < target.sum() < len(target) else None
    schema = T.StructType(
        [
            id_field(docs, id_col),
            T.StructField("posterior", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(ids, texts, strict=True):
            posterior = label[pattern_of(labellers(Shape(text)))]
            if weights is None:
                score = posterior
            elif not text:
                score = 0.0
            else:
                score = float(sigmoid(hashed_ngrams(_raw(text)) @ weights[:-1] + weights[-1]))
            yield key, posterior, score, (posterior + score) / 2 > threshold

    return map_rows(docs.select(id_col, text_col), rows, schema)
