"""Spelling variants of a corpus vocabulary: words one edit apart, and the form each belongs to.

Words are counted over all documents. Two words one edit apart share either their first or
their last code points: of the code points of the longer one all but the edited one agree, so
one of the two sides of the edit holds half of them. Words are therefore dealt into groups by
that prefix, and their reversals by that suffix; a group too large for one task is cut into
pieces, and every two pieces meet.

A group is a sorted list. Each word is compared with the words behind it by a banded edit
matrix, three cells a row: a row for the first ``d`` code points of a list word is kept for the
next one as far as the two agree (their LCP), and once no cell of a row is within one edit, all
words that share that prefix are skipped.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veildesk.staging import staged

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Words of a group that one task compares with each other; a larger group is cut.
PIECE = 4_096
#: Distinct words a task counts before it hands them on.
_HELD = 200_000
_BEYOND = "\U0010ffff"
#: Latin-1: letters, A-Z in lower case; anything else separates.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs(text: str | None) -> Counter:
    """Counts of the runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, as Latin-1 bytes."""
    if not text:
        return Counter()
    # What Latin-1 cannot hold becomes "?", which separates as the character itself would.
    return Counter(text.encode("latin-1", "replace").translate(_LETTERS).split(b" "))


def slipped(word: bytes, start: int, every: int) -> bytes:
    """The run, or the run less one code point where ``every`` divides the crc32 of its place."""
    code = word if word.isascii() else word.decode("latin-1").encode()
    place = zlib.crc32(code, start)
    if place % every:
        return word
    at = place % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip_every: int | None = None,
) -> DataFrame:
    """``word, n``: runs of letters of at least ``min_length``, with ``min_count`` or more places.

    With ``slip_every`` runs are damaged first: h is the crc32 of ``<id>:<run>`` (a null id is
    the empty text), and where ``slip_every`` divides h the code point h % length is left out.
    A null or empty text has no runs; repeated rows count each time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in runs(text).items():
                    if len(word) < min_length:
                        continue
                    if slip_every:
                        word = slipped(word, start, slip_every)
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) >= _HELD:
                    yield from _counted(held)
                    held = Counter()
        yield from _counted(held)

    keys = docs.select(F.col(id_col).cast("string"), text_col)
    found = keys.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(held: Counter) -> Iterator[pa.RecordBatch]:
    items = list(held.items())
    for at in range(0, len(items), 10_000):
        words, counts = zip(*items[at : at + 10_000], strict=True)
        words = pa.array([w.decode("latin-1") for w in words], pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], ["word", "n"])


# ---------------------------------------------------------------- the sorted list


def prefix_lengths(words: list[str]) -> list[int]:
    """The LCP of each word with the one before it, 0 for the first."""
    out = [0] * len(words)
    for i in range(1, len(words)):
        a, b = words[i - 1], words[i]
        n, most = 0, min(len(a), len(b))
        while n < most and a[n] == b[n]:
            n += 1
        out[i] = n
    return out


def scan(query: str, words: list[str], lcp: list[int], at: int, rows: list, depth: int):
    """Places from ``at`` on of the words exactly one edit from ``query``.

    ``rows[d]`` is the band of the edit matrix after ``d`` code points of the current list word:
    the distances to the query's first ``d - 1``, ``d`` and ``d + 1`` code points. They hold up
    to ``depth``, the part that the word at ``at`` shares with the one that they were made for.
    """
    size, padded, last = len(query), query + "\0\0\0", len(words)
    while at < last:
        word = words[at]
        before, same, after = rows[depth]
        long, d = len(word), depth
        while d < long:
            c = word[d]
            x = before if d and c == padded[d - 1] else before + 1
            if same < x:
                x = same + 1 if same + 1 < x else x
            y = same if c == padded[d] else same + 1
            if x < y:
                y = x + 1 if x + 1 < y else y
            if after < y:
                y = after + 1 if after + 1 < y else y
            z = after if c == padded[d + 1] else after + 1
            if y < z:
                z = y + 1 if y + 1 < z else z
            d += 1
            if x > 1 and y > 1 and z > 1:
                break
            before, same, after = x, y, z
            rows[d] = (x, y, z)
        else:
            gap = size - long
            if -1 <= gap <= 1 and (before, same, after)[gap + 1] == 1:
                yield at
            at += 1
            if at < last:
                depth = lcp[at]
            continue
        at += 1
        if at < last and lcp[at] >= d:
            at = bisect_left(words, word[:d] + _BEYOND, at)
        if at < last:
            depth = lcp[at]


def pairs_within(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places ``i < j`` of the words of a sorted list that are one edit apart."""
    lcp = prefix_lengths(words)
    rows: list = [None] * (max(map(len, words), default=0) + 2)
    for i, word in enumerate(words[:-1]):
        # Along the word itself the band is known; the next word starts where it branches off.
        shared = lcp[i + 1]
        rows[0] = (2, 0, 1)
        rows[1 : shared + 1] = [(1, 0, 1)] * shared
        for j in scan(word, words, lcp, i + 1, rows, shared):
            yield i, j


def pairs_between(queries: list[str], words: list[str]) -> Iterator[tuple[int, int]]:
    """Places in two sorted lists of words one edit apart."""
    lcp = prefix_lengths(words)
    rows: list = [None] * (max(map(len, words), default=0) + 2)
    rows[0] = (2, 0, 1)
    for i, word in enumerate(queries):
        for j in scan(word, words, lcp, 0, rows, 0):
            yield i, j


# ---------------------------------------------------------------------- the job


def shared_length(shorter: int) -> int:
    """Code points that two words one edit apart share at their start or at their end."""
    return shorter // 2


def near_words(words: DataFrame, piece: int = PIECE) -> DataFrame:
    """``a, n_a, b, n_b``: every two words one edit apart, each pair once, from ``word, n``.

    Words must be distinct and not null. A word is in a group as the shorter and as the longer
    of a pair, by its start and by its end; a pair whose starts agree is left to the first.
    """
    shorter = F.explode(F.sequence(F.greatest(F.length("word") - 1, F.lit(0)), F.length("word")))
    sided = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    sided = sided.select("word", "n", "back", shorter.alias("shorter")).withColumn(
        "w", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    )
    key = ["back", "shorter", "part"]
    members = staged(
        sided.select(
            "n",
            "back",
            "shorter",
            F.substring("w", F.lit(1), F.floor(F.col("shorter") / 2).cast("int")).alias("part"),
            "w",
        ),
        "word-groups",
    )
    shortest = F.min(F.length("w")).alias("least")
    sizes = members.groupBy(*key).agg(F.count("*").alias("size"), shortest)
    sizes = sizes.where("size > 1 and least = shorter")
    pieces = F.ceil(F.col("size") / F.lit(piece)).cast("int").alias("pieces")
    dealt = members.join(staged(sizes.select(*key, pieces), "group-sizes"), key)
    own = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("w"), F.col("pieces"))).otherwise(0)
    dealt = dealt.withColumn("own", own.cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    )
    cell = [*key, "i", "j"]
    cells = dealt.select(
        "n",
        "w",
        *key,
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("query"),
    )
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, members.count() // 16_384)
    columns = [*cell, "w", "n", "query"]
    sorted_lists = cells.repartition(tasks, *cell).sortWithinPartitions(*cell, "w")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for (back, shorter, _, i, j), group in groupby(_rows(batches, columns), itemgetter(*range(5))):
            group = list(group)
            one = group if i == j else [r for r in group if r[7]]
            other = group if i == j else [r for r in group if not r[7]]
            left, right = [r[5] for r in one], [r[5] for r in other]
            for x, y in pairs_within(left) if i == j else pairs_between(left, right):
                a, b = left[x], right[y]
                if _belongs(a, b, back, shorter):
                    a, b = (a[::-1], b[::-1]) if back else (a, b)
                    found.append((a, one[x][6], b, other[y][6]))
            if len(found) >= 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return sorted_lists.select(*columns).mapInArrow(
        pairs, "a string, n_a bigint, b string, n_b bigint"
    )


def _belongs(a: str, b: str, back: bool, shorter: int) -> bool:
    """Whether this group gives the pair: it is the pair's length, and the pair's first side."""
    if min(len(a), len(b)) != shorter:
        return False
    n = shared_length(shorter)
    return not back or a[len(a) - n :] != b[len(b) - n :]


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["a", "n_a", "b", "n_b"])


def forms(words: DataFrame, ratio: int = RATIO, piece: int = PIECE) -> DataFrame:
    """``word, n, form, form_n, n_near``: the near word of largest ``n``, if ``ratio`` times as
    frequent; of equal ones the smallest in code-point order."""
    pairs = staged(near_words(words, piece), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m"))
    both = both.unionAll(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best")
    )
    linked = -F.col("best.m") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.when(linked, F.col("best.near")).alias("form"),
        F.when(linked, -F.col("best.m")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """Add ``root``, the last word that the forms lead to from each word; itself without a form.

    A form is more frequent than its word, so there are no circles and chains are short; each
    round doubles the steps followed.
    """
    steps = staged(
        found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms"
    )
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.join(ahead, "root", "left")
        following = staged(
            joined.select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "forms",
        )
        steps = following.drop("moved")
        if following.where("moved").isEmpty():
            break
    return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip_every: int | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the documents' vocabulary.

    Null and empty texts have no words, repeated rows and ids count each time, other columns are
    not looked at; a table without words gives no rows.
    """
    words = staged(
        vocabulary(docs, id_col, text_col, min_length, min_count, slip_every), "vocabulary"
    )
    found = staged(forms(words, ratio), "word-forms")
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
