"""Term lists as trees: the same matches as one alternative a term, at any length of the list."""

import random
import re
import time

from pyspark.sql import functions as F

from veildesk.functions.spans import allow_terms, match_spans
from veildesk.functions.text import REGEX_SPECIALS, terms_regex
from veildesk.schemas import SPANS


def by_hand(text, terms):
    """Leftmost matches of whole words, the longest term first."""
    quoted = [re.escape(t) for t in sorted(terms, key=len, reverse=True)]
    pattern = re.compile(r"(?i)(?<![^\W_])(?:" + "|".join(quoted) + r")(?![^\W_])")
    return [(m.start(), m.end()) for m in pattern.finditer(text)]


def test_a_tree_matches_as_its_terms_do(spark):
    rng = random.Random(5)
    for _ in range(8):
        terms = {"".join(rng.choices("abA.- (+", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 40))}
        terms = {t for t in terms if t.strip()}
        texts = ["".join(rng.choices("abAB.- (+c", k=40)) for _ in range(40)]
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        found = df.select("text", match_spans(F.col("text"), terms_regex(terms)).alias("m")).collect()
        for row in found:
            assert [(m.start, m.end) for m in row.m] == by_hand(row.text, terms), (terms, row.text)


def test_no_terms_and_characters_with_a_meaning():
    assert terms_regex([]) is None and terms_regex(iter(())) is None
    pattern = terms_regex(["a" + ch + "b" for ch in REGEX_SPECIALS])
    compiled = re.compile(pattern.removeprefix("(?iu)").replace("\\p{L}\\p{N}", "A-Za-z0-9"))
    assert all(compiled.fullmatch("a" + ch + "b") for ch in REGEX_SPECIALS)
    assert not compiled.fullmatch("acb")


def test_time_hardly_follows_the_number_of_terms(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(6_000)]
    texts = [(" ".join(rng.choices(words, k=300)),) for _ in range(1_500)]
    df = spark.createDataFrame(texts, "text string").repartition(8).cache()
    df.count()
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length("text").alias("end"), F.lit("X").alias("type")))

    def seconds(n):
        terms = [f"{a} {b}" for a, b in zip(words[:n], words[1 : n + 1])]
        left = df.select(F.size(allow_terms(F.col("text"), whole.cast(SPANS), terms)).alias("n"))
        best = []
        for _ in range(3):
            start = time.perf_counter()
            left.agg(F.sum("n")).first()
            best.append(time.perf_counter() - start)
        return min(best)

    few, many = seconds(400), seconds(4_000)
    df.unpersist()
    assert many <= 2 * max(few, 0.5), (few, many)
