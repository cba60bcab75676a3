"""Literal edge cases and properties of detection and span algebra."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veildesk.checks import redaction as redaction_checks
from veildesk.functions import patterns as P
from veildesk.functions import spans as S
from veildesk.functions.text import comma_list, needs_scan, probability, strip_space
from veildesk.schemas import SPANS


def column(spark, values, name="t"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def found(spark, text, kind=None):
    col = F.col("t")
    spans = P.DETECTORS[kind](col) if kind else P.detect_patterns(col)
    row = column(spark, [text]).select(spans.alias("s")).first()
    return [(s.start, s.end, text[s.start : s.end]) for s in row.s]


@pytest.mark.parametrize(
    "kind, text, values",
    [
        (P.EMAIL, "a@b.co,", ["a@b.co"]),
        (P.EMAIL, "a.b%x@d.e@f.g", ["a.b%x@d.e"]),
        (P.EMAIL, "a@b.c%x@d.e", ["a@b.c", "%x@d.e"]),
        (P.EMAIL, "é@ü.de", ["é@ü.de"]),
        (P.EMAIL, "a@b", []),
        (P.IBAN, "DE89370400440532013000", ["DE89370400440532013000"]),
        (P.IBAN, "DE89 3704 0044 0532 0130 00", ["DE89 3704 0044 0532 0130 00"]),
        (P.IBAN, "DE88370400440532013000", []),
        (P.IBAN, "AB12CDEF3456", []),
        (P.IBAN, "éDE89370400440532013000", ["DE89370400440532013000"]),
        (P.IPV4, "10.2.3.4", ["10.2.3.4"]),
        (P.IPV4, "version 10.2.3.4", []),
        (P.IPV4, "v1.2.3.4", []),
        (P.IPV4, "1.2.3.4.5", []),
        (P.IPV4, "256.1.1.1", []),
        (P.IPV4, "9.9.9.9.", ["9.9.9.9"]),
        (P.IPV4, "rev 01.02.03.004", []),
        (P.IPV4, "ip 01.02.03.04", ["01.02.03.04"]),
        (P.CARD, "4785380592391139", ["4785380592391139"]),
        (P.CARD, "4465758382889437 446", []),
        (P.CARD, "4785-3805-9239-1139", ["4785-3805-9239-1139"]),
        (P.CARD, "47853805923911394785", []),
        (P.PHONE, "+33 6 12 34 56 78", ["+33 6 12 34 56 78"]),
        (P.PHONE, "+1 (743) 555-3824", ["+1 (743) 555-3824"]),
        (P.PHONE, "a+33612345678", []),
        (P.PHONE, "+1234567", []),
        (P.PHONE, "+1" + "2" * 5000 + "x", []),
    ],
)
def test_formats(spark, kind, text, values):
    assert [v for _, _, v in found(spark, text, kind)] == values


def test_offsets_survive_marker_characters(spark):
    text = "\ufdd0a@b.co\ufdd1 x@y.fr \U0001d400 q@r.de"
    assert [v for _, _, v in found(spark, text)] == ["a@b.co", "x@y.fr", "q@r.de"]


def test_many_matches_keep_their_offsets(spark):
    text = " ".join(f"user{i}@mail{i % 7}.org" for i in range(1000))
    spans = found(spark, text)
    assert [v for _, _, v in spans] == text.split(" ")
    assert all(text[a:b] == v for a, b, v in spans)


def test_long_unbroken_text_is_fast(spark):
    assert found(spark, "x" * 60_000 + "@") == []


def test_needs_scan(spark):
    texts = ["", "--", "2024-05-01T12:34:56Z", "2024-05-01", "é", "2024-05-01T12:34:56Z\n"]
    rows = column(spark, texts).select("i", needs_scan(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [False, False, False, True, True, True]


def test_strip_space_is_unicode_aware(spark):
    row = column(spark, [" \t a b 　\n"]).select(strip_space(F.col("t")).alias("s")).first()
    assert row.s == "a b"


def run(spark, text, spans, fn):
    df = spark.createDataFrame([(text, spans)], f"t string, s {SPANS}")
    row = df.select(fn(F.col("t"), F.col("s")).alias("out")).first()
    return [(s.start, s.end, s.type) for s in row.out]


@pytest.mark.parametrize(
    "text, start, end, value",
    [
        ("(jean-luc)", 1, 5, "jean-luc"),
        ('"Marie",', 2, 4, "Marie"),
        ("mail a.b@c.de.", 7, 9, "a.b@c.de"),
        ("xabcx", 2, 3, "xabcx"),
        ("x (… 78), y", 2, 9, "… 78"),
        ("a.-b", 0, 1, "a"),
        ("it's O'Neil", 7, 8, "O'Neil"),
        ("a , b", 2, 3, None),
    ],
)
def test_widen(spark, text, start, end, value):
    out = run(spark, text, [(start, end, "X")], S.widen_spans)
    assert [text[a:b] for a, b, _ in out] == ([value] if value else [])


@pytest.mark.parametrize(
    "text, spans, terms, left",
    [
        ("Acme Suite", [(0, 10)], ["acme"], ["Suite"]),
        ("the Acme Suite", [(4, 14)], ["the acme"], ["Suite"]),
        ("Acme Suite Pro", [(0, 10)], ["suite pro"], ["Acme"]),
        ("Acme Big Suite", [(0, 14)], ["big"], ["Acme", "Suite"]),
        ("Acme", [(0, 4)], ["ACME"], []),
        ("Acmes", [(0, 5)], ["acme"], ["Acmes"]),
        ("Acme - ", [(0, 6)], ["acme"], []),
        ("a.b+c x", [(0, 7)], ["a.b+c"], ["x"]),
        ("one two three", [(0, 13)], ["two", "one two"], ["three"]),
    ],
)
def test_allow_terms(spark, text, spans, terms, left):
    given = [(a, b, "X") for a, b in spans]
    out = run(spark, text, given, lambda t, s: S.allow_terms(t, s, terms))
    assert [text[a:b] for a, b, _ in out] == left


@pytest.mark.parametrize(
    "text, spans, merged",
    [
        ("abcdef", [(0, 3, "A"), (3, 6, "B")], [(0, 6, "A")]),
        ("ab - cd", [(0, 2, "A"), (5, 7, "A")], [(0, 7, "A")]),
        ("ab - cd", [(0, 2, "A"), (5, 7, "B")], [(0, 2, "A"), (5, 7, "B")]),
        ("ab -  cd", [(0, 2, "A"), (6, 8, "A")], [(0, 2, "A"), (6, 8, "A")]),
        ("abcdefghi", [(0, 4, "A"), (3, 6, "B"), (5, 9, "A")], [(0, 9, "A")]),
        ("abcdef", [(0, 2, "B"), (0, 6, "A")], [(0, 6, "A")]),
        ("abcdef", [(0, 6, "B"), (0, 6, "A")], [(0, 6, "B")]),
        ("ab x cd", [(5, 7, "A"), (0, 2, "A")], [(0, 2, "A"), (5, 7, "A")]),
    ],
)
def test_merge(spark, text, spans, merged):
    assert run(spark, text, spans, S.merge_spans) == merged


def merge_by_hand(text, spans):
    out = []
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if out and (
            start <= out[-1][1]
            or (kind == out[-1][2] and re.fullmatch(r"[\s.\-@_+/()]{0,3}", text[out[-1][1] : start]))
        ):
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2])
        else:
            out.append((start, end, kind))
    return out


def test_merge_of_many_random_spans(spark):
    rng = random.Random(7)
    rows = []
    for i in range(40):
        text = "".join(rng.choice("ab .-") for _ in range(600))
        spans = []
        for _ in range(rng.choice([1, 5, 63, 64, 65, 200])):
            a = rng.randrange(599)
            spans.append((a, min(600, a + rng.randrange(1, 4)), rng.choice("XY")))
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, f"i int, t string, s {SPANS}")
    out = df.select("i", S.merge_spans(F.col("t"), F.col("s")).alias("m")).collect()
    got = {r.i: [(s.start, s.end, s.type) for s in r.m] for r in out}
    for i, text, spans in rows:
        assert got[i] == merge_by_hand(text, spans)
        assert all(a[1] < b[0] for a, b in zip(got[i], got[i][1:]))


def test_redact(spark):
    df = spark.createDataFrame(
        [("call Ann now", [(5, 8, "PERSON_NAME")]), ("none", []), ("Ann", [(0, 3, "P")])],
        f"t string, s {SPANS}",
    )
    out = df.select(S.redact(F.col("t"), F.col("s"), S.plain_placeholder).alias("r")).collect()
    assert [r.r for r in out] == ["call [PERSON_NAME] now", "none", "[P]"]


def test_known_values_are_distinctive_and_of_specific_types(spark):
    text = "Al Ann 12345 123456 amount9"
    spans = [
        (0, 2, "PERSON_NAME"), (3, 6, "PERSON_NAME"), (7, 12, "ID"), (13, 19, "ID"),
        (20, 27, "FINANCIAL_AMOUNT"),
    ]
    df = spark.createDataFrame([(text, spans)], f"t string, s {SPANS}")
    row = df.select(S.known_values(F.col("t"), F.col("s")).alias("k")).first()
    assert [k.value for k in row.k] == ["Ann", "123456"]


def test_match_known_is_whole_word_case_sensitive_longest_first(spark):
    df = spark.createDataFrame(
        [("Ann Anna ann Ann Lee", [("Ann", "A"), ("Ann Lee", "B"), ("Ann", "C")])],
        "t string, k array<struct<value:string,type:string>>",
    )
    row = df.select(S.match_known(F.col("t"), S.first_types(F.col("k"))).alias("s")).first()
    assert [(s.start, s.end, s.type) for s in row.s] == [(0, 3, "A"), (13, 20, "B")]


def test_settings():
    assert comma_list(" a, b ,,c") == ["a", "b", "c"]
    assert [probability(x) for x in (None, 0, 0.3, 1, 2)] == [0.5, 0.5, 0.3, 1, 0.5]


@pytest.mark.parametrize("n", [120, 124, 125, 126, 127, 128, 129, 130, 500])
def test_widen_over_long_words(spark, n):
    for word in ("x" * n, "a." * (n // 2) + "b", "@" * 3 + "x" * n):
        text = f"so {word} said"
        at = text.index("x") if "x" in word else 3
        for start, end in ((at, at + 1), (3 + len(word) - 1, 3 + len(word)), (at + 5, at + 7)):
            out = run(spark, text, [(start, end, "X")], S.widen_spans)
            assert [text[s[0] : s[1]] for s in out] == [word.lstrip("@")]


def test_the_checked_merge_counts_a_text_once_and_not_for_each_span(spark, sf_dir):
    plan = redaction_checks.merge_spans(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "length(text" in plan
    assert not re.search(r"<= (char_)?length\(text", plan)
