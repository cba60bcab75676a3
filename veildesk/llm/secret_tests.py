"""Secret scan with a battery of randomness tests, in DataFrame functions only.

Fixed patterns give assignments, access keys and hex runs. Besides these, every long run of
token characters with letters and digits is a candidate: its encoding (hex, base32, base64 or
alphanumeric) is inferred from its characters, and three tests ask whether it could be a
random string over that alphabet: chi-squared uniformity of its symbols, the number of runs
above and below the alphabet's middle, and serial correlation of neighbours. The smallest of
the three p-values, corrected for there being three, is the candidate's p-value.

Random candidates have uniform p-values, others have small ones, so among candidates of one
encoding and length band the share of random ones follows from the p-values above a half. A
candidate is accepted if its p-value is above 0.001, whatever the table's size. A band's
threshold is raised only as far as its counts show, with confidence, that the share of
non-random candidates among the accepted exceeds the false-discovery limit; few candidates
show nothing. Short strings, on which the tests have little power, thereby get thresholds of
their own. The counts cover the distinct strings of all documents; a band is one of at most 4 x 63, so the table of
thresholds has a fixed bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.functions.patterns import match_spans
from veildesk.functions.spans import merge_spans, redact
from veildesk.functions.text import let
from veildesk.staging import staged

# The base kinds in their order, and their patterns.
ASSIGN = (
    "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{14,}+"
HEX = "[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 12
#: A candidate: a run of token characters, 20 or more, with padding, a letter and a digit.
CANDIDATE = (
    "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])"
    "[A-Za-z0-9+/_-]{20,}+={0,2}+"
)
# Alphabets of the encodings, in the order in which they are tried.
ALPHABETS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (
        "alphanumeric",
        "^[A-Za-z0-9]+$",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    ),
    (
        "base64",
        "^",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
)
#: Thresholds tried for a band, from the most to the least inclusive.
THRESHOLDS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5)
FALSE_DISCOVERIES = 0.1
#: Normal quantile of the confidence, 99%, that raises a band's threshold.
CONFIDENCE = 2.326
SPAN = "struct<start:int,kind:int,end:int>"


def _spans(found: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), number.alias("kind"), s["end"].alias("end")
        ),
    )


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, each kind leftmost and non-overlapping, unsorted.

    A pattern with its least length inside finds what filtering the matches of the open pattern
    finds, as a run that is too short holds no longer one; only assignments must be filtered,
    since a match of one that is too short takes the place of another.
    """
    long_enough = F.filter(
        match_spans(text, ASSIGN),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= LEAST_VALUE,
    )
    return F.concat(
        F.when(text.rlike(ASSIGN), _spans(long_enough, "assign")).otherwise(_none()),
        F.when(F.contains(text, F.lit("AKIA")), _spans(match_spans(text, ACCESS), "access"))
        .otherwise(_none()),
        F.when(text.rlike(HEX), _spans(match_spans(text, HEX), "hex")).otherwise(_none()),
    )


def candidates(text: Column) -> Column:
    """``array<struct<start,end,encoding,n,token,p>>`` of the runs that may be random; ``token``
    is a hash of the run without its padding."""

    def entry(hit: Column) -> Column:
        token = F.regexp_replace(hit["value"], "=+$", "")
        last = len(ALPHABETS) - 1
        test = _tested(token, last, hit)
        for number in reversed(range(last)):
            test = F.when(token.rlike(ALPHABETS[number][1]), _tested(token, number, hit)).otherwise(test)
        return test

    found = match_spans(text, CANDIDATE)
    none = F.transform(F.array().cast("array<struct<start:int,end:int,value:string>>"), entry)
    return F.when(text.rlike(CANDIDATE), F.transform(found, entry)).otherwise(none)


def _tested(token: Column, number: int, hit: Column) -> Column:
    _, _, alphabet = ALPHABETS[number]
    plain = F.translate(token, "-_", "+/") if alphabet.endswith("+/") else token
    plain = F.lower(plain) if alphabet.endswith("f") else plain
    codes = F.transform(
        F.filter(F.split(plain, ""), lambda c: c != ""),
        lambda c: F.instr(F.lit(alphabet), c).cast("double"),
    )
    return F.struct(
        hit["start"].alias("start"),
        hit["end"].alias("end"),
        F.lit(number).alias("encoding"),
        F.length(token).alias("n"),
        F.xxhash64(token).alias("token"),
        let(codes, lambda x: p_value(x, len(alphabet))).alias("p"),
    )


def upper_tail(z: Column) -> Column:
    """Standard normal upper tail by the logistic fit, exact to about 0.0002."""
    return 1 / (1 + F.exp(1.5976 * z + 0.070565 * z * z * z))


def two_sided(z: Column) -> Column:
    return 2 * upper_tail(F.abs(z))


def _sum(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + of(x))


def _neighbours(x: Column, of: Callable[[Column, Column], Column]) -> Column:
    """Sum of ``of`` over adjacent pairs."""
    least = F.size(x) - 1
    pairs = F.zip_with(F.slice(x, F.lit(1), least), F.slice(x, F.lit(2), least), of)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)


def p_value(codes: Column, symbols: int) -> Column:
    """The battery's p-value for symbol codes 1 to ``symbols``, two of them at least."""
    n = F.size(codes).cast("double")
    k, middle, mean = float(symbols), (symbols + 1) / 2, (symbols + 1) / 2

    def chi_squared(counts: Column) -> Column:
        statistic = _sum(counts, lambda c: c * c) * k / n - n
        return upper_tail((statistic - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))

    def runs(high: Column) -> Column:
        low = n - high
        changes = _neighbours(codes, lambda a, b: ((a > middle) != (b > middle)).cast("double"))
        expected = 2 * high * low / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        return F.when(variance > 0, two_sided((changes + 1 - expected) / F.sqrt(variance))).otherwise(0.0)

    def correlation(variation: Column) -> Column:
        products = _neighbours(codes, lambda a, b: (a - mean) * (b - mean))
        return F.when(
            variation > 0, two_sided((products / variation) * F.sqrt(n))
        ).otherwise(0.0)

    counts = F.transform(
        F.array_distinct(codes),
        lambda s: F.size(F.filter(codes, lambda c: c == s)).cast("double"),
    )
    smallest = F.least(
        chi_squared(counts),
        let(_sum(codes, lambda c: (c > middle).cast("double")), runs),
        let(_sum(codes, lambda c: (c - mean) * (c - mean)), correlation),
    )
    return 1 - F.pow(1 - F.least(smallest, F.lit(1.0)), F.lit(3))


def band(length: Column) -> Column:
    """Length band: the whole part of twice the binary logarithm, 62 at the most."""
    return F.floor(2 * F.log2(length.cast("double"))).cast("int")


def thresholds(found: DataFrame, limit: float = FALSE_DISCOVERIES) -> dict[tuple[int, int], float]:
    """``{(encoding, band): threshold}`` from rows with an array ``candidates``.

    Each distinct token counts once, so copies do not outweigh the others of their band.
    """
    each = found.select(F.inline("candidates"))
    tokens = each.groupBy("encoding", band(F.col("n")).alias("band"), "token").agg(
        F.first("p").alias("p")  # a token's p-value is the same everywhere
    )
    counts = (
        tokens.groupBy("encoding", "band")
        .agg(
            F.count("*").alias("n"),
            *[
                F.sum((F.col("p") > t).cast("bigint")).alias(f"above_{i}")
                for i, t in enumerate(THRESHOLDS)
            ],
        )
        .collect()  # a row for each encoding and band, 4 x 63 at most
    )
    return {(r["encoding"], r["band"]): lowest_threshold(r, limit) for r in counts}


def lowest_threshold(row, limit: float) -> float:
    """The lowest threshold at which the counts do not show too many false discoveries.

    The first one holds for every band, however few candidates it has. A higher one is taken
    only if, with confidence, more than ``limit`` of what the lower one accepts is not random:
    of random strings above ``t`` a share of 0.5 / (1 - t) lies above a half.
    """
    half = THRESHOLDS[-1]
    high = row[f"above_{len(THRESHOLDS) - 1}"]
    for i, t in enumerate(THRESHOLDS[:-1]):
        random = upper_bound(high, row[f"above_{i}"]) * (1 - t) / (1 - half)
        if 1 - random <= limit:
            return t
    return half


def upper_bound(hits: int, n: int) -> float:
    """One-sided upper bound (Wilson's) on a share of which ``hits`` of ``n`` were seen."""
    if not n:
        return 1.0
    z, share = CONFIDENCE, hits / n
    middle = share + z * z / (2 * n)
    return (middle + z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _text_spans(docs: DataFrame, text_col: str, columns: list[Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # One bound value, so that the filters on its fields don't compute it again.
    both = let(
        text, lambda t: F.struct(base_spans(t).alias("base"), candidates(t).alias("candidates"))
    )
    return docs.select(*columns, both.alias("found")).select("*", "found.*").drop("found")


def _all_spans(limits: dict[tuple[int, int], float]) -> Column:
    """Base spans and the accepted candidates, sorted by start and kind."""
    entries = [F.lit(x) for (e, b), t in sorted(limits.items()) for x in (e * 100 + b, t)]
    accepted = _none()
    if entries:
        limit = F.create_map(*entries)
        accepted = _spans(
            F.filter(
                F.col("candidates"),
                lambda c: c["p"] > limit[c["encoding"] * 100 + band(c["n"])],
            ),
            "random",
        )
    return F.sort_array(F.concat(F.col("base"), accepted))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ","
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: float = FALSE_DISCOVERIES,
) -> DataFrame:
    """One row per document: counts of base kinds, their digest, and all spans.

    Spans are ``kind:start:end`` in code points, by start and then kind, comma-joined; a span
    that a base pattern and the battery both find is listed under both kinds. A null text is an
    empty one, without spans. Rows are kept as they come, with repeated and null ids.
    """
    found = staged(_text_spans(docs, text_col, [F.col(id_col).alias("id")]), "secret-spans")
    spans = _all_spans(thresholds(found, limit))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")

    return found.select(
        F.col("id").alias(id_col),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_listed(F.sort_array("base")), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def without_secrets(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    limit: float = FALSE_DISCOVERIES,
) -> DataFrame:
    """The documents with every secret replaced by ``[SECRET]``, overlapping ones by one mark.

    All columns and rows stay; ``length_col``, if the table has it, follows the new text where
    the text changed. A null text stays null.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = staged(_text_spans(docs, text_col, [row]), "secrets")
    text = F.col("row")[text_col]
    # Types that differ keep spans apart that only stand close to each other.
    spans = F.transform(
        _all_spans(thresholds(found, limit)),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["start"].cast("string").alias("type")
        ),
    )
    clean = let(
        spans,
        lambda x: F.when(
            F.size(x) > 0,
            let(merge_spans(text, x), lambda m: redact(text, m, lambda s: F.lit("[SECRET]"))),
        ).otherwise(text),
    )
    bound = found.select("row", clean.alias("clean"))
    changed = F.col("row").withField(f"`{text_col}`", F.col("clean"))
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        same = F.col("clean").eqNullSafe(text)
        length = F.when(same, F.col("row")[length_col]).otherwise(F.length("clean").cast(kind))
        changed = changed.withField(f"`{length_col}`", length)
    return bound.select(changed.alias("row")).select("row.*")
