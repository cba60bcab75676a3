"""Format detectors as JVM-side expressions: text column in, array of spans out.

Spark has no function giving the offsets of all matches. ``pattern_spans`` marks every
match with two noncharacters, splits there, and sums the piece lengths. Offsets are in
code points. Each format has a cheap necessary condition that is tested first, so a text
without "@", "+" or enough digits never runs the expensive expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veildesk.functions.text import SPACE, WORD, digit_count, let
from veildesk.schemas import SPANS

HIT = "struct<start:int,end:int,value:string>"
BLOCK = 64
MATCH_OPEN, MATCH_CLOSE = "\uFDD0", "\uFDD1"

# Entity labels of the five formats and the patterns that define them.
# The e-mail and phone patterns use possessive groups and may start only where a match
# can begin, so unbroken runs of any length take linear time.
EMAIL, IBAN, IPV4, CARD, PHONE = (
    "EMAIL_ADDRESS",
    "BANK_ACCOUNT_IDENTIFIER",
    "IP_ADDRESS",
    "PAYMENT_CARD",
    "PHONE_NUMBER",
)
_LOCAL = f"[{WORD}._%+-]"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
EMAIL_PATTERN = f"(?:(?<!{_LOCAL})|\\G){_LOCAL}++@[{WORD}-]++(?:\\.[{WORD}-]++)++"
IBAN_PATTERN = (
    "(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9_])"
)
# The digit that a match begins with is asked for before what must not stand in front of it.
IPV4_PATTERN = (
    f"(?=[0-9])(?<!(?<![A-Za-z0-9_])(?:[vV]|[vV]er\\.?|[vV]ersion)[{SPACE}]?)(?<![0-9.])"
    f"(?:{_OCTET}\\.){{3}}{_OCTET}(?!\\.*+[0-9])"
)
CARD_PATTERN = "(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9-])"
_GROUP = "(?:[ .\\-/]?\\(?[0-9]++\\)?)"
PHONE_PATTERN = (
    "(?<![A-Za-z0-9_+])\\+"
    f"(?:[0-9]{{1,3}}+(?![0-9)]){_GROUP}{{1,6}}|[0-9]{{2,}}+\\)?{_GROUP}{{0,5}})(?![A-Za-z0-9_])"
)


def no_spans() -> Column:
    return F.array().cast(SPANS)


def match_pieces(text: Column, pattern: Column | str) -> Column:
    """The text cut at its matches: gap, match, gap, ..., match, gap."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    clean = F.translate(text, MATCH_OPEN + MATCH_CLOSE, "\uFFFD\uFFFD")
    marked = F.regexp_replace(clean, pattern, F.lit(f"{MATCH_OPEN}$0{MATCH_CLOSE}"))
    return F.split(marked, f"[{MATCH_OPEN}{MATCH_CLOSE}]")


def blocks_of(values: Column) -> Column:
    """An array cut into arrays of ``BLOCK``.

    ``F.aggregate`` copies its state at every step, so a state that grows with the array
    makes it quadratic. Folding block by block keeps the copied state short.
    """
    count = F.ceil(F.size(values) / F.lit(BLOCK)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)),
    )


def running_totals(values: Column) -> Column:
    """Sums of an integer array up to and including each element, block by block."""

    def grow(acc: Column, n: Column) -> Column:
        return F.concat(acc, F.array(F.element_at(acc, -1) + n))

    def in_blocks(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, n: acc + n))
        # The sums before each block, and one more behind the last.
        before = F.aggregate(sums, F.array(F.lit(0)), grow)

        def totals(block: Column, start: Column) -> Column:
            run = F.aggregate(block, F.array(start), grow)
            return F.slice(run, F.lit(2), F.size(block))

        return let(
            before,
            lambda at: F.flatten(F.transform(blocks, lambda b, i: totals(b, F.get(at, i)))),
        )

    def sums(values: Column) -> Column:
        # Most arrays are one block or less.
        few = F.slice(F.aggregate(values, F.array(F.lit(0)), grow), F.lit(2), F.size(values))
        return (
            F.when(F.size(values) > BLOCK, let(blocks_of(values), in_blocks))
            .when(F.size(values) > 0, few)
            .otherwise(F.array().cast("array<int>"))
        )

    return let(values, sums)


def piece_spans(pieces: Column) -> Column:
    """The matches among ``match_pieces`` as ``struct<start,end,value>``."""

    def placed(ends: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ends) - 2, F.lit(2)),
            lambda i: F.struct(
                F.get(ends, i - 1).alias("start"),
                F.get(ends, i).alias("end"),
                F.get(pieces, i).alias("value"),
            ),
        )

    ends = running_totals(F.transform(pieces, lambda p: F.length(p)))
    return F.when(F.size(pieces) > 1, let(ends, placed)).otherwise(
        F.array().cast(f"array<{HIT}>")
    )


def match_spans(text: Column, pattern: Column | str) -> Column:
    """Every match as ``struct<start,end,value>``, in text order."""
    return let(
        match_pieces(text, pattern),
        lambda p: F.when(F.size(p) > 1, piece_spans(p)).otherwise(
            F.array().cast(f"array<{HIT}>")
        ),
    )


def iban_ok(value: Column) -> Column:
    """Mod-97 check over the rearranged account number, 15 to 34 characters long."""
    compact = F.replace(value, F.lit(" "), F.lit(""))

    def remainder(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise(
            (acc * 10 + code - 48) % 97
        )

    return let(
        compact,
        lambda c: F.length(c).between(15, 34)
        & (
            F.aggregate(
                F.split(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4)), ""),
                F.lit(0),
                lambda acc, ch: F.when(F.length(ch) == 0, acc).otherwise(remainder(acc, ch)),
            )
            == 1
        ),
    )


def luhn_ok(value: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(value, "[^0-9]", ""))


# A cheap condition that every text with a match fulfils, then the pattern.
_FORMATS = {
    EMAIL: (lambda t: F.contains(t, F.lit("@")), EMAIL_PATTERN),
    IBAN: (lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), IBAN_PATTERN),
    IPV4: (lambda t: t.rlike("[0-9]\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]"), IPV4_PATTERN),
    CARD: (lambda t: t.rlike("[0-9](?:[ -]?[0-9]){12}"), CARD_PATTERN),
    PHONE: (lambda t: F.contains(t, F.lit("+")) & t.rlike("\\+[0-9]"), PHONE_PATTERN),
}
_VALID = {IBAN: iban_ok, CARD: luhn_ok, PHONE: lambda v: digit_count(v) >= 8}


def detect_patterns(text: Column, kinds: Sequence[str] = tuple(_FORMATS)) -> Column:
    """Spans of the given formats, format by format, each in text order."""
    cuts = [
        F.struct(
            F.lit(kind).alias("type"),
            F.when(_FORMATS[kind][0](text), match_pieces(text, _FORMATS[kind][1])).alias("pieces"),
        )
        for kind in kinds
    ]

    def valid(kind: Column, value: Column) -> Column:
        ok = F.lit(True)
        for name in kinds:
            if name in _VALID:
                ok = F.when(kind == name, _VALID[name](value)).otherwise(ok)
        return ok

    def spans(c: Column) -> Column:
        hits = F.filter(piece_spans(c["pieces"]), lambda h: valid(c["type"], h["value"]))
        return F.transform(hits, lambda h: F.struct(h["start"], h["end"], c["type"].alias("type")))

    matched = F.filter(F.array(*cuts), lambda c: F.size(c["pieces"]) > 1)
    return F.flatten(F.transform(matched, spans))


def detect_email(text: Column) -> Column:
    return detect_patterns(text, [EMAIL])


def detect_iban(text: Column) -> Column:
    return detect_patterns(text, [IBAN])


def detect_ipv4(text: Column) -> Column:
    return detect_patterns(text, [IPV4])


def detect_card(text: Column) -> Column:
    return detect_patterns(text, [CARD])


def detect_phone(text: Column) -> Column:
    return detect_patterns(text, [PHONE])


DETECTORS = {
    EMAIL: detect_email,
    IBAN: detect_iban,
    IPV4: detect_ipv4,
    CARD: detect_card,
    PHONE: detect_phone,
}
