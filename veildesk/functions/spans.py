"""Span algebra as expressions over ``array<struct<start,end,type>>``.

Offsets are half-open and in code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veildesk.functions.patterns import blocks_of, match_spans, no_spans
from veildesk.functions.text import (
    CONNECTOR,
    LEADING_PUNCT,
    MERGEABLE_GAP,
    SPACE,
    TRAILING_PUNCT,
    WORD,
    digit_count,
    escape_regex,
    has_word,
    let,
    strip_space,
    terms_regex,
    whole_word,
)
from veildesk.schemas import SPAN, SPANS

# Types too generic to redact wherever the same words appear.
NOT_PROPAGATED = ("PERSON_ATTRIBUTE", "PERSON_ROLE_OR_TITLE", "FINANCIAL_AMOUNT")

# The rest of a word after one character of context. Read on reversed text it is the
# part of the word before a position, because the rule is the same in both directions.
_WORD_REST = f"(?s)\\A.([{WORD}]*+(?:(?<=[{WORD}])[{CONNECTOR}][{WORD}]++)*+)"
# Characters beside a span that are read to find the rest of its word; nearly every word ends
# within them, and for one that may not, all of the text is read.
_NEAR = 128
_PAGE = 512


def span(start: Column, end: Column, kind: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"), end.cast("int").alias("end"), kind.alias("type")
    )


def cut(text: Column, start: Column, end: Column) -> Column:
    """``text[start:end]``; empty when the bounds are reversed."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def pages_of(text: Column) -> Column:
    """The text in pages of ``_PAGE`` characters. Finding a character counts all those before
    it, so many cuts from a long text are made from the few pages that they touch."""
    pages = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))
    return F.when(F.length(text) <= _PAGE, F.array(text)).otherwise(pages)


def cut_pages(pages: Column, start: Column, end: Column) -> Column:
    """``text[start:end]`` from ``pages_of(text)``; empty when the bounds are reversed."""
    first, last = F.floor(start / _PAGE).cast("int"), F.floor((end - 1) / _PAGE).cast("int")
    near = F.slice(pages, first + 1, F.greatest(last - first + 1, F.lit(0)))
    size = F.greatest(end - start, F.lit(0))
    return F.when(F.size(pages) == 1, F.substring(F.get(pages, F.lit(0)), start + 1, size)).otherwise(
        F.substring(F.array_join(near, ""), start - first * _PAGE + 1, size)
    )


def keep_entities(spans: Column, kept: Iterable[str]) -> Column:
    """Drop spans whose type is deliberately left readable."""
    kept = [name.upper() for name in kept]
    return F.filter(spans, lambda s: ~s["type"].isin(kept)) if kept else spans


def widen_spans(text: Column, spans: Column) -> Column:
    """Spans moved outward to word ends, then inward past punctuation; empty ones go.

    Each span reads a few characters on either side, so the work follows the spans and not
    the length of the text around them.
    """

    def rest(near: Column, whole: Column) -> Column:
        return let(
            F.length(F.regexp_extract(near, _WORD_REST, 1)),
            lambda found: F.when(found < _NEAR - 2, found).otherwise(
                F.length(F.regexp_extract(whole, _WORD_REST, 1))
            ),
        )

    def widened(pages: Column) -> Column:
        def grow(s: Column) -> Column:
            before = cut_pages(pages, F.greatest(s["start"] + 1 - _NEAR, F.lit(0)), s["start"] + 1)
            at = F.greatest(s["end"] - 1, F.lit(0))
            after = cut_pages(pages, at, at + _NEAR)
            return span(
                s["start"]
                - rest(F.reverse(before), F.reverse(F.substring(text, F.lit(1), s["start"] + 1))),
                s["end"] + rest(after, F.substring(text, s["end"], F.length(text))),
                s["type"],
            )

        def shed(s: Column) -> Column:
            value = cut_pages(pages, s["start"], s["end"])

            def core(no_lead: Column) -> Column:
                left = F.length(
                    F.regexp_replace(no_lead, f"(?<![{TRAILING_PUNCT}])[{TRAILING_PUNCT}]++\\z", "")
                )
                return let(
                    s["end"] - F.length(no_lead), lambda at: span(at, at + left, s["type"])
                )

            return let(F.regexp_replace(value, f"\\A[{LEADING_PUNCT}]++", ""), core)

        return F.filter(
            F.transform(F.transform(spans, grow), shed), lambda s: s["end"] > s["start"]
        )

    return let(pages_of(text), widened)


def allow_terms(text: Column, spans: Column, terms: Iterable[str]) -> Column:
    """Cut allowlisted terms out of the spans; what is left must hold a letter or digit."""
    pattern = terms_regex(terms)
    if pattern is None:
        return spans

    def without(pieces: Column, term: Column) -> Column:
        return F.flatten(
            F.transform(
                pieces,
                lambda p: F.when(
                    (term["end"] <= p["start"]) | (term["start"] >= p["end"]), F.array(p)
                ).otherwise(
                    F.array(
                        span(p["start"], term["start"], p["type"]),
                        span(term["end"], p["end"], p["type"]),
                    )
                ),
            )
        )

    def trimmed(p: Column) -> Column:
        value = cut(text, p["start"], p["end"])
        at = p["end"] - F.length(F.regexp_replace(value, f"\\A[{SPACE}]++", ""))
        return span(at, at + F.length(strip_space(value)), p["type"])

    def carve(found: Column, ranges: Column) -> Column:
        pieces = F.flatten(
            F.transform(found, lambda s: F.aggregate(ranges, F.array(s).cast(SPANS), without))
        )
        whole = F.filter(pieces, lambda p: p["end"] > p["start"])
        return F.filter(
            F.transform(whole, trimmed), lambda p: has_word(cut(text, p["start"], p["end"]))
        )

    def apply(found: Column) -> Column:
        return F.when(
            F.size(found) > 0,
            let(
                match_spans(text, pattern),
                lambda ranges: F.when(F.size(ranges) > 0, carve(found, ranges)).otherwise(found),
            ),
        ).otherwise(found)

    return let(spans, apply)


def merge_spans(text: Column, spans: Column) -> Column:
    """Sorted, disjoint spans; overlapping, touching or same-type close ones become one.

    The type of a merged span is that of its first part, and the closeness test uses the
    type of the span merged so far, which is why this is a fold and not a window query.
    """
    def ordered(found: Column) -> Column:
        return F.array_sort(
            F.transform(
                found,
                lambda s, i: F.struct(
                    s["start"].alias("start"),
                    (-s["end"]).alias("back"),
                    i.alias("seq"),
                    s["type"].alias("type"),
                ),
            )
        )

    def add(acc: Column, s: Column) -> Column:
        open_, end = acc["open"], -s["back"]
        gap = s["start"] - open_["end"]
        joins = open_.isNotNull() & (
            (gap <= 0)
            | (
                (gap <= 3)
                & (s["type"] == open_["type"])
                & cut(text, open_["end"], s["start"]).rlike(MERGEABLE_GAP)
            )
        )
        return let(
            joins,
            lambda j: F.struct(
                F.when(j, span(open_["start"], F.greatest(open_["end"], end), open_["type"]))
                .otherwise(span(s["start"], end, s["type"]))
                .alias("open"),
                F.when(j | open_.isNull(), acc["closed"])
                .otherwise(F.concat(acc["closed"], F.array(open_)))
                .alias("closed"),
            ),
        )

    def state(open_: Column) -> Column:
        return F.struct(open_.alias("open"), no_spans().alias("closed"))

    def add_block(acc: Column, block: Column) -> Column:
        return let(
            F.aggregate(block, state(acc["open"]), add),
            lambda done: F.struct(
                done["open"].alias("open"),
                F.concat(acc["closed"], F.array(done["closed"])).alias("closed"),
            ),
        )

    def merged(found: Column) -> Column:
        nothing = F.lit(None).cast(SPAN)
        start = F.struct(
            nothing.alias("open"), F.array().cast(f"array<{SPANS}>").alias("closed")
        )
        return F.aggregate(
            let(ordered(found), blocks_of),
            start,
            add_block,
            lambda acc: F.concat(F.flatten(acc["closed"]), F.array(acc["open"])),
        )

    return let(
        spans, lambda found: F.when(F.size(found) > 1, merged(found)).otherwise(found)
    )


def redact(text: Column, merged: Column, placeholder: Callable[[Column], Column]) -> Column:
    """``text`` with every merged span replaced by ``placeholder(span)``.

    ``merged`` is used several times: a column or a bound value, not an expression.
    """

    def rebuild(spans: Column, pages: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            previous = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0))
            return F.concat(cut_pages(pages, previous, s["start"]), placeholder(s))

        tail = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

    return F.when(
        F.size(merged) > 0, let(pages_of(text), lambda pages: rebuild(merged, pages))
    ).otherwise(text)


def plain_placeholder(s: Column) -> Column:
    return F.concat(F.lit("["), s["type"], F.lit("]"))


def distinctive(value: Column) -> Column:
    """Long enough to be searched for elsewhere: 3 characters with a letter, or 6 digits."""
    return (value.rlike("\\p{L}") & (F.length(value) >= 3)) | (digit_count(value) >= 6)


def known_values(text: Column, spans: Column) -> Column:
    """``struct<value,type>`` of each span that may be searched for elsewhere."""
    values = F.transform(
        F.filter(spans, lambda s: ~s["type"].isin(*NOT_PROPAGATED)),
        lambda s: F.struct(
            strip_space(cut(text, s["start"], s["end"])).alias("value"), s["type"].alias("type")
        ),
    )
    return F.filter(values, lambda v: distinctive(v["value"]))


def first_types(known: Column) -> Column:
    """One entry per value, the first type winning, longest value first."""
    placed = F.array_sort(
        F.transform(
            known, lambda k, i: F.struct(k["value"].alias("value"), i.alias("seq"), k["type"].alias("type"))
        )
    )

    # Sorted by value and place, the first of each value is the one whose neighbour differs.
    def once(entries: Column) -> Column:
        nothing = F.lit(None).cast("struct<value:string,seq:int,type:string>")
        before = F.concat(F.array(nothing), entries)
        marked = F.zip_with(
            entries,
            F.slice(before, F.lit(1), F.size(entries)),
            lambda k, b: F.when(b.isNull() | (k["value"] != b["value"]), k),
        )
        return F.filter(marked, lambda k: k.isNotNull())

    ranked = F.array_sort(
        F.transform(
            let(placed, once),
            lambda k: F.struct(
                (-F.length(k["value"])).alias("size"),
                k["seq"].alias("seq"),
                k["value"].alias("value"),
                k["type"].alias("type"),
            ),
        )
    )
    return F.transform(ranked, lambda k: F.struct(k["value"], k["type"]))


def only_there(text: Column, value: Column, own: Column) -> Column:
    """Whether ``value`` stands in the text once, as one of its ``own`` known values."""
    first = F.position(value, text)
    return (
        F.exists(own, lambda o: o["value"] == value)
        & (F.position(value, text, first + 1) == 0)
        # Marker characters of the text are searched as this one.
        & ~F.contains(value, F.lit("\uFFFD"))
    )


def match_known(text: Column, known: Column, own: Column | None = None) -> Column:
    """Whole-word, case-sensitive occurrences of known values (``first_types`` output).

    A plain substring test comes first, so the regular expression has as alternatives only
    the few values that this text contains, and most texts need no regular expression. With
    ``own``, the ``known_values`` of the text's spans, a text in which every value stands only
    inside the span that it was taken from is not searched: merging adds nothing there.
    """
    def search(entries: Column) -> Column:
        words = F.transform(entries, lambda k: escape_regex(k["value"]))
        types = F.map_from_entries(entries)
        return F.when(
            F.size(entries) > 0,
            F.transform(
                match_spans(text, whole_word(F.array_join(words, "|"))),
                lambda h: span(h["start"], h["end"], types[h["value"]]),
            ),
        ).otherwise(no_spans())

    present = F.filter(known, lambda k: F.contains(text, k["value"]))
    if own is None:
        return let(present, search)
    return let(
        present,
        lambda entries: F.when(
            F.exists(entries, lambda k: ~only_there(text, k["value"], own)), search(entries)
        ).otherwise(no_spans()),
    )
