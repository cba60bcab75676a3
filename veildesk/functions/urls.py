"""Addresses inside the helpdesk's own site, taken apart so that each part is a text.

Path segments, query values and the fragment are decoded and redacted as texts of their own;
a part that did not change keeps its spelling, so an address without personal data is the
same string as before. Whether fragments count, and whether a key that repeats is kept each
time, is up to the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veildesk.functions.text import SPACE, let

_DOT = "."


def is_own_url(s: Column, site: Column) -> Column:
    return F.startswith(s, F.concat(site, F.lit("/"))) & ~s.rlike(f"[{SPACE}]")


def _segments(s: Column, site: Column) -> Column:
    head = F.regexp_replace(s, "[?#].*", "")
    return F.split(F.substring(head, F.length(site) + 1, F.length(head)), "/")


def _query(s: Column) -> Column:
    return F.regexp_extract(s, "\\A[^?#]*\\?([^#]*)", 1)


def _fragment(s: Column) -> Column:
    return F.regexp_extract(s, "\\A[^#]*#(.*)", 1)


def _pairs(s: Column) -> Column:
    return F.split(_query(s), "&")


def _pair_key(pair: Column) -> Column:
    return F.regexp_extract(pair, "\\A([^=]*)", 1)


def _pair_value(pair: Column) -> Column:
    return F.regexp_extract(pair, "\\A[^=]*=(.*)", 1)


def decode_segment(s: Column) -> Column:
    """Percent-decoding in which "+" is literal; undecodable input stays as it is."""
    out = F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))
    return F.when(
        out.isNull() | (F.contains(out, F.lit("\ufffd")) & ~F.contains(s, F.lit("\ufffd"))), s
    ).otherwise(out)


def decode_query(s: Column) -> Column:
    return F.coalesce(F.try_url_decode(s), F.replace(s, F.lit("+"), F.lit(" ")))


def encode_segment(s: Column) -> Column:
    """Percent-encoding as browsers do it for one path segment."""
    out = F.url_encode(s)
    # Characters the two encodings treat differently.
    for code, char in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def url_parts(s: Column, site: Column, scan_fragment: bool = True) -> Column:
    """The decoded texts in an own-site URL that need scanning."""
    parts = [
        F.transform(_segments(s, site), decode_segment),
        F.transform(_pairs(s), lambda p: decode_query(_pair_value(p))),
    ]
    if scan_fragment:
        parts.append(F.array(decode_segment(_fragment(s))))
    return F.concat(*parts)


def sanitize_url(
    s: Column,
    site: Column,
    clean: Callable[[Column], Column],
    scan_fragment: bool = True,
    keep_repeated: bool = True,
) -> Column:
    """``s`` with every part that ``clean`` changes replaced and encoded again."""

    def redo(part: Column, decode, encode) -> Column:
        return let(
            decode(part),
            lambda d: let(
                clean(d), lambda c: F.when(c == d, part).otherwise(encode(c))
            ),
        )

    path = F.array_join(
        F.transform(_segments(s, site), lambda p: redo(p, decode_segment, encode_segment)), "/"
    )

    def redo_pair(pair: Column) -> Column:
        value = _pair_value(pair)
        return let(
            redo(value, decode_query, F.url_encode),
            lambda v: F.when(v == value, pair).otherwise(
                F.concat(_pair_key(pair), F.lit("="), v)
            ),
        )

    def query(pairs: Column) -> Column:
        redone = F.transform(pairs, redo_pair)
        return F.array_join(redone if keep_repeated else _collapsed(pairs, redone), "&")

    fragment = _fragment(s)
    if scan_fragment:
        fragment = redo(fragment, decode_segment, encode_segment)
    before_fragment = F.regexp_replace(s, "#.*", "")
    return F.concat(
        site,
        path,
        F.when(
            F.contains(before_fragment, F.lit("?")),
            F.concat(F.lit("?"), let(_pairs(s), query)),
        ).otherwise(F.lit("")),
        F.when(F.contains(s, F.lit("#")), F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def _collapsed(pairs: Column, redone: Column) -> Column:
    """One pair per key that had a changed value, holding its last changed value."""
    both = F.transform(
        pairs,
        lambda p, i: F.struct(
            _pair_key(p).alias("key"),
            i.alias("at"),
            F.get(redone, i).alias("pair"),
            (F.get(redone, i) != p).alias("changed"),
        ),
    )

    def settle(all_pairs: Column) -> Column:
        def changed(x: Column) -> Column:
            return F.filter(all_pairs, lambda y: y["changed"] & (y["key"] == x["key"]))

        def first_at(x: Column) -> Column:
            return F.get(F.filter(all_pairs, lambda y: y["key"] == x["key"]), F.lit(0))["at"]

        kept = F.filter(
            all_pairs, lambda x: (F.size(changed(x)) == 0) | (first_at(x) == x["at"])
        )
        return F.transform(
            kept,
            lambda x: F.when(
                F.size(changed(x)) > 0, F.element_at(changed(x), -1)["pair"]
            ).otherwise(x["pair"]),
        )

    return let(both, settle)


def attachment_name(url: Column, disposition: Column | None = None) -> Column:
    """File name of a download: header, then ``name=``, then a last segment with a dot."""
    named = F.regexp_extract(url, "[?&]name=([^&]+)", 1)
    path = F.regexp_extract(url, "\\A[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.element_at(F.filter(F.split(path, "/"), lambda p: p != ""), -1)
    choices = [
        F.when(named != "", decode_segment(named)),
        F.when(F.size(F.filter(F.split(path, "/"), lambda p: p != "")) > 0,
               F.when(F.contains(last, F.lit(_DOT)), F.try_url_decode(
                   F.replace(last, F.lit("+"), F.lit("%2B"))))),
        F.lit("attachment"),
    ]
    if disposition is not None:
        header = F.regexp_extract(
            disposition, "(?i)filename\\*?=(?:UTF-8'')?\"?([^\";]+)\"?", 1
        )
        choices.insert(0, F.when(header != "", decode_segment(header)))
    return F.coalesce(*choices)
