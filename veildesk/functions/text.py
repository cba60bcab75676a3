"""Small text expressions: whitespace, scan test, escaping, one-time bindings."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and formats that results depend on.
# SPACE spells out what "\s" covers in the source data's regular expressions;
# Java's own "\s" is ASCII only.
SPACE = "\\t\\n\\x0B\\f\\r \\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF"
WORD = "\\p{L}\\p{N}"
CONNECTOR = ".@+\\-'"
LEADING_PUNCT = "(\\[{<\"'«„“"
TRAILING_PUNCT = ")\\]}>\"'»“”,.;:!?"
MERGEABLE_GAP = f"\\A[{SPACE}.\\-@_+/()]{{0,3}}\\z"
ISO_DATETIME = (
    "\\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?"
    "(Z|[+-][0-9]{2}:?[0-9]{2})?\\z"
)
REGEX_SPECIALS = ".*+?^${}()|[]\\"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def has_word(text: Column) -> Column:
    return text.rlike(f"[{WORD}]")


def needs_scan(text: Column) -> Column:
    """Has a letter or digit and is not an ISO timestamp."""
    return has_word(text) & ~text.rlike(ISO_DATETIME)


def strip_space(text: Column) -> Column:
    """Trim every Unicode space; ``F.trim`` strips only U+0020."""
    return F.regexp_replace(text, f"\\A[{SPACE}]++|(?<![{SPACE}])[{SPACE}]++\\z", "")


def digit_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def escape_regex(text: Column) -> Column:
    return F.regexp_replace(text, "([.*+?^${}()|\\[\\]\\\\])", "\\\\$1")


def whole_word(alternatives: Column | str) -> Column | str:
    """Regular expression for any of ``alternatives`` not inside a longer word."""
    head, tail = f"(?<![{WORD}])(?:", f")(?![{WORD}])"
    if isinstance(alternatives, str):
        return head + alternatives + tail
    return F.concat(F.lit(head), alternatives, F.lit(tail))


def terms_regex(terms: Iterable[str]) -> str | None:
    """Case-insensitive whole-word pattern for a configured term list, the longest term first.

    The terms become a tree of their shared beginnings, so a place in a text is compared with
    the few branches that are still possible there and not with every term.
    """
    root: dict = {}
    for term in terms:
        node = root
        for ch in term:
            lower = ch.lower()
            node = node.setdefault(lower if len(lower) == 1 else ch, {})
        node[""] = {}
    return "(?iu)" + whole_word(_branches(root)) if root else None


def _branches(node: dict) -> str:
    """The alternatives of a tree of characters; "" marks that a term ends at the node."""
    out = []
    for ch, below in node.items():
        if ch == "":
            continue
        text = ch
        while len(below) == 1 and "" not in below:  # no choice here
            (ch, below), *_ = below.items()
            text += ch
        head = "".join("\\" + c if c in REGEX_SPECIALS else c for c in text)
        rest = _branches(below)
        if rest:
            rest = f"(?:{rest})" + ("?" if "" in below else "")
        out.append(head + rest)
    return "|".join(out)


def comma_list(value: str) -> list[str]:
    """``"a, b,,c"`` as a list, trimmed, empties dropped."""
    return [part.strip() for part in value.split(",") if part.strip()]


def probability(value: float | None, default: float = 0.5) -> float:
    """A threshold in (0, 1]; anything else is the default."""
    return value if value is not None and 0 < value <= 1 else default
