"""License scan: marked-up templates compiled to one automaton over words.

A template is wording with two kinds of regions in the markup license lists use::

    permission <<beginOptional>>is<<endOptional>> hereby granted <<var;match="0-6">> to use

Optional regions may be missing; a replaceable region stands for any number of words in its
range. A range without an end (``match="1-";not="liable"``) has no word limit, but none of its
words may be one that it excludes. All other words are mandatory and must stand there exactly, in order. Every template
becomes a chain of states; the automaton follows all templates at once, its state sets turned
into deterministic states as they are met. It starts only at words that can begin a template,
and dies at the first word that no template allows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veildesk.llm.common import ascii_words, id_field, map_rows, once_per_worker


@dataclass(frozen=True)
class Template:
    """``base`` templates are plain phrases whose places are counted."""

    label: str
    wording: str
    base: bool = False


# The phrases and labels that every scan reports.
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
# The wording of short licenses, whole, with optional and replaceable regions.
_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without"
    " restriction including without limitation the rights to use copy modify merge publish"
    " distribute sublicense and or sell copies of the software and to permit persons to whom the"
    " software is furnished to do so"
)
_MIT_CONDITION = (
    "subject to the following conditions the above copyright notice and this permission notice"
    " <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all"
    " copies or substantial portions of the software"
)
_MIT_DISCLAIMER = (
    "the software is provided as is without warranty of any kind express or implied including"
    " but not limited to the warranties of merchantability fitness for a particular purpose and"
    ' noninfringement in no event shall <<var;match="1-";not="liable">> liable for any claim'
    " damages or other liability whether in an action of contract tort or otherwise arising from"
    " out of or in connection with the software or the use or other dealings in the software"
)
_ISC_GRANT = (
    "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this"
    " software for any purpose with or without fee is hereby granted"
)
_ISC_CONDITION = (
    "provided that the above copyright notice and this permission notice appear in all copies"
)
_ISC_DISCLAIMER = (
    'the software is provided as is and <<var;match="1-";not="disclaims">> disclaims all'
    " warranties with regard to this software including all implied warranties of"
    ' merchantability and fitness in no event shall <<var;match="1-";not="liable">> liable for'
    " any special direct indirect or consequential damages or any damages whatsoever resulting"
    " from loss of use data or profits whether in an action of contract negligence or other"
    " tortious action arising out of or in connection with the use or performance of this"
    " software"
)
_BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are"
    " permitted provided that the following conditions are met"
)
_BSD_SOURCE = (
    "<<beginOptional>>1<<endOptional>> redistributions of source code must retain the above"
    " copyright notice this list of conditions and the following disclaimer"
)
_BSD_BINARY = (
    "<<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above"
    " copyright notice this list of conditions and the following disclaimer in the documentation"
    " and or other materials provided with the distribution"
)
_BSD_ADVERTISING = (
    "<<beginOptional>>3<<endOptional>> all advertising materials mentioning features or use of"
    " this software must display the following acknowledgement this product includes software"
    ' developed by <<var;match="1-";not="neither">>'
)
_BSD_NAMES = (
    "<<beginOptional>>3<<endOptional>> <<beginOptional>>4<<endOptional>> neither the name"
    " <<beginOptional>>s<<endOptional>> of"
    ' <<var;match="1-";not="may">> may be used to endorse or promote products derived from this'
    " software without specific prior written permission"
)
_BSD_DISCLAIMER = (
    'this software is provided by <<var;match="1-";not="as">> as is and any express or implied'
    " warranties including but not limited to the implied warranties of merchantability and"
    " fitness for a particular purpose are disclaimed in no event shall"
    ' <<var;match="1-";not="liable">> liable for any direct indirect incidental special'
    " exemplary or consequential damages including but not limited to procurement of substitute"
    " goods or services loss of use data or profits or business interruption however caused and"
    " on any theory of liability whether in contract strict liability or tort including"
    " negligence or otherwise arising in any way out of the use of this software even if advised"
    " of the possibility of such damage"
)
# Notices as their licenses word them, with optional and replaceable regions.
NOTICES = (
    Template(
        "apache-2.0",
        "licensed under <<beginOptional>>the terms of<<endOptional>> the apache license"
        " <<beginOptional>>version<<endOptional>> 2.0",
    ),
    Template(
        "gpl-2.0",
        "licensed under <<beginOptional>>the terms of<<endOptional>>"
        " <<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>>"
        " general public license <<beginOptional>>as published by the free software"
        " foundation either<<endOptional>> version 2",
    ),
    Template(
        "gpl-3.0",
        "licensed under <<beginOptional>>the terms of<<endOptional>>"
        " <<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>>"
        " general public license <<beginOptional>>as published by the free software"
        " foundation either<<endOptional>> version 3",
    ),
    Template(
        "gpl-or-later",
        "under the terms of the gnu general public license as published by the free software"
        ' foundation <<beginOptional>>either<<endOptional>> version <<var;match="1-1">> of the'
        " license or at your option any later version",
    ),
    Template(
        "mit-notice",
        '<<beginOptional>>this <<var;match="1-2">> is<<endOptional>>'
        " <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under"
        " <<beginOptional>>the terms of<<endOptional>> the mit license",
    ),
    *(
        Template(f"{label}-text", f"{_MIT_GRANT} {condition} {_MIT_DISCLAIMER}")
        for label, condition in (
            ("mit", _MIT_CONDITION),
            ("mit-0", ""),
        )
    ),
    *(
        Template(f"{label}-text", f"{_ISC_GRANT} {condition} {_ISC_DISCLAIMER}")
        for label, condition in (
            ("isc", _ISC_CONDITION),
            ("0bsd", ""),
        )
    ),
    *(
        Template(f"bsd-{count}-clause-text", f"{_BSD_GRANT} {clauses} {_BSD_DISCLAIMER}")
        for count, clauses in (
            (1, _BSD_SOURCE),
            (2, f"{_BSD_SOURCE} {_BSD_BINARY}"),
            (3, f"{_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES}"),
            (4, f"{_BSD_SOURCE} {_BSD_BINARY} {_BSD_ADVERTISING} {_BSD_NAMES}"),
        )
    ),
    Template("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by 4.0"),
    Template("cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by sa 4.0"),
    Template("cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by nc 4.0"),
    Template(
        "mpl-2.0",
        "subject to the terms of the mozilla public license <<beginOptional>>v<<endOptional>> 2.0",
    ),
    Template(
        "all-rights-reserved",
        'copyright <<beginOptional>>c<<endOptional>> <<var;match="1-";not="copyright">>'
        " all rights reserved",
    ),
)
#: A mark: of a replaceable region its least and its largest number of words and the word that
#: it excludes, else plain words.
MARK = re.compile(
    r'<<beginOptional>>|<<endOptional>>|<<var;match="(\d+)-(\d*)"(?:;not="([^"]*)")?>>|([^<]+)'
)


@dataclass
class _State:
    words: dict[bytes, int]
    any_word: int | None
    skip: list[int]
    except_word: bytes | None = None

    def ahead(self, word: bytes) -> Iterator[int]:
        if word in self.words:
            yield self.words[word]
        if self.any_word is not None and word != self.except_word:
            yield self.any_word


class TemplateAutomaton:
    """All templates as one automaton. ``places(words)`` yields every accepted stretch."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        self._states: list[_State] = []
        self._accepts: dict[int, int] = {}
        starts = [self._compile(k, t) for k, t in enumerate(self.templates)]
        self._sets: dict[frozenset[int], int] = {}
        self._moves: list[dict[bytes, int]] = []
        self._found: list[tuple[int, ...]] = []
        self._members: list[frozenset[int]] = []
        self._start = self._known(self._closure(starts))
        if self._found[self._start]:
            raise ValueError("a template must have a mandatory word")
        begin = [self._states[s] for s in self._members[self._start]]
        if any(s.any_word is not None for s in begin):
            raise ValueError("a template cannot begin with a replaceable region")
        self.firsts = frozenset(w for s in begin for w in s.words)

    def _new(self) -> int:
        self._states.append(_State({}, None, []))
        return len(self._states) - 1

    def _compile(self, number: int, template: Template) -> int:
        start = at = self._new()
        opened: list[int] = []
        for mark in MARK.finditer(template.wording):
            if mark[0] == "<<beginOptional>>":
                opened.append(at)
                following = self._new()
                self._states[at].skip.append(following)
                at = following
            elif mark[0] == "<<endOptional>>":
                following = self._new()
                self._states[at].skip.append(following)
                self._states[opened.pop()].skip.append(following)
                at = following
            elif mark[1] is not None:
                at = self._region(at, int(mark[1]), mark[2], (mark[3] or "").encode() or None)
            else:
                for word in ascii_words(mark[4]):
                    following = self._new()
                    self._states[at].words[word] = following
                    at = following
        if opened:
            raise ValueError(f"{template.label}: an optional region is not closed")
        self._accepts[at] = number
        return start

    def _region(self, at: int, low: int, high: str, excluded: bytes | None) -> int:
        """States for ``low`` to ``high`` words from ``at`` on; the last one goes round and round
        if there is no end."""
        end = self._new()
        for taken in range(int(high or low + 1) + 1):
            if taken >= low:
                self._states[at].skip.append(end)
            if high and taken == int(high):
                break
            self._states[at].except_word = excluded
            if not high and taken > low:
                self._states[at].any_word = at
                break
            self._states[at].any_word = at = self._new()
        return end

    def _closure(self, states: Sequence[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for following in self._states[todo.pop()].skip:
                if following not in seen:
                    seen.add(following)
                    todo.append(following)
        return frozenset(seen)

    def _known(self, members: frozenset[int]) -> int:
        if members not in self._sets:
            self._sets[members] = len(self._members)
            self._members.append(members)
            self._moves.append({})
            self._found.append(
                tuple(sorted(self._accepts[s] for s in members if s in self._accepts))
            )
        return self._sets[members]

    def _step(self, at: int, word: bytes) -> int:
        """The next deterministic state, -1 if no template goes on."""
        members = [self._states[s] for s in self._members[at]]
        if word not in self._alphabet:
            word = b""
        known = self._moves[at].get(word)
        if known is None:
            ahead = [following for s in members for following in s.ahead(word)]
            known = self._known(self._closure(ahead)) if ahead else -1
            self._moves[at][word] = known
        return known

    @property
    def _alphabet(self) -> frozenset[bytes]:
        if not hasattr(self, "_words"):
            known = {w for s in self._states for w in s.words}
            self._words = frozenset(known | {s.except_word for s in self._states})
        return self._words

    def places(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
        """``(template, start, end)`` of every accepted stretch, words counted from 0."""
        firsts, n = self.firsts, len(words)
        for start in [i for i, w in enumerate(words) if w in firsts]:
            at, i = self._start, start
            while i < n:
                at = self._step(at, words[i])
                if at < 0:
                    break
                i += 1
                for number in self._found[at]:
                    yield number, start, i


def scan(
    docs: DataFrame,
    templates: Sequence[Template] = BASE + NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document, from its whole text; a null text is an empty one.

    ``n_words``; ``n_base``: places of base phrases; ``first_word, last_word``: smallest and
    largest start of such a place, null without one; ``base_labels`` and ``labels``: distinct
    labels of accepted base templates and of all templates, sorted and comma-joined, empty
    without one; ``score``: 1 if a notice's template is accepted, 0.5 if only a base phrase is,
    else 0; ``spans``: ``label:start:end`` of all accepted stretches, in text order. Rows are kept as they come, with repeated and null ids.
    """
    schema = T.StructType(
        [
            id_field(docs, id_col),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_base", T.LongType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("base_labels", T.StringType()),
            T.StructField("labels", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    templates = tuple(templates)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        # Deterministic states are met once for a worker, whatever tasks it has.
        automaton = once_per_worker(("licenses", templates), lambda: TemplateAutomaton(templates))
        for key, text in zip(ids, texts, strict=True):
            words = ascii_words(text)
            places = sorted(automaton.places(words), key=lambda p: (p[1], p[2], p[0]))
            base = [start for k, start, _ in places if templates[k].base]
            yield (
                key,
                len(words),
                len(base),
                min(base, default=None),
                max(base, default=None),
                ",".join(sorted({templates[k].label for k, _, _ in places if templates[k].base})),
                ",".join(sorted({templates[k].label for k, _, _ in places})),
                max((0.5 if templates[k].base else 1.0 for k, _, _ in places), default=0.0),
                ",".join(f"{templates[k].label}:{start}:{end}" for k, start, end in places),
            )

    return map_rows(docs.select(id_col, text_col), rows, schema)
