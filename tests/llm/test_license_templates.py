"""Template automata against regular expressions over the words, and base phrases by hand."""

import re

import pytest

from veildesk.llm import license_templates as L
from veildesk.llm.common import ascii_words


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for phrase, label in (
            ("mit license", "mit"),
            ("apache license", "apache"),
            ("general public license", "gpl"),
        )
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = L.scan(docs).collect()
    assert len(found) == len(texts) and any(r["n_base"] for r in found)
    for row in found:
        assert tuple(row)[1:6] == base_by_hand(texts[row["doc_id"]])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))


def as_regex(wording):
    """The template as an expression over ``word `` strings."""
    out = []
    marks = r'<<beginOptional>>|<<endOptional>>|<<var;match="(\d+)-(\d*)"(?:;not="(\w+)")?>>|[^<]+'
    for mark in re.finditer(marks, wording):
        if mark[0] == "<<beginOptional>>":
            out.append("(?:")
        elif mark[0] == "<<endOptional>>":
            out.append(")?")
        elif mark[1]:
            other = f"(?!{mark[3]} )" if mark[3] else ""
            out.append(f"(?:{other}[^ ]+ ){{{mark[1]},{mark[2]}}}")
        else:
            out.append("".join(re.escape(w.decode()) + " " for w in ascii_words(mark[0])))
    return re.compile("".join(out))


@pytest.mark.parametrize(
    "text",
    [
        "Licensed under the Apache License, Version 2.0.",
        "licensed under the terms of the apache license 2.0 and the MIT License",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the MIT License. MIT MIT License license",
        "Licensed under CC BY-NC 4.0.",
        "Copyright (c) 2001, 2002 Some One. All rights reserved.",
        "Copyright all rights reserved",
        "Copyright a b c d e f g h i all rights reserved",
        "Copyright a copyright all rights reserved. Copyright b, all rights, all rights reserved",
        "licensed under the mozilla public license",
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "",
    ],
)
def test_regions(text):
    templates = L.BASE + L.NOTICES
    words = ascii_words(text)
    found = {(k, start) for k, start, _ in L.TemplateAutomaton(templates).places(words)}
    strings = [w.decode() for w in words]
    want = {
        (k, i)
        for k, t in enumerate(templates)
        for i in range(len(words))
        if as_regex(t.wording).match("".join(w + " " for w in strings[i:]))
    }
    # A leading optional region lets one stretch be accepted from several starts.
    assert found == want


# Whole license texts, set as their publishers set them; HOLDER stands for any holder.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MIT_CONDITION = MIT[MIT.index(", subject to") : MIT.index("\n\nTHE SOFTWARE IS")]
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND HOLDER DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL HOLDER BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ISC_CONDITION = ISC[ISC.index(", provided that") : ISC.index(".\n\nTHE SOFTWARE")]
BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
{}
THIS SOFTWARE IS PROVIDED BY HOLDER "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL HOLDER BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
OF SUCH DAMAGE."""
NAMES = """{}. Neither the name of HOLDER nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
"""
ADVERTISING = """3. All advertising materials mentioning features or use of this software must
display the following acknowledgement: This product includes software developed by HOLDER.
"""
LONG = "The Regents of the University of California, Berkeley, and its many, many, many contributors"
WHOLE = {
    "mit-text": MIT,
    "mit-0-text": MIT.replace(MIT_CONDITION, "."),
    "isc-text": ISC,
    "0bsd-text": ISC.replace(ISC_CONDITION, ""),
    "bsd-2-clause-text": BSD.format(""),
    "bsd-3-clause-text": BSD.format(NAMES.format(3)),
    "bsd-4-clause-text": BSD.format(ADVERTISING + NAMES.format(4)),
}


def labels_of(text):
    automaton = L.TemplateAutomaton(L.BASE + L.NOTICES)
    return {automaton.templates[k].label for k, _, _ in automaton.places(ascii_words(text))}


@pytest.mark.parametrize("label", WHOLE)
def test_whole_licenses(label):
    for holder in ("the author", LONG):
        text = WHOLE[label].replace("HOLDER", holder)
        assert labels_of(f"Some words before. {text} And some after.") == {label}
        assert labels_of(f"Copyright (c) 1991, 1993 {LONG}. All rights reserved.\n{text}") == {
            label, "all-rights-reserved",
        }
        # Cut short, altered in the middle, or with a word left out: no license.
        words = text.split()
        assert labels_of(" ".join(words[:-1])) == set()
        assert labels_of(" ".join([*words[:9], "unless you are a bank", *words[9:]])) == set()
        assert labels_of(" ".join([*words[:9], *words[10:]])) == set()
    first = WHOLE[label].split(":")[0].split(".")[0]
    assert labels_of(first + ", unless you are a bank, in which case you owe us everything.") == set()


def test_altered_mandatory_words():
    for label, text in WHOLE.items():
        text = text.replace("HOLDER", "the holder")
        for old, new in (("WITHOUT WARRANTY", "WITH WARRANTY"), ("ARISING", "COMING"), ("hereby", "seldom"), ("retain", "drop")):
            if old in text:
                assert labels_of(text.replace(old, new)) == set(), (label, old)


def test_an_open_region_stops_at_its_word():
    automaton = L.TemplateAutomaton([L.Template("x", 'a <<var;match="1-";not="a">> z')])
    accepted = lambda s: [p[1:] for p in automaton.places(ascii_words(s))]
    assert accepted("a z") == [] and accepted("a " + "b " * 500 + "z") == [(0, 502)]
    assert accepted("a b a c z") == [(2, 5)] and accepted("a b z z") == [(0, 3), (0, 4)]


def test_mandatory_wording_must_match():
    automaton = L.TemplateAutomaton([L.Template("x", 'a <<beginOptional>>b <<var;match="1-2">><<endOptional>> c')])
    accepted = lambda s: [p[1:] for p in automaton.places(ascii_words(s))]
    assert accepted("a c") == [(0, 2)]
    assert accepted("a b q c") == [(0, 4)]
    assert accepted("a b q r c") == [(0, 5)]
    assert accepted("a b c") == []
    assert accepted("a b q r s c") == []
    assert accepted("a q c") == []


def test_faulty_templates():
    with pytest.raises(ValueError):
        L.TemplateAutomaton([L.Template("x", "<<beginOptional>>a<<endOptional>>")])
    with pytest.raises(ValueError):
        L.TemplateAutomaton([L.Template("x", "a <<beginOptional>>b")])
    with pytest.raises(ValueError):
        L.TemplateAutomaton([L.Template("x", '<<var;match="0-2">> a')])


def test_odd_rows(documents_of, odd_rows):
    docs = documents_of([*odd_rows, (9, "mit license " * 5_000)])
    found = {r["doc_id"]: r for r in L.scan(docs).collect() if r["doc_id"] is not None}
    assert L.scan(docs).count() == len(odd_rows) + 1
    assert (found[9]["n_base"], found[9]["first_word"], found[9]["last_word"]) == (5000, 0, 9998)
    assert found[2]["n_words"] == 0 and found[2]["labels"] == "" and found[2]["first_word"] is None
    assert L.scan(docs.where("1 = 0")).count() == 0
