"""Words one edit apart against every pair, and the job against a plain count."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from veildesk.llm import spelling_variants as S
from veildesk.llm.queries import SLIP_EVERY

WORDS = st.lists(st.text("abé", min_size=1, max_size=6), max_size=40).map(lambda x: sorted(set(x)))


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    drops = [b[:i] + b[i + 1 :] for i in range(len(b))]
    if len(a) < len(b):
        return a in drops
    return any(a[:i] + a[i + 1 :] == d for i, d in enumerate(drops))


@settings(max_examples=150, deadline=None)
@given(WORDS)
def test_pairs_within_a_list(words):
    found = list(S.pairs_within(words))
    assert len(found) == len(set(found))
    n = range(len(words))
    assert set(found) == {(i, j) for i in n for j in n if i < j and one_edit(words[i], words[j])}


@settings(max_examples=150, deadline=None)
@given(WORDS, WORDS)
def test_pairs_between_lists(queries, words):
    found = list(S.pairs_between(queries, words))
    assert len(found) == len(set(found))
    assert {(queries[i], words[j]) for i, j in found} == {
        (a, b) for a in queries for b in words if one_edit(a, b)
    }


def test_near_words_whatever_the_size_of_a_piece(spark):
    words = sorted({w for a in "abc" for b in "abé" for c in "ab" for w in (a + b + c + "abab", a + b + "ababa", a + "bab")})
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    expected = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    for piece in (4_096, 3):
        found = [frozenset((r.a, r.b)) for r in S.near_words(rows, piece).collect()]
        assert len(found) == len(set(found)) and set(found) == expected


def vocabulary_by_hand(rows, every):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def variants_by_hand(words):
    out = {}
    for word, n in words.items():
        near = [(-m, w) for w, m in words.items() if one_edit(word, w)]
        best = min(near, default=None)
        linked = best is not None and -best[0] >= 5 * n
        out[word] = (best[1] if linked else None, n, len(near), -best[0] if linked else None)
    rows = set()
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((word, form, root, n, n_near, form_n))
    return rows


def test_whole_job(spark, documents_of, odd_rows):
    chain = "colours " * 200 + "colour " * 30 + "colou " * 5 + "Ñandúes ñandúes " * 6 + "cölours " * 5
    rows = [*odd_rows, *[(i, chain + f"garden{'xyz'[i % 3]} gardens " * 9) for i in range(9)]]
    for every in (SLIP_EVERY, 3):
        docs = documents_of(rows)
        found = S.spelling_variants(docs, slip_every=every)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        expected = variants_by_hand(vocabulary_by_hand(rows, every))
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    assert any(root not in (word, form) for word, form, root, *_ in expected)


def test_no_words(spark, documents_of):
    assert S.spelling_variants(documents_of([]), slip_every=SLIP_EVERY).count() == 0
    assert S.spelling_variants(documents_of([(1, None), (2, ""), (3, "漢字")])).count() == 0
