"""Treap search against the whole grid, and ranked search against scores by hand."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from veildesk.llm import term_treap as S


@pytest.mark.parametrize("seed", range(40))
def test_search_finds_the_best_columns(seed):
    rng = np.random.default_rng(seed)
    n_rows, n_columns = int(rng.integers(1, 40)), int(rng.integers(1, 90))
    cells = rng.choice(n_rows * n_columns, int(rng.integers(0, n_rows * n_columns // 2 + 1)), replace=False)
    rows, columns = (cells // n_columns).astype(np.int32), (cells % n_columns).astype(np.int32)
    impacts = rng.integers(1, 20, len(cells)).astype(np.int32)
    treap = S.build(rows, columns, impacts)
    grid = np.zeros((n_rows, n_columns), np.int64)
    grid[rows, columns] = impacts
    query = rng.choice(n_rows, min(n_rows, 5), replace=False).astype(np.int64)
    weights = rng.integers(1, 5, len(query)).astype(np.int64)
    scores = weights @ grid[query]
    for k in (1, 4, 200):
        at, found = S.search(treap, query, weights, k, 1, batch=3)
        best = sorted(zip((-found).tolist(), at.tolist(), strict=True))[:k]
        assert best == sorted((-int(s), i) for i, s in enumerate(scores) if s > 0)[:k]


def test_a_square_holds_its_largest_impact():
    rng = np.random.default_rng(0)
    cells = rng.choice(64 * 64, 500, replace=False)
    rows, columns = (cells // 64).astype(np.int32), (cells % 64).astype(np.int32)
    treap = S.build(rows, columns, rng.integers(1, 1000, 500).astype(np.int32))

    def largest(child):
        if child <= -2:
            return int(treap.impact[-2 - child])
        first, n = int(treap.first[child]), int(treap.mask[child]).bit_count()
        most = max(largest(int(c)) for c in treap.child[first : first + n])
        assert most == treap.most[child] and n >= 1
        return most

    assert largest(treap.root) == treap.impact.max()
    assert len(treap.mask) == len(treap.first) == len(treap.most)


def ranking_by_hand(docs, queries, k):
    def cut(text):
        words = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
        return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]

    words = [(key, Counter(cut(text))) for key, text in docs]
    words = [(key, c) for key, c in words if c]
    n_docs, n_terms = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(w for _, c in words for w in c)
    items = {}
    for key, text in queries:
        items.setdefault(key, set()).update(cut(text))
    rows = []
    for item, query in items.items():
        scored = []
        for key, counts in words:
            m = 50 + 50 * sum(counts.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * counts[w] // (1000 * counts[w] + 20 * m))
                for w in query
                if counts[w]
            )
            scored.append((-score, key is None, key or 0, key))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        rows += [(item, i, key, -score) for i, (score, _, _, key) in enumerate(best, 1)]
    return rows


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("points", [S.SHARD_POINTS, 40])
def test_ranked_search(spark, documents_of, odd_rows, monkeypatch, points):
    rows = odd_rows + [(100 + i, f"word{i % 7} common Straße twelve thirteen {'x ' * (i % 5)}") for i in range(60)]
    queries = [
        (1, "The SAME text, common word3 word3"), (1, "alpha"), (2, None), (3, ""), (None, "straße ABC"),
        (4, "x twelve common"), (5, "nowhere to be found"), (6, "common"),
    ]
    monkeypatch.setattr(S, "SHARD_POINTS", points)
    monkeypatch.setattr(S, "BLOCK_TERMS", 4 if points == 40 else S.BLOCK_TERMS)
    table = spark.createDataFrame([(*q, "x") for q in queries], "item_id long, text string, score string")
    for k in (50, 3):
        found = S.ranked_search(documents_of(rows), table, k)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        got = sorted((tuple(r) for r in found.collect()), key=key)
        assert got == sorted(ranking_by_hand(rows, queries, k), key=key)


def test_empty_tables(spark, documents_of, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "one two")], none.schema)
    assert S.ranked_search(documents_of([]), one).count() == 0
    assert S.ranked_search(documents_of(odd_rows), none).count() == 0
    assert S.ranked_search(documents_of([(1, None), (2, "")]), one).count() == 0
