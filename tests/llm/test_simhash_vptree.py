"""SimHash components against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from veildesk.llm import simhash_vptree as S


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    """``rows``: (id, fingerprint). The smallest non-null id reachable, row by row."""
    values = np.array([f for _, f in rows], np.uint64)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    group = np.arange(len(rows))
    while True:
        lower = np.array([group[c].min() for c in close])
        if (lower == group).all():
            break
        group = lower
    out = []
    for g in group:
        ids = [rows[i][0] for i in np.flatnonzero(group == g) if rows[i][0] is not None]
        out.append(min(ids, default=None))
    return out


def check(docs):
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, fingerprint_by_hand(t)) for i, t in given]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(rows, components_by_hand(rows), strict=True)]
    found = [tuple(r) for r in S.near_duplicates(docs).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return want


def test_documents(spark, sf_dir):
    want = check(spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet"))
    assert len({c for _, _, c in want}) < len(want)


def test_odd_rows(documents_of, odd_rows):
    docs = documents_of(odd_rows)
    check(docs)
    assert S.near_duplicates(docs.where("1 = 0")).count() == 0


def test_one_of_each(documents_of, odd_rows):
    docs = documents_of(odd_rows)
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [1, 2, 5, 6, 8]
    assert S.one_of_each(docs.where("1 = 0")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_shards_find_every_link(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    if seed % 2:  # few bits set, so that codes lie close together
        base &= rng.integers(0, 2**64, dtype=np.uint64)
    near = base[rng.integers(0, 150, 1000)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 1000).astype(np.uint64))
    fps = np.unique(np.concatenate((base, near)))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    want, found = np.arange(len(fps)), np.arange(len(fps))
    S._unite(want, i, j)
    for shift in (0, 32):
        codes = S._half(fps, shift)
        parts = list(S.VantageTree(codes[:800], 2 + 9 * seed).route(codes, 1))
        assert sum(h.sum() for _, _, h in parts) == len(fps)
        for _, places, home in parts:
            a, b = S.shard_links(fps[places[home]], fps[places[~home]], shift)
            S._unite(found, np.searchsorted(fps, a), np.searchsorted(fps, b))
    assert (S._roots(found) == S._roots(want)).all()


def test_star_forest_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    assert {tuple(r) for r in S.star_forest(edges).collect()} == {(i, 0) for i in range(1, 101)}
    assert S.star_forest(edges.where("1 = 0")).count() == 0
