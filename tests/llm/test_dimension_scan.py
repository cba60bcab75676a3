"""Neighbours by the adaptive scan against brute force: exact distances, recall, odd vectors."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from veildesk.llm import dimension_scan as S
from veildesk.llm.queries import QUERIES

DATA = os.path.dirname(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


def brute(rows, k, every=100):
    """``{query: [(distance, id), ...]}`` of rows ``(id, vector)``."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((x - x[at]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != ids[at]][:k]
        out[int(ids[at])] = [(float(far[j]), int(ids[j])) for j in order]
    return out


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    true = brute(rows, 10)
    found = by_query(QUERIES["op12_nearest_neighbours"](spark, f"{DATA}/{sf}"))
    x = {i: np.array(v, np.float64) for i, v in rows}
    hits = 0
    for query, best in true.items():
        got = found[query]
        assert len(got) == 10 == len({i for _, i in got}) and got == sorted(got)
        assert all(math.isclose(s, np.sqrt(((x[i] - x[query]) ** 2).sum()), rel_tol=1e-12) for s, i in got)
        hits += len({i for _, i in best} & {i for _, i in got})
    assert hits >= 0.9 * 10 * len(true)


def make(spark, rows):
    kind = "vec_id long, embedding array<float>, label string, node long, list int, score double"
    return spark.createDataFrame([(*r, "x", 1, 2, 3.0) for r in rows], kind).repartition(3)


def asks():
    return F.pmod("vec_id", F.lit(100)) == 0


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    hot = [0.5, 0.5, 0.0, 0.25]
    rows = [(i, hot) for i in range(0, 300)]  # three queries among 300 copies
    rows += [(300 + i, [float(np.float32(v)) for v in rng.standard_normal(4)]) for i in range(200)]
    rows += [(600, hot), (600, hot), (None, hot)]
    odd = [(700, None), (800, [0.0] * 4), (900, [1.0, None, 0.0, 0.0]), (1000, [math.nan, 1.0, 0.0, 0.0])]
    odd += [(1100, [math.inf, 1.0, 0.0, 0.0]), (1200, [1.0, 2.0]), (1300, [])]
    found = by_query(S.nearest(make(spark, rows + odd), asks()))
    clean = sorted({(i, tuple(v)) for i, v in rows if i is not None})
    true = brute(clean, 10)
    assert set(found) == set(true)
    for query in (0, 100, 200, 600):
        assert found[query] == true[query]  # ties go to the smallest ids, never to the own
    hits = sum(len({i for _, i in found[q]} & {i for _, i in true[q]}) for q in true)
    assert hits >= 0.9 * 10 * len(true)


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert by_query(S.nearest(make(spark, rows), asks())) == brute(rows, 10)
    assert S.nearest(make(spark, rows[:1]), asks()).count() == 0
    empty = S.nearest(make(spark, []), asks())
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert S.nearest(make(spark, [(0, None)]), asks()).count() == 0


def test_the_test_abandons_candidates_but_no_near_ones():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((512, 64))
    turn = S.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    near = x[:8] + 0.01 * rng.standard_normal((8, 64))
    columns = (x @ turn).T.astype(np.float32)
    q, c, far = S.scan_chunk(near, near @ turn, np.full(8, np.inf), columns, x, 1)
    assert q.tolist() == list(range(8)) == c.tolist()
    q, c, far = S.scan_chunk(near, near @ turn, np.full(8, 1e-3), columns, x, 1)
    assert len(q) == 0


def test_queries_are_not_broadcast_and_meet_their_lists_in_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.standard_normal(8).astype(np.float32)]) for i in range(3_000)]
    nodes = S.distinct_vectors(make(spark, rows).selectExpr("vec_id as id", "embedding as vector"), 10)
    index = S.Index(nodes, 8)
    assert len(index.centre) > 40 and index.visits > 2 and index.kind == "<f4"
    asking = nodes.select("node").where("node % 7 = 0")
    queries = nodes.join(asking, "node").select("node", "vector", F.lit(float("inf")).alias("bound"))
    found = []
    for together in (1, 7, len(index.centre)):
        index.together = together
        scan = index._scan(queries, 0, index.visits)
        plan = scan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin [group" not in plan
        found.append({(r.query, r.node): r.score for r in scan.collect()})
    true = index._scan(queries, 0, len(index.centre)).where("score = 0").count()
    assert true == asking.count()  # each finds itself
    for other in found[1:]:
        assert other == found[0]
