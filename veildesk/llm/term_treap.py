"""Ranked search over K2-treaps of the term-document grid.

A shard is the grid of some documents' terms (rows, the most frequent first) and of the
documents themselves (columns); a cell of it holds the term's impact in the document. The grid
is a square of side ``2 ** height``, cut again and again into four. A square is kept if it holds
a point, with the largest impact inside it; one with a single point is that point, which is
where the compression lies, as most terms are in few documents. The squares of all levels lie in
one array, a square's children side by side, found by a mask of the quarters that exist.

A query descends along the rows of all its terms at once. A state is a range of documents and,
for each term, the square that its row and the range meet in; the squares' maxima, weighted, add
up to a bound for every document of the range. The most promising states are split first, in
batches, and a state whose bound is below the k-th score found so far is dropped. A range of one
document has its exact score.

Impacts need the corpus's totals, so terms are counted once over all documents before the
shards are built. Tasks build and search shards of bounded size and keep the k best for each
query over all their shards; those meet in two rounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import id_field, map_rows
from veildesk.staging import staged

K = 50
#: A shard is closed at so many points or documents.
SHARD_POINTS, SHARD_DOCS = 1 << 20, 1 << 13
#: Terms of queries that tasks get at once; more queries are searched in further passes.
BLOCK_TERMS = 100_000
_HELD = 200_000
_BATCH = 1_024
_GROUPS = 64
_NONE = -1
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Maximal runs ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased, UTF-8."""
    return text.encode().translate(_TABLE).split() if text else []


# ------------------------------------------------------------------ one shard


@dataclass
class Treap:
    """Squares in breadth-first order, the root first; points apart.

    Square ``s`` has its children at ``first[s]`` and on, in the order of the quarters in
    ``mask[s]`` (bit ``2 * lower + right``). A child is a square if not negative, else the point
    ``-2 - child``.
    """

    height: int
    mask: np.ndarray
    first: np.ndarray
    child: np.ndarray
    most: np.ndarray
    row: np.ndarray
    column: np.ndarray
    impact: np.ndarray
    root: int


def build(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
    """The treap of distinct points ``(row, column)`` with their impacts."""
    side = max(int(rows.max(initial=0)), int(columns.max(initial=0)), 1)
    height = side.bit_length()
    code = _spread(rows.astype(np.uint64)) << np.uint64(1) | _spread(columns.astype(np.uint64))
    order = np.argsort(code, kind="stable")
    code, rows, columns, impacts = code[order], rows[order], columns[order], impacts[order]
    n = len(code)
    if n < 2:
        empty = np.empty(0, np.int32)
        parts = (empty.astype(np.uint8), empty, empty, empty)
        return Treap(height, *parts, rows, columns, impacts, -2 if n else _NONE)
    masks, firsts, children, maxima = [], [], [], [impacts.max(keepdims=True)]
    starts, ends = np.array([0]), np.array([n])  # points of the squares of this level
    squares, n_children = 1, 0
    for level in range(height):
        if not len(starts):
            break
        shift = np.uint64(2 * (height - 1 - level))
        # A new child begins where the quarter changes or a new square begins.
        inside = _ranges(starts, ends)
        quarter = code[inside] >> shift
        begins = np.ones(len(inside), bool)
        begins[1:] = quarter[1:] != quarter[:-1]
        at = np.flatnonzero(begins)
        sizes = np.diff(np.append(at, len(inside)))
        points = inside[at]
        kind = (quarter[at] & np.uint64(3)).astype(np.uint8)
        parent = np.searchsorted(starts, points, side="right") - 1
        firsts.append(n_children + np.searchsorted(parent, np.arange(len(starts))))
        masks.append(np.bitwise_or.reduceat(np.uint8(1) << kind, firsts[-1] - n_children))
        n_children += len(at)
        deep = sizes > 1
        names = np.where(deep, squares + np.cumsum(deep) - 1, -2 - points)
        children.append(names)
        squares += int(deep.sum())
        maxima.append(np.maximum.reduceat(impacts[inside], at)[deep])
        starts, ends = points[deep], points[deep] + sizes[deep]
    joined = (np.concatenate(firsts), np.concatenate(children), np.concatenate(maxima))
    return Treap(
        height,
        np.concatenate(masks),
        *(x.astype(np.int32) for x in joined),
        rows,
        columns,
        impacts,
        0,
    )


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers with a zero after each."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - starts
    skip = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return np.arange(int(sizes.sum())) + skip


def search(
    treap: Treap, rows: np.ndarray, weights: np.ndarray, k: int, floor: int, batch: int = _BATCH
) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the documents that can be among the ``k`` best.

    ``rows`` are the query's terms in this shard with their weights. Documents whose score is
    below ``floor`` (at least 1) are left out, and so are those below the ``k``-th best found;
    documents with the ``k``-th score itself are all returned.
    """
    found_at: list[np.ndarray] = []
    found: list[np.ndarray] = []
    best = np.empty(0, np.int64)
    nodes = np.full((1, len(rows)), treap.root, np.int32)
    if treap.root <= -2:
        nodes[0, treap.row[-2 - treap.root] != rows] = _NONE
    level, low = np.zeros(1, np.int32), np.zeros(1, np.int64)
    bound = _bounds(treap, nodes, rows, weights)
    limit = floor
    while True:
        keep = bound >= limit
        if not keep.any():
            break
        nodes, level, low, bound = nodes[keep], level[keep], low[keep], bound[keep]
        if len(bound) > batch:
            order = np.argpartition(-bound, batch)
            take, rest = order[:batch], order[batch:]
        else:
            take, rest = np.arange(len(bound)), np.empty(0, np.intp)
        parts = [(nodes[rest], level[rest], low[rest], bound[rest])]
        down, depth, start = nodes[take], level[take], low[take]
        bit = treap.height - 1 - depth
        for right, child in enumerate(_halves(treap, down, rows, bit)):
            there = start + (np.int64(right) << bit.astype(np.int64))
            above = _bounds(treap, child, rows, weights)
            good = above >= limit
            done = good & (bit == 0)
            if done.any():
                found_at.append(there[done])
                found.append(above[done])
                best = np.sort(np.concatenate((best, above[done])))[-k:]
                if len(best) == k:
                    limit = max(limit, int(best[0]))
            good &= bit > 0
            parts.append((child[good], depth[good] + 1, there[good], above[good]))
        nodes, level, low, bound = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not found:
        return np.empty(0, np.int64), best
    columns, scores = np.concatenate(found_at), np.concatenate(found)
    keep = scores >= limit
    return columns[keep], scores[keep]


#: For each mask and quarter, how many of the mask's quarters come before it; -1 if it has not.
_PLACE = np.array(
    [(m & ((1 << q) - 1)).bit_count() if m >> q & 1 else -1 for m in range(16) for q in range(4)],
    np.int32,
)


def _halves(treap: Treap, nodes: np.ndarray, rows: np.ndarray, bit: np.ndarray):
    """Each term's child in the left and in the right half of the states' document ranges."""
    flat = nodes.ravel()
    left, right = np.full((2, len(flat)), _NONE, np.int32)
    at = np.flatnonzero(flat >= 0)
    if len(at):
        state, term = np.divmod(at, len(rows))
        square = flat[at]
        quarter = ((rows[term] >> bit[state]) & 1) * 2
        key = treap.mask[square].astype(np.int64) * 4 + quarter
        first = treap.first[square]
        for out, step in ((left, 0), (right, 1)):
            place = _PLACE[key + step]
            there = np.flatnonzero(place >= 0)
            child = treap.child[first[there] + place[there]]
            # A square of one point belongs to one row; for the others it is empty.
            alone = np.flatnonzero(child <= -2)
            alien = treap.row[-2 - child[alone]] != rows[term[there[alone]]]
            child[alone[alien]] = _NONE
            out[at[there]] = child
    at = np.flatnonzero(flat <= -2)
    if len(at):
        half = (treap.column[-2 - flat[at]] >> bit[at // len(rows)]) & 1
        left[at[half == 0]] = flat[at[half == 0]]
        right[at[half == 1]] = flat[at[half == 1]]
    return left.reshape(nodes.shape), right.reshape(nodes.shape)


def _bounds(treap: Treap, nodes: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The states' weighted maxima; sums stay below 2 ** 53, so they are exact as doubles."""
    flat = nodes.ravel()
    value = np.zeros(len(flat))
    at = np.flatnonzero(flat >= 0)
    value[at] = treap.most[flat[at]]
    at = np.flatnonzero(flat <= -2)
    value[at] = treap.impact[-2 - flat[at]]
    return (value.reshape(nodes.shape) @ weights.astype(np.float64)).astype(np.int64)


class Shard:
    """Documents gathered until a treap is built over them."""

    def __init__(self) -> None:
        self.keys: list = []
        self.lengths: list[int] = []
        self.names: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.points = 0

    def add(self, key, words: list[bytes]) -> None:
        counts, names = Counter(words), self.names
        self.keys.append(key)
        self.lengths.append(len(words))
        rows = (names.setdefault(w, len(names)) for w in counts)
        self.rows.append(np.fromiter(rows, np.int32, len(counts)))
        self.counts.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.points += len(counts)

    @property
    def full(self) -> bool:
        return self.points >= SHARD_POINTS or len(self.keys) >= SHARD_DOCS

    def treap(self, n_docs: int, n_terms: int) -> tuple[Treap, dict[bytes, int]]:
        """The grid's treap and each term's row, given the corpus's documents and terms."""
        per = [len(r) for r in self.rows]
        rows, tf = np.concatenate(self.rows), np.concatenate(self.counts)
        columns = np.repeat(np.arange(len(per), dtype=np.int32), per)
        length = np.repeat(np.array(self.lengths, np.int64), per)
        m = 100 - 50 + 50 * length * n_docs // n_terms
        impacts = (1_000_000_000 * tf // (1_000 * tf + 20 * m)).astype(np.int32)
        frequent = np.argsort(-np.bincount(rows, minlength=len(self.names)), kind="stable")
        place = np.empty(len(frequent), np.int32)
        place[frequent] = np.arange(len(frequent), dtype=np.int32)
        named = {w: int(place[i]) for w, i in self.names.items()}
        return build(place[rows], columns, impacts), named


# ------------------------------------------------------------------- the corpus


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term, df, places``: documents that hold a term; in the row of the null term, documents
    with at least one term and the number of their terms. Written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        documents = places = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = terms(text)
                documents += bool(words)
                places += len(words)
                held.update(set(words))
                if len(held) >= _HELD:
                    yield from _counted(held)
                    held = Counter()
        yield from _counted(held)
        yield _count_batch([None], [documents], [places])

    found = docs.select(text_col).mapInArrow(count, "term string, df bigint, places bigint")
    summed = found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("places").alias("places"))
    return staged(summed, "term-counts")


def _counted(held: Counter) -> Iterator[pa.RecordBatch]:
    items = list(held.items())
    for at in range(0, len(items), 10_000):
        words, counts = zip(*items[at : at + 10_000], strict=True)
        yield _count_batch([w.decode() for w in words], counts, [0] * len(words))


def _count_batch(words, counts, places) -> pa.RecordBatch:
    arrays = [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(places, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["term", "df", "places"])


def weighted_queries(queries: DataFrame, counts: DataFrame, n_docs: int, id_col: str, text_col: str):
    """``query, term, w``: the distinct terms of each query that some document holds."""
    schema = T.StructType([id_field(queries, id_col), T.StructField("term", T.StringType())])

    def cut(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            for word in set(terms(text)):
                yield key, word.decode()

    named = map_rows(queries.select(id_col, text_col), cut, schema).distinct()
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    known = counts.where(F.col("term").isNotNull()).select("term", weight.alias("w"))
    return named.join(known, "term").where("w > 0").select(F.col(id_col).alias("query"), "term", "w")


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` best documents of each query, best first.

    Documents with a score of 0 are not returned. Equal scores rank by ascending id, null ids
    last; rows that share an id are documents of their own, in an order of their own. Rows of
    ``queries`` that share an id are one query of all their terms, null ids too. Null and empty
    texts have no terms: such a query has no rows, such a document is never found. Other columns
    are not looked at.
    """
    counts = term_counts(docs, text_col)
    totals = counts.where(F.col("term").isNull()).select("df", "places").first()
    n_docs, n_terms = (totals["df"], totals["places"]) if totals else (0, 0)
    out = T.StructType(
        [
            T.StructField("query", id_field(queries, query_id).dataType),
            T.StructField("doc", id_field(docs, id_col).dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    found = queries.sparkSession.createDataFrame([], out)
    if n_terms:
        wanted = staged(
            weighted_queries(queries, counts, n_docs, query_id, query_text), "query-terms"
        )
        for block in _blocks(wanted):
            part = _searched(docs.select(id_col, text_col), block, n_docs, n_terms, k, out)
            found = found.unionAll(_best(part, k))
    return _numbered(found, k).select(
        F.col("query").alias(query_id), "rank", F.col("doc").alias(id_col), "score"
    )


def _blocks(wanted: DataFrame) -> Iterator[dict]:
    """Queries with their terms' weights, in blocks of about ``BLOCK_TERMS`` terms."""
    blocks = max(1, -(-wanted.count() // BLOCK_TERMS))
    dealt = F.pmod(F.xxhash64("query"), F.lit(blocks))
    for block in range(blocks):
        queries: dict = {}
        for query, term, weight in wanted.where(dealt == block).collect():
            queries.setdefault(query, []).append((term.encode(), weight))
        if queries:
            yield queries


def _searched(docs, queries: dict, n_docs: int, n_terms: int, k: int, out: T.StructType):
    """Each task's ``k`` best documents for each query, over the shards that the task builds."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {query: [] for query in queries}
        shard = Shard()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = terms(text)
                if words:
                    shard.add(key, words)
                if shard.full:
                    _search_shard(shard, queries, n_docs, n_terms, k, best)
                    shard = Shard()
        if shard.keys:
            _search_shard(shard, queries, n_docs, n_terms, k, best)
        rows = [(q, key, score) for q, top in best.items() for score, key in top]
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000], strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.mapInArrow(run, out)


def _search_shard(shard: Shard, queries, n_docs, n_terms, k, best) -> None:
    treap, rows_of = shard.treap(n_docs, n_terms)
    for query, words in queries.items():
        known = [(rows_of[w], weight) for w, weight in words if w in rows_of]
        if not known:
            continue
        rows, weights = np.array(known, np.int64).T
        top = best[query]
        floor = top[-1][0] if len(top) == k else 1
        columns, scores = search(treap, rows, weights, k, floor)
        more = [(s, shard.keys[c]) for s, c in zip(scores.tolist(), columns.tolist(), strict=True)]
        merged = sorted(top + more, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        best[query] = merged[:k]


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query in each of some groups of rows, so that no query's rows of
    all tasks meet in one."""
    order = _order()
    group = F.pmod(F.xxhash64("doc"), F.lit(_GROUPS)).alias("group")
    first = Window.partitionBy("query", "group").orderBy(*order)
    ranked = found.select("*", group).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= k).select("query", "doc", "score")


def _numbered(found: DataFrame, k: int) -> DataFrame:
    last = Window.partitionBy("query").orderBy(*_order())
    return found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def _order():
    return F.col("score").desc(), F.col("doc").asc_nulls_last()
