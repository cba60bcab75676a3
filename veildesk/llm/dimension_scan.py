"""Nearest neighbours by an adaptive scan of dimensions over inverted lists.

Vectors are turned by a random rotation, so that any first dimensions are a fair sample of a
distance, and stored by list (nearest of some centres) in chunks of bounded size, each as blocks
of columns. A query scans the chunks of its nearest lists block by block: after ``d`` of ``D``
dimensions a candidate whose partial distance, scaled to ``D``, exceeds the best k-th distance by
more than chance allows is abandoned. What is left is measured exactly on the given vectors.

The home list is scanned first; the k-th distance found there is the bound for the others. How
many lists a query visits is set by a calibration: for a bounded number of queries the true
neighbours are found by brute force over all rows, and the lists visited are as many as cover
``COVERAGE`` of them.

A query visits many lists, so it is not sent to each of them: lists are dealt into groups, as many
as the cluster can use, and a query travels once to each group together with the lists it visits
there. What travels follows the queries, not the queries times the lists.

Equal vectors are one candidate with the smallest of their ids, and equal queries are searched
once, so a vector that makes up much of the table costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.staging import staged

K = 10
SEED = 42
#: Vectors that the centres are fitted on, and queries that set the number of lists.
SAMPLE, TRIALS = 16_384, 64
#: At most so many lists (their centres travel with the tasks); vectors and queries of a chunk.
MAX_LISTS, CHUNK, QUERY_BLOCK = 1_024, 512, 512
#: Groups of lists at least, where there are as many lists.
GROUPS = 64
#: Share of true neighbours whose lists are visited, and the test's width in deviations.
COVERAGE, WIDTH = 0.99, 2.6
#: Columns of a block.
BLOCK = 16
_ROUNDS = 12
_ROUNDING = 1e-3


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    normal = np.random.default_rng(seed).standard_normal((size, size))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Lloyd's centres of a sample; an empty one keeps its place."""
    chosen = np.random.default_rng(seed).choice(len(sample), lists, replace=False)
    centre = sample[chosen].copy()
    for _ in range(_ROUNDS):
        home = nearest_lists(sample, centre, 1)[:, 0]
        sums = np.zeros_like(centre)
        np.add.at(sums, home, sample)
        counts = np.bincount(home, minlength=lists)
        filled = counts > 0
        centre[filled] = sums[filled] / counts[filled, None]
    return centre


def nearest_lists(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first."""
    out = np.empty((len(x), n), np.int32)
    own = (centre**2).sum(1)
    for at in range(0, len(x), 4_096):
        far = own - 2 * (x[at : at + 4_096] @ centre.T)
        if n == 1:
            out[at : at + 4_096, 0] = far.argmin(1)
        else:
            out[at : at + 4_096] = np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


def column_blocks(turned: np.ndarray) -> bytes:
    """Rotated vectors as float32, columns of a block one after the other."""
    return np.ascontiguousarray(turned.T.astype("<f4")).tobytes()


def scan_chunk(
    queries: np.ndarray,
    turned: np.ndarray,
    bound: np.ndarray,
    columns: np.ndarray,
    vectors: np.ndarray,
    k: int,
    width: float = WIDTH,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, candidate, distance`` places: up to ``k`` for each query, none beyond its bound.

    ``turned`` are the rotated queries, ``columns`` the chunk's rotated columns (one row each),
    ``vectors`` its given vectors, ``bound`` a distance within which each query has ``k``
    candidates already, or infinity. Equal distances keep the earlier candidates.
    """
    size, n = columns.shape
    bound = bound.copy()
    open_bound = np.isinf(bound)
    if open_bound.any() and n > k:
        # Some candidates, measured in full, bound the others.
        first = columns[:, : max(4 * k, n // 8)]
        far = _squares(turned[open_bound], first)
        bound[open_bound] = np.sqrt(np.partition(far, k - 1, axis=1)[:, k - 1])
    # Columns are rounded to 32 bits, so what is as near as the bound may seem a little farther.
    limit = bound**2 * (1 + _ROUNDING) + _ROUNDING**3 * (queries**2).sum(1)
    partial = _squares(turned[:, :BLOCK], columns[:BLOCK])
    seen = min(BLOCK, size)
    q, c = np.nonzero(partial <= _allowed(limit, seen, size, width)[:, None])
    sums = partial[q, c]
    for at in range(BLOCK, size, BLOCK):
        part = columns[at : at + BLOCK]
        for row, column in enumerate(part):
            sums += (turned[q, at + row] - column[c]) ** 2
        seen += len(part)
        keep = sums <= _allowed(limit, seen, size, width)[q]
        q, c, sums = q[keep], c[keep], sums[keep]
    exact = np.sqrt(((queries[q] - vectors[c]) ** 2).sum(1))
    near = exact**2 <= limit[q]
    q, c, exact = q[near], c[near], exact[near]
    order = np.lexsort((c, exact, q))
    q, c, exact = q[order], c[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return q[best], c[best], exact[best]


def _squares(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
    columns = columns.astype(np.float64)
    far = (x**2).sum(1)[:, None] + (columns**2).sum(0) - 2 * (x @ columns)
    return np.maximum(far, 0)


def _allowed(limit: np.ndarray, seen: int, size: int, width: float) -> np.ndarray:
    """The largest partial squared distance that may still end within the limit."""
    if seen >= size:
        return limit  # the last test is the exact one
    return limit * (seen / size) * (1 + width / np.sqrt(seen)) ** 2


# ------------------------------------------------------------------------ the job


def usable(vector: Column) -> Column:
    """Not null, not all zero, no null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    some = F.exists(x, lambda v: F.coalesce(v != 0, F.lit(False)))
    return vector.isNotNull() & finite & some


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``node, vector, ids``: each distinct vector with its ``k + 1`` smallest ids, from distinct
    rows of ``id, vector``. Written once, which fixes the node numbers."""
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k + 1)
    kept = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return staged(
        kept.select(F.monotonically_increasing_id().alias("node"), "vector", "ids"), "vectors"
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` nearest rows found for each row that is a
    query, by Euclidean distance, nearest first, equal ones by ascending id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
    with a null id or of another length than most. Rows that share an id are never each other's
    neighbours; a row repeated with id and vector counts once, and a query id with several
    vectors takes the nearest of all of them. Fewer than ``k`` candidates are all returned; an
    empty table gives no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), "size").first()
    if common is None:
        empty = f"query_id {kind.simpleString()}, rank int, {id_col} {kind.simpleString()}, score double"
        return spark.createDataFrame([], empty)
    size = common["size"]
    rows = staged(rows.where(F.size("vector") == size).distinct(), "usable-vectors")
    nodes = distinct_vectors(rows.select("id", "vector").distinct(), k)
    asking = rows.where("asks").select(F.col("id").alias("query_id"), "vector")
    asking = staged(asking.join(nodes.select("node", "vector"), "vector").drop("vector"), "queries")
    index = Index(nodes, size, k)
    found = index.search(asking.select("node").distinct())
    return _expanded(found, nodes, asking, k).withColumnRenamed("id", id_col)


def _expanded(found: DataFrame, nodes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """Neighbouring vectors as rows: each query's own id left out, its ``k`` nearest ids."""
    near = found.join(nodes.select("node", "ids"), "node").select(
        "query", F.explode("ids").alias("id"), "score"
    )
    # One more than k vectors of k + 1 ids each: what reaches a query is bounded.
    order = F.array_sort(F.collect_list(F.struct("score", "id")))
    lists = near.groupBy(F.col("query").alias("node")).agg(order.alias("near"))
    other = asking.join(lists, "node").select("query_id", F.explode("near").alias("x"))
    other = other.select("query_id", "x.id", "x.score").where("id <> query_id")
    best = other.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return (
        best.withColumn("rank", rank).where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


class Index:
    """Chunks by list, written once; ``visits`` is the number of lists that a query scans."""

    def __init__(self, nodes: DataFrame, size: int, k: int = K) -> None:
        self.nodes, self.size, self.k = nodes, size, k
        # Floats take half the room of doubles and lose nothing.
        single = nodes.schema["vector"].dataType.elementType == T.FloatType()
        self.kind = "<f4" if single else "<f8"
        count = nodes.count()
        share = int(min(1.0, 1.1 * SAMPLE / max(1, count)) * (1 << 31))
        drawn = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 31)) < share)
        sample = np.array(
            [r["vector"] for r in drawn.select("vector").limit(SAMPLE).collect()], np.float64
        ).reshape(-1, size)
        lists = max(1, min(MAX_LISTS, round(count**0.5), len(sample) // 8))
        self.turn = rotation(size)
        self.centre = centres(sample @ self.turn, lists) if len(sample) else np.zeros((1, size))
        groups = max(GROUPS, 2 * nodes.sparkSession.sparkContext.defaultParallelism)
        #: Lists of a group, which have consecutive numbers.
        self.together = -(-len(self.centre) // groups)
        self.chunks = self._chunks()
        self.visits = self._calibrated(sample[:TRIALS])

    def _chunks(self) -> DataFrame:
        turn, centre, kind = self.turn, self.centre, self.kind

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1))
                home = nearest_lists(x @ turn, centre, 1)[:, 0] if len(x) else np.empty(0, np.int32)
                arrays = [pa.array(home, pa.int32()), batch.column(0), batch.column(2), batch.column(1)]
                yield pa.RecordBatch.from_arrays(arrays, ["list", "node", "least", "vector"])

        kinds = self.nodes.select("node", F.get("ids", F.lit(0)).alias("least"), "vector").schema
        schema = T.StructType(
            [T.StructField("list", T.IntegerType()), kinds["node"], kinds["least"], kinds["vector"]]
        )
        taken = self.nodes.select("node", "vector", F.get("ids", F.lit(0)).alias("least"))
        placed = staged(taken.mapInArrow(place, schema), "placed-vectors")
        counts = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}
        pieces = F.array(*[F.lit(-(-counts.get(i, 1) // CHUNK)) for i in range(len(centre))])
        dealt = placed.withColumn(
            "piece", F.pmod(F.xxhash64("node"), F.get(pieces, F.col("list")).cast("long"))
        )

        def pack(group: pa.Table) -> pa.Table:
            group = group.sort_by("least")
            vectors = _matrix(group.column("vector").combine_chunks())
            return pa.table(
                {
                    "list": pa.array([group.column("list")[0].as_py()], pa.int32()),
                    "nodes": pa.array([group.column("node").to_numpy().astype("<i8").tobytes()]),
                    "columns": pa.array([column_blocks(vectors @ turn)]),
                    "vectors": pa.array([vectors.astype(kind).tobytes()]),
                }
            )

        packed = dealt.groupBy("list", "piece").applyInArrow(
            pack, "list int, nodes binary, columns binary, vectors binary"
        )
        return staged(packed, "index-chunks")

    def _calibrated(self, trials: np.ndarray) -> int:
        """Lists to visit, from the true neighbours of the trial vectors among all rows."""
        if not len(trials):
            return 1
        k, size, kind = self.k, self.size, self.kind

        def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            far = np.full((len(trials), 0), np.inf)
            home = np.zeros((len(trials), 0), np.int32)
            for batch in batches:
                for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    here = _squares(trials, np.frombuffer(packed, kind).reshape(-1, size).T)
                    far = np.hstack((far, here))
                    home = np.hstack((home, np.full(here.shape, number, np.int32)))
                    best = np.argsort(far, axis=1, kind="stable")[:, : k + 1]
                    far = np.take_along_axis(far, best, 1)
                    home = np.take_along_axis(home, best, 1)
            trial = np.repeat(np.arange(len(trials)), far.shape[1])
            arrays = [pa.array(trial, pa.int32()), pa.array(far.ravel()), pa.array(home.ravel(), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["trial", "far", "list"])

        near = self.chunks.select("list", "vectors").mapInArrow(brute, "trial int, far double, list int")
        place = F.row_number().over(Window.partitionBy("trial").orderBy("far", "list"))
        rows = near.withColumn("place", place).where(F.col("place") <= k + 1).collect()
        order = nearest_lists(trials @ self.turn, self.centre, len(self.centre))
        where = np.argsort(order, axis=1)
        ranks = np.sort([where[r["trial"], r["list"]] for r in rows])
        return int(ranks[min(len(ranks) - 1, int(np.ceil(COVERAGE * len(ranks))) - 1)]) + 1

    def search(self, asking: DataFrame) -> DataFrame:
        """``query, node, score``: the ``k + 1`` nearest vectors of each node in ``asking``, its
        own among them."""
        queries = staged(
            asking.join(self.nodes, "node").select(
                "node", "vector", F.lit(float("inf")).alias("bound")
            ),
            "query-vectors",
        )
        home = staged(self._best(self._scan(queries, 0, 1)), "home-neighbours")
        if self.visits < 2:
            return home
        full = home.groupBy(F.col("query").alias("node")).agg(
            F.count("*").alias("n"), F.max("score").alias("far")
        )
        bound = F.when(F.col("n") > self.k, F.col("far")).otherwise(float("inf"))
        bounded = queries.drop("bound").join(full, "node").select("node", "vector", bound.alias("bound"))
        more = self._scan(bounded, 1, self.visits)
        return staged(self._best(home.unionAll(more)), "neighbours")

    def _best(self, found: DataFrame) -> DataFrame:
        least = self.nodes.select("node", F.get("ids", F.lit(0)).alias("least"))
        order = Window.partitionBy("query").orderBy("score", "least")
        named = found.join(least, "node").withColumn("place", F.row_number().over(order))
        return named.where(F.col("place") <= self.k + 1).select("query", "node", "score")

    def _scan(self, queries: DataFrame, first: int, last: int) -> DataFrame:
        """Candidates of the queries in their nearest lists ``first`` to ``last - 1``."""
        turn, centre, size, k = self.turn, self.centre, self.size, self.k + 1
        kind, together = self.kind, self.together

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, bounds = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                x = _matrix(batch.column(1))
                if not len(x):
                    continue
                order = nearest_lists(x @ turn, centre, last)[:, first:]
                visited = np.zeros((len(x), -(-len(centre) // together) * together), bool)
                np.put_along_axis(visited, order.astype(np.int64), True, 1)
                for group in range(visited.shape[1] // together):
                    lists = visited[:, group * together : (group + 1) * together]
                    here = np.flatnonzero(lists.any(1))
                    for at in range(0, len(here), QUERY_BLOCK):
                        some = here[at : at + QUERY_BLOCK]
                        parts = (
                            names[some].astype("<i8"), x[some].astype(kind),
                            bounds[some].astype("<f8"), lists[some],
                        )
                        arrays = [pa.array([group], pa.int32()), *(pa.array([p.tobytes()]) for p in parts)]
                        yield pa.RecordBatch.from_arrays(arrays, ["group", "asked", "points", "bounds", "lists"])

        blocks = queries.select("node", "vector", "bound").mapInArrow(
            route, "group int, asked binary, points binary, bounds binary, lists binary"
        )
        # Spark takes the blocks for little more than the queries they are made from and would
        # broadcast them; they are many times that.
        grouped = self.chunks.withColumn("group", F.floor(F.col("list") / together).cast("int"))
        met = grouped.join(blocks.hint("merge"), "group")

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = (batch.column(i) for i in range(8))
                for asked, points, bounds, lists, number, nodes, packed, vectors in zip(*columns, strict=True):
                    visits = np.frombuffer(lists.as_py(), bool).reshape(-1, together)
                    here = np.flatnonzero(visits[:, number.as_py() % together])
                    if not len(here):
                        continue
                    x = np.frombuffer(points.as_py(), kind).reshape(-1, size)[here].astype(np.float64)
                    given = np.frombuffer(vectors.as_py(), kind).reshape(-1, size)
                    turned = np.frombuffer(packed.as_py(), "<f4").reshape(size, -1)
                    q, c, far = scan_chunk(
                        x, x @ turn, np.frombuffer(bounds.as_py())[here], turned, given, k
                    )
                    names = np.frombuffer(asked.as_py(), "<i8")[here][q]
                    arrays = [pa.array(names), pa.array(np.frombuffer(nodes.as_py(), "<i8")[c]), pa.array(far)]
                    yield pa.RecordBatch.from_arrays(arrays, ["query", "node", "score"])

        met = met.select("asked", "points", "bounds", "lists", "list", "nodes", "columns", "vectors")
        return met.mapInArrow(scan, "query bigint, node bigint, score double")


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrow lists of one length as float64 rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
