"""SimHash near-duplicates, found through vantage-point trees over Hamming distance.

Two fingerprints of 64 bits that differ in at most ``radius`` bits differ in at most
``radius // 2`` bits of their low or of their high half. For each half a vantage-point tree,
grown from a bounded sample, cuts the half codes into shards: a node sends codes within its
radius of its vantage point one way, the others the other way. A fingerprint lives in one
shard and, by the triangle bound, also visits every shard whose boundary is within reach, so
that each close pair meets in some shard. Inside a shard the tree goes on over the shard's own
codes until few are left, and those are compared bit by bit, so the links are exact.

A shard returns, for each of its linked groups, edges to the group's smallest member, never
all pairs. A star contraction over the shared folder joins these into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import fresh, id_field, map_rows
from veildesk.staging import staged

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints a tree is grown from; the sample fixes the shards' shape, never the result.
TREE_SAMPLE = 32_768
#: Fingerprints a shard should hold; together with the sample's size it bounds the tree.
SHARD = 4_096
_HALVES = (0, 32)
_BLOCK = 1 << 22


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles, repeats included, as an unsigned number.

    A-Z are lower-cased and words are cut at ASCII white space. A text of fewer words than a
    shingle is one shingle, a text without words has fingerprint 0.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), 65_536):
        pairs = zip(first[at : at + 65_536], last[at : at + 65_536], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col, fp`` (the bits as a signed long) for every document, rows as they come."""
    fields = [id_field(docs, c) for c in (id_col, *keep)]
    schema = T.StructType([*fields, T.StructField("fp", T.LongType())])

    def rows(texts: list, *columns: list) -> Iterator[tuple]:
        for text, *rest in zip(texts, *columns, strict=True):
            value = fingerprint(text)
            yield (*rest, value - (1 << 64) if value >> 63 else value)

    return map_rows(docs.select(text_col, id_col, *keep), rows, schema)


class VantageTree:
    """Top of a vantage-point tree over half codes; ``shards`` of it are the leaves."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.vantage: list[int] = []
        self.bound: list[int] = []
        self.children: list[tuple[int, int]] = []
        self.shards = 0
        self._grow(sample.astype(np.uint32), max(1, shards))

    def _grow(self, codes: np.ndarray, shards: int) -> int:
        """Number of the node, negative for a shard."""
        cut = _cut(codes) if shards > 1 else None
        if cut is None:
            self.shards += 1
            return -self.shards
        vantage, bound, near = cut
        node = len(self.vantage)
        self.vantage.append(vantage)
        self.bound.append(bound)
        self.children.append((0, 0))
        inside = self._grow(codes[near], shards - shards // 2)
        self.children[node] = (inside, self._grow(codes[~near], shards // 2))
        return node

    def route(self, codes: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``shard, members, at_home``: places of the codes that live in or visit each shard."""
        root = 0 if self.vantage else -1
        todo = [(root, np.arange(len(codes)), np.ones(len(codes), bool))]
        while todo:
            node, places, home = todo.pop()
            if not len(places):
                continue
            if node < 0:
                yield -node - 1, places, home
                continue
            distance = np.bitwise_count(codes[places] ^ np.uint32(self.vantage[node]))
            distance = distance.astype(np.int32)
            bound, (inside, outside) = self.bound[node], self.children[node]
            near = distance - reach <= bound
            far = distance + reach > bound
            todo.append((inside, places[near], home[near] & (distance[near] <= bound)))
            todo.append((outside, places[far], home[far] & (distance[far] > bound)))


def _cut(codes: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """A vantage point, the radius that halves the codes best, and who is inside; or None.

    The radius is tried at the quartiles too, as distances lie close together; the point is the
    one, of a few spread over the codes, that leaves the fewest codes near its boundary.
    """
    best = None
    for vantage in codes[:: max(1, len(codes) // 8)][:8]:
        distance = np.bitwise_count(codes ^ vantage).astype(np.int32)
        middle = int(np.median(distance))
        for bound in (middle - 1, middle):
            near = distance <= bound
            inside = int(near.sum())
            if not 0 < inside < len(codes):
                continue
            crossing = int((np.abs(2 * distance - 2 * bound - 1) <= 2).sum())
            cost = crossing + 2 * abs(2 * inside - len(codes))
            if best is None or cost < best[0]:
                best = cost, int(vantage), bound, near
    return best and best[1:]


def _half(fps: np.ndarray, shift: int) -> np.ndarray:
    return (fps >> np.uint64(shift)).astype(np.uint32)


def shard_links(live: np.ndarray, visit: np.ndarray, shift: int, radius: int = RADIUS):
    """Edges ``(member, smallest member)`` of the linked groups in one shard.

    ``live`` are the fingerprints of the shard, ``visit`` those that only reach into it. Codes
    are split by vantage points of their own, visitors going down every branch they reach; what
    is small enough, or cannot be split, is compared in blocks of bounded size.
    """
    fps = np.concatenate((live, visit))
    label = np.arange(len(fps))
    todo = [(np.arange(len(live)), np.arange(len(live), len(fps)))]
    while todo:
        home, guests = todo.pop()
        if not len(home):
            continue
        both = np.concatenate((home, guests))
        codes = _half(fps[home], shift)
        cut = _cut(codes) if len(home) > 512 else None
        if cut is None:
            _compare(fps, home, both, label, radius)
            continue
        vantage, bound, near = cut
        # Homes that reach over the boundary visit the outside, as guests do.
        reach = radius // 2
        distance = np.bitwise_count(_half(fps[both], shift) ^ np.uint32(vantage)).astype(np.int32)
        lives = np.arange(len(both)) < len(home)
        inside = distance <= bound
        todo.append((home[near], both[~lives & (distance - reach <= bound)]))
        over = (lives & inside | ~lives) & (distance + reach > bound)
        todo.append((home[~near], both[over]))
    root = _roots(label)
    members = np.flatnonzero(root != np.arange(len(fps)))
    smallest = fps.copy()
    np.minimum.at(smallest, root, fps)
    linked = np.union1d(members, root[members])
    edges = linked[fps[linked] != smallest[root[linked]]]
    return fps[edges], smallest[root[edges]]


def _compare(fps, home, both, label, radius) -> None:
    """Join the labels of all pairs of a home and anyone within ``radius`` bits."""
    step = max(1, _BLOCK // max(1, len(both)))
    codes = fps[both]
    for at in range(0, len(home), step):
        rows = home[at : at + step]
        close = np.bitwise_count(fps[rows][:, None] ^ codes[None, :]) <= radius
        i, j = np.nonzero(close)
        a, b = rows[i], both[j]
        other = a != b
        _unite(label, a[other], b[other])


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by smallest label, vectorised: hook roots to smaller roots until none differs."""
    while len(a):
        ra, rb = _find(label, a), _find(label, b)
        differ = ra != rb
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def _find(label: np.ndarray, places: np.ndarray) -> np.ndarray:
    root = label[places]
    while True:
        above = label[root]
        if np.array_equal(above, root):
            return root
        root = above


def _roots(label: np.ndarray) -> np.ndarray:
    return _find(label, np.arange(len(label)))


def links(fps: DataFrame, radius: int = RADIUS, sample: int = TREE_SAMPLE, shard: int = SHARD):
    """``a, b``: edges that connect exactly the fingerprints linked within ``radius`` bits.

    ``fps`` has distinct fingerprints ``fp``. Only the bounded sample reaches the driver.
    """
    if radius > 3:
        raise ValueError("two halves need a radius of 3 or less")
    count = fps.count()
    # A share of the fingerprints by hash, about ``sample`` of them; the limit is the bound.
    share = int(min(1.0, sample / max(1, count)) * (1 << 31))
    some = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 31)) < share).limit(2 * sample)
    drawn = np.array(sorted(r["fp"] for r in some.collect()), np.int64).view(np.uint64)
    drawn = drawn[np.argsort(drawn * np.uint64(0x9E3779B97F4A7C15), kind="stable")]
    shards = min(-(-count // shard), max(1, sample // 8))
    trees = [VantageTree(_half(drawn, shift), shards) for shift in _HALVES]
    routed = "half:int,shard:int,home:boolean,fp:bigint"
    schema = T._parse_datatype_string(f"struct<{routed}>")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signed = batch["fp"].to_numpy()
            codes = signed.view(np.uint64)
            for half, (shift, tree) in enumerate(zip(_HALVES, trees, strict=True)):
                parts = list(tree.route(_half(codes, shift), radius // 2))
                own = np.empty(len(codes), np.int64)
                for number, places, home in parts:
                    own[places[home]] = number
                for number, places, home in parts:
                    # A pair between two shards needs to meet in one of them only.
                    take = home | (number < own[places])
                    yield pd.DataFrame(
                        {
                            "half": half,
                            "shard": number,
                            "home": home[take],
                            "fp": signed[places[take]],
                        }
                    )

    def link(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().view(np.uint64)
        home = group["home"].to_numpy()
        shift = _HALVES[int(group["half"].iloc[0])] if len(group) else 0
        a, b = shard_links(values[home], values[~home], shift, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (
        fps.select("fp")
        .mapInPandas(place, schema)
        .groupBy("half", "shard")
        .applyInPandas(link, "a bigint, b bigint")
        .distinct()
    )


def star_forest(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not its component's smallest, by star contraction.

    Each round hooks larger neighbours to a node's smallest neighbour and then smaller ones,
    until every edge leads from a member to its root. Rounds are written to the shared folder.
    """
    edges = staged(edges.where("a <> b").select("a", "b"), "links")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ).distinct()
        large = staged(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("b", "low").where("b <> low")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(small.unionAll(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        roles = roles.unionAll(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        open_nodes = (
            roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        ).where("up > 1 or (up > 0 and down > 0)")
        if open_nodes.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(fps: DataFrame, smallest: Column, radius: int = RADIUS) -> DataFrame:
    """``fp, best``: for each fingerprint the least ``smallest`` in its component."""
    per = staged(fps.groupBy("fp").agg(F.min(smallest).alias("best")), "fingerprints")
    roots = star_forest(links(per, radius))
    rooted = per.join(roots, per["fp"] == roots["node"], "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("best").alias("least"))
    return rooted.join(best, "root").select("fp", F.col("least").alias("best"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint, component_id``, one row for each row of ``docs``.

    ``component_id`` is the smallest non-null id reachable through links of 3 or fewer
    differing bits, the row's own included; null only if the whole component has null ids.
    Null and empty texts, and texts of white space, have fingerprint 0 and link like others.
    Repeated rows and ids stay and share a component if their texts link.
    """
    fps = staged(fingerprints(docs, id_col, text_col), "document-fingerprints")
    found = components(fps, F.col(id_col))
    return fps.join(found, "fp").select(
        id_col,
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("best").alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, all its columns: the one with the smallest id.

    Null ids come last; of rows that share the id an arbitrary one stays, the same at each
    later read. The documents are written once with a row number, which the choice refers to.
    """
    row, fp = fresh(docs, "_row", "_fp")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    fps = staged(
        fingerprints(numbered, id_col, text_col, (row,)).withColumnRenamed("fp", fp),
        "document-fingerprints",
    )
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row).alias("row"))
    found = components(fps.withColumnRenamed(fp, "fp"), order)
    keep = staged(found.select(F.col("best.row").alias(row)).distinct(), "kept-rows")
    # A number per kept document grows with the documents, so it is never broadcast; hashing
    # the numbers spares a sort of the texts.
    return numbered.join(keep.hint("shuffle_hash"), row, "left_semi").drop(row)
