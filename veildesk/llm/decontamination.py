"""Benchmark decontamination as a prefix-filtered set join.

Each item gives windows of ``width`` consecutive words (a shorter item is one window). To hold
a window a document must hold all its words, so the necessary prefix, in order of rarity, is
one word: the window's rarest in the corpus, its anchor. Documents give their occurrences of
anchors with the words around them, and an equi-join on the anchor finds the windows that may
stand there. The positional bound (anchor's place in the window against the words that are
there) and the length bound are checked before the words themselves are compared, exactly.

What tasks know of the anchors is a bitmap of fixed size, so nothing broadcast grows with the
benchmark; a word that only collides in it is dropped by the join. Documents are processed as
whole texts; a text that occurs many times yields the same candidates, which are joined once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import ascii_words, fresh, id_field, map_rows, text_hash
from veildesk.staging import staged

WIDTH = 10
#: Slots of the anchor bitmap: 2**22 bits are 512 KB whatever the benchmark's size.
SLOTS = 1 << 22
_BITMAP = 4096
WORDS = "[^0-9a-z\\x80-\\x{10FFFF}]+"


def words_column(text: Column) -> Column:
    """The same words as ``ascii_words``, as an array in the JVM; null has none."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), WORDS, -1), lambda w: w != "")


def windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``item, window`` (array of words), distinct."""
    words = items.select(F.col(id_col).alias("item"), words_column(F.col(text_col)).alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item", F.slice("words", F.col("at") + 1, F.lit(width)).alias("window"))
        .distinct()
    )


def bitmap(words: DataFrame, column: str, slots: int = SLOTS) -> bytes:
    """A bit per slot, set where a word's crc32 falls. Its size depends on ``slots`` alone."""
    slot = F.crc32(F.col(column).cast("binary")) % slots + 1
    parts = (
        words.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()  # at most slots / 32768 rows of 4096 bytes
    )
    whole = bytearray(max(slots // 8, _BITMAP))
    for part in parts:
        start = (part["bucket"] - 1) * _BITMAP
        whole[start : start + _BITMAP] = part["bits"]
    return bytes(whole)


def marked(words: list[bytes], bits: bytes, slots: int) -> list[int]:
    """Places of the words whose bit is set."""
    crc = zlib.crc32
    slot = [crc(w) % slots for w in words]
    return [i for i, s in enumerate(slot) if bits[s >> 3] >> (s & 7) & 1]


def corpus_counts(docs: DataFrame, text_col: str, vocabulary: DataFrame, slots: int) -> DataFrame:
    """``word, count`` over all documents, for words of the vocabulary (and some others)."""
    bits = bitmap(vocabulary, "word", slots)
    schema = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("count", T.LongType())]
    )

    def rows(texts: list) -> Iterator[tuple]:
        counts: Counter[bytes] = Counter()
        for text in texts:
            words = ascii_words(text)
            counts.update([words[i] for i in marked(words, bits, slots)])
        for word, count in counts.items():
            yield word.decode(), count

    partial = map_rows(docs.select(text_col), rows, schema)
    return partial.groupBy("word").agg(F.sum("count").alias("count"))


def anchored(docs: DataFrame, text_col: str, cut: DataFrame, slots: int) -> DataFrame:
    """``window, n, anchor, offset``: each distinct window with its rarest word.

    Ties go to the word that sorts first; of equal words in a window the first is the anchor.
    """
    distinct = cut.select("window").distinct()
    word = distinct.select("window", F.explode("window").alias("word"))
    vocabulary = staged(word.select("word").distinct(), "benchmark-words")
    counts = corpus_counts(docs, text_col, vocabulary, slots)
    ranked = (
        word.join(counts, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), F.col("word"))).alias("rarest"))
    )
    return ranked.select(
        F.array_join("window", " ").alias("window"),
        F.size("window").alias("n"),
        F.col("rarest.word").alias("anchor"),
        (F.array_position("window", F.col("rarest.word")) - 1).cast("int").alias("offset"),
    )


def candidates(
    docs: DataFrame, anchors: DataFrame, id_col: str, text_col: str, width: int, slots: int
) -> DataFrame:
    """Per document its text hash, id, ``n_words`` and the marked words with their neighbours."""
    bits = bitmap(anchors, "anchor", slots)
    spot = "array<struct<at:int,left:int,word:string,around:string>>"
    schema = T.StructType(
        [
            T.StructField("text_hash", T.BinaryType()),
            id_field(docs, id_col),
            T.StructField("n_words", T.LongType()),
            T.StructField("spots", T._parse_datatype_string(spot)),
        ]
    )

    def rows(hashes: list, ids: list, texts: list) -> Iterator[tuple]:
        for digest, key, text in zip(hashes, ids, texts, strict=True):
            words = ascii_words(text)
            spots = []
            for at in marked(words, bits, slots):
                low = max(0, at - width + 1)
                spots.append(
                    {
                        "at": at,
                        "left": at - low,
                        "word": words[at].decode(),
                        "around": b" ".join(words[low : at + width]).decode(),
                    }
                )
            yield digest, key, len(words), spots

    hashed = docs.select(text_hash(F.col(text_col)).alias("text_hash"), id_col, text_col)
    return map_rows(hashed, rows, schema)


def hits(spots: DataFrame, anchors: DataFrame) -> DataFrame:
    """``text_hash, start, n, window``: every occurrence of a window, words compared exactly."""
    spot = spots.where(F.size("spots") > 0).select("text_hash", F.inline("spots"))
    around = F.split("around", " ")
    first = F.col("left") - F.col("offset") + 1
    return (
        spot.join(anchors, spot["word"] == anchors["anchor"])
        .where((F.col("left") >= F.col("offset")) & (F.size(around) >= first + F.col("n") - 1))
        .where(F.array_join(F.slice(around, first, F.col("n")), " ") == F.col("window"))
        .select("text_hash", (F.col("at") - F.col("offset")).alias("start"), "n", "window")
    )


def covered(spans: Column) -> Column:
    """Words inside the union of ``struct<start,n>`` spans sorted by start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        new = F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))
        return F.struct(
            F.greatest(acc["end"], end).alias("end"), (acc["total"] + new).alias("total")
        )

    return F.aggregate(spans, begin, add, lambda acc: acc["total"])


def _found(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str,
    item_text_col: str, width: int, slots: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    cut = staged(windows(benchmark, item_col, item_text_col, width), "benchmark-windows")
    anchors = staged(anchored(docs, text_col, cut, slots), "benchmark-anchors")
    spots = staged(candidates(docs, anchors, id_col, text_col, width, slots), "anchor-spots")
    return cut, spots, hits(spots, anchors)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per document: ``n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the document's words inside any occurrence of a window. A null or empty
    text has no words, an empty benchmark hits nothing. Rows are kept as they come; repeated
    and null ids get the verdict of their text. An item without an id still hits words, but is
    not counted among the items; rows that share an item id are one item.
    """
    cut, spots, found = _found(
        docs, benchmark, id_col, text_col, item_col, item_text_col, width, slots
    )
    found = staged(found.distinct(), "window-hits")
    words = found.groupBy("text_hash").agg(
        covered(F.sort_array(F.collect_set(F.struct("start", "n")))).alias("n_hit")
    )
    # Rows a text gets here are the items it holds, which the digest has to list.
    named = cut.where(F.col("item").isNotNull()).select(
        F.array_join("window", " ").alias("window"), F.col("item").cast("string").alias("item")
    )
    items = (
        found.select("text_hash", "window").distinct().join(named, "window")
        .groupBy("text_hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(
            "text_hash",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )
    verdicts = words.join(items, "text_hash", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    nothing = F.sha2(F.lit(""), 256)
    return spots.drop("spots").join(verdicts, "text_hash", "left").select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", nothing).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    slots: int = SLOTS,
) -> DataFrame:
    """The documents, all columns, that hold no window of any item.

    Null and empty texts hold none and stay; rows with equal texts stay or go together; empty
    tables, and benchmarks without words, take nothing away.
    """
    id_col = next((c for c in docs.columns if c != text_col), None)
    named = docs
    if id_col is None:  # a table of texts alone
        id_col = "_id"
        named = docs.withColumn(id_col, F.lit(0))
    _, _, found = _found(named, benchmark, id_col, text_col, item_col, item_text_col, width, slots)
    (key,) = fresh(docs, "_text_hash")
    bad = staged(found.select(F.col("text_hash").alias(key)).distinct(), "contaminated-texts")
    return docs.withColumn(key, text_hash(F.col(text_col))).join(bad, key, "left_anti").drop(key)
