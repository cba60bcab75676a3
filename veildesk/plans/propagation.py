"""Redact a value everywhere in a scope once it was detected anywhere in that scope.

A scope is a conversation, a ticket, a customer or the whole data set. The values become keys:
each value is its own words plus the punctuation around them, so an occurrence starts at a
word equal to the value's first word. A Bloom filter of these first words, of bounded size, tells which
words of a text may begin a value before any of them is shuffled; those are joined with the first
words, the candidate pieces are put together from the words and gaps that follow, and an equi-join on
(scope, piece) keeps the real ones. No value meets a text it does not occur in, no group is
ever gathered in one place, and the work on a text is linear in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.functions.patterns import blocks_of, running_totals
from veildesk.functions.spans import known_values
from veildesk.functions.text import WORD, let
from veildesk.schemas import SPANS
from veildesk.staging import staged

_CELL = ("record", "cell")
# Of the Bloom filter of first words: 8 KB at least, 4 MB at most.
_LEAST_BITS, _MOST_BITS, _HASHES = 1 << 16, 1 << 25, 4


def scope_values(hits: DataFrame) -> DataFrame:
    """Distinct (scope, value, type) to search for; the first type seen wins.

    ``hits`` has columns ``record, scope, cell, text, spans``.
    """
    return (
        hits.select(
            "record", "scope", "cell", F.posexplode(known_values(F.col("text"), F.col("spans")))
        )
        .select("scope", "col.value", "col.type", F.struct("record", "cell", "pos").alias("seen"))
        .groupBy("scope", "value")
        .agg(F.min_by("type", "seen").alias("type"))
    )


def propagate(cells: DataFrame, values: DataFrame) -> DataFrame:
    """Spans of known values: ``record, cell, text, spans``, only cells with a span.

    ``cells`` has columns ``record, scope, cell, text``, and others, which stay; a record is best
    a number. ``values`` is ``scope_values``; it is written once.
    """
    word, gap = f"[{WORD}]++", f"[^{WORD}]*+"
    values = staged(values, "known-values")
    shaped = values.select(
        "scope",
        "value",
        "type",
        F.length(F.regexp_extract("value", f"\\A({gap})", 1)).alias("lead"),
        F.length(F.regexp_extract("value", f"([^{WORD}]*)\\z", 1)).alias("tail"),
        F.regexp_extract_all("value", F.lit(f"({word})")).alias("words"),
    ).withColumns({"word": F.col("words")[0], "n_words": F.size("words")})
    anchors = shaped.select("scope", "word", "lead", "tail", "n_words").distinct()

    searched = cells.join(values.select("scope").distinct(), "scope", "left_semi").select(
        "scope",
        *_CELL,
        F.regexp_extract_all("text", F.lit(f"({word})")).alias("words"),
        F.split("text", word, -1).alias("gaps"),
    )
    starts = (
        first_words(searched, anchors)
        .join(anchors, ["scope", "word"])
        .groupBy(*_CELL)
        .agg(F.collect_set(F.struct("at", "lead", "tail", "n_words")).alias("starts"))
    )
    found = (
        searched.join(starts, list(_CELL))
        .select("scope", *_CELL, F.explode(_candidates()).alias("c"))
        .select("scope", *_CELL, "c.*")
        .join(shaped.select("scope", "value", "type"), ["scope", "value"])
        .groupBy(*_CELL)
        .agg(F.collect_set(F.struct("start", "end", "type")).alias("found"))
        .select(*_CELL, leftmost_longest(F.col("found")).alias("spans"))
    )
    return cells.join(found, list(_CELL)).drop("scope")


def first_words(searched: DataFrame, anchors: DataFrame) -> DataFrame:
    """``scope, record, cell, at, word``: words of the texts that may begin a value.

    A Bloom filter of (scope, first word), at least 32 bits a word up to ``_MOST_BITS``, tells
    them from the others inside the scan; about one other in 5,000 passes. Beyond that size more
    of them do, and the join drops them as ever.
    """
    wanted = 32 * max(1, anchors.count())
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << (wanted - 1).bit_length()))
    places = F.transform(
        F.sequence(F.lit(0), F.lit(_HASHES - 1)), lambda k: _place(F.col("_hash"), k, bits)
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    hashes = anchors.select(F.xxhash64("scope", "word").alias("_hash")).distinct()
    set_bits = (
        hashes.select(F.explode(places).alias("place"))
        .groupBy(F.floor(F.col("place") / 64).alias("id"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    spark = searched.sparkSession
    every = spark.range(bits // 64).join(set_bits, "id", "left")
    rows = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    bitmap = staged(every.agg(rows["bits"].alias("bitmap")), "first-words").scalar()

    placed = searched.select("scope", *_CELL, F.posexplode("words").alias("at", "word"))
    placed = placed.withColumn("_hash", F.xxhash64("scope", "word"))
    held = F.lit(True)
    for k in range(_HASHES):
        place = _place(F.col("_hash"), F.lit(k), bits)
        word = F.get(bitmap, F.floor(place / 64).cast("int"))
        held = held & (F.getbit(word, (place % 64).cast("int")) == 1)
    return placed.where(held).drop("_hash")


def _place(hashed: Column, k: Column, bits: int) -> Column:
    """The ``k``-th bit of a hash, ``bits`` a power of two."""
    low, high = hashed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(hashed, 32)
    return (low + k * high).bitwiseAND(F.lit(bits - 1))


def _candidates() -> Column:
    """Pieces of the text ``struct<start,end,value>`` that begin and end outside a word.

    ``gaps`` stand around the ``words``: gap 0, word 0, gap 1, and so on to the last gap.
    """
    words, gaps = F.col("words"), F.col("gaps")
    before = F.concat(F.array(F.lit("")), words)
    starts = running_totals(F.zip_with(gaps, before, lambda g, w: F.length(g) + F.length(w)))

    def candidate(s: Column, at: Column) -> Column:
        n, lead, tail = s["n_words"], s["lead"], s["tail"]
        first, last = F.get(gaps, s["at"]), F.get(gaps, s["at"] + n)
        # Each word but the first with the gap before it.
        inner = F.zip_with(
            F.slice(words, s["at"] + 1, n),
            F.concat(F.array(F.lit("")), F.slice(gaps, s["at"] + 2, n - 1)),
            lambda w, g: F.concat(g, w),
        )
        value = F.concat(
            F.when(lead > 0, F.right(first, lead)).otherwise(""),
            F.array_join(inner, ""),
            F.left(last, tail),
        )
        start = F.get(at, s["at"]) - lead
        # A neighbouring word touches the piece if the piece uses up the gap between them.
        free = ((lead < F.length(first)) | ((s["at"] == 0) & (lead == F.length(first)))) & (
            (tail < F.length(last)) | ((s["at"] + n == F.size(words)) & (tail == F.length(last)))
        )
        fits = (s["at"] + n <= F.size(words)) & free
        return F.when(
            fits,
            F.struct(
                start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value")
            ),
        )

    return let(
        starts,
        lambda at: F.filter(
            F.transform("starts", lambda s: candidate(s, at)), lambda c: c.isNotNull()
        ),
    )


def leftmost_longest(found: Column) -> Column:
    """Occurrences in reading order, the longest at each place, none overlapping."""
    ordered = F.array_sort(
        F.transform(
            found,
            lambda f: F.struct(
                f["start"].alias("start"), (-f["end"]).alias("back"), f["type"].alias("type")
            ),
        )
    )
    none = F.array().cast(SPANS)

    def take(acc: Column, f: Column) -> Column:
        hit = F.struct(f["start"].alias("start"), (-f["back"]).alias("end"), f["type"])
        fits = f["start"] >= acc["free"]
        return F.struct(
            F.when(fits, -f["back"]).otherwise(acc["free"]).alias("free"),
            F.when(fits, F.concat(acc["taken"], F.array(hit))).otherwise(acc["taken"]).alias("taken"),
        )

    def take_block(acc: Column, block: Column) -> Column:
        begin = F.struct(acc["free"].alias("free"), none.alias("taken"))
        return let(
            F.aggregate(block, begin, take),
            lambda done: F.struct(
                done["free"].alias("free"),
                F.concat(acc["taken"], F.array(done["taken"])).alias("taken"),
            ),
        )

    begin = F.struct(
        F.lit(0).alias("free"), F.array().cast(f"array<{SPANS}>").alias("taken")
    )
    return F.aggregate(
        let(ordered, blocks_of), begin, take_block, lambda acc: F.flatten(acc["taken"])
    )
