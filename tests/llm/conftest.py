import pytest
from pyspark.sql import types as T

#: Names that the operators use for columns of their own.
CLASHING = (
    "n_words", "fp", "_fp", "text_hash", "_text_hash", "spots", "_row", "n_hit", "root", "word",
    "kept", "host", "score", "spans", "best", "window", "item", "ids", "start",
)


@pytest.fixture(scope="session")
def documents_of(spark):
    """Make a documents table with extra columns of clashing names."""

    def make(rows):
        """``rows``: (doc_id, text) or (doc_id, text, source)."""
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
                *[T.StructField(c, T.StringType()) for c in CLASHING],
            ]
        )
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""))
            + ("x",) * len(CLASHING)
            for r in rows
        ]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = "alpha beta gamma delta " * 20_000
    same = "the same text twice over and over again in one table of rows"
    return [
        (1, "one two three four five six seven eight nine ten eleven twelve"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long),
        (6, same),
        (6, same),
        (7, same),
        (None, same),
        (None, None),
        (8, "ÄÖÜ Straße, 漢字 🎉 naïve café ABC"),
    ]
