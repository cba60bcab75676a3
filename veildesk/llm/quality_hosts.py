"""Quality rules, per document and per host, in DataFrame functions only.

Each document is measured in one projection. Failures are then summed by host (partial sums
first, so a host with most of the rows costs no more than another), every host's failure rate
is shrunk towards an empirical beta prior fitted to all hosts, and the verdicts on hosts are
joined back: a document stays if it passes its own rules, and on a rejected host only if none of
its measures is borderline. Documents that are clear of the limits stay, whatever their host.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.functions.text import let
from veildesk.staging import staged

SPACES = "[\\x20\\x09-\\x0D]+"
NO_SPACE = "[^\\x20\\x09-\\x0D]"
WINDOW = 8


@dataclass(frozen=True)
class Rules:
    """Limits a document fails beyond, and the share of failures a host may have.

    ``min_words`` and ``max_repeat_percent`` are the base rules. The others: symbols per 100
    words, repeated lines per 100 lines, and the mean length of words in tenths of a character.
    A host is rejected if its shrunk failure rate is above ``max_host_rate``.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbol_percent: int = 30
    max_dup_line_percent: int = 50
    min_word_tenths: int = 20
    max_word_tenths: int = 200
    max_host_rate: float = 0.5

    @property
    def borderline(self) -> Rules:
        """Limits that documents of a rejected host have to keep: half of what is allowed in
        excess, and words half as far again from the extremes. Short texts are not suspect."""
        return replace(
            self,
            max_repeat_percent=self.max_repeat_percent // 2,
            max_symbol_percent=self.max_symbol_percent // 2,
            max_dup_line_percent=self.max_dup_line_percent // 2,
            min_word_tenths=self.min_word_tenths * 3 // 2,
            max_word_tenths=self.max_word_tenths * 3 // 4,
        )


RULES = Rules()


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES, -1), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more, the first included.

    Windows are compared by a hash of their words' hashes. Only if some hash repeats are places
    sorted by it; neighbours with equal hashes are confirmed word by word, and the union of
    their windows is the sum of the steps between places, eight at most.
    """

    def windows(w: Column) -> Column:
        def hashes(h: Column) -> Column:
            places = F.sequence(F.lit(1), F.size(h) - WINDOW + 1)
            return F.transform(places, lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))))

        return let(F.transform(w, lambda x: F.xxhash64(x)), hashes)

    def repeats(w: Column, hashed: Column) -> Column:
        ordered = F.sort_array(
            F.transform(hashed, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i")))
        )

        def pairs(s: Column) -> Column:
            least = F.size(s) - 1
            return F.flatten(
                F.zip_with(
                    F.slice(s, F.lit(1), least),
                    F.slice(s, F.lit(2), least),
                    lambda a, b: F.when(
                        (a["h"] == b["h"])
                        & (
                            F.slice(w, a["i"], F.lit(WINDOW)) == F.slice(w, b["i"], F.lit(WINDOW))
                        ),
                        F.array(a["i"], b["i"]),
                    ).otherwise(F.array().cast("array<int>")),
                )
            )

        def total(places: Column) -> Column:
            following = F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0)))
            steps = F.zip_with(
                places, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))
            )
            return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

        return let(F.sort_array(F.array_distinct(let(ordered, pairs))), total)

    def counted(w: Column) -> Column:
        return let(
            windows(w),
            lambda h: F.when(
                F.size(F.array_distinct(h)) < F.size(h), repeats(w, h)
            ).otherwise(F.lit(0)),
        )

    return F.when(F.size(words) > WINDOW, let(words, counted)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """Struct of counts over the whole text; a null text has no words and no lines."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    def of_text(whole: Column) -> Column:
        by_line = let(F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(NO_SPACE)), of_lines)
        return F.struct(
            let(words_of(whole), of_words).alias("words"),
            by_line.alias("lines"),
            F.length(F.regexp_replace(whole, SPACES, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        )

    # Bound as one value: a bare struct would be taken apart and computed once for each field.
    return let(F.coalesce(text, F.lit("")), of_text)


def base_failed(rules: Rules) -> Column:
    repeated = 100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    return (F.col("n_words") < rules.min_words) | repeated


def failed(rules: Rules) -> Column:
    """Fails a base rule or one of the others."""
    n_words = F.col("n_words")
    return (
        base_failed(rules)
        | (100 * F.col("n_symbols") > rules.max_symbol_percent * n_words)
        | (100 * F.col("n_dup_lines") > rules.max_dup_line_percent * F.col("n_lines"))
        | (10 * F.col("word_chars") < rules.min_word_tenths * n_words)
        | (10 * F.col("word_chars") > rules.max_word_tenths * n_words)
    )


def host_of_url(url: Column) -> Column:
    """Lower-case host of a URL, the usual value of ``host`` for crawled pages."""
    return F.lower(F.parse_url(url, F.lit("HOST")))


def measured(docs: DataFrame, host: Column, text_col: str, rules: Rules) -> DataFrame:
    """``docs`` and their measures, under names that ``docs`` does not have."""
    return docs.select("*", host.alias("_host"), measures(F.col(text_col)).alias("_m")).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "_host",
        "_m.words.*",
        "_m.lines.*",
        "_m.word_chars",
        "_m.n_symbols",
    )


def host_verdicts(found: DataFrame, rules: Rules = RULES) -> DataFrame:
    """``host, n_docs, n_failed, rate, host_rejected`` from rows of ``host, failed``.

    The beta prior comes from the method of moments over the hosts' raw rates: their mean and
    the variance left after the binomial part is taken away. Rates no more spread than chance
    allows give a prior so strong that every host gets the mean. Only the prior's two numbers
    reach the driver. Rows without a host are no host and get no verdict.
    """
    hosts = staged(
        found.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("bigint")).alias("n_failed")),
        "hosts",
    )
    raw = F.col("n_failed") / F.col("n_docs")
    mean, spread, inverse = hosts.agg(
        F.avg(raw), F.var_pop(raw), F.avg(1 / F.col("n_docs"))
    ).first()
    alpha, beta = beta_prior(mean, spread, inverse)
    rate = (F.col("n_failed") + alpha) / (F.col("n_docs") + (alpha + beta))
    return hosts.withColumn("rate", rate).withColumn(
        "host_rejected", F.col("rate") > rules.max_host_rate
    )


def beta_prior(mean: float | None, spread: float | None, inverse: float | None):
    """Alpha and beta from the mean and variance of raw rates and the mean of 1 / n."""
    if mean is None or not 0 < mean < 1:
        return 0.5, 0.5  # no host, or nothing to tell them apart: a weak even prior
    binomial = mean * (1 - mean)
    own = max((spread - binomial * inverse) / (1 - min(inverse, 0.999)), binomial / 1e6)
    strength = max(binomial / own - 1, 1e-3)
    return mean * strength, (1 - mean) * strength


def judge(
    docs: DataFrame,
    host: Column | None = None,
    rules: Rules = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its measures, ``base_failed``, ``kept``, host and host's rate.

    ``host`` is the source column by default. A null text has no words and fails; a null host
    leaves only the document's own rules. Rows are kept as they come, with repeated and null
    ids; an empty table gives an empty result. A document is kept if it fails no rule and, where
    its host is rejected, is not borderline either.
    """
    host = F.col("source") if host is None else host
    narrow = docs.select(F.col(id_col).alias("id"), host.alias("host"), F.col(text_col).alias("t"))
    found = measured(narrow, F.col("host"), "t", rules).drop("t", "_host")
    found = staged(
        found.withColumns(
            {
                "base_failed": base_failed(rules),
                "failed": failed(rules),
                "borderline": failed(rules.borderline),
            }
        ),
        "document-measures",
    )
    verdicts = host_verdicts(found, rules).select("host", "rate", "host_rejected")
    return found.join(verdicts, "host", "left").select(
        F.col("id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (
            ~F.col("failed") & ~(F.col("borderline") & F.coalesce("host_rejected", F.lit(False)))
        ).alias("kept"),
        "n_lines", "host", F.col("rate").alias("host_rate"),
    )


def kept_documents(
    docs: DataFrame, host: Column | None = None, rules: Rules = RULES, text_col: str = "text"
) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    Nulls, empty texts, repeated rows and empty tables are as ``judge`` has them. Documents are
    written once with their host; hosts' sums are taken from all documents in the same pass, so
    texts are measured once and never shuffled unless the hosts are too many to broadcast. Only
    borderline documents need their host's verdict.
    """
    host = F.col("source") if host is None else host
    columns = [F.col(f"`{c}`") for c in docs.columns]
    bare = docs.select(F.struct(*columns).alias("row"), host.alias("host"), F.col(text_col).alias("t"))
    found = measured(bare, F.col("host"), "t", rules).withColumns(
        {"failed": failed(rules), "borderline": failed(rules.borderline)}
    )
    found = staged(found.select("row", "host", "failed", "borderline"), "judged-documents")
    verdicts = host_verdicts(found, rules).where("host_rejected").select(F.col("host").alias("bad"))
    rejected = F.col("borderline") & (F.col("host") == F.col("bad"))
    return (
        found.where("not failed").join(staged(verdicts, "rejected-hosts"), rejected, "left_anti")
        .select("row.*")
    )
