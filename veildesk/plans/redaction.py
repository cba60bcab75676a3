"""The whole redaction job over tables.

Per record: strings -> texts to scan -> detect -> keep list -> widen -> allowlist ->
known values of the scope -> merge -> placeholder -> rebuild. Three plans, from cheap to
general, give the same redaction:

* plain placeholders, formats only, scope = record: one expression, no shuffle at all;
* numbered placeholders: only texts with a detection are written out, numbered through
  the vault and joined back;
* a detector or a wider scope: each distinct text is detected once, by digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veildesk.functions.detectors import Detector, run_detector
from veildesk.functions.patterns import detect_patterns, no_spans, running_totals
from veildesk.functions.spans import (
    allow_terms,
    cut,
    first_types,
    keep_entities,
    known_values,
    match_known,
    merge_spans,
    plain_placeholder,
    redact,
    widen_spans,
)
from veildesk.functions.text import let, needs_scan
from veildesk.functions.tree import all_leaves, leaf_count, map_leaves, string_leaves
from veildesk.functions.urls import is_own_url, sanitize_url, url_parts
from veildesk.plans.memo import DetectionMemo
from veildesk.plans.propagation import propagate, scope_values
from veildesk.plans.vault import (
    distinct_values,
    empty_vault,
    first_seen,
    keyed,
    number_values,
)
from veildesk.staging import deep_expressions, staged, staged_records, with_found


@dataclass(frozen=True)
class Policy:
    """What to redact and how.

    ``scope`` names the columns whose values bound the search for known values; None
    means each record by itself. ``memo`` keeps a detector's answers from run to run. ``site`` is the address prefix of the helpdesk's own
    URLs, as text or as a column.
    """

    keep: Sequence[str] = ("FINANCIAL_AMOUNT",)
    allow: Sequence[str] = ()
    pseudonyms: bool = True
    scope: Sequence[str] | None = None
    detector: Detector | None = None
    memo: DetectionMemo | None = None
    site: str | Column | None = None
    scan_fragment: bool = True
    keep_repeated: bool = True

    @property
    def narrow(self) -> bool:
        return self.detector is None and self.scope is None


@dataclass(frozen=True)
class Sanitized:
    """A redacted table and the vault after the run.

    ``originals`` has (sanitized, original) for each own URL that changed, wherever in the
    columns it stood; of several the last one in key order wins. It holds what the redaction
    took out, so it stays with the job, as the vault does.
    """

    frame: DataFrame
    vault: DataFrame
    originals: DataFrame | None = None


# ----------------------------------------------------------------- per record


def _site(policy: Policy) -> Column:
    return F.lit(policy.site) if isinstance(policy.site, str) else policy.site


def _leaves(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat(*[all_leaves(F.col(c), df.schema[c].dataType) for c in columns])


def _parts(text: Column, policy: Policy) -> Column:
    """What is scanned of a leaf: its own text, or the parts of one of the helpdesk's URLs."""
    site = _site(policy)
    return F.when(is_own_url(text, site), url_parts(text, site, policy.scan_fragment)).otherwise(
        F.array(text)
    )


def record_texts(df: DataFrame, columns: Sequence[str], policy: Policy) -> Column:
    """All texts of a record in traversal order, by place; null where nothing needs a scan."""
    texts = _leaves(df, columns)
    if policy.site is not None:
        texts = F.flatten(F.transform(texts, lambda s: _parts(s, policy)))
    return F.transform(texts, lambda s: F.when(needs_scan(s), s))


def detected(text: Column, policy: Policy, model: Column | None = None) -> Column:
    """Spans of one text before known values: formats, then the detector's, cleaned up."""
    raw = detect_patterns(text) if model is None else F.concat(detect_patterns(text), model)
    return let(
        keep_entities(raw, policy.keep),
        lambda spans: F.when(
            F.size(spans) > 0, allow_terms(text, widen_spans(text, spans), policy.allow)
        ).otherwise(no_spans()),
    )


def _stages(text: Column, raw: Column, policy: Policy) -> Column:
    """Spans found, those not kept by policy, and what widening and the allowlist leave."""

    def of(spans: Column) -> Column:
        kept = keep_entities(spans, policy.keep)
        left = allow_terms(text, widen_spans(text, kept), policy.allow)
        return F.struct(spans.alias("found"), kept.alias("open"), left.alias("left"))

    return let(raw, of)


def _counted(stages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts by record key and type from rows of ``keys, s``, ``s`` as ``_stages`` has it."""

    def types(stage: str) -> Column:
        return F.transform(
            F.col(f"s.{stage}"),
            lambda x: F.struct(F.lit(stage).alias("stage"), x["type"].alias("type")),
        )

    def count(stage: str) -> Column:
        return F.count_if(F.col("stage") == stage)

    all_types = F.concat(*[types(stage) for stage in ("found", "open", "left")])
    rows = stages.select("keys", F.explode(all_types).alias("x")).select("keys.*", "x.*")
    return rows.groupBy(*keys, "type").agg(
        count("found").alias("n_found"),
        (count("found") - count("open")).alias("n_kept"),
        count("left").alias("n_redacted"),
    )


def merged_in_record(texts: str, policy: Policy) -> Column:
    """Merged spans of each text in an array column, known values searched in the record."""
    return _merged_in_record(texts, tuple(policy.keep), tuple(policy.allow))


@lru_cache(maxsize=64)
def _merged_in_record(column: str, keep: tuple[str, ...], allow: tuple[str, ...]) -> Column:
    # A large expression: made once per policy, because making it costs seconds and a
    # stream needs it for every micro-batch.
    texts, policy = F.col(column), Policy(keep=keep, allow=allow)

    def with_known(spans: Column) -> Column:
        cells = F.zip_with(
            texts,
            spans,
            lambda t, s: F.struct(
                t.alias("text"), s.alias("spans"), known_values(t, s).alias("own")
            ),
        )

        def merged(c: Column, known: Column) -> Column:
            again = match_known(c["text"], known, c["own"])
            return F.when(
                c["text"].isNotNull(),
                merge_spans(
                    c["text"], F.concat(c["spans"], allow_terms(c["text"], again, policy.allow))
                ),
            ).otherwise(no_spans())

        def of(cells: Column) -> Column:
            own = F.flatten(F.transform(cells, lambda c: c["own"]))
            known = let(own, lambda k: F.when(F.size(k) > 1, first_types(k)).otherwise(k))
            return let(known, lambda k: F.transform(cells, lambda c: merged(c, k)))

        return let(cells, of)

    empty = F.transform(texts, lambda _: no_spans())
    return let(
        F.transform(
            texts, lambda t: F.when(t.isNotNull(), detected(t, policy)).otherwise(no_spans())
        ),
        lambda spans: F.when(
            F.exists(spans, lambda s: F.size(s) > 0), with_known(spans)
        ).otherwise(empty),
    )


def _rebuilt(
    df: DataFrame, columns: Sequence[str], policy: Policy, clean: Column
) -> dict[str, Column]:
    """The columns with each text replaced by the one at its place in ``clean``, if there is one.

    ``clean`` follows ``record_texts``; an empty one leaves the record as it is.
    """
    # Where the texts of each leaf begin: a URL has several.
    ends = F.array().cast("array<int>")
    if policy.site is not None:
        sizes = F.transform(_leaves(df, columns), lambda s: F.size(_parts(s, policy)))
        ends = running_totals(sizes)
    # Bound once per record: a leaf inside an array must not clean the record again.
    known = F.struct(clean.alias("clean"), F.when(F.size(clean) > 0, ends).alias("ends"))

    def leaf(known: Column, text: Column, at: Column) -> Column:
        if policy.site is None:
            return F.coalesce(F.get(known["clean"], at), text)
        site, start = _site(policy), F.coalesce(F.get(known["ends"], at - 1), F.lit(0))

        def url(parts: Column) -> Column:
            def lookup(part: Column) -> Column:
                place = F.array_position(parts, part).cast("int")
                new = F.when(place > 0, F.get(known["clean"], start + place - 1))
                return F.coalesce(new, part)

            return sanitize_url(text, site, lookup, policy.scan_fragment, policy.keep_repeated)

        return F.when(
            is_own_url(text, site), let(url_parts(text, site, policy.scan_fragment), url)
        ).otherwise(F.coalesce(F.get(known["clean"], start), text))

    def rebuilt(name: str, before: Column) -> Column:
        kind = df.schema[name].dataType

        def whole(k: Column) -> Column:
            new = map_leaves(F.col(name), kind, before, lambda s, at: leaf(k, s, at))
            return F.when(F.size(k["clean"]) > 0, new).otherwise(F.col(name))

        return let(known, whole)

    out, before = {}, F.lit(0)
    for name in columns:
        out[name] = rebuilt(name, before)
        before = before + leaf_count(F.col(name), df.schema[name].dataType)
    return out


def _by_place(changed: Column) -> Column:
    """Cleaned texts by place, from an array of ``struct<cell,clean>`` in order of ``cell``."""

    def none(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("string"), n)

    def filled(rows: Column) -> Column:
        def gap(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(rows, i + 1)["cell"] - x["cell"] - 1, F.lit(0))

        rest = F.transform(rows, lambda x, i: F.concat(F.array(x["clean"]), none(gap(x, i))))
        return F.concat(none(F.get(rows, F.lit(0))["cell"]), F.flatten(rest))

    empty = F.array().cast("array<string>")
    return F.when(F.size(changed) > 0, let(changed, filled)).otherwise(empty)


# ------------------------------------------------------------------ the tables


def distinct_texts(cells: DataFrame) -> DataFrame:
    """Each text once, with its digest; copies are folded before the shuffle."""
    return cells.select("text").distinct().withColumn("digest", F.sha2("text", 256))


#: Number of a record, told from others even where keys are null or repeated.
ROW = "_record_row"


def with_rows(df: DataFrame) -> DataFrame:
    """The records with a number each, written once, so that the number stays the same."""
    if ROW in df.columns:
        return df
    return staged_records(df.withColumn(ROW, F.monotonically_increasing_id()), "records")


def record_cells(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], policy: Policy
) -> DataFrame:
    """One row per text to scan: ``record, keys, scope, cell, text`` of ``with_rows`` records;
    ``cell`` is the text's place in the record."""
    return df.select(
        F.col(ROW).alias("record"),
        F.struct(*keys).alias("keys"),
        (F.struct(*policy.scope) if policy.scope else F.col(ROW)).alias("scope"),
        F.posexplode(record_texts(df, columns, policy)).alias("cell", "text"),
    ).where(F.col("text").isNotNull())


def _scored(cells: DataFrame, policy: Policy) -> DataFrame:
    """``digest, text, spans``: what the detector says of each text, once."""
    if policy.memo is not None:
        return policy.memo.detect(distinct_texts(cells), policy.detector)
    return run_detector(distinct_texts(cells), policy.detector)


def _hits(cells: DataFrame, policy: Policy) -> DataFrame:
    """Cells with a detection: ``record, keys, scope, cell, text, spans``."""
    text = F.col("text")
    if policy.detector is None:
        return with_found(cells, "spans", detected(text, policy))
    scored = _scored(cells, policy).withColumnRenamed("spans", "model")
    found = with_found(scored, "spans", detected(text, policy, F.col("model"))).drop("model")
    places = cells.select("record", "keys", "scope", "cell", F.sha2("text", 256).alias("digest"))
    return places.join(found, "digest").select("record", "keys", "scope", "cell", "text", "spans")


def _merged_in_scope(cells: DataFrame, policy: Policy) -> DataFrame:
    """``record, keys, cell, text, merged`` with known values searched in the whole scope."""
    cells = staged(cells, "cells")
    return _merged_from_hits(cells, staged(_hits(cells, policy), "hits"), policy)


def _merged_from_hits(cells: DataFrame, hits: DataFrame, policy: Policy) -> DataFrame:
    known = propagate(cells, scope_values(hits)).withColumn(
        "spans", allow_terms(F.col("text"), F.col("spans"), policy.allow)
    )
    parts = hits.select("record", "keys", "cell", "text", "spans", F.lit(0).alias("kind")).unionByName(
        known.where(F.size("spans") > 0).withColumn("kind", F.lit(1))
    )
    return (
        parts.groupBy("record", "cell")
        .agg(
            F.first("keys").alias("keys"),
            F.first("text").alias("text"),
            F.collect_list(F.struct("kind", "spans")).alias("parts"),
        )
        .select(
            "record",
            "keys",
            "cell",
            "text",
            merge_spans(
                F.col("text"),
                F.flatten(F.transform(F.array_sort("parts"), lambda p: p["spans"])),
            ).alias("merged"),
        )
    )


def _merged_per_record(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], policy: Policy
) -> DataFrame:
    """``record, keys, cell, text, merged`` without a shuffle: the record is the scope."""
    texts = df.select(
        F.col(ROW).alias("record"),
        F.struct(*keys).alias("keys"),
        record_texts(df, columns, policy).alias("_texts"),
    )
    cells = F.transform(
        merged_in_record("_texts", policy),
        lambda m, i: F.struct(
            i.alias("cell"), F.get("_texts", i).alias("text"), m.alias("merged")
        ),
    )
    changed = F.filter(cells, lambda c: F.size(c["merged"]) > 0)
    return texts.select("record", "keys", F.inline(changed))


def merged_cells(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], policy: Policy
) -> DataFrame:
    """Every text with something to redact and its final, disjoint spans.

    ``record, keys, cell, text, merged``; what is to be put back needs the records of
    ``with_rows``, others are numbered here.
    """
    with deep_expressions(df.sparkSession):
        if policy.narrow:
            if ROW not in df.columns:
                df = df.withColumn(ROW, F.monotonically_increasing_id())
            return _merged_per_record(df, keys, columns, policy)
        return _merged_in_scope(record_cells(with_rows(df), keys, columns, policy), policy)


def occurrences(merged: DataFrame) -> DataFrame:
    """One row per span: ``record, cell, start, end, type, value, seen``."""
    text = F.col("text")
    return merged.select(
        "record", "keys", "cell", "text", F.explode("merged").alias("s")
    ).select(
        "record",
        "cell",
        "s.*",
        cut(text, F.col("s.start"), F.col("s.end")).alias("value"),
        F.struct("keys", "record", "cell", F.col("s.start").alias("start")).alias("seen"),
    )


def named_values(merged: DataFrame) -> DataFrame:
    """Each distinct value once: ``value, type, seen, key``, written for the steps after it."""
    return staged(keyed(distinct_values(occurrences(merged))), "values")


def _named_cells(merged: DataFrame, values: DataFrame, vault: DataFrame) -> DataFrame:
    """``record, cell, clean`` with numbered placeholders from the vault."""
    names = values.select("value", "key").join(vault.select("key", "placeholder"), "key")
    named = (
        occurrences(merged)
        .select("record", "cell", "start", "end", "value")
        .join(names.select("value", "placeholder"), "value")
        .groupBy("record", "cell")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end", "placeholder"))).alias("named"))
    )
    return merged.join(named, ["record", "cell"]).select(
        "record",
        "cell",
        redact(F.col("text"), F.col("named"), lambda s: s["placeholder"]).alias("clean"),
    )


def sanitize(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy = Policy(),
    vault: DataFrame | None = None,
) -> Sanitized:
    """Redact ``columns`` of ``df``; ``keys`` name a record, nulls and repeats are safe.

    With numbered placeholders the returned vault holds ``vault`` plus the new values.
    """
    vault = empty_vault(df.sparkSession) if vault is None else vault
    with deep_expressions(df.sparkSession):
        return _sanitize(df, keys, columns, policy, vault)


def _sanitize(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], policy: Policy, vault: DataFrame
) -> Sanitized:
    if policy.narrow and not policy.pseudonyms:
        pairs = _sanitize_narrow(df, columns, policy)
        return _result(df, keys, columns, policy, pairs, vault)

    df = with_rows(df)
    merged = staged(merged_cells(df, keys, columns, policy), "merged")
    return _from_merged(df, keys, columns, policy, merged, vault)


def _from_merged(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    merged: DataFrame,
    vault: DataFrame,
) -> Sanitized:
    values = None
    if policy.pseudonyms:
        values = named_values(merged)
        vault = staged(vault.unionByName(number_values(first_seen(values), vault)), "vault")
    pairs = _put_back(df, keys, columns, policy, merged, values, vault)
    return _result(df, keys, columns, policy, pairs, vault)


def _result(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    pairs: DataFrame,
    vault: DataFrame,
) -> Sanitized:
    """The redacted table, and the originals of the helpdesk's own URLs if there is a site."""
    frame = pairs.select(
        *[F.col(f"_clean_{c}").alias(c) if c in columns else c for c in df.columns if c != ROW]
    )
    if policy.site is None:
        return Sanitized(frame, vault)
    own = [
        F.filter(
            F.arrays_zip(
                string_leaves(F.col(c), df.schema[c].dataType).alias("original"),
                string_leaves(F.col(f"_clean_{c}"), df.schema[c].dataType).alias("sanitized"),
            ),
            lambda p: is_own_url(p["original"], _site(policy)) & (p["original"] != p["sanitized"]),
        )
        for c in columns
    ]
    changed = pairs.select(F.struct(*keys).alias("seen"), F.inline(F.concat(*own)))
    originals = changed.groupBy("sanitized").agg(
        F.max_by("original", F.struct("seen", "original")).alias("original")
    )
    return Sanitized(frame, vault, originals)


def put_back(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    merged: DataFrame,
    values: DataFrame | None,
    vault: DataFrame,
) -> DataFrame:
    """``df`` (``with_rows``) with the merged cells replaced by placeholders (the vault's, if
    numbered), without the rows' numbers."""
    with deep_expressions(df.sparkSession):
        pairs = _put_back(df, keys, columns, policy, merged, values, vault)
        return _result(df, keys, columns, policy, pairs, vault).frame


def _put_back(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy,
    merged: DataFrame,
    values: DataFrame | None,
    vault: DataFrame,
) -> DataFrame:
    """``df`` and, as ``_clean_<column>``, its redacted columns."""
    if values is not None:
        cleaned = _named_cells(merged, values, vault)
    else:
        cleaned = merged.withColumn(
            "clean", redact(F.col("text"), F.col("merged"), plain_placeholder)
        )
    changed = cleaned.groupBy(F.col("record").alias(ROW)).agg(
        F.array_sort(F.collect_list(F.struct("cell", "clean"))).alias("_changed")
    )
    joined = df.join(changed, ROW, "left").withColumn("_clean", _by_place(F.col("_changed")))
    rebuilt = _rebuilt(df, columns, policy, F.col("_clean"))
    return joined.select(*df.columns, *[new.alias(f"_clean_{c}") for c, new in rebuilt.items()])


def _sanitize_narrow(df: DataFrame, columns: Sequence[str], policy: Policy) -> DataFrame:
    """``df`` and, as ``_clean_<column>``, its redacted columns, in one projection."""
    texts = F.col("_texts")
    clean = let(
        merged_in_record("_texts", policy),
        lambda merged: F.when(
            F.exists(merged, lambda m: F.size(m) > 0),
            F.zip_with(
                texts,
                merged,
                lambda t, m: F.when(F.size(m) > 0, redact(t, m, plain_placeholder)),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )
    scanned = df.withColumn("_texts", record_texts(df, columns, policy)).withColumn("_clean", clean)
    rebuilt = _rebuilt(df, columns, policy, F.col("_clean"))
    return scanned.select(*df.columns, *[new.alias(f"_clean_{c}") for c, new in rebuilt.items()])


def sanitize_df(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy = Policy(),
    vault: DataFrame | None = None,
) -> DataFrame:
    return sanitize(df, keys, columns, policy, vault).frame


def restore_urls(df: DataFrame, originals: DataFrame, column: str) -> DataFrame:
    """Put the real URL back where a sanitised one is known; others pass through."""
    known = originals.select(
        F.col("sanitized").alias(column), F.col("original").alias("_original")
    )
    return (
        df.join(known, column, "left")
        .withColumn(column, F.coalesce("_original", column))
        .select(*df.columns)
    )


def sanitize_errors(
    errors: DataFrame, keys: Sequence[str], message: str, policy: Policy = Policy()
) -> DataFrame:
    """Error and reject tables can quote data, so their messages are redacted as well.

    Own guidance texts have no message from outside (null) and stay null. If redaction
    fails the job fails, and nothing is written.
    """
    return sanitize_df(errors, keys, [message], policy)


def redaction_report(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], policy: Policy = Policy()
) -> DataFrame:
    """Per record and type: spans found, kept by policy, and left to redact.

    Found are the formats' and the detector's spans; left are those that are not kept, after
    widening and the allowlist, which may cut one in several or remove it.
    """
    if ROW not in df.columns:
        df = df.withColumn(ROW, F.monotonically_increasing_id())
    cells = record_cells(df, keys, columns, policy).select("keys", "text")
    raw_cells, raw = _raw(cells, policy)
    return _counted(raw_cells.select("keys", _stages(F.col("text"), raw, policy).alias("s")), keys)


def sanitize_with_report(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    policy: Policy = Policy(),
    vault: DataFrame | None = None,
) -> tuple[Sanitized, DataFrame]:
    """``sanitize`` and ``redaction_report`` from one run: every text is read and detected once.

    The spans of each stage are written with the texts that have any; the report is an aggregate
    of what was written, and the redaction goes on from the spans that are left.
    """
    spark = df.sparkSession
    vault = empty_vault(spark) if vault is None else vault
    with deep_expressions(spark):
        df = with_rows(df)
        cells = staged(record_cells(df, keys, columns, policy), "cells")
        raw_cells, raw = _raw(cells, policy)
        stages = raw_cells.withColumn("s", _stages(F.col("text"), raw, policy)).drop("model")
        found = staged(stages.where(F.size("s.found") > 0), "stages")
        hits = found.where(F.size("s.left") > 0).select(
            "record", "keys", "scope", "cell", "text", F.col("s.left").alias("spans")
        )
        merged = staged(_merged_from_hits(cells, hits, policy), "merged")
        done = _from_merged(df, keys, columns, policy, merged, vault)
    return done, _counted(found, keys)


def _raw(cells: DataFrame, policy: Policy) -> tuple[DataFrame, Column]:
    """``cells`` with what the detector says of their texts, if there is one, and all spans."""
    formats = detect_patterns(F.col("text"))
    if policy.detector is None:
        return cells, formats
    scored = _scored(cells, policy).select("digest", F.col("spans").alias("model"))
    joined = cells.withColumn("digest", F.sha2("text", 256)).join(scored, "digest").drop("digest")
    return joined, F.concat(formats, F.col("model"))
