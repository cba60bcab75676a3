"""Checked queries over redaction: detectors, span algebra, placeholders, URLs, whole plan.

The SQL sides are independent formulations. DuckDB's regular expressions know no
lookaround, so boundaries are settled by doubling characters or by looking at neighbours.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veildesk.checks.tables import duck, table
from veildesk.functions import patterns, scoring, spans, windows
from veildesk.functions.detectors import GazetteerDetector, run_detector
from veildesk.functions.text import let, needs_scan
from veildesk.functions.tree import map_strings
from veildesk.plans.memo import DetectionMemo
from veildesk.plans.propagation import propagate, scope_values
from veildesk.plans.redaction import (
    Policy,
    distinct_texts as distinct_text_rows,
    merged_cells,
    occurrences,
    redaction_report as report,
    restore_urls,
    sanitize as sanitize_all,
    sanitize_df as sanitize_table,
    sanitize_errors as sanitize_error_table,
    sanitize_with_report as sanitize_and_report,
)
from veildesk.plans.vault import (
    distinct_values,
    empty_vault,
    entity_counts as count_entities,
    first_seen,
    keyed,
    number_values,
)
from veildesk.schemas import SPANS
from veildesk.sources.sinks import write_sanitized as write_table
from veildesk.staging import scratch_path

QUERIES: dict = {}
ORACLES: dict = {}

PLAIN = Policy(pseudonyms=False)


def check(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = duck(sql)
        return fn

    return add


# Every document and page, the input of most checks.
TEXTS = """
    (select 'document' as source, doc_id as id, text from {documents}
     union all select 'page' as source, page_id as id, html as text from {pages})"""


def texts(spark, sf_dir):
    """All documents and pages, as DataFrame."""
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return docs.union(pages)


# ------------------------------------------------------------------ detectors

_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""
    list_reduce(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
        case when i % 2 = 1 then cast(substr(reverse({_DIGITS}), i, 1) as integer)
             else (cast(substr(reverse({_DIGITS}), i, 1) as integer) * 2) // 10
                + (cast(substr(reverse({_DIGITS}), i, 1) as integer) * 2) % 10 end),
        lambda a, b: a + b) % 10 = 0"""
_COMPACT = "replace(value, ' ', '')"
_IBAN_OK = f"""
    length({_COMPACT}) between 15 and 34 and list_reduce(list_transform(
        string_split(substr({_COMPACT}, 5) || substr({_COMPACT}, 1, 4), ''),
        lambda c: case when c >= 'A' then ascii(c) - 55 else cast(c as integer) end),
        lambda a, d: (case when d > 9 then a * 100 else a * 10 end + d) % 97, 0) = 1"""
_LOCAL = r"regexp_extract(substr(a.p, a.used + 1), '[\p{L}\p{N}._%+-]+$')"
_LABELS = r"string_split(regexp_extract(b.p, '^[\p{L}\p{N}.-]+'), '.')"
_FULL = f"coalesce(list_position({_LABELS}, ''), len({_LABELS}) + 1) - 1"
_DOMAIN = f"case when {_FULL} >= 2 then array_to_string(({_LABELS})[1:{_FULL}], '.') else '' end"
# What an octet, a version before an address and an account number look like.
_OCTET = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP_PARTS = r"(\b(?:[vV]|[vV]er\.?|[vV]ersion)\s?)?([0-9.]+)"

# Values found per text, in order: (source, id, ord, value).
FOUND = {
    # Text is cut at every "@"; an address is the end of the piece before (what an earlier
    # address did not use) and the labels that the piece after begins with.
    patterns.EMAIL: rf"""
        select source, id, unnest(v) as value, generate_subscripts(v, 1) as ord
        from (select source, id, list_reduce(list_transform(string_split(text, '@'),
                  lambda p: struct_pack(p := p, used := 0, found := cast([] as varchar[]))),
                  lambda a, b: struct_pack(
                      p := b.p,
                      used := case when {_LOCAL} <> '' then length({_DOMAIN}) else 0 end,
                      found := case when {_LOCAL} <> '' and {_DOMAIN} <> ''
                          then list_append(a.found, {_LOCAL} || '@' || {_DOMAIN})
                          else a.found end)).found as v
              from {TEXTS} where contains(text, '@'))""",
    patterns.IBAN: rf"""
        select source, id, value, ord
        from (select source, id, unnest(v) as value, generate_subscripts(v, 1) as ord
              from (select source, id, regexp_extract_all(text,
                        '\b[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,4}})?\b')
                        as v from {TEXTS}))
        where {_IBAN_OK}""",
    patterns.IPV4: rf"""
        select source, id, rtrim(run, '.') as value, ord
        from (select source, id, unnest(regexp_extract_all(text, '{_IP_PARTS}', 1)) as version,
                     unnest(regexp_extract_all(text, '{_IP_PARTS}', 2)) as run,
                     generate_subscripts(regexp_extract_all(text, '{_IP_PARTS}', 2), 1) as ord
              from {TEXTS})
        where coalesce(version, '') = ''
          and regexp_full_match(rtrim(run, '.'), '({_OCTET}\.){{3}}{_OCTET}')""",
    patterns.CARD: rf"""
        select source, id, value, ord
        from (select source, id, replace(unnest(v), '  ', ' ') as value,
                     generate_subscripts(v, 1) as ord
              from (select source, id, regexp_extract_all(
                        regexp_replace(text, '([^0-9-])', '\1\1', 'gs'),
                        '(?:^|[^0-9-])([0-9](?:(?:  |-)?[0-9]){{12,18}})(?:[^0-9-]|$)', 1) as v
                    from {TEXTS}))
        where {_LUHN}""",
    patterns.PHONE: rf"""
        select source, id, value, ord
        from (select source, id, replace(replace(replace(replace(replace(replace(unnest(v), '  ', ' '),
                         '..', '.'), '--', '-'), '//', '/'), '((', '('), '))', ')')
                         as value, generate_subscripts(v, 1) as ord
              from (select source, id, regexp_extract_all(
                        regexp_replace(text, '([^0-9A-Za-z_+])', '\1\1', 'gs'),
                        '(?:^|[^0-9A-Za-z_+])(\+[0-9]{{1,3}}(?:(?:  |\.\.|--|//)?(?:\(\()?[0-9]+(?:\)\))?){{2,6}})(?:[^0-9A-Za-z_]|$)',
                        1) as v
                    from {TEXTS}))
        where length({_DIGITS}) >= 8""",
}


def _values_sql(kind: str) -> str:
    return f"""
        select source, id, row_number() over (partition by source, id order by ord) - 1 as pos,
               value
        from ({FOUND[kind]})"""


def _values(spark, sf_dir, kind):
    text = F.col("text")
    found = patterns.DETECTORS[kind](text)
    return (
        texts(spark, sf_dir)
        .select("source", "id", "text", F.posexplode(found).alias("pos", "s"))
        .select(
            "source",
            "id",
            F.col("pos").cast("bigint").alias("pos"),
            spans.cut(text, F.col("s.start"), F.col("s.end")).alias("value"),
        )
    )


@check("detect_email", _values_sql(patterns.EMAIL))
def detect_email(spark, sf_dir):
    return _values(spark, sf_dir, patterns.EMAIL)


# Account numbers made from customer keys: valid, valid in groups of four, wrong checksum.
_IBANS = """
    select c_custkey as id, c_custkey % 3 as form, concat('Konto ', case c_custkey % 3
               when 1 then concat(substr(iban, 1, 4), ' ', substr(iban, 5, 4), ' ',
                   substr(iban, 9, 4), ' ', substr(iban, 13, 4), ' ', substr(iban, 17, 4), ' ',
                   substr(iban, 21, 2))
               else iban end, ', danke') as text, iban
    from (select c_custkey, concat('DE', lpad(cast(98 - rest + case when c_custkey % 3 = 2
                     then 1 else 0 end as string), 2, '0'), bban) as iban
          from (select c_custkey, lpad(cast(c_custkey * 7919 + 5 as string), 18, '0') as bban,
                       ((c_custkey * 7919 + 5) % 97 * 1000000 + 131400) % 97 as rest
                from {customer}))"""


@check(
    "detect_iban",
    f"""
    select id, value, length(value) as n_chars
    from (select id, split_part(substr(text, 7), ',', 1) as value from ({_IBANS}))
    where {_IBAN_OK}""",
)
def detect_iban(spark, sf_dir):
    rows = spark.sql(_IBANS, customer=table(spark, sf_dir, "customer"))
    text = F.col("text")
    return (
        rows.select("id", "text", F.explode(patterns.detect_iban(text)).alias("s"))
        .select("id", spans.cut(text, F.col("s.start"), F.col("s.end")).alias("value"))
        .withColumn("n_chars", F.length("value").cast("bigint"))
    )


@check("detect_ipv4", _values_sql(patterns.IPV4))
def detect_ipv4(spark, sf_dir):
    return _values(spark, sf_dir, patterns.IPV4)


@check("detect_card", _values_sql(patterns.CARD))
def detect_card(spark, sf_dir):
    return _values(spark, sf_dir, patterns.CARD)


@check("detect_phone", _values_sql(patterns.PHONE))
def detect_phone(spark, sf_dir):
    return _values(spark, sf_dir, patterns.PHONE)


LABELS = ["O"] + [("B-" if k % 2 == 0 else "") + f"T{k % 8}" for k in range(1, 64)]


@check(
    "detect_model",
    """
    with scored as (
        select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
    odds as (
        select vec_id, e, 1 - exp(e[1] - list_max(e)) / list_sum(list_transform(e,
            lambda x: exp(x - list_max(e)))) as p,
            list_position(e[2:], list_max(e[2:])) as best from scored)
    select cast(floor(vec_id / 10) as bigint) as text_id, vec_id % 10 as token,
           case when p >= 0.984 then 'T' || (best % 8) else 'O' end as label,
           round(p, 6) as p
    from odds""",
)
def detect_model(spark, sf_dir):
    logits = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("text_id"),
        (F.col("vec_id") % 10).alias("token"),
        scoring.token_label(logits, LABELS, threshold=0.984).alias("label"),
        F.round(scoring.pii_probability(logits), 6).alias("p"),
    )


_SPACE = "\\t\\n\\x0B\\f\\r \\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}"


@check(
    "chunk_windows",
    f"""
    with recursive pieces as (
        select doc_id, unnest(p) as piece, generate_subscripts(p, 1) as i
        from (select doc_id, string_split(regexp_replace(replace(text, '_', ' '),
                  '([^{_SPACE}]+)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as p
              from {{documents}})),
    placed as (
        select doc_id, i // 2 as word, piece, i,
               sum(length(piece)) over (partition by doc_id order by i) as ends
        from pieces),
    words as (
        select p.doc_id, list(p.ends - length(p.piece) order by p.i) as starts,
               list(p.ends order by p.i) as ends,
               list(regexp_matches(substr(d.text, cast(p.ends as bigint), 1), '[.!?:;]')
                    order by p.i) as stops
        from placed p join {{documents}} d on d.doc_id = p.doc_id
        where p.i % 2 = 0 group by p.doc_id),
    cuts as (
        select doc_id, 0 as win, 0 as low, 0 as high from words
        union all
        select c.doc_id, c.win + 1, c.high,
               case when c.high + 254 >= len(w.ends) then len(w.ends)
                    else coalesce(list_max(list_filter(range(c.high + 128, c.high + 255),
                             lambda j: w.stops[j])), c.high + 254) end
        from cuts c join words w on w.doc_id = c.doc_id where c.high < len(w.ends))
    select c.doc_id, cast(c.win - 1 as bigint) as win, cast(w.starts[c.low + 1] as bigint) as first_char,
           cast(w.ends[c.high] as bigint) as last_char, cast(c.high - c.low as bigint) as n_tokens
    from cuts c join words w on w.doc_id = c.doc_id where c.win > 0""",
)
def chunk_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = docs.select("doc_id", windows.chunk_windows(F.col("text")).alias("w"))
    return cut.select("doc_id", F.posexplode("w").alias("win", "w")).select(
        "doc_id",
        F.col("win").cast("bigint").alias("win"),
        F.col("w.start").cast("bigint").alias("first_char"),
        F.col("w.end").cast("bigint").alias("last_char"),
        F.col("w.n_tokens").cast("bigint").alias("n_tokens"),
    )


# --------------------------------------------------------------- span algebra

_W = "\\p{L}\\p{N}"
_RUN = f"[{_W}]+(?:[.@+\\-''][{_W}]+)*"
_LEAD = "([{<\"''«„“"
_TRAIL = ")]}>\"''»“”,.;:!?"


def _widened_sql(hits: str) -> str:
    """Hits (…, text, s, e) with the bounds of the word around them, edges shed.

    Whole words are read off the text before and after the hit; whether the hit's own
    first and last characters are word characters decides which neighbours count.
    """
    return f"""
    (select * exclude (s, e, ws, we, core), ws + length(v) - length(ltrim(v, '{_LEAD}')) as s,
            ws + length(v) - length(ltrim(v, '{_LEAD}')) + length(core) as e
     from (select *, substr(text, cast(ws as bigint) + 1, cast(we - ws as bigint)) as v,
                  rtrim(ltrim(substr(text, cast(ws as bigint) + 1, cast(we - ws as bigint)),
                              '{_LEAD}'), '{_TRAIL}') as core
           from (select *,
                     case when regexp_matches(substr(text, s + 1, 1), '[{_W}]')
                          then s + 1 - length(regexp_extract(substr(text, 1, s + 1), '{_RUN}$'))
                          else s - length(regexp_extract(substr(text, 1, s), '{_RUN}$')) end as ws,
                     case when regexp_matches(substr(text, e, 1), '[{_W}]')
                          then e - 1 + length(regexp_extract(substr(text, e), '^{_RUN}'))
                          else e + length(regexp_extract(substr(text, e + 1), '^{_RUN}')) end as we
                 from ({hits})))
     where length(core) > 0)"""


@check(
    "widen_spans",
    f"""
    select source, id, cast(s as bigint) as first_char, cast(e as bigint) as last_char
    from {_widened_sql(f'''
        select source, id, text, cast(floor(length(text) * third / 3) as bigint) as s,
               cast(least(floor(length(text) * third / 3) + 4, length(text)) as bigint) as e
        from (select *, unnest([0, 1, 2]) as third from {TEXTS})''')}""",
)
def widen_spans(spark, sf_dir):
    text = F.col("text")
    thirds = F.transform(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda k: F.floor(F.length(text) * k / 3).cast("int"),
    )
    given = F.transform(
        thirds,
        lambda at: F.struct(
            at.alias("start"),
            F.least(at + 4, F.length(text)).alias("end"),
            F.lit("X").alias("type"),
        ),
    )
    return (
        texts(spark, sf_dir)
        .select("source", "id", F.explode(spans.widen_spans(text, given)).alias("s"))
        .select(
            "source",
            "id",
            F.col("s.start").cast("bigint").alias("first_char"),
            F.col("s.end").cast("bigint").alias("last_char"),
        )
    )


@check(
    "keep_entities",
    f"""
    select source, id, type, count(*) as n from (
        select source, id, 'IP_ADDRESS' as type from ({FOUND[patterns.IPV4]})
        union all select source, id, 'PHONE_NUMBER' from ({FOUND[patterns.PHONE]})
        union all select source, id, 'BANK_ACCOUNT_IDENTIFIER' from ({FOUND[patterns.IBAN]}))
    group by all""",
)
def keep_entities(spark, sf_dir):
    found = spans.keep_entities(
        patterns.detect_patterns(F.col("text")), ["email_address", "payment_card"]
    )
    return (
        texts(spark, sf_dir)
        .select("source", "id", F.explode(found).alias("s"))
        .groupBy("source", "id", "s.type")
        .agg(F.count("*").alias("n"))
    )


ALLOWED = ("MAIL3", "example.com", "19")


@check(
    "allowlist",
    rf"""
    select source, id, ord - 1 as pos, piece, row_number() over (
               partition by source, id, ord order by n) - 1 as part
    from (select source, id, ord, unnest(pieces) as piece, generate_subscripts(pieces, 1) as n
          from (select source, id, ord, regexp_split_to_array(value,
                    '(?i)\bexample\.com\b|\bmail3\b|\b19\b') as pieces
                from ({_values_sql(patterns.EMAIL).replace('as pos,', '+ 1 as ord,')})))
    where regexp_matches(piece, '[\p{{L}}\p{{N}}]')""",
)
def allowlist(spark, sf_dir):
    text = F.col("text")
    rows = texts(spark, sf_dir).select(
        "source", "id", "text", F.posexplode(patterns.detect_email(text)).alias("pos", "s")
    )
    kept = spans.allow_terms(text, F.array("s").cast(SPANS), ALLOWED)
    return rows.select(
        "source", "id", "text", F.col("pos").cast("bigint").alias("pos"),
        F.posexplode(kept).alias("part", "p"),
    ).select(
        "source", "id", "pos", F.col("part").cast("bigint").alias("part"),
        spans.cut(text, F.col("p.start"), F.col("p.end")).alias("piece"),
    )


# Spans on words of even length, typed by length, plus longer ones reaching over the next
# word, so that merging meets gaps, touching ends and overlaps of different types.
_WORD_SPANS = f"""
    (select doc_id, text, list(struct_pack(s := s, e := e, t := t) order by s, e desc, t) as spans
     from (select doc_id, text, s, unnest(case when n % 2 = 0 and n = 6 then [e, e + 4]
                                          when n % 2 = 0 then [e] else [] end) as e,
                  'T' || (n % 3) || case when n = 6 then 'L' else '' end as t
           from (select doc_id, text, length(piece) as n,
                        cast(total - length(piece) as bigint) as s, cast(total as bigint) as e, i
                 from (select doc_id, text, piece, i,
                              sum(length(piece)) over (partition by doc_id order by i) as total
                       from (select doc_id, text, unnest(p) as piece,
                                    generate_subscripts(p, 1) as i
                             from (select doc_id, text, string_split(regexp_replace(text,
                                       '([{_W}]+)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as p
                                   from {{documents}})))
                 where i % 2 = 0))
     where e <= length(text) group by doc_id, text)"""


def _merged_sql(grouped: str, keys: str) -> str:
    """Rows (keys, text, spans list sorted) folded to merged (keys, text, s, e, t)."""
    return f"""
    (select {keys}, text, unnest(list_append(m.done, struct_pack(s := m.s, e := m.e, t := m.t)),
            recursive := true) from (
        select {keys}, text, list_reduce(list_transform(spans, lambda x: struct_pack(
                   done := cast([] as struct(s bigint, e bigint, t varchar)[]),
                   s := x.s, e := x.e, t := x.t)),
               lambda a, x: case
                   when x.s <= a.e or (x.t = a.t and x.s - a.e <= 3 and regexp_full_match(
                        substr(text, a.e + 1, x.s - a.e), '[\\s\\x{{00A0}}.\\-@_+/()]*'))
                   then struct_pack(done := a.done, s := a.s, e := greatest(a.e, x.e), t := a.t)
                   else struct_pack(done := list_append(a.done,
                            struct_pack(s := a.s, e := a.e, t := a.t)),
                            s := x.s, e := x.e, t := x.t) end) as m
        from ({grouped})))"""


@check(
    "merge_spans",
    f"""
    select doc_id, s as first_char, e as last_char, t as type
    from {_merged_sql('select * from ' + _WORD_SPANS, 'doc_id')}""",
)
def merge_spans(spark, sf_dir):
    text = F.col("text")
    words = F.filter(
        spans.match_spans(text, "[\\p{L}\\p{N}]++"), lambda w: F.length(w["value"]) % 2 == 0
    )

    def of_word(w):
        n = F.length(w["value"])
        kind = F.concat(
            F.lit("T"), (n % 3).cast("string"), F.when(n == 6, "L").otherwise("")
        )
        first = F.struct(w["start"], w["end"], kind.alias("type"))
        longer = F.struct(w["start"], (w["end"] + 4).alias("end"), kind.alias("type"))
        return F.when(n == 6, F.array(longer, first)).otherwise(F.array(first))

    # Counting a text's characters reads all of it, so it is done once and not for each span.
    given = let(
        F.length(text),
        lambda size: F.filter(F.flatten(F.transform(words, of_word)), lambda s: s["end"] <= size),
    ).cast(SPANS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (
        docs.withColumn("given", given)
        .select("doc_id", F.explode(spans.merge_spans(text, F.col("given"))).alias("s"))
        .select(
            "doc_id",
            F.col("s.start").cast("bigint").alias("first_char"),
            F.col("s.end").cast("bigint").alias("last_char"),
            "s.type",
        )
    )


# ------------------------------------------------------- hits with their offsets

def _placed_sql(kind: str) -> str:
    """Found values with their offsets: each is looked for after the end of the last."""
    return f"""
        select source, id, text, value, '{kind}' as t, cast(e - length(value) as bigint) as s,
               cast(e as bigint) as e
        from (select *, list_reduce(list_transform(vals, lambda v: struct_pack(p := 0, v := v)),
                     lambda a, b: struct_pack(
                         p := a.p + position(b.v in substr(text, a.p + 1)) - 1 + length(b.v),
                         v := b.v), struct_pack(p := 0, v := '')).p as e
              from (select source, id, value,
                           list(value) over (partition by source, id order by ord
                               rows between unbounded preceding and current row) as vals
                    from ({FOUND[kind]})) join {TEXTS} using (source, id))"""


HITS = " union all ".join(f"({_placed_sql(kind)})" for kind in patterns.DETECTORS)
_ORDERED = f"""
    (select source, id, text, list(struct_pack(s := s, e := e, t := t)
                                   order by s, e desc, k) as spans
     from (select *, list_position([{", ".join(f"'{k}'" for k in patterns.DETECTORS)}], t) as k
           from {_widened_sql(HITS)}) group by source, id, text)"""

# Values known in a text, searched in the whole text as words, added to its spans.
_WITH_KNOWN = f"""
    (select source, id, text, list(struct_pack(s := s, e := e, t := t)
                                   order by s, e desc, k) as spans
     from (select source, id, text, cast(s as bigint) as s, cast(e as bigint) as e, t, k
           from (select source, id, text, unnest(spans, recursive := true), 0 as k
                 from {_ORDERED})
           union all
           select source, id, text, s, s + length(v) as e, t, 1 as k
           from (select source, id, text, v, t, unnest(list_filter(
                        range(0, length(text) - length(v) + 1),
                        lambda i: substr(text, i + 1, length(v)) = v
                            and not regexp_matches(substr(text, i, case when i > 0 then 1
                                else 0 end), '[{_W}]')
                            and not regexp_matches(substr(text, i + length(v) + 1, 1),
                                '[{_W}]'))) as s
                 from (select source, id, text, v, arg_min(t, n) as t
                       from (select source, id, text, trim(substr(text, cast(spans[n].s as bigint) + 1,
                                    cast(spans[n].e - spans[n].s as bigint))) as v,
                                    spans[n].t as t, n
                             from (select *, unnest(range(1, len(spans) + 1)) as n
                                   from {_ORDERED}))
                       where (regexp_matches(v, '\\p{{L}}') and length(v) >= 3)
                          or length(regexp_replace(v, '[^0-9]', '', 'g')) >= 6
                       group by source, id, text, v)))
     group by source, id, text)"""
MERGED = _merged_sql(f"select * from {_WITH_KNOWN}", "source, id")


def _redacted_sql(placeholder: str, merged: str = MERGED) -> str:
    """Texts rebuilt from merged spans, each replaced by ``placeholder``."""
    return f"""
    (select source, id, coalesce(clean, text) as text
     from {TEXTS} left join (
         select source, id, string_agg(substr(text, before + 1, s - before) || {placeholder},
                                       '' order by s)
                    || any_value(substr(text, last_e + 1)) as clean
         from (select *, coalesce(lag(e) over w, 0) as before,
                      max(e) over (partition by source, id) as last_e
               from {merged} window w as (partition by source, id order by s))
         group by source, id) using (source, id))"""


@check("redact", f"select source, id, text from {_redacted_sql(chr(39) + '[' + chr(39) + ' || t || ' + chr(39) + ']' + chr(39))}")
def redact(spark, sf_dir):
    return sanitize_table(texts(spark, sf_dir), ["source", "id"], ["text"], PLAIN)


_KEY = "trim(regexp_replace(lower({v}), '[\\s_.-]+', ' ', 'g'))"


@check(
    "pseudonym_key",
    f"""
    select v as value, {_KEY.format(v='v')} as key, count(*) as n
    from (select c_name as v from customer union all select s_name from supplier
          union all select n_name from nation
          union all select upper(replace(p_name, ' ', '-')) || '__' || p_brand || ' .' from part
          union all select email from {{users}} where email is not null)
    group by v""",
)
def pseudonym_key(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit("__"), "p_brand", F.lit(" ."))
    )
    values = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_name").alias("value"))
        .union(table(spark, sf_dir, "supplier").select("s_name"))
        .union(table(spark, sf_dir, "nation").select("n_name"))
        .union(part)
        .union(table(spark, sf_dir, "users").where("email is not null").select("email"))
    )
    return keyed(values.groupBy("value").agg(F.count("*").alias("n"))).select("value", "key", "n")


# Values under changing types: parts in two spellings, customers, line items.
_SEEN = """
    (select case when p_partkey % 2 = 0 then upper(replace(p_name, ' ', '-')) else p_name end
                as value, p_type as type, 1 as kind, cast(p_partkey as bigint) as a,
            cast(0 as bigint) as b from {part}
     union all select c_name, c_mktsegment, 2, c_custkey, 0 from {customer}
     union all select concat('order_', cast(l_orderkey as string)), min(l_returnflag), 3,
                      l_orderkey, l_linenumber
     from {lineitem} group by l_orderkey, l_linenumber)"""
_NUMBERED = """
    (select key, type, row_number() over (partition by type order by {order}) as n from {first})"""


@check(
    "pseudonym_vault",
    f"""
    with firsts as (
        select key, arg_min(type, seen) as type, min(seen) as seen
        from (select {_KEY.format(v='value')} as key, type,
                     [cast(kind as bigint), a, b] as seen from {_SEEN})
        group by key)
    select key, type, n, '[' || type || '_' || n || ']' as placeholder
    from {_NUMBERED.format(order='seen', first='firsts')}""",
)
def pseudonym_vault(spark, sf_dir):
    names = {n: table(spark, sf_dir, n) for n in ("part", "customer", "lineitem")}
    rows = spark.sql(f"select * from {_SEEN}", **names)
    seen = rows.select("value", "type", F.struct("kind", "a", "b").alias("seen"))
    return number_values(first_seen(keyed(distinct_values(seen))), empty_vault(spark))


@check("entity_counts", f"""
    with firsts as (
        select {_KEY.format(v="substr(text, s + 1, e - s)")} as key,
               arg_min(t, [source, lpad(cast(id as varchar), 12, '0'),
                           lpad(cast(s as varchar), 12, '0')]) as type
        from {MERGED} group by 1)
    select type, count(*) as n_values from firsts group by type""")
def entity_counts(spark, sf_dir):
    merged = merged_cells(texts(spark, sf_dir), ["source", "id"], ["text"], Policy())
    return count_entities(occurrences(merged))


@check(
    "distinct_texts",
    r"""
    select sha256(text) as digest, length(text) as n_chars
    from (select distinct text from documents where regexp_matches(text, '[\p{L}\p{N}]'))""",
)
def distinct_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text").where(needs_scan(F.col("text")))
    return distinct_text_rows(docs).select(
        "digest", F.length("text").cast("bigint").alias("n_chars")
    )


# ------------------------------------------------------------- known values

# Per conversation, the first one and two words of every turn count as names.
_NAMES = """
    (select conv_id, turn, text, pos, case pos when 0 then w[1] else w[1] || ' ' || w[2] end as v,
            case pos when 0 then 'PERSON_NAME' else 'PROPER_NAME' end as t
     from (select conv_id, turn, text, string_split(text, ' ') as w, unnest([0, 1]) as pos
           from conversations))"""


@check(
    "propagate",
    f"""
    with known as (
        select conv_id, v, arg_min(t, turn * 10 + pos) as t
        from (select conv_id, turn, pos, trim(v) as v, t from {_NAMES} where v is not null)
        where regexp_matches(v, '\\p{{L}}') and length(v) >= 3 group by conv_id, v),
    places as (
        select conv_id, turn, s, s + length(v) as e, t, length(v) as n
        from (select c.conv_id, turn, v, t, unnest(list_filter(
                     range(0, length(text) - length(v) + 1),
                     lambda i: substr(text, i + 1, length(v)) = v
                         and not regexp_matches(substr(text, i, case when i > 0 then 1 else 0 end),
                                                '[{_W}]')
                         and not regexp_matches(substr(text, i + length(v) + 1, 1), '[{_W}]')))
                     as s
              from conversations c join known k on k.conv_id = c.conv_id)),
    chosen as (
        select conv_id, turn, list_reduce(list_transform(list(struct_pack(s := s, e := e, t := t)
                   order by s, e desc), lambda x: struct_pack(
                       done := [x], free := x.e, s := x.s, x := x)),
               lambda a, b: case when b.s >= a.free
                   then struct_pack(done := list_append(a.done, b.x), free := b.free, s := b.s,
                                    x := b.x)
                   else a end).done as done
        from places group by conv_id, turn)
    select conv_id, turn, s as first_char, e as last_char, t as type
    from (select conv_id, turn, unnest(done, recursive := true) from chosen)""",
)
def propagate_(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    words = F.split("text", " ")
    one = F.length(words[0])
    two = one + 1 + F.length(words[1])
    named = F.array(
        F.struct(F.lit(0).alias("start"), one.alias("end"), F.lit("PERSON_NAME").alias("type")),
        F.struct(F.lit(0).alias("start"), two.alias("end"), F.lit("PROPER_NAME").alias("type")),
    ).cast(SPANS)
    cells = turns.select(
        F.struct("conv_id", "turn").alias("record"),
        F.struct("conv_id").alias("scope"),
        F.lit(0).alias("cell"),
        "text",
    )
    hits = cells.withColumn(
        "spans", F.filter(named, lambda s: s["end"].isNotNull())
    )
    found = propagate(cells, scope_values(hits))
    return found.select("record.*", F.explode("spans").alias("s")).select(
        "conv_id",
        "turn",
        F.col("s.start").cast("bigint").alias("first_char"),
        F.col("s.end").cast("bigint").alias("last_char"),
        "s.type",
    )


QUERIES["propagate"] = propagate_


# ---------------------------------------------------------------- nested values


@check(
    "walk_strings",
    """
    select conv_id, cast(floor(turn / 1000) as bigint) as part, count(*) as n_turns,
           string_agg(turn || ':' || md5(role) || ':' || md5(text), ' ' order by turn) as turns,
           md5(cast(conv_id as varchar)) as label, conv_id * 2 as number
    from conversations group by conv_id, part""",
)
def walk_strings(spark, sf_dir):
    nested = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / 1000).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select(
            "conv_id",
            "part",
            F.struct(
                F.struct((F.col("conv_id") * 2).alias("number")).alias("inner"),
                F.create_map(F.lit("label"), F.col("conv_id").cast("string")).alias("labels"),
                "turns",
            ).alias("tree"),
        )
    )
    walked = nested.withColumn(
        "tree", map_strings(F.col("tree"), nested.schema["tree"].dataType, F.md5)
    )
    line = F.transform(
        "tree.turns",
        lambda t: F.concat_ws(":", t["turn"].cast("string"), t["role"], t["text"]),
    )
    return walked.select(
        "conv_id",
        "part",
        F.size("tree.turns").cast("bigint").alias("n_turns"),
        F.array_join(line, " ").alias("turns"),
        F.col("tree.labels")["label"].alias("label"),
        F.col("tree.inner.number").alias("number"),
    )


# ------------------------------------------------------------------------ URLs

# Each page's site with personal data in path, query and fragment, and a foreign host.
_OWN = """
    (select page_id, site, url, page_id % 4 as form, concat(site, case page_id % 4
         when 0 then concat('/t/a', cast(page_id as string), '%40b.co/x')
         when 1 then concat('/s?q=u', cast(page_id as string), '@b.co&q=c+d&page=2')
         when 2 then concat('/zz/%zz/ok?k=1#u', cast(page_id as string), '@b.co')
         else '/plain%20path/?a=b&a=c#top' end) as own
     from {page_texts})"""
_OWN_CLEAN = """case form when 0 then site || '/t/%5BEMAIL_ADDRESS%5D/x'
    when 1 then site || '/s?q=%5BEMAIL_ADDRESS%5D&q=c+d&page=2'
    when 2 then site || '/zz/%zz/ok?k=1#%5BEMAIL_ADDRESS%5D' else own end"""


def _own_urls(spark, sf_dir):
    return spark.sql(f"select * from {_OWN}", page_texts=table(spark, sf_dir, "page_texts"))


def _clean_urls(spark, sf_dir):
    """The pages' URLs, nested in an array, redacted with their originals."""
    rows = _own_urls(spark, sf_dir).withColumn("links", F.array("url", "own"))
    policy = Policy(pseudonyms=False, site=F.col("site"))
    return sanitize_all(rows, ["page_id"], ["links"], policy)


@check("sanitize_url", f"select page_id, url, {_OWN_CLEAN} as own from {_OWN}")
def sanitize_url(spark, sf_dir):
    policy = Policy(pseudonyms=False, site=F.col("site"))
    rows = _own_urls(spark, sf_dir)
    return sanitize_table(rows, ["page_id"], ["own", "url"], policy).select(
        "page_id", "url", "own"
    )


@check(
    "url_originals",
    f"""
    select sanitized, arg_max(own, page_id) as original
    from (select page_id, own, {_OWN_CLEAN} as sanitized from {_OWN})
    where own <> sanitized group by sanitized""",
)
def url_originals(spark, sf_dir):
    return _clean_urls(spark, sf_dir).originals


@check(
    "restore_url",
    f"""
    with c as (select page_id, own, {_OWN_CLEAN} as sanitized from {_OWN})
    select page_id, case when sanitized = own then own else
               (select arg_max(own, page_id) from c d where d.sanitized = c.sanitized) end as own
    from c""",
)
def restore_url(spark, sf_dir):
    clean = _clean_urls(spark, sf_dir)
    own = clean.frame.select("page_id", F.col("links")[1].alias("own"))
    return restore_urls(own, clean.originals, "own").select("page_id", "own")


# ------------------------------------------------------------------ the whole plan

_VAULT = f"""
    (select source, id, s, e, key, first_value(t) over (partition by key order by source, id, s) as t
     from (select *, {_KEY.format(v="substr(text, s + 1, e - s)")} as key from {MERGED}))"""
_NAMED = f"""
    (select m.source, m.id, m.text, m.s, m.e, m.t, v.name
     from (select *, {_KEY.format(v="substr(text, s + 1, e - s)")} as key from {MERGED}) m
     join (select key, '[' || t || '_' || row_number() over (partition by t
                      order by first_seen) || ']' as name
           from (select key, any_value(t) as t, min([source, lpad(cast(id as varchar), 12, '0'),
                        lpad(cast(s as varchar), 12, '0')]) as first_seen
                 from {_VAULT} group by key)) v on v.key = m.key)"""


@check("sanitize_df", f"select source, id, text from {_redacted_sql('name', _NAMED)}")
def sanitize_df(spark, sf_dir):
    return sanitize_table(texts(spark, sf_dir), ["source", "id"], ["text"])


@check(
    "sanitize_errors",
    f"""
    with e as (select event_id, event_type, email from events join {{users}} on user_id = id),
    v as (select email, row_number() over (order by min(event_id)) as n from e group by email)
    select event_id, event_type || ' failed for [EMAIL_ADDRESS_' || n || '], see log' as message
    from e join v using (email)""",
)
def sanitize_errors(spark, sf_dir):
    users = table(spark, sf_dir, "users").select(F.col("id").alias("user_id"), "email")
    errors = (
        table(spark, sf_dir, "events")
        .join(users, "user_id")
        .select(
            "event_id",
            F.concat("event_type", F.lit(" failed for "), "email", F.lit(", see log")).alias("message"),
        )
    )
    return sanitize_error_table(errors, ["event_id"], "message")


_REPORT = rf"""
    select source, id, t as type, cast(sum(found) as bigint) as n_found,
           cast(coalesce(sum(found) filter (t = 'IP_ADDRESS'), 0) as bigint) as n_kept,
           cast(coalesce(sum(parts) filter (t <> 'IP_ADDRESS'), 0) as bigint) as n_redacted
    from (select source, id, t, 1 as found, 0 as parts from ({HITS})
          union all
          select source, id, t, 0, len(list_filter(regexp_split_to_array(substr(text,
                 cast(s as bigint) + 1, cast(e - s as bigint)),
                 '(?i)\bexample\.com\b|\bmail3\b|\b19\b'),
                 lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]')))
          from {_widened_sql(HITS)})
    group by source, id, t"""


@check("redaction_report", _REPORT)
def redaction_report(spark, sf_dir):
    rows = texts(spark, sf_dir).withColumn("parts", F.array("text"))
    policy = Policy(keep=("ip_address",), allow=ALLOWED)
    return report(rows, ["source", "id"], ["parts"], policy)


@check("sanitize_with_report", _REPORT)
def sanitize_with_report(spark, sf_dir):
    """The report that a sanitising run leaves."""
    rows = texts(spark, sf_dir).withColumn("parts", F.array("text"))
    policy = Policy(keep=("ip_address",), allow=ALLOWED, pseudonyms=False)
    return sanitize_and_report(rows, ["source", "id"], ["parts"], policy)[1]


@check("write_sanitized", f"select id as doc_id, text from {_redacted_sql(chr(39) + '[' + chr(39) + ' || t || ' + chr(39) + ']' + chr(39))} where source = 'document'")
def write_sanitized(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "sanitized")
    write_table(docs, path, ["doc_id"], ["text"], PLAIN, "json")
    return spark.read.schema("doc_id bigint, text string").json(path)


# A small word list that stands in for a trained model.
GAZETTEER = {
    "der": "PERSON_NAME", "the": "PROPER_NAME", "les": "PERSON_NAME", "que": "ORGANIZATION_NAME",
    "los": "PROPER_NAME", "her": "PERSON_NAME", "ein": "ORGANIZATION_NAME", "une": "PROPER_NAME",
}


@check(
    "detector_plugin",
    f"""
    select sha256(text) as digest, type, count(*) as n from (
        select text, case w {" ".join(f"when '{w}' then '{t}'" for w, t in GAZETTEER.items())}
                     end as type
        from (select text, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) as w
              from (select distinct text from documents)))
    where type is not null group by all""",
)
def detector_plugin(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    scanned = distinct_text_rows(docs.where(needs_scan(F.col("text"))))
    found = run_detector(scanned, GazetteerDetector(GAZETTEER))
    return (
        found.select("digest", F.explode("spans").alias("s"))
        .groupBy("digest", "s.type")
        .agg(F.count("*").alias("n"))
    )


@check(
    "detector_memo",
    f"""
    select sha256(text) as digest, type, run, count(*) as n from (
        select text, run, case w {" ".join(f"when '{w}' then '{t}'" for w, t in GAZETTEER.items())}
                          end as type
        from (select text, run, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) as w
              from (select text, if(bool_or(doc_id % 2 = 0), 1, 2) as run from documents group by text)))
    where type is not null group by all""",
)
def detector_memo(spark, sf_dir):
    """The documents of even id, then all: the second run detects only what the first had not."""
    docs = table(spark, sf_dir, "documents").where(needs_scan(F.col("text")))
    memo, detector = DetectionMemo(scratch_path(spark, "memo")), GazetteerDetector(GAZETTEER)
    memo.detect(distinct_text_rows(docs.where("doc_id % 2 = 0").select("text")), detector)
    found = memo.detect(distinct_text_rows(docs.select("text")), detector)
    run = memo.answers(spark, detector).select("digest", F.substring("run", 1, 6).cast("int").alias("run"))
    return (
        found.join(run, "digest").select("digest", "run", F.explode("spans").alias("s"))
        .groupBy("digest", "s.type", "run")
        .agg(F.count("*").alias("n"))
    )
