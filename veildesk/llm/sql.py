"""SQL for the queries of this subpackage that SQL can express, run by DuckDB over the tables.

Language and quality models, the secret battery, SimHash's hash function and token ids cannot
be written in it; their tests use brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

from veildesk.llm.common import ascii_words
from veildesk.llm.license_templates import BASE, MARK, NOTICES, Template

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ","
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

QUALITY_RULES = r"""
with docs as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
), cut as (
  select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from docs
), slid as (
  select r, list_transform(range(1, len(words) - 6), lambda p: array_to_string(words[p:p + 7], ' '))
    as wins
  from cut where len(words) >= 8
), placed as (
  select r, unnest(wins) as win, unnest(range(len(wins))) as p from slid
), twice as (
  select r, p from (select r, p, count(*) over (partition by r, win) as n from placed) where n > 1
), repeats as (
  select r, count(distinct p + k) as n from twice, range(8) as g(k) group by r
), lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select r, unnest(string_split(t, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
), counted as (
  select d.r, doc_id, source, len(words) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_dup, 0) as n_dup_lines,
    coalesce(x.n, 0) as n_repeat_words
  from docs d join cut c on c.r = d.r left join lines l on l.r = d.r left join repeats x on x.r = d.r
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
), failing as (
  select *, base_failed or 100 * n_symbols > 30 * n_words or 100 * n_dup_lines > 50 * n_lines
    or 10 * word_chars < 20 * n_words or 10 * word_chars > 200 * n_words as failed,
    100 * n_repeat_words > 15 * n_words or 100 * n_symbols > 15 * n_words
    or 100 * n_dup_lines > 25 * n_lines
    or 10 * word_chars < 30 * n_words or 10 * word_chars > 150 * n_words as borderline
  from judged
), hosts as (
  select source, count(*)::double as n, sum(failed::int)::double as f
  from failing where source is not null group by source
), moments as (
  select avg(f / n) as m, var_pop(f / n) as v, avg(1 / n) as i from hosts
), prior as (
  select m, m * (1 - m) / greatest((v - m * (1 - m) * i) / (1 - least(i, 0.999)), m * (1 - m) / 1e6)
    - 1 as raw
  from moments
), shape as (
  select if(m > 0 and m < 1, m * greatest(raw, 1e-3), 0.5) as a,
    if(m > 0 and m < 1, (1 - m) * greatest(raw, 1e-3), 0.5) as b
  from prior
), verdicts as (
  select source, (f + a) / (n + a + b) > 0.5 as rejected from hosts, shape
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
  n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, base_failed,
  not failed and not (borderline and coalesce(rejected, false)) as kept
from failing left join verdicts using (source)
"""

_PART = (
    "translate(to_base(('0x' || substr(h, {}, 10))::bigint, 32, 8),"
    " '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
)
WARC = f"""
with hashed as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h
  from pages
), shown as (
  select page_id, payload_bytes, {" || ".join(_PART.format(k) for k in (1, 11, 21, 31))}
    as payload_digest
  from hashed
), best as (
  select *, max(page_id) over (partition by payload_digest) as top from shown
)
select page_id, payload_bytes, payload_digest,
  if(page_id = top, 'response', 'revisit') as record_type, if(page_id = top, null, top) as refers_to
from best
"""

DECONTAMINATION = f"""
with docs as (
  select row_number() over () as r, doc_id, {_WORDS} as words from documents
), items as (
  select item_id, {_WORDS} as words from benchmark
), windows as (
  select distinct item_id, least(len(words), 10) as n,
    unnest(list_transform(range(1, greatest(len(words) - 8, 2)),
      lambda p: array_to_string(words[p:p + 9], ' '))) as win
  from items where len(words) > 0
), sizes as (
  select distinct n from windows
), slid as (
  select r, n, list_transform(range(1, len(words) - n + 2),
    lambda p: array_to_string(words[p:p + n - 1], ' ')) as wins
  from docs, sizes where len(words) >= n
), placed as (
  select r, n, unnest(wins) as win, unnest(range(len(wins))) as p from slid
), hits as (
  select distinct r, p, placed.n, item_id from placed join windows using (n, win)
), words as (
  select r, count(distinct p + k) as n_hit
  from (select r, p, unnest(range(n)) as k from (select distinct r, p, n from hits)) group by r
), named as (
  select r, list_sort(list(distinct item_id::varchar)) as ids from hits group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(len(ids), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join named using (r)
"""


def _other_than(word: str) -> str:
    """Any word but one, in an expression language that cannot look ahead."""
    parts = [f"[^ {word[0]}][^ ]*", f"{word}[^ ]+"]
    parts += [f"{word[:k]}(?:[^ {word[k]}][^ ]*)?" for k in range(1, len(word))]
    return f"(?:{'|'.join(parts)})"


def _expression(template: Template) -> str:
    """A template as an expression over words that each end with a space."""
    out = []
    for mark in MARK.finditer(template.wording):
        if mark[0] == "<<beginOptional>>":
            out.append("(?:")
        elif mark[0] == "<<endOptional>>":
            out.append(")?")
        elif mark[1]:
            word = _other_than(mark[3]) if mark[3] else "[^ ]+"
            out.append(f"(?:{word} ){{{mark[1]},{mark[2]}}}")
        else:
            out.append("".join(w.decode() + " " for w in ascii_words(mark[4])).replace(".", "[.]"))
    return " " + "".join(out)


def _labels(templates: tuple[Template, ...]) -> str:
    tests = ", ".join(
        f"if(regexp_matches(line, '{_expression(t)}'), '{t.label}', null)" for t in templates
    )
    return f"list_sort(list_distinct(list_filter([{tests}], lambda x: x is not null)))"


def _starts(template: Template) -> str:
    words = [w.decode() for w in ascii_words(template.wording)]
    same = " and ".join(f"words[p + {k}] = '{w}'" for k, w in enumerate(words, 1))
    return f"list_filter(range(len(words)), lambda p: {same})"


LICENSE_SCANS = f"""
with cut as (
  select doc_id, {_WORDS} as words from documents
), found as (
  select doc_id, words, ' ' || array_to_string(words, ' ') || ' ' as line,
    flatten([{", ".join(_starts(t) for t in BASE)}]) as starts
  from cut
), labelled as (
  select *, {_labels(BASE)} as base, {_labels(NOTICES)} as notices from found
)
select doc_id, len(words)::bigint as n_words, len(starts)::bigint as n_base,
  list_min(starts)::bigint as first_word, list_max(starts)::bigint as last_word,
  coalesce(array_to_string(base, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_concat(base, notices)), ','), '') as labels,
  case when len(notices) > 0 then 1.0 when len(starts) > 0 then 0.5 else 0.0 end::double as score
from labelled
"""


RANKED_SEARCH = f"""
with docs as (
  select row_number() over () as r, doc_id, unnest({_WORDS}) as term from documents
), grid as (
  select r, doc_id, term, count(*) as tf from docs group by all
), lengths as (
  select r, count(*) as n from docs group by r
), corpus as (
  select count(*) as n_docs, sum(n)::bigint as n_terms from lengths
), frequencies as (
  select term, count(*) as df from grid group by term
), weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from frequencies, corpus
), items as (
  select distinct item_id, unnest({_WORDS}) as term from benchmark
), scored as (
  select item_id, r, any_value(doc_id) as doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint
      as score
  from items join weights using (term) join grid using (term) join lengths using (r), corpus
  group by item_id, r
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
    doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 50
"""

#: crc32, byte by byte from the polynomial, over hexadecimal digits.
_CRC_BIT = "if(({c}) & 1 = 1, xor(({c}) >> 1, 3988292384), ({c}) >> 1)"
_CRC_STEP = "list_reduce(range(8), lambda c, k: {bit}, xor(c, b))".format(bit=_CRC_BIT.format(c="c"))
_BYTES = "list_transform(range(strlen({t})), lambda i: ('0x' || substr(hex(encode({t})), 2 * i + 1, 2))::bigint)"
_CRC = (
    "xor(list_reduce(" + _BYTES + ", lambda c, b: " + _CRC_STEP + ", 4294967295::bigint), 4294967295)"
)

SPELLING_VARIANTS = f"""
with recursive runs as (
  select coalesce(doc_id::varchar, '') as d,
    unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\u00C0-\u00FF]+')) as run
  from documents
), counted as (
  select run, d || ':' || run as place, count(*) as n from runs group by d, run
), hashed as (
  select run, n, {_CRC.format(t="place")} as h from counted where length(run) >= 6
), slipped as (
  select if(h % 199 = 0,
    left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2), run) as word, n
  from hashed
), words as (
  select word, sum(n)::bigint as n from slipped where length(word) >= 6
  group by word having sum(n) >= 5
), cut as (
  select word, n, unnest(range(length(word))) as i from words
), less as (
  select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest from cut
), pairs as (
  select distinct a.word, a.n, b.word as near, b.n as m
  from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select less.word, less.n, words.word, words.n from less join words on words.word = rest
), both_ways as (
  select word, near, m from pairs union select near, word, n from pairs
), best as (
  select word, count(*) as n_near, max(m) as m,
    (list(near order by m desc, near))[1] as near
  from both_ways group by word
), forms as (
  select word, n, if(m >= 5 * n, near, null) as form, if(m >= 5 * n, m, null)::bigint as form_n,
    coalesce(n_near, 0)::bigint as n_near
  from words left join best using (word)
), chain as (
  select word, word as root, form as ahead from forms
  union all
  select chain.word, forms.word, forms.form from chain join forms on forms.word = chain.ahead
)
select word, form, root, n, n_near, form_n
from forms join (select word, root from chain where ahead is null) using (word)
"""
