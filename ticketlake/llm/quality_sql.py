"""The quality rules in DuckDB SQL."""

from .quality import MEASURES, MIN_GROUP, MIN_WORDS


def _rate(name: str) -> str:
    top, under, *_ = MEASURES[name]
    return f"coalesce((1000 * {top}) // nullif({under}, 0), 0)"


def _of_measure(place: int, column: str = "measure") -> str:
    """A parameter of the row's measure."""
    return f"case {column} " + " ".join(f"when '{k}' then {v[place]}" for k, v in MEASURES.items()) + " end"


def _level(keys: str, name: str) -> str:
    group = f"{keys}, " if keys else ""
    over = f"partition by {group}measure"
    return f"""
{name}_cells as (select {group}measure, cell, sum(n) as n from cells group by {group}measure, cell),
{name}_sums as (select *, sum(n) over ({over} order by cell) as seen, sum(n) over ({over}) as docs from {name}_cells),
{name} as (
  select {group}measure, max(docs) as docs, min(cell) filter (where seen >= (docs + 1) // 2) as mid,
    min(cell) filter (where seen >= (docs * {_of_measure(2)} + 99) // 100) as high
  from {name}_sums group by {group}measure
)"""


_PICK = "case when a.docs >= {m} then a.{c} when b.docs >= {m} then b.{c} else c.{c} end"
_MID, _HIGH = _PICK.format(m=MIN_GROUP, c="mid"), _PICK.format(m=MIN_GROUP, c="high")

SQL = f"""
with t as (
  select doc_id, lang, source, coalesce(text, '') as text,
    list_filter(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
  from documents
),
places as (
  select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from t where len(ws) >= 3
),
grams as (
  select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as found from places
),
inside as (
  select doc_id, count(distinct p) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as p from grams where found > 1
  ) group by doc_id
),
counted as (
  select t.doc_id, lang, source, len(ws) as n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from t left join inside on t.doc_id = inside.doc_id
),
val as (
  {" union all ".join(f"select lang, source, '{m}' as measure, {_rate(m)} as v from counted where n_words > 0" for m in MEASURES)}
),
cells as (
  select lang, source, measure,
    v - v % (2 ** greatest(length(ltrim(bin(v), '0')) - 7, 0))::bigint as cell, count(*) as n
  from val group by all
),
{_level("lang, source", "by_source")},
{_level("lang", "by_lang")},
{_level("", "overall")},
wanted as (select distinct lang, source, measure from cells),
most as (
  select w.lang, w.source, w.measure,
    {_HIGH} + case when {_HIGH} > {_MID} then {_of_measure(3, "w.measure")} * ({_HIGH} - {_MID})
      else {_of_measure(4, "w.measure")} end as most
  from wanted w
  left join by_source a on w.lang is not distinct from a.lang and w.source is not distinct from a.source
    and w.measure = a.measure
  left join by_lang b on w.lang is not distinct from b.lang and w.measure = b.measure
  left join overall c on w.measure = c.measure
),
limits as (
  select lang, source, {", ".join(f"max(most) filter (where measure = '{m}')::bigint as most_{m}" for m in MEASURES)}
  from most group by lang, source
),
judged as (
  select c.*, {", ".join(f"most_{m}" for m in MEASURES)},
    n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed
  from counted c left join limits l
    on c.lang is not distinct from l.lang and c.source is not distinct from l.source
)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
  {", ".join(f"most_{m}" for m in MEASURES)}, base_failed,
  not base_failed and {" and ".join(f"{_rate(m)} <= coalesce(most_{m}, {_rate(m)})" for m in MEASURES)} as kept
from judged
"""
