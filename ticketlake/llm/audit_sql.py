"""The filter audit and the vector codes in DuckDB SQL."""

from .filter_audit import FILTERS, MAX_CAPITALS, MIN_DISTINCT, MIN_WORDS, SYMBOLS
from .vector_codes import ENTRIES, LARGEST, PARTS, ROUNDS, SCALE

_N = len(FILTERS)
_STEPS = range(1, _N + 1)
_ORDER = " || ".join(f"f{k}.f" for k in _STEPS)
_FROM = ", ".join(f"filters f{k}" for k in _STEPS)
_DIFFERENT = " and ".join(f"f{a}.f <> f{b}.f" for a in _STEPS for b in _STEPS if a < b)

AUDIT_SQL = f"""
with filters as (select unnest(string_split('{",".join(FILTERS)}', ',')) as f),
orders as (select {_ORDER} as filter_order from {_FROM} where {_DIFFERENT}),
t as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    list_filter(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
  from documents
),
own as (
  select doc_id, part,
    case when len(ws) < {MIN_WORDS} then 'A' else '' end
    || case when 100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws) then 'B' else '' end
    || case when 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {MAX_CAPITALS} * length(text) then 'C' else '' end
    || case when regexp_matches(text, '[{SYMBOLS}]') then 'D' else '' end
    || case when doc_id is distinct from min(doc_id) over (partition by text) then 'E' else '' end as fails
  from t
),
said as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
  from labels where doc_id is not null group by doc_id
),
weighted as (
  select part, fails, count(*) as docs, sum(coalesce(good, 0)) as good, sum(coalesce(s.toxic, 0)) as toxic
  from own left join said s using (doc_id) group by part, fails
),
placed as (
  select part, filter_order, step, filter_order[step] as f, fails, docs, good, toxic,
    contains(fails, filter_order[step]) as here,
    length(translate(fails, filter_order[:step - 1], '')) < length(fails) as before
  from weighted, orders, (select unnest(range(1, {_N + 1})) as step)
),
counted as (
  select part, filter_order, step, any_value(f) as f,
    coalesce(sum(docs) filter (not here and not before), 0) as kept,
    coalesce(sum(docs) filter (here and not before), 0) as removed,
    coalesce(sum(docs) filter (here and before), 0) as redundant,
    coalesce(sum(docs) filter (fails = f), 0) as unique_fails,
    coalesce(sum(good) filter (here and not before), 0) as good_lost,
    coalesce(sum(toxic) filter (here and not before), 0) as toxic_lost
  from placed group by part, filter_order, step
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
  toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, f))::bigint as shapley
from counted
"""

_FINITE = "len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _round(k: int) -> str:
    """Assignment ``a{k}`` to the codebooks ``book{k}``; the codebooks of the next round."""
    return f"""
a{k} as materialized (
  select uid, part, arg_min(entry, (dist, entry)) as entry, min(dist) as dist
  from (
    select v.uid, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x)) as dist
    from v join book{k} b using (part, place) group by v.uid, v.part, b.entry
  )
  group by uid, part
),
book{k + 1} as materialized (
  select b.part, b.place, b.entry, coalesce(m.x, b.x) as x
  from book{k} b left join (
    select a.part, v.place, a.entry, floor(sum(v.x) / count(*))::bigint as x
    from a{k} a join v using (uid, part) group by a.part, v.place, a.entry
  ) m using (part, place, entry)
)"""


CODES_SQL = f"""
with kept as (
  select row_number() over (order by vec_id) as uid, vec_id, label, embedding from embeddings
  where len(embedding) > 0 and {_FINITE}
),
v as materialized (
  select uid, (i - 1) // (len(embedding) // {PARTS}) as part, (i - 1) % (len(embedding) // {PARTS}) as place,
    floor(greatest(-{LARGEST}, least({LARGEST}, {SCALE} * embedding[i]::double)))::bigint as x
  from (select uid, embedding, unnest(range(1, len(embedding) + 1)) as i from kept)
),
book0 as (select part, place, uid - 1 as entry, x from v where uid <= {ENTRIES}),
{",".join(_round(k) for k in range(ROUNDS + 1))},
coded as (
  select uid, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(dist)::bigint as error
  from a{ROUNDS} group by uid
),
digest as (select sha256(string_agg(x::varchar, ',' order by part, entry, place)) as h from book{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select h from digest) as codebooks_sha256
from coded join kept using (uid)
"""
