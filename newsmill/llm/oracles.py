"""DuckDB SQL for those queries of this folder that SQL can express."""

from newsmill.llm.licenses import TEMPLATES

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
  select doc_id,
    case when w is null or len(w) = 0 then []
         when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
    end as s
  from words
), shingles as (
  select doc_id, unnest(s) as g from sets
), common as (
  select a.doc_id as u, b.doc_id as v, count(*) as n
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
  select u, v from common
  join sets a on a.doc_id = u join sets b on b.doc_id = v
  where 100 * n >= 85 * (len(a.s) + len(b.s) - n)
), ways as (
  select u, v from links union all select v, u from links
), reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, ways.v from reach join ways on reach.other = ways.u
)
select sets.doc_id, len(s)::bigint as n_shingles, min(other) as component_id, sets.doc_id = min(other) as kept
from sets join reach using (doc_id) group by sets.doc_id, s
"""

OP10 = f"""
with docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), items as (
  select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark
), item_windows as (
  select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as g
  from (
    select item_id, w, least(10, len(w)) as n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as p
    from items where len(w) > 0
  )
), doc_windows as (
  select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as g
  from (
    select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p
    from docs, (select distinct n from item_windows) where len(w) >= n
  )
), hits as (
  select doc_id, item_id, p, n from doc_windows join item_windows using (n, g)
), words as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(generate_series(p, p + n - 1)) as place from hits) group by doc_id
), found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id
)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (doc_id) left join found using (doc_id)
"""

_TEMPLATES = ", ".join(
    "('{}', {}, '{}')".format(name, i, text.replace("'", "''"))
    for name, group in TEMPLATES.items()
    for i, text in enumerate(group)
)
_SHINGLES = """case when len(w) >= 5 then list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end"""
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8 = f"""
with docs as (
  select doc_id, {_SHINGLES} as s from (select doc_id, {_WORDS} as w from documents)
), placed as (
  select doc_id, len(s) as size, unnest(s) as g, unnest(generate_series(0, len(s) - 1)) as p from docs where len(s) > 0
), templates as (
  select license, number, list_distinct({_SHINGLES}) as t
  from (select license, number, {_WORDS} as w from (values {_TEMPLATES}) as v(license, number, text))
), sized as (
  select license, number, t, len(t) as n, (2 ** greatest(0, ceil(log2(len(t) / 3.0))))::bigint as block from templates
), rivals as (
  select a.license, a.number, list_filter(a.t, lambda g: not list_contains(b.t, g)) as own
  from templates a join templates b on a.license <> b.license
  where 100 * len(list_filter(a.t, lambda g: list_contains(b.t, g))) >= 50 * len(a.t)
), hits as (
  select doc_id, size, p, placed.g, license, number, n, block
  from placed join (select *, unnest(t) as g from sized) using (g)
), windowed as (
  select *, unnest(generate_series(
    greatest(0, ceil((p - 4 * block + 1) / block::double)::bigint),
    least(p // block, greatest(size - block, 0) // block))) * block as start
  from hits
), parts as (
  select doc_id, license, number, min(p) as place, count(distinct g) / n as part, list(distinct g) as found
  from windowed group by doc_id, license, number, n, start having count(distinct g) * 100 >= n * 80
), verified as (
  select doc_id, license, place, part from parts anti join rivals
  on parts.license = rivals.license and parts.number = rivals.number
    and 2 * len(list_filter(own, lambda g: list_contains(found, g))) < len(own)
)
select doc_id, license, place::int as first_word, part as containment
from verified qualify row_number() over (partition by doc_id, license order by part desc, place) = 1
"""

OP11 = """
with units as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || doc_id) as h,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as w
  from documents
), drawn as (
  select doc_id, t, w, len(w) as n, ('0x' || h[1:8])::bigint % (len(w) + 1) as c1, ('0x' || h[9:16])::bigint % (len(w) + 1) as c2,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 50
      then 'plain' when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form
  from units
), parts as (
  select doc_id, t, n, form, array_to_string(w[1:least(c1, c2)], '') as p,
    array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], '') as m, array_to_string(w[greatest(c1, c2) + 1:], '') as s
  from drawn
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(p) end::bigint as prefix_chars,
  case when form <> 'plain' then length(m) end::bigint as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""

OP12 = """
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents
), words as (
  select row, lang, source, unnest(w) as term from docs
), kept as (
  select lang, term, count(*) as total from words group by all having count(distinct row) >= 10
), langs as (
  select lang, count(*) as v, sum(total) as n from kept group by lang
), groups as (
  select distinct lang, source from docs
), counts as (
  select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all
), sized as (
  select lang, source, coalesce(sum(c), 0) as n from groups left join counts using (lang, source) group by all
), shares as (
  select lang, source, term, coalesce(c, 0) as c,
    1 + 1000000000::hugeint * (coalesce(c, 0) + 2) // (sized.n + 2 * langs.v) as p,
    1 + 1000000000::hugeint * (kept.total + 2) // (langs.n + 2 * langs.v) as q
  from sized join kept using (lang) join langs using (lang) left join counts using (lang, source, term)
), near as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join near on near.lang = a.lang and near.source = a.source and near.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from shares where c > 0 and p > q
)
select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
from parts qualify part = 'pair' or rank <= 10
"""

SQL: dict[str, str] = {"op8_licenses": OP8, "op4_near_dups": OP4, "op10_decontamination": OP10, "op11_fill_in_middle": OP11,
                       "op12_source_divergence": OP12}
