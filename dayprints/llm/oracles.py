"""SQL for the exact operators whose statement is long."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def byte_shards(shards: int) -> str:
    """Midpoints of rows in doc_id order; crc32 byte for byte by its polynomial's table."""
    return f"""
with recursive steps(byte, bit, c) as (
  select range, 0, range from range(256)
  union all
  select byte, bit + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
  from steps where bit < 8),
crc as (select list(c order by byte) as t from steps where bit = 8),
d as (
  select doc_id, coalesce(octet_length(encode(text)), 0) + 1 as size,
         xor(list_reduce(
           list_prepend(4294967295::bigint, list_transform(
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda x: ('0x' || x)::bigint)),
           lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as text_crc32
  from documents, crc),
p as (
  select *, sum(size) over o as ends, sum(size) over () as total,
         row_number() over o as place
  from d window o as (order by doc_id nulls first, text_crc32, size
                      rows between unbounded preceding and current row)),
s as (
  select *, least((2 * ends - size) * {shards} // (2 * total), {shards - 1})::int as shard from p)
select doc_id, size, text_crc32, 'bytes' as law, shard,
       place - min(place) over (partition by shard) as slot, null::int as grown_shard
from s"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Each round as two more steps: nearest entries of all parts, then new entries."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as (
  select vec_id, part, p, min(d) as d, arg_min(entry, (d, entry)) as entry
  from (select vec_id, part, v.p, entry,
               list_sum(list_transform(list_zip(v.p, b.p),
                                       lambda x: (x[1] - x[2]) * (x[1] - x[2])))::bigint as d
        from v join b{i} b using (part))
  group by all)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} as (
  select part, entry, coalesce(m.p, b.p) as p
  from b{i} b left join (
    select part, entry, list(x order by pos) as p
    from (select part, entry, pos, floor_div as x
          from (select part, entry, pos, s, n,
                       case when s >= 0 then s // n else -((n - 1 - s) // n) end as floor_div
                from (select part, entry, pos, sum(x) as s, count(*) as n
                      from (select part, entry, unnest(p) as x,
                                   generate_subscripts(p, 1) as pos from a{i})
                      group by all)))
    group by all) m using (part, entry))""")
    last = f"a{rounds}"
    return f"""
with k as (
  select vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
v as (
  select vec_id, i as part, v[i * (len(v) // {parts}) + 1 : (i + 1) * (len(v) // {parts})] as p
  from k, range({parts}) r(i)),
b0 as (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, p
  from v qualify entry < {entries}),{",".join(steps)},
digest as (
  select sha256(string_agg(x::varchar, ',' order by part, entry, pos)) as codebooks_sha256
  from (select part, entry, unnest(p) as x, generate_subscripts(p, 1) as pos from b{rounds})),
e as (
  select vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code,
         sum(d)::bigint as error
  from {last} group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
       codebooks_sha256
from e join k using (vec_id), digest"""


def source_divergence(min_docs: int = 3, top: int = 200, unit: int = 1_000_000_000) -> str:
    """Every group against every kept term of its language."""
    return f"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text
  from documents),
w as (
  select doc, lang, source,
         unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from d),
kept as (
  select lang, term, count(*) as n_lang from w
  group by all having count(distinct doc) >= {min_docs}),
sizes as (select lang, count(*) as v, sum(n_lang) as n_all from kept group by all),
groups as (select distinct lang, source from d),
n as (select lang, source, term, count(*) as n from w join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) as own from n group by all),
p as (
  select lang, source, term, coalesce(n, 0) as n,
         1 + ({unit}::hugeint * (coalesce(n, 0) + 1)) // (coalesce(own, 0) + v) as p,
         1 + ({unit}::hugeint * (n_lang + 1)) // (n_all + v) as q
  from groups join kept using (lang) join sizes using (lang)
  left join n using (lang, source, term) left join totals using (lang, source)),
pairs as (
  select a.lang, a.source, b.source as item,
         sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all),
pair as (
  select g.lang, g.source, 'pair' as part, h.source as item, coalesce(value, 0) as value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join pairs on pairs.lang = g.lang and pairs.source = g.source and item = h.source),
term as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // q as value
  from p where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part
                               order by value desc, encode(item)) as rank
  from (select * from pair union all select * from term))
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= {top}"""
