"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# The alphabet of base32, and the characters of a word.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WORD = r"[^\x20\x09-\x0D]+"

#: 160 bits as 8 numbers of 20 bits, each of which makes 4 letters.
OP3_WARC = f"""
with paid as (
  select page_id, encode(coalesce(html, '')) as payload from pages
),
hashed as (
  select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex from paid
),
named as (
  select *, array_to_string([substr('{_BASE32}', cast(
      (('0x' || substr(hex, cast(5 * (n // 4) + 1 as int), 5))::bigint >> (15 - 5 * (n % 4))) & 31 as int) + 1, 1)
    for n in range(0, 32)], '') as payload_digest
  from hashed
)
select p.page_id, s.url, p.payload_bytes, p.payload_digest,
  case when p.page_id = least_id then 'response' else 'revisit' end as record_type,
  case when p.page_id <> least_id then least_id end as refers_to
from (select *, min(page_id) over (partition by payload_digest) as least_id from named) p
join pages s using (page_id)
"""

#: The resharing of `mixing.source_rates`, and the draws of `common.hash_draw`.
OP4_MIXING = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) as size from documents
),
per as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by encode(source) nulls last) - 1 as place
  from sized group by source
),
capped as (
  select *, [5.0, 2.0, 1.0][place % 3 + 1]::double as weight, source_size * 3.0::double as cap from per
),
along as (
  select *, cast(sum(source_size) over () as double) as words,
    coalesce(sum(cap) over ahead, 0) as cap_ahead,
    sum(weight) over () - coalesce(sum(weight) over ahead, 0) as weight_left
  from capped
  window ahead as (order by cap / weight, encode(source) nulls last rows between unbounded preceding and 1 preceding)
),
units as (select *, (words - cap_ahead) / weight_left as unit from along),
targets as (
  select source, source_size,
    case when cap <= unit * weight then cap
      else max(case when cap > unit * weight then unit end) over () * weight end as target
  from units
),
rates as (
  select *, case when source_size > 0 then least(target / source_size, 3.0::double) else 0 end as rate from targets
),
drawn as (
  select doc_id, size, source_size, target, rate,
    (('0x' || substr(md5('mix/' || coalesce(cast(doc_id as varchar), 'null')), 1, 12))::bigint + 0.5::double) / 281474976710656 as draw
  from sized s join rates r on s.source is not distinct from r.source
)
select doc_id, size, source_size, target,
  cast(size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from drawn
"""

#: All pairs of one label by brute force; components by the smallest id reachable.
OP6_NEAR_VECTORS = """
with recursive usable as (
  select vec_id, label, [x::double for x in embedding] as v
  from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0
),
links as materialized (
  select a.vec_id as a, b.vec_id as b
  from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(a, b) as (
  select a, b from links
  union
  select r.a, l.b from reach r join links l on r.b = l.a
),
counts as (select a, count(*) as n_links from links group by a),
roots as (select a, least(a, min(b)) as root from reach group by a)
select e.vec_id, coalesce(n_links, 0) as n_links, coalesce(root, e.vec_id) as component_id,
  coalesce(root, e.vec_id) = e.vec_id as kept
from embeddings e left join counts c on c.a = e.vec_id left join roots r on r.a = e.vec_id
"""

#: Every query against every other row.
OP10_TOP_K = """
with whole as (
  select vec_id, [floor(x::double * 64) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored
qualify rank <= 20
"""

#: Equal normalised texts by window functions; the longest original, then the smallest doc_id stays.
OP11_CHUNK_DEDUP = r"""
with bare as (
  select doc_id, coalesce(length(text), 0) as n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
  from documents
)
select doc_id, text_sha256, count(*) over (partition by bare) as group_size,
  first_value(doc_id) over best as keep_id, row_number() over best = 1 as kept
from bare
window best as (partition by bare order by n_chars desc, doc_id nulls last)
"""


def _op12(k: int, rounds: int, scale: int, size: int, seed: int) -> str:
    """Lloyd's rounds over one row per component; every distance is computed."""
    parts = [f"""
with recursive kept as (
  select row_number() over () as rid, vec_id, [cast(floor({scale} * x::double) as bigint) for x in embedding] as v
  from embeddings
  where len(embedding) = {size} and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
points as materialized (select rid, unnest(range({size})) as d, unnest(v) as x from kept),
seeds as (
  select row_number() over (order by sha256('{seed}:' || vec_id) nulls last, v) - 1 as c, v from kept qualify c < {k}
),
centroids0 as materialized (select c, unnest(range({size})) as d, unnest(v) as x from seeds)"""]
    for at in range(rounds + 1):
        parts.append(f"""
placed{at} as materialized (
  select rid, arg_min(c, (apart, c)) as c, min(apart) as apart
  from (
    select rid, c, sum((p.x - q.x) * (p.x - q.x)) as apart from points p join centroids{at} q using (d) group by rid, c
  ) group by rid
)""")
        if at < rounds:
            parts.append(f"""
sums{at} as (select c, d, sum(x) as total, count(*) as n from placed{at} join points using (rid) group by c, d),
centroids{at + 1} as materialized (
  select c, d, cast(coalesce((total - ((total % n) + n) % n) // n, x) as bigint) as x from centroids{at} left join sums{at} using (c, d)
)""")
    return ",".join(parts) + f"""
select vec_id, cast(c as int) as cluster, cast(apart as bigint) as distance,
  cast(sum(apart) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(apart) over () as bigint) as inertia, name as centroid_sha256
from placed{rounds} join kept using (rid)
join (select c, sha256(string_agg(x::varchar, ',' order by d)) as name from centroids{rounds} group by c) using (c)
"""


OP12_BISECTORS = _op12(40, 5, 256, 64, 2)

#: The same edits as the cheapest path through one turn after the other, instead of intervals.
#: A path is in one of four states: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant.
OP13_REPAIR = r"""
with recursive crc_table as (
  select list(value order by n) as entry from (
    select n, list_reduce(list_prepend(n, range(8)), lambda crc, i: case when crc & 1 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end) as value
    from range(256) t(n)
  )
),
named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
),
summed as (
  select *, xor(list_reduce(
      list_prepend(4294967295, [cast(unicode(x) as bigint) for x in string_split(name, '')]),
      lambda crc, b: xor(crc >> 8, entry[(xor(crc, b) & 255) + 1])), 4294967295) % 20 as fault
  from named, crc_table
),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when fault = 3 then 2 else 1 end)) as copy
  from summed where fault <> 0
),
numbered as (select *, row_number() over () as rid from damaged),
placed as (
  select *, row_number() over same_conv as place, row_number() over (partition by conv_id, role, text order by turn nulls first, rid) > 1 as again,
    substr(role, 1, 1) as initial,
    lag(substr(role, 1, 1)) over same_conv || substr(role, 1, 1) as pair
  from numbered
  window same_conv as (partition by conv_id order by turn nulls first, role, text, rid)
),
faulty as (
  select *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') as solid from placed
),
judged as (
  select conv_id, turn, place, role, text, initial, pair,
    case when solid = '' then 'blank' when again then 'duplicate' when right(solid, 1) not in ('.', '!', '?') then 'truncated' end as fault
  from faulty
),
steps(p, symbol, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
wanted(symbol, name) as (values ('u', 'user'), ('a', 'assistant')),
added(p, q, cost, audit, body) as (
  values (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 3, 'I', e'user:\n'), (0, 3, 6, 'II', e'user:\nassistant:\n'), (1, 2, 3, 'I', e'user:\n'),
    (1, 3, 6, 'II', e'user:\nassistant:\n'), (2, 3, 3, 'I', e'assistant:\n'), (3, 2, 3, 'I', e'user:\n')
),
edits as materialized (
  select j.conv_id, place, p, q, if(fault = 'truncated', 3, 0) as cost, 'K' as audit, role || ':' || text || e'\n' as body
  from judged j join steps on symbol = initial where fault is null or fault = 'truncated'
  union all
  select j.conv_id, place, p, q, if(fault = 'truncated', 6, 3), 'R', name || ':' || text || e'\n'
  from judged j join steps on true join wanted using (symbol) where fault is null or fault = 'truncated'
  union all
  select j.conv_id, place, p, p, 4, 'D', '' from judged j join range(4) t(p) on true
),
convs as (select a.conv_id, coalesce(max(place), 0) as places from (select distinct conv_id from conversations) a left join judged b on a.conv_id is not distinct from b.conv_id group by a.conv_id),
paths(conv_id, place, q, cost, audit, body) as (
  select conv_id, 0, q, cost, audit, body from convs join added on p = 0 where places > 0
  union all
  select * from (
    select conv_id, place, q, min(cost) as cost, arg_min(audit, (cost, audit)) as audit, arg_min(body, (cost, audit)) as body
    from (
      select w.conv_id, e.place, i.q, w.cost + e.cost + i.cost as cost, w.audit || e.audit || i.audit as audit, w.body || e.body || i.body as body
      from paths w join edits e on e.conv_id is not distinct from w.conv_id and e.place = w.place + 1 and e.p = w.q
      join added i on i.p = e.q
    ) group by conv_id, place, q
  )
),
ended as (
  select c.conv_id, min(cost) as cost, arg_min(audit, (cost, audit)) as audit, arg_min(body, (cost, audit)) as body
  from convs c join paths w on w.conv_id is not distinct from c.conv_id and w.place = c.places where q in (0, 3) group by c.conv_id
),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 'blank') as blank,
    count_if(fault = 'duplicate') as duplicate, count_if(fault = 'truncated') as truncated,
    count_if(pair not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id
)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(cost as bigint), 0) as cost,
  coalesce(audit, '') as audit, sha256(coalesce(if(body = '', '', left(body, length(body) - 1)), '')) as repaired_sha256
from convs c left join counted n on n.conv_id is not distinct from c.conv_id left join ended e on e.conv_id is not distinct from c.conv_id
"""
