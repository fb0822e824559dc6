"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Keys of the lattice: eight digits of cost, then the audit, so that the least string is the cheapest, ASCII-least path.
def _dearer(key: str, letter: str, cost: int | str) -> str:
    return f"lpad((substr({key}, 1, 8)::bigint + {cost})::varchar, 8, '0') || '{letter}' || substr({key}, 9)"


def _inserted(new: str, s: str, u: str, a: str) -> str:
    """Keys of the four states before rows follow, with inserts."""
    a1, u1 = _dearer(u, "I", 5), _dearer(a, "I", 5)
    two = f"lpad((substr({a}, 1, 8)::bigint + 10)::varchar, 8, '0') || 'II' || substr({a}, 9)"
    return (f"least({new}, {_dearer(u, 'I', 5)}, {two}) as kn, least({s}, {_dearer(u, 'I', 5)}, {two}) as ks, "
            f"least({u}, {u1}) as ku, least({a}, {a1}) as ka")


def _row(state: str, after: str, kept: str) -> str:
    """The key of ``state`` before a row, inserts apart."""
    edits = f"{_dearer('k' + after, 'R', 'dear + 1')}), ({kept}"
    return f"list_min([x for x in [({_dearer('k' + state, 'D', 2)}), ({edits})] if x is not null])"


def _kept(initial: str, after: str) -> str:
    return f"case when i = '{initial}' then {_dearer('k' + after, 'K', 'dear')} end"


CONVERSATIONS = f"""
with recursive bits(n, r, c) as (
  select n, 0, n::bigint from range(256) as g(n) union all
  select n, r + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where r < 8),
crc as (select list(c order by n) as tab from bits where r = 8),
said as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
hits as (select *, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(k, ''), lambda c: ord(c)::bigint)),
                                   lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 as hit from said, crc),
damaged as (
  select conv_id, turn, case when hit = 4 then 'user' else role end as role,
         case hit when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from hits, unnest(range(case hit when 0 then 0 when 3 then 2 else 1 end)) as c(copy)),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as p from damaged),
ordered as (
  select *, row_number() over (partition by conv_id, role, text order by p) as nth,
         rtrim(text, {_SPACES}) as kept, role[1] as r1, lag(role[1]) over (partition by conv_id order by p) as r0 from placed),
faults as (
  select *, case when kept = '' then 'b' when nth > 1 then 'd' when kept[-1] not in ('.', '!', '?') then 't' else '' end as fault
  from ordered),
coded as (select *, case when fault in ('b', 'd') then 'd' when r1 in ('s', 'u', 'a') then r1 else 'x' end as i,
                 case when fault = 't' then 5 else 0 end as dear from faults),
stats as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
         count(*) filter (fault = 't') as truncated,
         count(*) filter (p > 1 and r0 || r1 not in ('su', 'ua', 'au')) as illegal from coded group by conv_id),
steps as (
  select conv_id, n as p, {_inserted("'00000000'", "null::varchar", "null::varchar", "'00000000'")} from stats
  union all
  select conv_id, p, {_inserted('bn', 'bs', 'bu', 'ba')} from (
    select s.conv_id, s.p - 1 as p,
      case when i = 'd' then {_dearer('kn', 'D', 2)} else {_row('n', 'u', f"coalesce({_kept('s', 's')}, {_kept('u', 'u')})")} end as bn,
      case when i = 'd' then {_dearer('ks', 'D', 2)} else {_row('s', 'u', _kept('u', 'u'))} end as bs,
      case when i = 'd' then {_dearer('ku', 'D', 2)} else {_row('u', 'a', _kept('a', 'a'))} end as bu,
      case when i = 'd' then {_dearer('ka', 'D', 2)} else {_row('a', 'u', _kept('u', 'u'))} end as ba
    from steps s join coded c on c.conv_id is not distinct from s.conv_id and c.p = s.p)),
best as (select conv_id, substr(kn, 1, 8)::bigint as cost, substr(kn, 9) as audit from steps where p = 0),
edits as (
  select conv_id, k, e, count(*) filter (e <> 'I') over w as p, count(*) filter (e <> 'D') over w as m
  from (select conv_id, k, audit[k] as e from best, unnest(range(1, length(audit) + 1)) as r(k))
  window w as (partition by conv_id order by k)),
lines as (
  select e.conv_id, k, e, m, role, text,
         max(case when m = 1 and e = 'K' and c.i = 's' then 1 else 0 end) over (partition by e.conv_id) as led
  from edits e left join coded c on e.e <> 'I' and c.conv_id is not distinct from e.conv_id and c.p = e.p where e <> 'D'),
repaired as (
  select conv_id, string_agg(case when e = 'K' then role when (m - led) % 2 = 1 then 'user' else 'assistant' end
                             || ':' || coalesce(text, ''), chr(10) order by k) as said
  from lines group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
       coalesce(audit, '') as audit, sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join stats s on s.conv_id is not distinct from c.conv_id left join best b on b.conv_id is not distinct from c.conv_id
left join repaired r on r.conv_id is not distinct from c.conv_id"""


def _vector_codes(rounds: int = 4) -> str:
    near = """a{r} as (select id, part, min(struct_pack(d := d, e := entry)) as best from (
  select id, p.part, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
  from parts p join b{r} b on p.part = b.part) group by id, part),"""
    move = """b{s} as (select b.part, b.entry, coalesce(m.x, b.x) as x from b{r} b left join (
  select part, entry, list(q order by j) as x from (
    select a.part, a.best.e as entry, j, ((sum(p.x[j]) - ((sum(p.x[j]) % count(*)) + count(*)) % count(*)) // count(*))::bigint as q
    from a{r} a join parts p using (id, part), unnest(range(1, len(p.x) + 1)) as g(j) group by a.part, a.best.e, j)
  group by part, entry) m using (part, entry)),"""
    sql = """
with v as (select row_number() over (order by vec_id nulls last, embedding) - 1 as id, vec_id, label,
                  list_transform(embedding, lambda c: floor(1024 * c::double)::bigint) as x
           from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
parts as (select id, part, x[part * len(x) // 4 + 1 : (part + 1) * len(x) // 4] as x from v, unnest(range(4)) as g(part)),
b0 as (select part, id as entry, x from parts where id < 256),"""
    for r in range(rounds):
        sql += near.format(r=r) + move.format(r=r, s=r + 1)
    return sql + near.format(r=rounds) + f"""
codes as (select id, string_agg(printf('%02x', best.e), '' order by part) as code, sum(best.d)::bigint as error from a{rounds} group by id),
said as (select sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' order by part, entry)) as h from b{rounds})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, (select h from said) as codebooks_sha256
from v join codes using (id)"""


ORACLE_SQL = {
    "op11_conversation_repair": CONVERSATIONS,
    "op13_vector_codes": _vector_codes(),
    "op1_bit_sliced_top_k": """
with v as (select distinct vec_id, list_transform(embedding, lambda c: floor(64 * c::double)::bigint) as x
           from embeddings where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
pairs as (select q.vec_id as query_id, q.x as qx, c.vec_id,
                 list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
          from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id, qx order by score desc, vec_id) as r from pairs)
select query_id, r::int as rank, vec_id, score from ranked where r <= 20""",
    "op5_decontaminate": f"""
with b as (select cast(item_id as varchar) as item,
                  regexp_extract_all({_LOW}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') as w from benchmark),
d as (select row_number() over () as id, doc_id,
             regexp_extract_all({_LOW}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
win as (select distinct item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win, least(10, len(w)) as n
        from b, unnest(range(1, greatest(1, len(w) - 9) + 1)) as r(i) where len(w) > 0),
lengths as (select distinct n from win),
grams as (select id, s, n, array_to_string(w[s:s + n - 1], ' ') as g from d, lengths, unnest(range(1, len(w) - n + 2)) as r(s)
          where len(w) >= n),
hits as (select id, s, g.n, item from grams g join win on win.win = g.g and win.n = g.n),
words as (select id, count(distinct p) as n_hit from hits, unnest(range(s, s + n)) as r(p) group by id),
items as (select id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as said
          from hits group by id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(said, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (id) left join items using (id)""",
    "op8_line_dedup": f"""
with d as (select row_number() over () as id, doc_id, string_split(coalesce(text, ''), chr(10)) as lines,
                  string_split({_LOW}, chr(10)) as low from documents),
l as (select id, doc_id, p, lines[p] as line, trim(low[p], {_SPACES}) as k from d, unnest(range(1, len(lines) + 1)) as r(p)),
shared as (select k from l where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (k in (select k from shared)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by p) filter (k not in (select k from shared)), '')) as kept_sha256
from l group by id, doc_id""",
}
