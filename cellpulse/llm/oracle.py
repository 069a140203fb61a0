"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP6 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (
  select *,
    length(replace(replace(replace(role, '\', '\0'), '<', '\1'), '[', '\2'))
    + length(replace(replace(replace(text, '\', '\0'), '<', '\1'), '[', '\2')) + 20 as size from rows),
joined as (
  select conv_id, count(*) as n_turns, sum(size) as size,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as learned
  from escaped group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(learned) as bigint) as loss_chars,
  sha256(learned) as loss_sha256, cast(size as bigint) as formatted_chars
from joined
"""

OP10 = r"""
with docs as (
  select doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
lines as (
  select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from docs),
windows as (
  select doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] as k
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from docs)),
twice as (select doc_id, k from windows group by all having count(*) > 1),
covered as (
  select doc_id, count(distinct i + o) as n
  from windows join twice using (doc_id, k), (values (0), (1), (2)) as offsets(o) group by doc_id),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words, cast(len(l) as bigint) as n_lines,
    cast(length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) as bigint) as n_capitals
  from docs join lines using (doc_id) left join covered using (doc_id)),
judged as (
  select *,
    cast(n_words < 50 as bigint) + 2 * cast(100 * n_repeat_words > 50 * n_words as bigint)
    + 4 * cast(10 * n_symbols > n_words as bigint) + 8 * cast(2 * n_dup_lines > n_lines as bigint)
    + 16 * cast(word_chars < 3 * n_words or word_chars > 12 * n_words as bigint)
    + 32 * cast(10 * n_capitals > 3 * word_chars as bigint) as failed
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed,
  failed = 0 as kept, n_lines, n_capitals, failed
from judged
"""

OP11 = r"""
with recursive crc as (
  select list_transform(range(256), lambda x: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: xor(c >> 1, (c & 1) * 3988292384), x)) as t),
hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(
      list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda ch: ascii(ch)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as kind
  from conversations, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hashed, range(case kind when 0 then 0 when 3 then 2 else 1 end)),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
ordered as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as seen,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said, left(role, 1) as initial
  from numbered),
turns as (
  select *, said = '' as blank, said <> '' and seen as duplicate,
    said <> '' and not seen and right(said, 1) not in ('.', '!', '?') as truncated,
    lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as illegal
  from ordered),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal
  from turns group by conv_id),
ids as (
  select distinct c.conv_id, gaps, coalesce(n, 0) as n, blank, duplicate, truncated, illegal
  from conversations c left join counted d on c.conv_id is not distinct from d.conv_id),
-- States: b nothing yet, s, u, a. Up to two insertions may stand before every turn and at the end.
inserted(p, q, edits, price, added) as (values
  ('b', 'b', '', 0, ''), ('s', 's', '', 0, ''), ('u', 'u', '', 0, ''), ('a', 'a', '', 0, ''),
  ('b', 'u', 'I', 5, 'user:'), ('s', 'u', 'I', 5, 'user:'), ('a', 'u', 'I', 5, 'user:'), ('u', 'a', 'I', 5, 'assistant:'),
  ('b', 'a', 'II', 10, 'user:' || chr(10) || 'assistant:'), ('s', 'a', 'II', 10, 'user:' || chr(10) || 'assistant:'),
  ('a', 'a', 'II', 10, 'user:' || chr(10) || 'assistant:'), ('u', 'u', 'II', 10, 'assistant:' || chr(10) || 'user:')),
steps(p, q, edit, price, name) as (values
  ('b', 's', 'K', 0, 's'), ('b', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('a', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'),
  ('b', 'u', 'R', 1, 'user'), ('s', 'u', 'R', 1, 'user'), ('a', 'u', 'R', 1, 'user'), ('u', 'a', 'R', 1, 'assistant'),
  ('b', 'b', 'D', 2, ''), ('s', 's', 'D', 2, ''), ('u', 'u', 'D', 2, ''), ('a', 'a', 'D', 2, '')),
walk as (
  select conv_id, 0 as i, n, 'b' as state, 0 as cost, '' as audit, '' as said from ids
  union all
  select conv_id, i, n, state, best.cost, best.audit, best.said from (
    select w.conv_id, w.i + 1 as i, w.n, s.q as state, arg_min(
      struct_pack(cost := w.cost + k.price + s.price + case when s.edit <> 'D' and t.truncated then 5 else 0 end,
        audit := w.audit || k.edits || s.edit,
        said := w.said || case when k.added = '' then '' else chr(10) || k.added end || case s.edit
          when 'D' then '' when 'K' then chr(10) || t.role || ':' || t.text else chr(10) || s.name || ':' || t.text end),
      struct_pack(cost := w.cost + k.price + s.price + case when s.edit <> 'D' and t.truncated then 5 else 0 end,
        audit := w.audit || k.edits || s.edit)) as best
    from walk w join turns t on t.conv_id is not distinct from w.conv_id and t.i = w.i + 1
    join inserted k on k.p = w.state
    join steps s on s.p = k.q and (s.edit = 'D' or not (t.blank or t.duplicate)) and (s.edit <> 'K' or s.name = t.initial)
    group by w.conv_id, w.i, w.n, s.q)),
ended as (
  select conv_id, arg_min(struct_pack(cost := cost + price, audit := audit || edits,
      said := said || case when added = '' then '' else chr(10) || added end),
    struct_pack(cost := cost + price, audit := audit || edits)) as best
  from walk join inserted on p = state where i = n and q in ('b', 'a') group by conv_id)
select i.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(best.cost as bigint) as cost, best.audit as audit,
  sha256(substr(best.said, 2)) as repaired_sha256
from ids i join ended e on i.conv_id is not distinct from e.conv_id
"""

OP12 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, p, count(*) as a from (
    select lang, unnest(list_concat(
      list_transform(range(1, len(w) + 1), lambda i: [w[i]]),
      list_transform(range(1, len(w)), lambda i: list_slice(w, i, i + 1)),
      list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2)),
      list_transform(range(1, len(w) - 2), lambda i: list_slice(w, i, i + 3)))) as p
    from worded) group by lang, p),
totals as (select lang, sum(a) as n from grams where len(p) = 1 group by lang),
candidates as (select * from grams where len(p) > 1 and a >= 30),
frequent as (select * from grams where a >= 30),
parts as (
  select *, list_slice(p, 1, k) as q, list_slice(p, k + 1, len(p)) as s
  from (select *, unnest(range(1, len(p))) as k from candidates)),
cuts as (
  select c.lang, c.p, c.a, k, f.a as l, g.a as r, (2000000 * c.a::hugeint) // (f.a + g.a)::hugeint as score
  from parts c join frequent f on f.lang = c.lang and f.p = c.q join frequent g on g.lang = c.lang and g.p = c.s),
lowest as (
  select lang, p, a, arg_min(struct_pack(l := l, r := r, score := score), struct_pack(score := score, k := k)) as b
  from cuts group by lang, p, a),
longer as (
  select lang, q as p, max(a) as a from (
    select lang, a, unnest(case len(p) when 3 then [p[1:2], p[2:3]] when 4 then [p[1:2], p[2:3], p[3:4], p[1:3], p[2:4]] else [] end) as q
    from candidates) group by lang, q),
kept as (
  select o.lang, array_to_string(o.p, ' ') as phrase, o.a, b.l as l, b.r as r, b.score as score
  from lowest o left join longer g on g.lang = o.lang and g.p = o.p
  where g.a is null or 100 * g.a::hugeint < 80 * o.a::hugeint),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
  cast(t.n as bigint) as n, cast(score as bigint) as score
from ranked join totals t using (lang) where rank <= 2000
"""

# The exact search: among the 200 vectors of the compared tables the graph finds every neighbour.
OP13 = r"""
with rows as (
  select distinct vec_id as id, cast(embedding as double[]) as v from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.id as query_id, c.id as vec_id,
    list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, x: a + x) as score
  from rows q join rows c on q.id % 20 = 0 and c.id is distinct from q.id and len(c.v) = len(q.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id nulls last) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""

ORACLE = {
    "op6_chat_formatting": OP6, "op10_quality_rules": OP10, "op11_conversation_repair": OP11,
    "op12_phrase_collocations": OP12, "op13_nearest_neighbours": OP13,
}
