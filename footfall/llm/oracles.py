"""DuckDB SQL for the corpus queries that SQL can express, without their methods: brute force."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
)

ORACLES["op1_minhash_dedup"] = f"""
with recursive words as (select doc_id, {_WORDS} as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
),
links as (
  select x, y from shared join sizes m on m.doc_id = x join sizes n on n.doc_id = y
  where 100 * c >= 80 * (m.n + n.n - c)
),
edges as (select x, y from links union all select y, x from links),
reached as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, e.y from reached r join edges e on e.x = r.other
),
least as (select doc_id, min(other) as component_id from reached group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least using (doc_id) left join sizes using (doc_id)
"""

_ESCAPED = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"

ORACLES["op6_chat_windows"] = f"""
with raw as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from raw
),
sized as (
  select *, cast(ceil(strlen(text) / 4.0) + 4 as bigint) as tokens,
    23 + length({_ESCAPED.format("role")}) + (length(role) - length(replace(role, chr(10), '')))
      + 1 + length({_ESCAPED.format("text")}) as chars,
    row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos
  from turns
),
placed as (
  select *, sum(tokens) over (partition by conv_id order by pos) - tokens as start from sized
),
systems as (select conv_id, tokens as system, chars as system_chars from sized where pos = 0 and role = 'system'),
spoken as (
  select p.*, p.start - coalesce(system, 0) as place, greatest(1024 - coalesce(system, 0), 1) as room,
    least(greatest(1024 - coalesce(system, 0), 1), 512) as stride
  from placed p left join systems s on s.conv_id is not distinct from p.conv_id
  where not (pos = 0 and role = 'system')
),
units as (
  select *, (place + tokens - 1) // stride as unit,
    sum(tokens) over (partition by conv_id, (place + tokens - 1) // stride) as total
  from spoken
),
windows as (
  select *, unit * 2 + case when place // stride = unit and total > room then 1 else 0 end as win from units
),
bounds as (
  select conv_id, win, min(place) as first, greatest(least(256, max(room) - sum(tokens)), 0) as allowed
  from windows group by 1, 2
),
repeated as (
  select w.conv_id, chars from windows w
  join bounds b on b.conv_id is not distinct from w.conv_id and place >= first - allowed and place < first
),
retained as (
  select s.conv_id, system_chars as chars from systems s
  join bounds b on b.conv_id is not distinct from s.conv_id and b.first > 0
  union all select conv_id, system_chars from systems
),
written as (
  select conv_id, sum(chars) as formatted_chars from (
    select conv_id, chars from windows union all select * from repeated union all select * from retained
  ) group by conv_id
),
whole as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by pos), '') as loss
  from placed group by conv_id
)
select w.conv_id, n_turns, turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from whole w join written x on x.conv_id is not distinct from w.conv_id
"""

ORACLES["op8_decontamination"] = f"""
with docs as (select distinct doc_id, {_WORDS} as w from documents),
items as (select distinct item_id, {_WORDS} as w from benchmark),
doc_words as (select doc_id, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) as i from docs),
item_words as (select item_id, len(w) as m, unnest(w) as word, generate_subscripts(w, 1) as j from items),
equal as (
  select doc_id, item_id, i - j as diagonal, i, n, m, least(m, 13) as size
  from doc_words join item_words using (word)
),
dense as (
  select doc_id, item_id, diagonal, list(i) as places, any_value(size) as size,
    least(any_value(n), any_value(m) + diagonal) as last, greatest(1, 1 + diagonal) as first
  from equal group by doc_id, item_id, diagonal
  having count(*) >= case when any_value(m) < 13 then any_value(m) else 0.8 * 13 end
),
starts as (
  select *, unnest(list_transform(places, lambda p: least(p, last - size + 1))) as s
  from dense where last - first + 1 >= size
),
counted as (
  select doc_id, item_id, size, len(list_filter(places, lambda p: p >= s and p < s + size)) as equal_words
  from starts where s >= first
)
select doc_id, item_id, cast(max(equal_words) as int) as equal_words, cast(max(size) as int) as "window"
from counted where equal_words >= case when size < 13 then size else 0.8 * size end
group by doc_id, item_id
"""

ORACLES["op10_substring_dedup"] = """
with docs as (
  select doc_id, row_number() over () as row, encode(coalesce(text, '')) as b from documents
),
starts as (
  select row, unnest(range(1, octet_length(b) - 198)) as s, b from docs where octet_length(b) >= 200
),
prints as (select row, s, md5(b[s:s + 199]) as print from starts),
again as (select print from prints group by print having count(*) > 1),
marked as (select row, s from prints semi join again using (print)),
cuts as (
  select row, s, sum(new) over (partition by row order by s) as span from (
    select row, s, case when s <= lag(s) over (partition by row order by s) + 200 then 0 else 1 end as new
    from marked
  )
),
spans as (select row, min(s) as a, max(s) + 199 as z from cuts group by row, span),
gaps as (
  select row, a, z, lag(z, 1, 0) over (partition by row order by a) + 1 as since from spans
),
kept as (
  select row, sum(z - a + 1) as n_removed, count(*) as n_spans,
    string_agg(hex(b[since:a - 1]), '' order by a) || hex(any_value(b)[max(z) + 1:]) as rest
  from gaps join docs using (row) group by row
)
select doc_id, octet_length(b) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, hex(b)))) as kept_sha256
from docs left join kept using (row)
"""

ORACLES["op11_window_dedup"] = """
with words as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents
),
windows as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words)
),
firsts as (select s, min(doc_id) as least from windows group by s),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as p from windows join firsts using (s) where least < doc_id
),
intervals as (
  select doc_id, count(*) as n_removed, count(*) filter (before is null or p > before + 1) as n_intervals
  from (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from gone)
  group by doc_id
),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from words),
kept as (
  select doc_id, string_agg(w[p], ' ' order by p) as t
  from places anti join gone using (doc_id, p) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, coalesce(n_intervals, 0) as n_intervals,
  sha256(coalesce(t, '')) as kept_sha256
from words left join intervals using (doc_id) left join kept using (doc_id)
"""

# CRC-32 by its table of 256 entries, made from the polynomial.
ORACLES["op12_prefix_trie"] = """
with entries as (
  select i, list_reduce(list_prepend(i, [cast(k as bigint) for k in range(8)]), lambda a, k:
    case when a % 2 = 1 then xor(cast(3988292384 as bigint), a >> 1) else a >> 1 end) as v
  from (select unnest(range(cast(256 as bigint))) as i)
),
crc as (select list(v order by i) as t from entries),
turns as (
  select conv_id, role, text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(concat(length(role), ':', role, text))) as pos
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations)
  where conv_id is not null
),
convs as (
  select conv_id, conv_id - conv_id % 100 as base,
    xor(list_reduce(list_prepend(cast(4294967295 as bigint),
      list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda a, b: xor(a >> 8, t[cast(xor(a, b) & 255 as bigint) + 1])), cast(4294967295 as bigint)) % 6 as h
  from (select distinct conv_id from turns) cross join crc
),
heads as (
  select c.conv_id, t.pos as d, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
),
lent as (select conv_id, count(*) as n from heads group by conv_id),
rebuilt as (
  select * from heads
  union all
  select c.conv_id, coalesce(n, 0) + t.pos - c.h, t.role, t.text
  from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h left join lent on lent.conv_id = c.conv_id
),
sizes as (select c.conv_id, count(r.d) as n from convs c left join rebuilt r using (conv_id) group by c.conv_id),
prefixes as (
  select conv_id, d, length(text) as chars,
    list({'r': role, 't': text}) over (partition by conv_id order by d rows unbounded preceding) as path
  from rebuilt
  union all select conv_id, 0, 0, [] from convs
),
nodes as (
  select path, d, min(p.conv_id) as conv_id, count(*) as n_convs, max(chars) as chars,
    bool_and(s.n = d) as childless,
    sha256(coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) filter (s.n = d), '')) as ends_sha256
  from prefixes p join sizes s using (conv_id) group by path, d
),
inside as (
  select u.path, u.d, sum(case when v.childless then 1 else 0 end) as n_leaves,
    sum((v.n_convs - 1) * v.chars) as saved_tokens, count(*) filter (v.d = u.d + 1) as n_children
  from nodes u join nodes v on v.d >= u.d and v.path[:u.d] = u.path
  group by u.path, u.d
)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, cast(i.n_children as bigint) as n_children,
  cast(i.n_leaves as bigint) as n_leaves, cast(i.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from nodes n join inside i on i.path = n.path and i.d = n.d
left join nodes p on p.d = n.d - 1 and p.path = n.path[:n.d - 1]
"""
