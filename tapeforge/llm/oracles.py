"""DuckDB SQL of the operators that SQL can express beside chat formatting."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in DuckDB, which has no function for it: a byte at a time, eight shifts each."""
    step = "xor(x >> 1, 3988292384 * (x & 1))"
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)"
    return f"xor(list_reduce({bytes_}, lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {step}), 4294967295::bigint), 4294967295)"


#: Every node of every tree by its level, then a fold for each leaf.
OP11_SQL = f"""
with recursive given as (
  select doc_id, source, {crc32_sql('doc_id::varchar')} % 2 = 0 and text is not null as cut, text,
    {" || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} as head
  from documents
), hashed as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when cut then sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) end as bad
  from given
), leaves as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by source) as n from hashed
), own(tree, level, pos, n, node) as (
  select tree, 0, pos, n, leaf from leaves
  union all
  select tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' order by pos)) from own where n > 1 group by tree, level, pos // 3, n
), subroots as (select tree, level as levels, node as subroot from own where n = 1
), upper(level, pos, n, node) as (
  select 0, tree, count(*) over (), subroot from subroots
  union all
  select level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' order by pos)) from upper where n > 1 group by level, pos // 3, n
), nodes as (
  select tree, level, pos, n, node from own where n > 1
  union all select -1, level, pos, n, node from upper where n > 1
), sides as (
  select a.tree, a.level, a.pos, coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos < a.pos), '') as lefts, coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos > a.pos), '') as rights
  from nodes a join nodes b on a.tree = b.tree and a.level = b.level and a.pos // 3 = b.pos // 3 group by a.tree, a.level, a.pos
), folded(tree, pos, level, node, proof) as (
  select tree, pos, 0, coalesce(bad, leaf), '' from leaves
  union all
  select f.tree, f.pos, f.level + 1, sha256(s.lefts || f.node || s.rights), f.proof || s.lefts || s.rights
  from folded f join subroots r using (tree) join sides s on
    s.tree = case when f.level < r.levels then f.tree else -1 end
    and s.level = case when f.level < r.levels then f.level else f.level - r.levels end
    and s.pos = case when f.level < r.levels then f.pos // (3 ** f.level)::bigint else f.tree // (3 ** (f.level - r.levels))::bigint end
), ends as (select tree, pos, node, proof from folded qualify row_number() over (partition by tree, pos order by level desc) = 1)
select doc_id, leaf, subroot, u.node as root, sha256(proof) as proof_sha256, e.node as folded_root, e.node = u.node as verified
from leaves join subroots using (tree) join ends e using (tree, pos) join (select node from upper where n = 1) u on true
"""

OP12_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
window w as (partition by t)
"""

#: The least (cost, audit) by state after each row.
OP13_SQL = f"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32_sql("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as kind, dense_rank() over (order by conv_id nulls first) as c
  from conversations
), damaged as (
  select c, conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, copy
  from given, unnest(case when kind = 3 then [0, 1] else [0] end) t(copy) where kind > 0
), placed as (
  select *, row_number() over w as pos, left(role, 1) as initial,
    coalesce(lag(left(role, 1)) over w || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as core
  from damaged window w as (partition by c order by turn nulls first, role, text, copy)
), faulty as (
  select *, case when core = '' then 'blank' when row_number() over (partition by c, role, text order by pos) > 1 then 'duplicate' when right(core, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from placed
), ops(op, state, initial, next, price, said_by) as (values
  ('D', 0, null, 0, 3, null), ('D', 1, null, 1, 3, null), ('D', 2, null, 2, 3, null), ('D', 3, null, 3, 3, null),
  ('K', 0, 's', 1, 0, null), ('K', 0, 'u', 2, 0, null), ('K', 1, 'u', 2, 0, null), ('K', 2, 'a', 3, 0, null), ('K', 3, 'u', 2, 0, null),
  ('R', 0, null, 2, 2, 'user'), ('R', 1, null, 2, 2, 'user'), ('R', 2, null, 3, 2, 'assistant'), ('R', 3, null, 2, 2, 'user')
), inserts(state, next, price, audit, said) as (values
  (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])
), best(c, pos, x) as (
  select c, 0, {{'state': i.next, 'cost': i.price, 'audit': i.audit, 'said': i.said::varchar[]}} from (select distinct c from given), inserts i where i.state = 0
  union all
  select c, pos, arg_min(x, (x.cost, x.audit)) from (
    select b.c, r.pos, {{'state': i.next, 'cost': b.x.cost + o.price + i.price + case when o.op <> 'D' and r.fault = 'truncated' then 1 else 0 end, 'audit': b.x.audit || o.op || i.audit,
      'said': list_concat(b.x.said, case o.op when 'D' then []::varchar[] when 'K' then [r.role || ':' || r.text] else [o.said_by || ':' || r.text] end, i.said::varchar[])}} as x
    from best b join faulty r on r.c = b.c and r.pos = b.pos + 1 join ops o on o.state = b.x.state and (o.op = 'D' or r.fault not in ('blank', 'duplicate')) and (o.op <> 'K' or o.initial = r.initial) join inserts i on i.state = o.next
  ) group by c, pos, x.state
), figures as (
  select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (illegal) as illegal, count(*) as n from faulty group by c
), answers as (
  select b.c, arg_min(x, (x.cost, x.audit)) as x from best b left join figures f using (c) where b.pos = coalesce(f.n, 0) and x.state in (0, 3) group by b.c
)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  x.cost::bigint as cost, x.audit as audit, sha256(array_to_string(x.said, chr(10))) as repaired_sha256
from (select distinct c, conv_id from given) g join answers using (c) left join figures using (c)
"""
