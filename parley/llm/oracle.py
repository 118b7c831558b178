"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

EXACT = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
), g as (
  select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm
)
select t.doc_id, g.keep_id, g.group_size, t.doc_id is not distinct from g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g using (norm)
"""

QUOTES = r"""
with recursive msg as (
  select row_number() over () as id, conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
), ln as (
  select id, conv_id, turn, unnest(string_split_regex(text, '\r?\n')) as line,
         generate_subscripts(string_split_regex(text, '\r?\n'), 1) as pos from msg
), lv as (
  select *, length(regexp_replace(regexp_extract(line, '^[ \t]{0,3}(?:>[ \t]?)+', 0), '[^>]', '', 'g')) as lev,
         regexp_replace(line, '^[ \t]{0,3}(?:>[ \t]?)+', '') as body from ln
), ls as (
  select *, lev = 0 and regexp_matches(body, '(?i)wrote:[ \t\r]*$')
            and coalesce(lead(lev) over (partition by id order by pos), 0) > 0 as intro,
         lower(regexp_replace(regexp_replace(body, '[ \t\r\n\f\v]+', ' ', 'g'), '^[ ]+|[ ]+$', '', 'g')) as norm from lv
), own as (
  select id, regexp_replace(string_agg(body, chr(10) order by pos), '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g') as body
  from ls where lev = 0 and not intro group by id
), q as (
  select id, conv_id, turn, lev, norm from ls where lev > 0 and norm <> ''
), ol as (
  select conv_id, norm, min(turn) as origin from ls where lev = 0 and not intro and norm <> '' and turn is not null group by 1, 2
), lk as (
  select q.conv_id, q.turn, q.lev, ol.origin, count(*) as n
  from q join ol on q.conv_id is not distinct from ol.conv_id and q.norm = ol.norm and ol.origin < q.turn group by all
), rp as (
  select conv_id, turn, sum(n) as n_linked,
         max(case when lev = 1 then {'n': n, 'o': origin} end).o as reply_to from lk group by 1, 2
), th as (
  select conv_id, turn, turn as cur, reply_to as up, 0 as depth from rp where reply_to is not null
  union all
  select th.conv_id, th.turn, th.up, rp.reply_to, th.depth + 1
  from th left join rp on rp.conv_id is not distinct from th.conv_id and rp.turn = th.up where th.up is not null
), rt as (
  select conv_id, turn, cur as root, depth from th where up is null
)
select m.conv_id, m.turn, m.role, rp.reply_to, coalesce(rt.root, m.turn) as thread, coalesce(rt.depth, 0)::bigint as depth,
       (select count(*) from q where q.id = m.id) as n_quoted, coalesce(rp.n_linked, 0)::bigint as n_linked,
       coalesce(own.body, '') as text,
       '<|im_start|>' || m.role || chr(10) || coalesce(own.body, '') || '<|im_end|>' || chr(10) as formatted
from msg m left join own on own.id = m.id
left join rp on rp.conv_id is not distinct from m.conv_id and rp.turn = m.turn
left join rt on rt.conv_id is not distinct from m.conv_id and rt.turn = m.turn
"""

FIM = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || coalesce(doc_id::varchar, '')) as d from documents
), h as (
  select *, len(u) as n, ('0x' || substr(d, 1, 8))::bigint as h1, ('0x' || substr(d, 9, 8))::bigint as h2,
         ('0x' || substr(d, 17, 8))::bigint as h3, ('0x' || substr(d, 25, 8))::bigint as h4 from t
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100
              then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from h
), p as (
  select *, array_to_string(u[1 : a], '') as prefix, array_to_string(u[a + 1 : b], '') as middle,
         array_to_string(u[b + 1 : n], '') as suffix from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256
from p
"""

HARD_NEGATIVES = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, id, score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.id as positive_id,
       row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id)::integer as rank,
       s.id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
qualify rank <= 5
"""

ORACLE: dict[str, str] = {"op6_exact_dedup": EXACT, "op9_quotations": QUOTES, "op11_fim": FIM,
                          "op13_hard_negatives": HARD_NEGATIVES}
