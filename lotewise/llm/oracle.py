"""SQL that gives the rows of a query, where SQL can."""

from __future__ import annotations

# Every pair of vectors of a label is compared here, which small tables allow; the query
# itself finds the pairs by sorted passes.
EMBEDDINGS = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
  sound as (select * from v where label is not null and len(e) > 0
            and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0
            and len(list_filter(e, lambda x: x <> 0)) > 0),
  links as (select a.vec_id as a, b.vec_id as b from sound a
            join sound b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
            where list_cosine_similarity(a.e, b.e) >= 0.98),
  reached as (select vec_id as a, vec_id as b from v
              union select r.a, l.b from reached r join links l on r.b = l.a),
  counted as (select a, count(*) as n from links group by a),
  least as (select a, min(b) as component_id from reached group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from v join least on least.a = vec_id left join counted on counted.a = vec_id
"""

# Conversations as lists of turns; a node is a prefix of such a list.
CONVERSATIONS = r"""
with recursive said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
  talks as (
    select conv_id, list({'role': role, 'text': text}
                         order by turn nulls first, md5(strlen(role) || ':' || role || text)) as turns
    from said group by conv_id),
  bits as (  -- crc32 of the decimal id, bit by bit
    select conv_id, conv_id::varchar as digits, 4294967295::bigint as crc, 0 as k from talks
    union all
    select conv_id, digits,
      list_reduce([xor(crc, ord(substr(digits, k + 1, 1))::bigint)] || list_transform(range(8), lambda x: 0::bigint),
                  lambda c, x: xor(c >> 1, (c & 1) * 3988292384::bigint)), k + 1
    from bits where k < length(digits)),
  heads as (select conv_id, xor(crc, 4294967295::bigint) % 4 as h from bits where k = length(digits)),
  paths as (
    select c.conv_id, coalesce(f.turns[1:h], []) || coalesce(c.turns[h + 1:], []) as path
    from talks c join heads using (conv_id) left join talks f on f.conv_id = c.conv_id - c.conv_id % 20),
  members as (select conv_id, path, unnest(range(len(path) + 1)) as depth from paths),
  nodes as (
    select path[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
      sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(path) = depth), '')) as ends_sha256,
      (count(*) - 1) * case when depth = 0 then 0 else
        len(regexp_extract_all(path[1:depth][depth].text, '[^\x20\x09-\x0D]+')) end as saved
    from members group by path[1:depth], depth),
  children as (select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by 1),
  whole as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (node)),
  below as (  -- each node with all its ancestors and itself
    select node[1:a] as node, sum(saved) as saved_tokens, sum((n_children = 0)::int) as n_leaves
    from (select *, unnest(range(depth + 1)) as a from whole) group by 1)
select w.conv_id, w.depth::bigint as depth, p.conv_id as parent_conv_id, w.n_convs::bigint as n_convs,
  w.n_children::bigint as n_children, b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens, w.ends_sha256
from whole w join below b using (node) left join whole p on w.depth > 0 and p.depth = w.depth - 1 and p.node = w.node[1:w.depth - 1]
"""

# Texts in hexadecimal, two digits a byte; every 50-byte window is looked up whole.
REPEATS = r"""
with texts as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
  pieces as (select r, doc_id, b, substr(h, 2 * b + 1, 1598) as p  -- 750 windows each
             from (select *, unnest(range(0, greatest(length(h) // 2 - 49, 0), 750)) as b from texts) where doc_id is not null),
  windows as (select r, doc_id, b + i as i, substr(p, 2 * i + 1, 100) as w
              from (select *, unnest(range(least(length(p) // 2 - 49, 750))) as i from pieces)),
  least as (select w, min(doc_id) as d from windows group by w having min(doc_id) < max(doc_id)),
  gone as (select r, i from windows join least using (w) where doc_id > d),
  marked as (select r, i, case when i <= lag(i) over (partition by r order by i) + 50 then 0 else 1 end as new from gone),
  numbered as (select r, i, sum(new) over (partition by r order by i) as span from marked),
  spans as (select r, span, min(i) as a, max(i) + 50 as b from numbered group by r, span),
  gaps as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as since from spans),
  ends as (select r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as upto from spans group by r),
  parts as (select r, string_agg(substr(h, 2 * since::int + 1, 2 * (a - since)::int), '' order by a) as front
            from gaps join texts using (r) group by r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(case when upto is null then h else front || substr(h, 2 * upto::int + 1) end)) as kept_sha256
from texts left join ends using (r) left join parts using (r)
"""
