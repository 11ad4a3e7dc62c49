"""SQL twins of the corpus queries that SQL can express."""

ORACLE_SQL = {
    "op1_embedding_dedup": r"""
with recursive v as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_cosine_similarity(a.v, b.v) >= 0.9),
reached as (select x, y from links union select r.x, l.y from reached r join links l on l.x = r.y),
component as (select x, least(x, min(y)) as c from reached group by x),
counted as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(c, vec_id) as component_id, coalesce(c, vec_id) = vec_id as kept
from embeddings left join counted on counted.x = vec_id left join component on component.x = vec_id""",
    "op11_suffix_dedup": r"""
with d as (select row_number() over () as id, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select id, unnest(range(1, length(h) // 2 - 198)) as s from d where length(h) >= 400),
strings as (select id, s, md5_number(substr(h, 2 * s - 1, 400)) as m from starts join d using (id)),
again as (select m from strings group by m having count(*) > 1),
hits as (select id, s, lag(s) over (partition by id order by s) as before from strings semi join again using (m)),
runs as (select id, s, sum(case when before is null or s > before + 200 then 1 else 0 end) over (partition by id order by s) as run from hits),
spans as (select id, min(s) as lo, max(s) + 200 as hi from runs group by id, run),
edges as (select id, lo, hi, coalesce(lag(hi) over (partition by id order by lo), 1) as from_, row_number() over (partition by id order by lo desc) = 1 as last_ from spans),
kept as (
  select id, sum(hi - lo) as n_removed, count(*) as n_spans,
    string_agg(concat(substr(h, 2 * from_ - 1, 2 * (lo - from_)), case when last_ then substr(h, 2 * hi - 1) else '' end), '' order by lo) as rest
  from edges join d using (id) group by id
)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
from d left join kept using (id)""",
    "op12_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k, list_slice(w, i, i + k - 1) as p
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from cut, (values (1), (2), (3)) as sizes(k) where len(w) >= k)
),
f as (select lang, k, p, count(*) as a from grams group by all),
totals as (select lang, sum(a) as n from f where k = 1 group by lang),
long as (select * from f where k > 1 and a >= 10),
within as (
  select lang, p[1:2] as p, max(a) as longer from long where k = 3 group by all
  union all select lang, p[2:3], max(a) from long where k = 3 group by all
),
swallowed as (select lang, p, max(longer) as longer from within group by all),
kept as (select long.* from long left join swallowed s on s.lang = long.lang and s.p = long.p where s.longer is null or 100 * s.longer < 50 * a),
cuts as (select lang, p, k, a, c, p[1:c] as one, p[c + 1:k] as two from (select *, unnest(range(1, k)) as c from kept)),
scored as (
  select c.lang, c.p, c.a, x.a as l, y.a as r, c.c, (1000000::hugeint * c.a * c.a) // (x.a::hugeint * y.a) as score
  from cuts c join f x on x.lang = c.lang and x.p = c.one join f y on y.lang = c.lang and y.p = c.two
),
lowest as (select * from scored qualify row_number() over (partition by lang, p order by score, c) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank from lowest)
select ranked.lang, rank, array_to_string(p, ' ') as phrase, a, l, r, n::bigint as n, score::bigint as score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000""",
    "op13_source_divergence": r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from d
),
kept as (select lang, term, count(*) as m from words group by all having count(distinct id) >= 30),
own as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(m) as total from kept group by all),
groups as (select distinct lang, source from d),
sums as (select g.lang, g.source, coalesce(sum(n), 0) as total from groups g left join own using (lang, source) group by all),
shares as (
  select s.lang, s.source, k.term, coalesce(o.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(o.n, 0) + 5)) // (s.total + 5 * l.v)::hugeint as p,
    1 + (1000000000::hugeint * (k.m + 5)) // (l.total + 5 * l.v)::hugeint as q
  from sums s join langs l using (lang) join kept k using (lang) left join own o on o.lang = s.lang and o.source = s.source and o.term = k.term
),
summed as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
),
terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from shares where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50""",
}
