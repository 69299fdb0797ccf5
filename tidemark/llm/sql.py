"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

from .licenses import PHRASES, SHARE, TEMPLATES, stride_of
from .terms import terms_of

#: The Pareto ranking in one window a source; SQL that is plain and not meant for size.
OP6 = """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
    (('0x' || substr(md5('6:' || coalesce(doc_id::varchar, 't' || md5(coalesce(text, '')))), 1, 13))::bigint::double + 0.5)
      / 4503599627370496.0 as u
  from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from d group by source
), w as (
  select source, source_size, 2.0::double * source_size as cap, ([5.0, 2.0, 1.0]::double[])[place % 3 + 1] as weight from s
), o as (
  select *, cap / weight as need, row_number() over (order by cap / weight, source nulls last) as pos from w
), r as (
  select a.pos,
    ((1.5::double * (select sum(source_size) from w)) - coalesce((select sum(b.cap) from o b where b.pos < a.pos), 0))
      / (select sum(b.weight) from o b where b.pos >= a.pos) as rate, a.need
  from o a
), rate as (
  select rate from r where need > rate order by pos limit 1
), t as (
  select source, source_size, least(cap, weight * (select rate from rate)) as target from w
), p as (
  select *, case when source_size = 0 then 0.0 else target / source_size end as ratio from t
), k as (
  select d.doc_id, d.source, d.size, p.source_size, p.target, floor(p.ratio) as whole, p.ratio - floor(p.ratio) as f,
    p.target - floor(p.ratio) * p.source_size as lack, d.u
  from d join p on d.source is not distinct from p.source
), q as (
  select *, u * (1 - f) / ((1 - u) * f * (1 + log2(1 + size) / 16)) as odds from k where f > 0 and size > 0
), x as (
  select *, sum(size) over (partition by source order by odds, size, doc_id rows unbounded preceding) as upto from q
)
select doc_id, size::bigint as size, source_size, target,
  (size * (whole + case when upto - size / 2.0 <= lack then 1 else 0 end))::bigint as taken
from x
union all
select doc_id, size::bigint, source_size, target, (size * whole)::bigint from k where not (f > 0 and size > 0)
"""

#: All pairs of documents that share a shingle, and all documents that links lead to.
OP1 = """
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), s as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from w
), n as (
  select doc_id, len(s)::bigint as n, md5(array_to_string(list_sort(s), chr(10))) as same from s
), u as (
  select doc_id, unnest(s) as g from s
), x as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from u a join u b on a.g = b.g and a.doc_id <> b.doc_id group by all
), l as (
  select x.a, x.b from x join n p on p.doc_id = x.a join n q on q.doc_id = x.b where 100 * k >= 75 * (p.n + q.n - k)
), r as (
  select doc_id as d, doc_id as c from n union select l.b, r.c from r join l on l.a = r.d
), k as (
  select a, count(*) as n_links from l group by a
)
select n.doc_id, n.n as n_shingles, min(r.c) as component_id,
  any_value(case when n.n = 0 then 0 else (select count(*) from n m where m.same = n.same) end)::bigint as n_equal,
  coalesce(any_value(n_links), 0)::bigint as n_links
from n join r on r.d = n.doc_id left join k on k.a = n.doc_id group by n.doc_id, n.n
"""

OP2 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10
"""

#: Words of letters and digits, A-Z lower-cased, of a column ``text``.
_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

#: All runs of one to three words of all pieces.
OP11 = """
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), v as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p
), g as (
  select lang, unnest(w) as x, unnest(w[2:]) as y, unnest(w[3:]) as z from v
), one as (
  select lang, x, count(*) as c from g group by all
), two as (
  select lang, x, y, count(*) as c from g where y is not null group by all having count(*) >= 10
), three as (
  select lang, x, y, z, count(*) as c from g where z is not null group by all having count(*) >= 10
), n as (
  select lang, sum(c)::bigint as n from one group by lang
), inside as (
  select lang, x, y, max(c) as longer from (select lang, x, y, c from three union all select lang, y, z, c from three) group by all
), cuts as (
  select two.lang, two.x || ' ' || two.y as phrase, 1 as cut, two.c as a, l.c as l, r.c as r
  from two join one l on l.lang = two.lang and l.x = two.x join one r on r.lang = two.lang and r.x = two.y
  left join inside i on i.lang = two.lang and i.x = two.x and i.y = two.y
  where longer is null or 100 * longer < 50 * two.c
  union all
  select t.lang, t.x || ' ' || t.y || ' ' || t.z, 1, t.c, l.c, r.c
  from three t join one l on l.lang = t.lang and l.x = t.x join two r on r.lang = t.lang and r.x = t.y and r.y = t.z
  union all
  select t.lang, t.x || ' ' || t.y || ' ' || t.z, 2, t.c, l.c, r.c
  from three t join two l on l.lang = t.lang and l.x = t.x and l.y = t.y join one r on r.lang = t.lang and r.x = t.z
), s as (
  select *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint as score from cuts
), b as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), o as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b
)
select o.lang, rank, phrase, a, l, r, n, score from o join n on n.lang = o.lang where rank <= 2000
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(text: str) -> str:
    return "[" + ", ".join(_literal(w.decode()) for w in terms_of(text)) + "]"


#: All blocks of each stride against all templates of that stride.
OP12 = f"""
with d as (
  select doc_id, row_number() over () as r, {_TERMS} as w from documents
), p(label, p) as (
  values {", ".join(f"({_literal(label)}, {_listed(phrase)})" for phrase, label in PHRASES.items())}
), t(label, stride, t) as (
  values {", ".join(f"({_literal(label)}, {stride_of(len(terms_of(text)))}, list_distinct({_listed(text)}))" for label, text in TEMPLATES)}
), places as (
  select r, label, unnest(list_filter(generate_series(1, len(w) - len(p) + 1), lambda i: w[i:i + len(p) - 1] = p)) - 1 as spot from d, p
), base as (
  select r, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list(distinct label) as labels from places group by r
), b as (
  select r, stride, list_distinct(w[k * stride + 1:(k + 2) * stride]) as b
  from (select r, w, stride, unnest(generate_series(0, (len(w) - 1) // stride)) as k from d, (select distinct stride from t) where len(w) > 0)
), found as (
  select r, label, len(list_intersect(b, t)) as o, len(t) as size from b join t on t.stride = b.stride
  where {SHARE[1]} * len(list_intersect(b, t)) >= {SHARE[0]} * len(t)
), own as (
  select r, list(distinct label) as labels, max(o::double / size) as share from found group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0.0::double) end as score
from d left join base on base.r = d.r left join own on own.r = d.r
"""

#: All documents with a term of an item, scored.
OP13 = f"""
with d as (
  select doc_id, row_number() over () as r, {_TERMS} as w from documents
), g as (
  select count(*)::bigint as all_docs, sum(len(w))::bigint as all_terms from d where len(w) > 0
), tf as (
  select r, t, count(*) as tf from (select r, unnest(w) as t from d) group by all
), df as (
  select t, count(*) as df from tf group by t
), i as (
  select item_id, row_number() over () as q, unnest({_TERMS}) as t from benchmark
), it as (
  select q, item_id, i.t, count(*) as occurs, any_value(floor(1000 * ln((2 * all_docs + 2)::double / (2 * df + 1)))::bigint) as weight
  from i join df on df.t = i.t, g group by q, item_id, i.t
), m as (
  select r, doc_id, 75 + (25 * len(w)::bigint * all_docs) // all_terms as m from d, g where len(w) > 0
), s as (
  select q, item_id, doc_id, m.r, sum(occurs * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from it join tf on tf.t = it.t join m on m.r = tf.r group by all
), o as (
  select item_id, row_number() over (partition by q order by score desc, doc_id) as rank, doc_id, score from s where score > 0
)
select item_id, rank::int as rank, doc_id, score from o where rank <= 20
"""

ORACLE: dict[str, str] = {
    "op1_jaccard_join": OP1,
    "op2_exact_top_k": OP2,
    "op6_mix_sources": OP6,
    "op11_phrases": OP11,
    "op12_licenses": OP12,
    "op13_ranked_search": OP13,
}
