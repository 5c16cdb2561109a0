"""DuckDB SQL for the queries that SQL can express over whole tables."""

LINE_DEDUP = """
with l as (select doc_id, text, string_split(text, chr(10)) as lines from documents where text is not null),
w as (select doc_id, i, list_slice(lines, i + 1, least(i + 3, len(lines))) as win, len(lines) as n
      from (select doc_id, lines, unnest(range(0, greatest(len(lines) - 2, 1))) as i from l)),
ranked as (select doc_id, i, n, row_number() over (partition by win order by doc_id, i) as place
           from w where trim(array_to_string(win, '')) <> ''),
covered as (select distinct doc_id, unnest(range(i, least(i + 3, n))) as line from ranked where place > 1),
numbered as (select doc_id, unnest(lines) as words, unnest(range(0, len(lines))) as line from l),
kept as (select n.doc_id, string_agg(n.words, chr(10) order by n.line) as text from numbered n
         left join covered c on c.doc_id = n.doc_id and c.line = n.line where c.doc_id is null group by 1),
cuts as (select doc_id, count(*) as n_removed from covered group by 1)
select d.doc_id, coalesce(len(l.lines), 0)::bigint as n_lines, coalesce(c.n_removed, 0)::bigint as n_removed,
       case when c.n_removed is null then d.text else coalesce(k.text, '') end as text
from documents d left join l on l.doc_id = d.doc_id left join cuts c on c.doc_id = d.doc_id left join kept k on k.doc_id = d.doc_id
"""

NGRAM_JOIN = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as words from documents),
s as (select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 2), lambda i: array_to_string(list_slice(words, i, i + 3), ' ')) end) as gram from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
r as (select doc_id, doc_id as root from documents union select e.y, r.root from r join e on e.x = r.doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.root as component_id
from documents d left join n on n.doc_id = d.doc_id join (select doc_id, min(root) as root from r group by 1) m on m.doc_id = d.doc_id
"""

MIXING = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || left(md5(concat_ws('|', '7', doc_id::varchar, text)), 12))::bigint as draw from documents),
liked as (select *, floor(size * 1000 / (size + 300))::bigint as preference from sized),
sources as (select source, sum(size)::bigint as words, sum(size * preference)::bigint as liking from liked group by source),
weighed as (select *, 3 * words as most, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight,
                   sum(words) over () as total from sources),
levels as (select *, row_number() over (order by most / weight, weight, source nulls last) as turn,
                  (total - coalesce(sum(most) over (order by most / weight, weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
                  / sum(weight) over (order by most / weight, weight, source nulls last rows between current row and unbounded following) as level from weighed),
share as (select arg_min(level, turn) as level from levels where weight * level <= most),
aims as (select l.source, l.words, l.liking, least(l.most::double, l.weight * s.level) as target from levels l, share s),
expected as (
  select k.*, a.words, a.target, a.target / a.words as ratio, a.liking / a.words as usual
  from liked k join aims a on a.source is not distinct from k.source),
copies as (select *, greatest(0.0::double, least(3.0::double, coalesce(ratio, 0) + least(coalesce(ratio, 0), 3.0::double - coalesce(ratio, 0))
                  * (preference - coalesce(usual, 0)) / 1000)) as want from expected),
parts as (select *, floor(want + 1e-9)::bigint as certain, greatest(0.0::double, want - floor(want + 1e-9)) as p from copies),
odds as (select *, case when p > 0 then ((draw + 0.5::double) / 281474976710656.0::double)
                  / (1 - (draw + 0.5::double) / 281474976710656.0::double) * ((1 - p) / p) end as odds from parts),
ranked as (select *, case when p > 0 then least(1073741823, floor(odds / (1 + odds) * 1073741824))::bigint end as rank from odds),
certain as (select source, sum(certain * size)::double as taken from ranked group by source),
steps as (select source, rank, sum(size) as size from ranked where rank is not null group by source, rank),
sums as (select s.source, s.rank, c.taken + sum(s.size) over (partition by s.source order by s.rank) - s.size / 2 as middle
         from steps s join certain c on c.source is not distinct from s.source),
picked as (select s.source, max(s.rank) as last from sums s join aims a on a.source is not distinct from s.source
           where s.middle <= a.target group by s.source)
select r.doc_id, r.size, r.words as source_size, r.target,
       (r.size * (r.certain + case when r.rank <= p.last then 1 else 0 end))::bigint as taken
from ranked r left join picked p on p.source is not distinct from r.source
"""

# The checksum of IEEE 802.3 by a table of 256 remainders; ``{bytes}`` is a list of the bytes.
_CRC_TABLE = """remainders as (select list(v order by i) as t from (select i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i)))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, {bytes}), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295)"""
_DIGITS = "list_transform(range(1, length(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i, 1))::bigint)"

PREFIX_TRIE = f"""
with {_CRC_TABLE},
turns as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
                 row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
          from conversations where conv_id is not null),
told as (select c, list(struct_pack(r := r, x := x) order by place) as own from turns group by c),
wanted as (select c, own, {_CRC.format(bytes=_DIGITS)} % 9 as h, c - c % 5 as giver from told, remainders),
whole as (select w.c, list_concat(coalesce(list_slice(g.own, 1, h), []), list_slice(w.own, h + 1, len(w.own))) as s
          from wanted w left join told g on g.c = w.giver),
members as (select c, d, len(s) as n, md5(s[1:d]::varchar) as node, case when d > 0 then md5(s[1:d - 1]::varchar) end as parent,
                   case when d > 0 then octet_length(encode(s[d].x)) else 0 end as size,
                   list_transform(range(0, d + 1), lambda k: md5(s[1:k]::varchar)) as above
            from (select c, s, unnest(range(0, len(s) + 1)) as d from whole)),
nodes as (select d, node, any_value(parent) as parent, any_value(size) as size, any_value(above) as above, min(c) as conv_id, count(*) as n_convs,
                 sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '')) as ends_sha256
          from members group by d, node),
children as (select parent, d - 1 as d, count(*) as n from nodes where parent is not null group by all),
subtrees as (select top, level, sum(saved) as saved, sum(leaf) as leaves from (
               select unnest(above) as top, unnest(range(0, n.d + 1)) as level, (n.n_convs - 1) * n.size as saved, (c.n is null)::int as leaf
               from nodes n left join children c on c.parent = n.node and c.d = n.d) group by all)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0)::bigint as n_children,
       s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join subtrees s on s.top = n.node and s.level = n.d
left join nodes p on p.node = n.parent and p.d = n.d - 1 left join children c on c.parent = n.node and c.d = n.d
"""

SUFFIX_DEDUP = """
with d as (select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
w as (select doc_id, i, md5(b[i:i + 399]) as h from (select doc_id, b, unnest(range(1, n - 398)) as i from d where n >= 400)),
r as (select doc_id, i from w where h in (select h from w group by h having count(*) > 1)),
e as (select doc_id, i, (i <= coalesce(lag(i) over (partition by doc_id order by i) + 400, 0))::int as goes_on from r),
g as (select doc_id, i, sum(1 - goes_on) over (partition by doc_id order by i) as run from e),
s as (select doc_id, min(i) as a, max(i) + 399 as z from g group by doc_id, run),
gaps as (select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 0) + 1 as f, a - 1 as t from s
         union all select s.doc_id, max(z) + 1, any_value(n) from s join d on d.doc_id = s.doc_id group by s.doc_id),
kept as (select d.doc_id, list_reduce(list(case when t >= f then b[f:t] else ''::blob end order by f), lambda x, y: x || y) as b
         from gaps join d on d.doc_id = gaps.doc_id group by d.doc_id),
cut as (select doc_id, sum(z - a + 1)::bigint as n_removed, count(*) as n_spans from s group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(c.n_removed, 0)::bigint as n_removed, coalesce(c.n_spans, 0)::bigint as n_spans,
       sha256(coalesce(k.b, d.b)) as kept_sha256
from d left join cut c on c.doc_id = d.doc_id left join kept k on k.doc_id = d.doc_id
"""

_CODES = "list_transform(range(0, (length(code) // 2)::bigint), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::bigint)"

SPELLING_VARIANTS = rf"""
with recursive {_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[a-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents),
numbered as (select doc_id, run, count(*) as n from runs where length(run) >= 7 group by all),
coded as (select run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as code from numbered),
drawn as (select run, n, {_CRC.format(bytes=_CODES)} as h from coded, remainders),
cut as (select n, case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word
        from drawn),
words as (select word, sum(n)::bigint as n from cut where length(word) >= 7 group by word having sum(n) >= 2),
spots as (select word, n, unnest(range(1, length(word)::bigint + 1)) as i from words),
masked as (select word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) as key from spots),
shorter as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as key from spots),
pairs as (select a.word, b.word as near, b.n as near_n from masked a join masked b on a.key = b.key and a.word <> b.word
          union all select a.word, b.word, b.n from shorter a join words b on a.key = b.word
          union all select b.word, a.word, a.n from shorter a join words b on a.key = b.word),
best as (select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by word),
formed as (select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near, case when b.near_n >= 10 * w.n then b.near end as form,
                  case when b.near_n >= 10 * w.n then b.near_n end as form_n from words w left join best b on b.word = w.word),
walk as (select word, word as root, form as next from formed
         union all select k.word, k.next, f.form from walk k join formed f on f.word = k.next where k.next is not null)
select f.word, f.form, k.root, f.n, f.n_near, f.form_n from formed f join walk k on k.word = f.word and k.next is null
"""

# Every pair of vectors; the index finds the same links where its recall is 1, as on a table that it holds in one list.
NEAR_VECTORS = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
able as (select vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
           and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from able a join able b on len(a.e) = len(b.e) and a.vec_id <> b.vec_id
          where list_cosine_similarity(a.e, b.e) >= 0.9),
reached as (select vec_id, vec_id as root from v union select l.y, r.root from reached r join links l on l.x = r.vec_id),
least as (select vec_id, min(root) as component_id from reached group by vec_id),
degree as (select x, count(*) as n from links group by x)
select v.vec_id, coalesce(d.n, 0)::bigint as n_links, l.component_id, v.vec_id = l.component_id as kept
from v join least l on l.vec_id = v.vec_id left join degree d on d.x = v.vec_id
"""
