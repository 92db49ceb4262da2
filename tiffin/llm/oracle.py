"""DuckDB SQL for the queries that SQL can express: search, chats, mixing, licences and quality rules.

The others are tested against brute force: they need a tokenizer, XXH64, or rank-order profiles.
"""

from __future__ import annotations

from tiffin.llm.chat import CHUNK
from tiffin.llm.licenses import LEAST, LOWER, TEMPLATES, UPPER

TOP_K = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), asked as (select distinct vec_id, v from usable where vec_id % 20 = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from asked q join usable c on c.vec_id <> q.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

CHATS = f"""
with lines as (
    select distinct conv_id, turn, role, text,
        '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as line
    from conversations
), placed as (
    -- The place of a turn, from 0 for the first one with a number; rows that share a number stand by role and text here.
    select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1
        - count(*) filter (turn is null) over (partition by conv_id) as place
    from lines
), whole as (
    select conv_id, count(*) as n, list(struct_pack(role := role, text := text) order by place) as said from placed group by conv_id
), single as (select min(conv_id) as conv_id, count(*) as copies, any_value(n) as n, said from whole group by said),
kept as (
    select conv_id, copies from single a
    where not exists (select 1 from single b where b.n > a.n and b.said[1] = a.said[1] and b.said[1:a.n] = a.said)
)
select placed.conv_id, floor(place / {CHUNK})::bigint as part, count(*) as n_turns, any_value(copies) as copies,
    string_agg(line, '' order by place) as text
from placed join kept on placed.conv_id is not distinct from kept.conv_id
group by placed.conv_id, part
"""

MIXING = """
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents
), sources as (
    select source, sum(size)::bigint as source_size,
        [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
    from sized group by source
), bounded as (
    -- Sources by how soon they reach three times their size; what is left for the others at each step.
    select *, 3 * source_size as top,
        coalesce(sum(3 * source_size) over (order by 3.0 * source_size / weight, source rows between unbounded preceding and 1 preceding), 0) as held,
        sum(weight) over (order by 3.0 * source_size / weight, source rows between current row and unbounded following) as free,
        sum(source_size) over () as total
    from sources
), share as (
    -- The first step at which no source that is left goes over; later ones hold too much back.
    select max((total - held)::double / free::double) filter (where (total - held)::double / free::double * weight <= top) as share from bounded
), targets as (
    select source, source_size, least(weight * share, top::double) as target from bounded cross join share
), drawn as (
    select *, ('0x' || substr(md5('mix-1:' || draw || ':' || coalesce(source, chr(0))), 1, 8))::bigint / 4294967296.0::double as u
    from targets cross join range(32) as draws(draw)
), placed as (
    select doc_id, source, size, row_number() over (partition by source order by size, doc_id) - 1 as place from sized
), rated as (
    select p.*, t.source_size, t.target, t.draw, t.u, case when t.source_size = 0 then 0 else t.target / t.source_size end as rate
    from placed p join drawn t on p.source is not distinct from t.source
), copied as (
    select *, (floor((place + 1) * rate + u) - floor(place * rate + u))::bigint as copies from rated
), totals as (
    select source, draw, abs(sum(copies * size) - target) as missed from copied group by source, draw, target
), best as (
    select source, draw from totals qualify row_number() over (partition by source order by missed, draw) = 1
), counted as (
    select c.* from copied c join best b on c.source is not distinct from b.source and c.draw = b.draw
)
select doc_id, source, size, source_size, target, copies, copies * size as taken from counted
"""


def _licences() -> str:
    rows = ",\n        ".join(
        "({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES)
    )
    clean = f"trim(regexp_replace(translate({{}}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    pairs = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
    return f"""
with templates(template, license, t) as (values
        {rows}),
known as (
    select template, license, w, list_distinct({pairs.format("w")}) as tb
    from (select *, string_split({clean.format("t")}, ' ') as w from templates)
), places as (
    select template, license, len(w) as nw, tb, unnest({pairs.format("w")}) as pair, unnest(range(len(w) - 1)) as place from known
), held as (
    select template, license, nw, tb, pair, min(place) as place, count(*) over (partition by pair) as holders
    from places group by template, license, nw, tb, pair
), anchors as (
    select * from held
    qualify row_number() over (partition by template order by holders, length(pair) desc, pair) <= len(tb) // 3 + 1
), texts as (
    select distinct doc_id, text, string_split({clean.format("text")}, ' ') as w from documents where text is not null
), hits as (
    select doc_id, text, w, unnest({pairs.format("w")}) as pair, unnest(range(len(w) - 1)) as spot from texts
), windows as (
    select distinct doc_id, text, template, license, tb, greatest(spot - place, 0) as lo, least(spot - place + nw, len(w)) as hi,
        w[greatest(spot - place, 0) + 1:least(spot - place + nw, len(w))] as part
    from hits join anchors using (pair)
), scored as (
    select * exclude (part, b), list_sort(b) as b, 2.0::double * len(list_intersect(b, tb)) / (len(b) + len(tb)) as dice
    from (select *, list_distinct({pairs.format("part")}) as b from windows)
), matched as (
    select * from scored where dice >= {LEAST}::double
), best as (
    select * from matched m where not exists (
        select 1 from matched o
        where o.doc_id is not distinct from m.doc_id and o.text = m.text and o.lo < m.hi and m.lo < o.hi and o.dice > m.dice)
)
select doc_id, license, max(dice) as dice, arg_max(template, dice * 1000 - template)::int as template, count(distinct b) as n_units
from best
group by doc_id, license
"""


QUALITY = """
with texts as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
), words as (
    select doc_id, unnest(w) as word, unnest(range(len(w))) as i, len(w) as n from texts
), windows as (
    select doc_id, i, n,
        case when i + 3 <= n then list(word) over (partition by doc_id order by i rows between current row and 2 following) end as w3,
        case when i + 10 <= n then list(word) over (partition by doc_id order by i rows between current row and 9 following) end as w10
    from words
), counted as (
    select *, w3 is not null and count(*) over (partition by doc_id, w3) > 1 as r3,
        w10 is not null and count(*) over (partition by doc_id, w10) > 1 as r10
    from windows
), spread as (
    select doc_id, i, bool_or(r3) over (partition by doc_id order by i rows between 2 preceding and current row) as c3,
        bool_or(r10) over (partition by doc_id order by i rows between 9 preceding and current row) as c10
    from counted
), covered as (
    select doc_id, count(*) filter (where c3) as n_repeat_words, count(*) filter (where c10) as repeat_covered from spread group by doc_id
), pairs as (
    -- Starts of repeated passages, left-maximal ones alone: each pair of equal three-word windows that isn't led by equal words.
    select a.doc_id, a.i as i, b.i as j
    from counted a join counted b on a.doc_id = b.doc_id and a.w3 = b.w3 and a.i < b.i
), runs as (
    select doc_id, j - i as lag, i - row_number() over (partition by doc_id, j - i order by i) as run from pairs
), longest as (
    select doc_id, max(len) as len from (select doc_id, count(*) + 2 as len from runs group by doc_id, lag, run) group by doc_id
), short as (
    select doc_id, max(case when c2 > 1 then 2 when c1 > 1 then 1 else 0 end) as len from (
        select doc_id, count(*) over (partition by doc_id, word) as c1,
            case when next is null then 0 else count(*) over (partition by doc_id, word, next) end as c2
        from (select *, lead(word) over (partition by doc_id order by i) as next from words)
    ) group by doc_id
), lines as (
    select doc_id, count(*) - count(distinct line) as n_dup_lines
    from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
), measured as (
    select t.doc_id, len(w) as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(repeat_covered, 0) as repeat_covered,
        coalesce(l.len, s.len, 0) as longest_repeat
    from texts t left join covered c using (doc_id) left join longest l using (doc_id) left join short s using (doc_id)
        left join lines using (doc_id)
), judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
select *, not base_failed and repeat_covered <= n_words * 0.3::double and longest_repeat <= 200 as kept from judged
"""

UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = f"""
with recursive texts as (
    select row_number() over () as rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER_AZ}', '{LOWER_AZ}'), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), sets as (
    select rid, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as s
    from texts
), grams as (select rid, unnest(s) as gram from sets),
met as (
    select a.rid as a, b.rid as b, count(*) as n from grams a join grams b on a.gram = b.gram and a.rid <> b.rid group by a.rid, b.rid
), links as (
    select a, b from met join sets x on a = x.rid join sets y on b = y.rid where 100 * n >= 80 * (len(x.s) + len(y.s) - n)
), reached(a, b) as (select rid, rid from sets union select r.a, l.b from reached r join links l on r.b = l.a),
first as (select a, min(doc_id) as component_id from reached join sets on b = rid group by a),
counted as (select a, count(*) as n_links from links group by a)
select doc_id, len(s) as n_shingles, coalesce(n_links, 0) as n_links, component_id
from sets left join counted c on rid = c.a join first f on rid = f.a
"""

COLLOCATIONS = f"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER_AZ}', '{LOWER_AZ}'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), worded as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from worded group by lang),
spans as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) as phrase
    from worded cross join (select unnest([1, 2, 3, 4]) as k) where len(w) >= k
), counted as (select lang, k, phrase, count(*) as f from spans group by lang, k, phrase having count(*) >= 30),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k > 1),
held as (
    select lang, unnest(list_transform(range(1, k - part + 2), lambda i: array_to_string(w[i : i + part - 1], ' '))) as phrase, a as longer
    from candidates cross join (select unnest([2, 3]) as part) where part < k
), covering as (select lang, phrase, max(longer) as longer from held group by lang, phrase),
kept as (
    select c.* from candidates c left join covering o on c.lang = o.lang and c.phrase = o.phrase where 100 * coalesce(longer, 0) < 80 * a
), cuts as (
    select lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') as head, array_to_string(w[cut + 1 :], ' ') as tail
    from kept cross join (select unnest([1, 2, 3]) as cut) where cut < k
), scored as (
    select c.lang, c.phrase, a, x.f as l, y.f as r, cut, ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
    from cuts c join counted x on c.lang = x.lang and c.head = x.phrase join counted y on c.lang = y.lang and c.tail = y.phrase
), worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from worst)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

RANKED_SEARCH = f"""
with docs as (
    select row_number() over () as rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER_AZ}', '{LOWER_AZ}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
    from documents
), totals as (select count(*)::hugeint as n_docs, sum(len(t))::hugeint as n_terms from docs where len(t) > 0),
asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, '{UPPER_AZ}', '{LOWER_AZ}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from benchmark where text is not null
), held as (
    select rid, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*) as tf
    from (select rid, doc_id, len(t) as n, unnest(t) as term from docs) group by rid, term
), frequent as (select term, count(*) as df from held group by term),
weighed as (
    select item_id, f.term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w
    from asked a join frequent f on a.term = f.term cross join totals
), scored as (
    select item_id, rid, any_value(doc_id) as doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))::bigint)::bigint as score
    from held h join weighed q on h.term = q.term cross join totals
    group by item_id, rid
), ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
    from scored where score > 0
)
select * from ranked where rank <= 10
"""

ORACLE_SQL = {
    "op1_top_k_search": TOP_K,
    "op3_chat_formatting": CHATS,
    "op4_mixing": MIXING,
    "op8_license_scan": _licences(),
    "op9_quality_rules": QUALITY,
    "op11_ngram_jaccard": JACCARD,
    "op12_collocations": COLLOCATIONS,
    "op13_ranked_search": RANKED_SEARCH,
}
