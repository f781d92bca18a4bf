"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op3_mix_sources"] = r"""
with sizes as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(coalesce(text, '')) as mark,
        row_number() over (partition by doc_id, source, md5(coalesce(text, ''))) as number
    from documents
),
sources as (select source, sum(size)::bigint as source_size from sizes group by source),
weighed as (
    select *, ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from sources
),
placed as (
    select *, (3 * source_size)::double / weight as bound,
        row_number() over (order by (3 * source_size)::double / weight, source nulls last) as place
    from weighed
),
levels as (
    select *,
        (sum(source_size) over () - coalesce(sum(3 * source_size) over before, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
    from placed
    window before as (order by place rows between unbounded preceding and 1 preceding)
),
first as (select place, level from levels where level <= bound order by place limit 1),
goals as (
    select l.source, l.source_size,
        case when l.place < f.place then (3 * l.source_size)::double else f.level * l.weight end as target
    from levels l, first f
),
rates as (
    select s.doc_id, s.size, g.source_size, g.target,
        case when g.source_size > 0 then g.target / g.source_size else 0.0 end as rate,
        ('0x' || substr(md5(coalesce(s.doc_id::varchar, 'null') || ':' || s.mark || ':' || s.number || ':7'), 1, 13))::bigint / 4503599627370496.0::double as draw
    from sizes s join goals g on s.source is not distinct from g.source
)
select doc_id, size, source_size, target,
    ((floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) * size)::bigint as taken
from rates
"""

LINES = r"""
with line as (
    select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from {docs}
),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from line
),
over as (
    select key, max(doc_id) as last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
),
marked as (
    select k.doc_id, k.line, k.place, o.key is not null and k.doc_id <> o.last as dropped
    from keyed k left join over o on k.key = o.key
),
kept as (
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
        coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '') as text
    from marked group by doc_id
)
"""

SQL["op9_line_dedup"] = LINES.format(docs="documents") + "select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256 from kept"

SQL["op12_benchmark_passages"] = r"""
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), asked as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), windows as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + 9), ' ') as passage
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from asked where len(w) > 0)
), found as (
    select d.doc_id, d.i, q.n, q.item_id
    from (
        select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as passage
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, (select distinct n from windows))
    ) d
    join windows q on d.n = q.n and d.passage = q.passage
), hits as (
    select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(i, i + n)) as spot from found) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join items using (doc_id)
"""

SQL["op13_hard_negatives"] = """
with r as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as p
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scores as (
    select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label, cast(list_dot_product(a.p, b.p) as bigint) as score
    from r a join r b on a.vec_id <> b.vec_id
    where a.vec_id % 50 = 0
), positives as (
    select anchor_id, anchor_label, vec_id as positive_id, score as positive_score
    from scores where label = anchor_label
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank,
    s.vec_id as negative_id, positive_score, s.score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and s.label <> p.anchor_label
    and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
qualify rank <= 3
"""
