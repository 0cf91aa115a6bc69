"""The queries' results in DuckDB SQL, where SQL can express them."""

from notemill.llm import licences, privacy, secrets


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def spans_of(kind: str, place: int, pattern: str, accepts: str, group: int = 0) -> str:
    """Rows (doc_id, kind, place, s, e) of one pattern's matches: pieces and matches alternate, so that lengths
    before a match add up to its start. ``accepts`` sees the match as m and the group as g."""
    p = quoted(pattern)
    return f"""
    select doc_id, '{kind}' as kind, {place} as place, x.s as s, x.s + length(x.m) as e from (
        select doc_id, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'m': ms[i], 'g': gs[i],
            's': coalesce(list_sum(list_transform(ps[1:i], lambda v: length(v))), 0)::BIGINT
                 + coalesce(list_sum(list_transform(ms[1:i - 1], lambda v: length(v))), 0)::BIGINT}})) as x
        from (select doc_id, regexp_extract_all(t, {p}) as ms, regexp_extract_all(t, {p}, {group}) as gs,
                     regexp_split_to_array(t, {p}) as ps from texts) where len(ms) > 0)
    where {accepts.replace('$m', 'x.m').replace('$g', 'x.g')}"""


def span_query(parts: list[str], base: list[str]) -> str:
    kinds = ", ".join(f"'{k}'" for k in base)
    row = "kind || ':' || s || ':' || e"
    counts = ", ".join(f"count(*) filter (kind = '{k}')::BIGINT as n_{k}" for k in base)
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
spans as ({' union all '.join(parts)}),
per_doc as (select doc_id, {counts},
    coalesce(string_agg({row}, ',' order by s, place) filter (kind in ({kinds})), '') as base_spans,
    coalesce(string_agg({row}, ',' order by s, place), '') as spans from spans group by doc_id)
select doc_id, {', '.join(f'coalesce(n_{k}, 0) as n_{k}' for k in base)},
       sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join per_doc using (doc_id)"""


_ACCEPTS = {"assign": "length($g) >= 8", "access": "length($m) >= 16", "hex": "length($m) >= 32"}

SQL = {
    "op4_secrets": span_query([spans_of(r.kind, i, r.pattern, _ACCEPTS.get(r.kind, "true"), 2 if r.kind == "assign" else 0)
                               for i, r in enumerate(secrets.RULES)], [r.kind for r in secrets.BASE]),
}


def listed(words) -> str:
    """The words as an SQL list; of none, one that no text holds."""
    return ", ".join(f"'{w}'" for w in words) or "''"


def licence_query() -> str:
    lower = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places = " union all ".join(
        f"select row, '{label}' as label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + {len(phrase.split())}] = "
        f"{phrase.split()!r})) as place from words where len(w) > 0" for phrase, label in licences.PHRASES)
    held = " union all ".join(
        f"""select row, '{t.label}' as label, max(held) / {len(t.words)}.0::DOUBLE as share from (
        select s.row, s.place, count(distinct h.word) filter (h.word in ({listed(t.words)})) as held,
               count(distinct h.word) filter (h.word in ({listed(t.must)})) as telling, count(*) filter (h.word in ({listed(t.never)})) as other
        from hits s join hits h on s.row = h.row and h.place >= s.place and h.place < s.place + {t.block}
        where s.word in ({listed(t.words)}) group by s.row, s.place)
        where held >= {licences.needed(len(t.words), licences.CONTAINMENT)} and telling = {len(t.must)} and other = 0 group by row"""
        for t in licences.TEMPLATES)
    universe = listed(sorted({w for t in licences.TEMPLATES for w in t.marks}))
    return rf"""
with texts as (select row_number() over () as row, doc_id, coalesce(text, '') as t from documents),
words as materialized (select row, regexp_extract_all({lower}, '{word}') as w from texts),
hits as materialized (select row, place, word from (select row, unnest(range(len(w))) as place, unnest(w) as word from words) where word in ({universe})),
places as ({places}), held as ({held}),
base as (select row, count(*) as n, min(place) as first_word, max(place) as last_word,
    string_agg(distinct label, ',' order by label) as labels from places group by row),
best as (select row, max(share) as share from held group by row),
every as (select row, string_agg(distinct label, ',' order by label) as labels from
    (select row, label from places union all select row, label from held) group by row)
select doc_id, len(w)::BIGINT as n_words, coalesce(n, 0)::BIGINT as n_base, first_word, last_word,
    coalesce(base.labels, '') as base_labels, coalesce(every.labels, '') as labels,
    greatest(case when n > 0 then 1.0 else 0.0 end, coalesce(share, 0.0))::DOUBLE as score
from texts join words using (row) left join base using (row) left join best using (row) left join every using (row)"""


SQL["op10_licences"] = licence_query()


_PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "len(list_filter(string_split($m, '.'), lambda p: try_cast(p as HUGEINT) is null or try_cast(p as HUGEINT) > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+", """length(regexp_replace($m, '[^0-9]', '', 'g')) between 14 and 19 and
        list_sum(list_transform(string_split(reverse(regexp_replace($m, '[^0-9]', '', 'g')), ''), lambda d, i:
            case when i % 2 = 1 then d::INT when d::INT > 4 then d::INT * 2 - 9 else d::INT * 2 end)) % 10 = 0"""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace($m, '[^0-9]', '', 'g')) between 10 and 15"),
}


def personal_query() -> str:
    reach, letters = privacy.REACH, privacy.LETTERS
    parts = " union all ".join(spans_of(kind, i, *_PERSONAL[kind]) for i, kind in enumerate(privacy.KINDS))
    whole = span_query(["select * from every_span"], list(privacy.KINDS))
    before = f"""
base_spans as (select row_number() over () as span, * from ({parts})),
beside as (select doc_id, span, kind || ':' || lower(substr(t, s + 1, e - s)) as entity,
    regexp_extract_all(lower(substr(t, greatest(s - {reach}, 0) + 1, least(s, {reach}))), '{letters}') as l,
    regexp_extract_all(lower(substr(t, e + 1, {reach})), '{letters}') as r, s, e, length(t) as size
    from base_spans join texts using (doc_id)),
wordings as (select doc_id, entity, list_distinct(list_concat(case when s > {reach} then l[2:] else l end,
    case when size > e + {reach} and len(r) > 0 then r[1:len(r) - 1] else r end)) as words from beside),
once as (select doc_id, entity, list_sort(words) as wording, unnest(words) as word from wordings),
per_word as (select entity, word, count(distinct wording) as wordings, count(distinct doc_id) as together from once group by all),
everywhere as (select word, count(distinct doc_id) as documents from
    (select doc_id, unnest(regexp_extract_all(lower(t), '{letters}')) as word from texts) group by word),
dangerous as (select entity, word from per_word join everywhere using (word)
    where wordings >= {privacy.LEAST_WORDINGS} and together * {2 ** privacy.LEFT_BITS} >= documents),
doc_words as (select distinct doc_id, word from wordings join dangerous using (entity)),
doc_texts as (select doc_id, t, regexp_extract_all(t, '\\p{{L}}+') as ms, regexp_split_to_array(t, '\\p{{L}}+') as ps
    from texts where doc_id in (select doc_id from doc_words)),
doc_tokens as (select doc_id, x.w as word, x.s as s, x.s + length(x.w) as e from (select doc_id,
    unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'w': ms[i],
        's': list_sum(list_transform(ps[1:i], lambda v: length(v)))::BIGINT
             + coalesce(list_sum(list_transform(ms[1:i - 1], lambda v: length(v))), 0)::BIGINT}})) as x from doc_texts)),
term_spans as (select k.doc_id, 'term' as kind, {len(privacy.KINDS)} as place, k.s, k.e from doc_tokens k
    join doc_words d on k.doc_id = d.doc_id and lower(k.word) = d.word),
every_span as (select doc_id, kind, place, s, e from base_spans union all select * from term_spans),
""".replace("\\\\", "\\")
    head = "with texts as (select doc_id, coalesce(text, '') as t from documents),"
    return whole.replace(head, head + before)


SQL["op7_personal_data"] = personal_query()


SQL["op9_near_duplicates"] = r"""
with recursive texts as (select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda w: w <> '') as w from documents),
sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from texts),
classes as (select list_sort(s) as s, min(doc_id) as rep from sets where len(s) > 0 group by 1),
items as (select rep, len(s) as n, unnest(s) as x from classes),
pairs as (select a.rep as a, b.rep as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as shared
    from items a join items b on a.x = b.x and a.rep < b.rep group by 1, 2),
links as (select a, b from pairs where 100 * shared >= 85 * (na + nb - shared)),
edges as (select a, b from links union select b, a from links),
reach as (select rep as node, rep as seen from classes union select r.node, e.b from reach r join edges e on r.seen = e.a),
parts as (select node, min(seen) as component from reach group by node)
select doc_id, len(sets.s)::BIGINT as n_shingles, coalesce(component, doc_id) as component_id, doc_id = coalesce(component, doc_id) as kept
from sets left join classes on list_sort(sets.s) = classes.s left join parts on rep = node"""


SQL["op6_passages"] = r"""
with texts as (select row_number() over () as row, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '') as w from documents),
runs as (select row, doc_id, i, array_to_string(w[i:i + 49], ' ') as run from
    (select row, doc_id, w, unnest(range(1, len(w) - 48)) as i from texts where len(w) >= 50)),
firsts as (select run, min(doc_id) as first from runs group by run),
gone as (select row, list(distinct p) as p from (select row, unnest(range(i, i + 50)) as p from runs join firsts using (run) where first < doc_id) group by row)
select doc_id, len(w)::BIGINT as n_words, coalesce(len(p), 0)::BIGINT as n_removed,
    sha256(array_to_string(case when p is null then w else list_filter(w, lambda x, i: not list_contains(p, i)) end, ' ')) as kept_sha256
from texts left join gone using (row)"""


SQL["op2_neighbours"] = """
with vectors as (select vec_id, v, sqrt(list_inner_product(v, v)) as n from (select vec_id, min(embedding::DOUBLE[]) as v from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 group by vec_id)),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) / (q.n * c.n) as score
    from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v))
select query_id, rank::INT as rank, vec_id, score from
    (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5"""


def centroid_query(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Plain k-means, one assignment and one mean after the other."""
    apart = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select row, vec_id, v, best.j as j, best.d as d from (select row, any_value(vec_id) as vec_id, any_value(v) as v,
    min({{'d': {apart}, 'j': j}}) as best from kept, c{r} group by row))""")
        if r < rounds:
            steps.append(f"""
m{r} as (select j, list(((total - ((total % n) + n) % n) // n)::BIGINT order by place) as c from (
    select j, place, sum(value) as total, count(*) as n from (
        select j, unnest(range(1, {dim} + 1)) as place, unnest(v) as value from a{r}) group by j, place) group by j)""")
            steps.append(f"""
c{r + 1} as materialized (select j, coalesce(m{r}.c, c{r}.c) as c from c{r} left join m{r} using (j))""")
    return f"""
with kept as materialized (select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) as v
    from embeddings where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select row_number() over (order by sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 as j, v as c from kept
    order by sha256('2:' || coalesce(vec_id::VARCHAR, '')), v limit {k}), {','.join(steps)},
sums as (select j, sum(d)::BIGINT as one from a{rounds} group by j)
select vec_id, j::INTEGER as cluster, d as distance, one as cluster_inertia, (select sum(d)::BIGINT from a{rounds}) as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join sums using (j) join c{rounds} using (j)"""


SQL["op12_centroids"] = centroid_query()


SQL["op11_divergence"] = r"""
with docs as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
words as (select row, lang, source, unnest(terms) as term from docs),
counts as materialized (select lang, source, term, count(*) as n from words group by all),
kept as materialized (select lang, term, count(*) as total from words group by lang, term having count(distinct row) >= 3),
per_lang as (select lang, count(*) as v, sum(total)::BIGINT as size from kept group by lang),
groups as materialized (select distinct lang, source from docs),
sizes as (select lang, source, coalesce(sum(n) filter (kept.term is not null), 0)::BIGINT as size
    from groups left join counts using (lang, source) left join kept using (lang, term) group by lang, source),
shares as materialized (select lang, source, term, coalesce(n, 0) as n,
    (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (sizes.size + v))::HUGEINT as p,
    (1 + (1000000000::HUGEINT * (total + 1)) // (per_lang.size + v))::HUGEINT as whole
    from sizes join per_lang using (lang) join kept using (lang) left join counts using (lang, source, term)),
pairs as (select a.lang, a.source, b.source as item, coalesce(s.value, 0)::BIGINT as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source left join (
        select p.lang, p.source, q.source as item, sum(((p.p - q.p) * (p.p - q.p)) // q.p) as value
        from shares p join shares q on p.lang = q.lang and p.term = q.term and p.source <> q.source group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, term as item, (((p - whole) * (p - whole)) // whole)::BIGINT as value from shares where n > 0 and p > whole),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from
    (select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms))
select lang, source, part, item, value, rank::INTEGER as rank from ranked where part = 'pair' or rank <= 200"""
