"""The same results in SQL, where SQL can express them."""

# Escaped control strings of the chat template, in the order that keeps them apart.
_ESCAPED = r"""replace(replace(replace(replace({0}, '\', '\\'), '###', '\###'), '</turn>',
  '\</turn>'), ': ', '\: ')"""

from counterfoil.llm.licenses import TEMPLATES, THRESHOLD

_TEMPLATES = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(TEMPLATES))


def _floor(total: str, n: str) -> str:
    """Whole-number division that goes down, also below zero."""
    return f"(({total}) - ((({total}) % ({n})) + ({n})) % ({n})) // ({n})"


_GAP = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _centroid_rounds(rounds: int = 3, clusters: int = 16) -> str:
    """The tables c0, a0, c1, a1, ...: centroids, and each vector's least distance * clusters + c."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select k, min({_GAP.format("v.v", "c.v")}::bigint * {clusters} + c) as m from v, c{r} as c group by k
)""")
        if r < rounds:
            steps.append(f"""
s{r} as (
  select m % {clusters} as c, pos, {_floor("sum(x)::bigint", "count(*)")} as x
  from (select k, unnest(v) as x, unnest(range(len(v))) as pos from v) join a{r} using (k)
  group by 1, 2
), c{r + 1} as materialized (
  select c, coalesce(n.v, o.v) as v from c{r} as o
  left join (select c, list(x order by pos) as v from s{r} group by c) as n using (c)
)""")
    return ",".join(steps)


def _codebook_rounds(rounds: int = 4, entries: int = 256) -> str:
    """The tables b0, a0, b1, a1, ...: codebooks, and each part's least error * entries + entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select k, part, min({_GAP.format("p.v", "b.v")}::bigint * {entries} + entry) as m
  from p join b{r} as b using (part) group by k, part
)""")
        if r < rounds:
            steps.append(f"""
s{r} as (
  select part, m % {entries} as entry, pos, {_floor("sum(x)::bigint", "count(*)")} as x
  from (select k, part, unnest(v) as x, unnest(range(len(v))) as pos from p)
  join a{r} using (k, part) group by 1, 2, 3
), b{r + 1} as materialized (
  select part, entry, coalesce(n.v, o.v) as v from b{r} as o
  left join (select part, entry, list(x order by pos) as v from s{r} group by 1, 2) as n
  using (part, entry)
)""")
    return ",".join(steps)


_FINITE = "len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

ORACLES = {
    "op2_chat_formatting": f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, k, r, '\\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(k, r)
), digest as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
    coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '') as loss,
    sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 14)
      as formatted_chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss)::bigint as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars
from digest""",
    "op6_exact_dedup": """
with d as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over (partition by text) as keep_id,
  count(*) over (partition by text) as group_size,
  doc_id is not distinct from max(doc_id) over (partition by text) as kept,
  sha256(text) as text_sha256
from d""",
    "op8_license_scans": rf"""
with d as (
  select row_number() over () as k, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), w as (
  select k, doc_id, t,
    list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws
  from d
), phrases as (
  select k, unnest(range(len(ws))) as pos, ws from w where t like '%license%'
), base as (
  select k, pos, case when ws[pos + 1] = 'mit' and ws[pos + 2] = 'license' then 'mit'
    when ws[pos + 1] = 'apache' and ws[pos + 2] = 'license' then 'apache'
    when ws[pos + 1] = 'general' and ws[pos + 2] = 'public' and ws[pos + 3] = 'license' then 'gpl'
    end as label
  from phrases
), places as (
  select k, count(*) as n, min(pos) as a, max(pos) as b,
    string_agg(distinct label, ',' order by label) as labels
  from base where label is not null group by k
), templates as (
  select label, list_distinct(regexp_extract_all(lower(text), '[0-9a-z]+')) as own
  from (values {_TEMPLATES}) v(id, label, text)
), blocks as (
  select k, list_distinct(regexp_extract_all(block, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as ws
  from (select k, unnest(string_split(t, chr(10))) as block from d)
  where regexp_matches(block, 'license|licensed|rights|software|permission|redistribution')
), hits as (
  select k, label, len(list_intersect(own, ws)) / len(own)::double as score
  from blocks, templates
  where len(list_intersect(own, ws)) >= ceil(round({THRESHOLD} * len(own), 9))
), every as (
  select k, label, 0.0 as score from base where label is not null
  union all select k, label, score from hits
), named as (
  select k, string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from every group by k
)
select doc_id, len(ws) as n_words, coalesce(n, 0) as n_base, a as first_word, b as last_word,
  coalesce(places.labels, '') as base_labels, coalesce(named.labels, '') as labels,
  coalesce(score, 0.0)::double as score
from w left join places using (k) left join named using (k)""",
    "op12_centroid_clustering": f"""
with v as materialized (
  select row_number() over () as k, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings where len(embedding) = 64 and {_FINITE}
), c0 as (
  select row_number() over (order by sha256('1:' || vec_id), v) - 1 as c, v from v qualify c < 16
), {_centroid_rounds()}
select vec_id, (m % 16)::int as cluster, m // 16 as distance,
  (sum(m // 16) over (partition by m % 16))::bigint as cluster_inertia,
  (sum(m // 16) over ())::bigint as inertia,
  sha256(list_aggregate(c3.v, 'string_agg', ',')) as centroid_sha256
from a3 join v using (k) join c3 on c3.c = m % 16""",
    "op13_vector_codes": f"""
with v as materialized (
  select row_number() over (order by vec_id) as k, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings where len(embedding) > 0 and {_FINITE}
), p as materialized (
  select k, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] as v from v, range(4) r(part)
), b0 as (
  select part, k - 1 as entry, v from p where k <= 256
), {_codebook_rounds()}, errors as (
  select k, sum(m // 256)::bigint as error, string_agg(printf('%02x', m % 256), '' order by part) as code
  from a4 group by k
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' order by part, entry)) from b4)
    as codebooks_sha256
from errors join v using (k)""",
}
