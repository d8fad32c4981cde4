"""SQL with the same results as the queries of this package, where SQL can express them."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PLAIN = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MATCH_WORDS = r"regexp_extract_all(" + _PLAIN.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
with docs as (select row_number() over () as r, doc_id, {_MATCH_WORDS} as w from documents),
items as (select coalesce(item_id::varchar, '') as item, {_MATCH_WORDS} as w from benchmark),
windows as (
    select distinct item, array_to_string(w[s:s + 12], ' ') as win, least(13, len(w)) as n
    from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as s from items where len(w) > 0)
),
starts as (
    select r, w, n, unnest(range(1, len(w) - n + 2)) as s from docs, (select distinct n from windows) where len(w) >= n
),
hits as (
    select distinct s.r, s.s, s.n, x.item
    from (select r, s, n, array_to_string(w[s:s + n - 1], ' ') as win from starts) s join windows x using (win, n)
),
words_hit as (
    select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from hits) group by r
),
items_hit as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from hits) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words_hit using (r) left join items_hit using (r)
"""

OP7 = """
with pages_ as (select page_id, coalesce(html, '') as html from pages),
firsts as (select html, min(page_id) as first from pages_ group by html),
digests as (
    select page_id, octet_length(encode(html)) as payload_bytes, sha1(encode(html)) as hex, first
    from pages_ join firsts using (html)
),
bits as (
    select *, list_reduce(list_prepend('', list_transform(range(1, 41),
        lambda i: lpad(bin((strpos('0123456789abcdef', hex[i]) - 1)::int), 4, '0'))), lambda a, b: a || b) as bits
    from digests
)
select page_id, payload_bytes::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(0, 5), lambda j: (1 << (4 - j)) * bits[5 * i + j + 1]::int))::int, 1)), '') as payload_digest,
    case when page_id is distinct from first then 'revisit' else 'response' end as record_type,
    case when page_id is distinct from first then first end as refers_to
from bits
"""

OP9 = f"""
with sizes as (
    select doc_id, source, len({_WORDS})::bigint as size,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as place
    from documents
),
per_source as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as no
    from sizes group by source
),
weighted as (select *, [3.0, 1.0, 2.0][(no % 3 + 1)::int]::double as weight, (2 * source_size)::double as full_size from per_source),
levelled as (
    select *, (1.5 * sum(source_size) over () - coalesce(sum(full_size) over below, 0.0))
        / (sum(weight) over () - coalesce(sum(weight) over below, 0.0)) as level
    from weighted
    window below as (order by full_size / weight, no rows between unbounded preceding and 1 preceding)
),
targets as (
    select source, no, source_size,
        least(full_size, coalesce(max(case when full_size / weight >= level then level end) over () * weight, full_size)) as target
    from levelled
),
shares as (
    select no, sum(target) over (order by no) / sum(target) over () as high from targets where target > 0
),
ranges as (select no, coalesce(lag(high) over (order by no), 0.0) as low, high from shares),
points as (
    select (i + 0.5::double) * 0.6180339887498949::double - floor((i + 0.5::double) * 0.6180339887498949::double) as point
    from (select unnest(range(0, (select ceil(1.5 * sum(size) / 64)::bigint from sizes))) as i)
),
slots as (select no, count(*) * 64 as words from points join ranges on point >= low and point < high group by no),
placed as (
    select s.*, t.no, source_size, target, coalesce(sum(size) over (
        partition by t.no order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
    from sizes s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    (greatest(0, least(start + size, words) - start)
        + greatest(0, least(source_size + start + size, words) - source_size - start))::bigint as taken
from (select p.*, coalesce(words, 0) as words from placed p left join slots using (no))
"""

_LAST_TWO = "array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')"
_LONG = "('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in')"
_DOMAIN = f"case when {_LAST_TWO} in {_LONG} then array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') else {_LAST_TWO} end"
_SUFFIX = f"case when {_LAST_TWO} in {_LONG} then {_LAST_TWO} else string_split(host, '.')[-1] end"


def _strength(groups: str) -> str:
    return f"""(
        select 1 / greatest(1 / 1001.0::double, least(0.999, coalesce(
            (xx - n * p * p - p * (1 - p) * (k - 1))
            / case when p * (1 - p) * (n - nn / n - (k - 1)) > 0 then p * (1 - p) * (n - nn / n - (k - 1)) end, 0.0))) - 1 as strength
        from (
            select sum(good)::double as x, sum(n)::double as n, sum(n::double * n) as nn, count(*)::double as k,
                sum(good::double * good / n) as xx, coalesce(sum(good)::double / nullif(sum(n)::double, 0), 0.5) as p
            from {groups}
        )
    )"""


OP10 = f"""
with parsed as (
    select page_id, {_PLAIN.format("regexp_extract(rest, '^([^/?#]*)', 1)")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages)
),
good as (select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id),
hosts as (
    select host, {_DOMAIN} as domain, {_SUFFIX} as suffix, sum(quality)::bigint as good, count(*)::bigint as n
    from (select host, try_cast(regexp_extract(path, '/(\\d+)(\\.\\w+)?/?$', 1) as bigint) as doc_id from parsed) join good using (doc_id)
    group by host
),
domains as (select domain, suffix, sum(good) as good, sum(n) as n from hosts group by all),
suffixes as (select suffix, sum(good) as good, sum(n) as n from domains group by all),
overall as (select coalesce(sum(good)::double / nullif(sum(n)::double, 0), 0.5) as prior from suffixes),
suffixes_ as (
    select suffix, (strength * prior + good) / (strength + n) as mean, strength + n as weight
    from suffixes, overall, {_strength("suffixes")}
),
domains_ as (
    select d.domain, d.suffix, (strength * s.mean + good) / (strength + n) as mean, strength + n as weight
    from domains d join suffixes_ s using (suffix), {_strength("domains")}
),
hosts_ as (
    select h.host, (strength * d.mean + good) / (strength + n) as mean, strength + n as weight
    from hosts h join domains_ d using (domain, suffix), {_strength("hosts")}
),
rated as (
    select host, coalesce(h.mean, d.mean, s.mean, 1.0) as mean, coalesce(h.weight, d.weight, s.weight, 1.0) as weight
    from (select distinct host, {_DOMAIN} as domain, {_SUFFIX} as suffix from parsed)
    left join hosts_ h using (host) left join domains_ d using (domain, suffix) left join suffixes_ s using (suffix)
),
bounds as (select host, mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) as bound from rated),
rules(kind, rule_host, rule_path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
judged as (
    select page_id, host, path, bound,
        (select rule_host || rule_path from rules where (host = rule_host or ends_with(host, '.' || rule_host))
            and starts_with(path, rule_path) order by length(rule_host || rule_path) desc limit 1) as rule,
        (select kind from rules where (host = rule_host or ends_with(host, '.' || rule_host))
            and starts_with(path, rule_path) order by length(rule_host || rule_path) desc limit 1) as kind
    from parsed left join bounds using (host)
)
select page_id, host, path, rule, coalesce(kind, case when bound < 0.5 then 'block' else 'allow' end) as verdict from judged
"""

def _op11(centroids: int = 40, rounds: int = 5) -> str:
    """Plain rounds: every vector against every centroid."""
    steps = [f"""
kept as (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as p
    from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
),
c0 as (
    select row_number() over (order by sha256('2:' || vec_id::varchar) nulls last, p) - 1 as c, p
    from kept qualify c < {centroids}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""
d{i} as (
    select r, c, list_sum(list_transform(list_zip(kept.p, c{i}.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as distance
    from kept, c{i}
),
a{i} as (select r, arg_min(c, (distance, c)) as c, min(distance) as distance from d{i} group by r)""")
        if i < rounds:
            steps.append(f"""
m{i} as (
    select c, d, sum(x) as s, count(*) as n
    from (select a{i}.c, unnest(p) as x, unnest(range(64)) as d from kept join a{i} using (r)) group by c, d
),
f{i} as (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by d) as p from m{i} group by c),
c{i + 1} as (select c, coalesce(f{i}.p, c{i}.p) as p from c{i} left join f{i} using (c))""")
    return "with" + ",".join(steps) + f"""
select vec_id, c::integer as cluster, distance, sum(distance) over (partition by c)::bigint as cluster_inertia,
    sum(distance) over ()::bigint as inertia, sha256(array_to_string(c{rounds}.p, ',')) as centroid_sha256
from kept join a{rounds} using (r) join c{rounds} using (c)
"""


#: Kinds of secrets in order: name, pattern, least length of group 2 (0: no test).
_SECRETS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0),
    ("hex", "[0-9a-f]{24,}", 0),
    ("private_key", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 0),
    ("github", "gh[oprsu]_[A-Za-z0-9]{36,}", 0),
    ("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}", 0),
    ("google", "AIza[A-Za-z0-9_-]{35,}", 0),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,512}\.eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}", 0),
    ("url", r"://[^\x00-\x20/:@]{1,256}:[^\x00-\x20/@]{1,256}@", 0),
)


def _op12() -> str:
    kinds = []
    for no, (name, pattern, least) in enumerate(_SECRETS):
        quoted = pattern.replace("'", "''")
        test = f"length(regexp_extract(match, '{quoted}', 2)) >= {least}" if least else "true"
        kinds.append(f"""
    select r, {no} as no, '{name}' as kind, gap, length(match) as size, i, {test} as kept from (
        select r, unnest(regexp_extract_all(text, '{quoted}')) as match,
            unnest(list_transform(string_split_regex(text, '{quoted}'), lambda x: length(x))) as gap,
            unnest(range(1, len(regexp_extract_all(text, '{quoted}')) + 1)) as i
        from docs
    ) where match is not null""")
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
matches as ({" union all ".join(kinds)}
),
placed as (select *, sum(gap + size) over (partition by r, no order by i) as stop from matches),
spans as (select r, no, kind, stop - size as start, kind || ':' || (stop - size) || ':' || stop as span from placed where kept),
per_doc as (
    select r, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
        count(*) filter (where kind = 'hex') as n_hex,
        string_agg(span, ',' order by start, no) filter (where no < 3) as base, string_agg(span, ',' order by start, no) as spans
    from spans group by r
)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
    coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join per_doc using (r)
"""


OP13 = """
with turns as (
    select conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
        octet_length(encode(coalesce(text, ''))) as size,
        row_number() over (partition by conv_id order by turn nulls first, id, size) as n
    from conversations where conv_id is not null
),
convs as (
    select conv_id, conv_id - conv_id % 5 as base,
        xor(list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
            lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))
        ), 4294967295::bigint) % 9 as heads
    from (select distinct conv_id from turns)
),
parts as (
    select c.conv_id, 0 as part, n, id, size from convs c join turns t on t.conv_id = c.base and n <= heads
    union all
    select c.conv_id, 1, n, id, size from convs c join turns t on t.conv_id = c.conv_id and n > heads
),
paths as (
    select conv_id, string_agg(id, '') over steps as key, row_number() over steps as depth, size,
        count(*) over (partition by conv_id) as n_turns
    from parts window steps as (partition by conv_id order by part, n)
    union all
    select conv_id, '', 0, 0, (select count(*) from parts p where p.conv_id = c.conv_id) from convs c
),
nodes as (
    select key, depth, min(conv_id) as conv_id, count(*) as n_convs, max(size) as size,
        string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = n_turns) as ends
    from paths group by key, depth
),
children as (select substr(key, 1, length(key) - 32) as key, count(*) as n_children from nodes where depth > 0 group by 1),
below as (
    select substr(key, 1, 32 * d) as key, count(*) filter (where n_children is null) as n_leaves,
        sum((n_convs - 1) * size)::bigint as saved_tokens
    from (select nodes.*, n_children, unnest(range(depth + 1)) as d from nodes left join children using (key)) group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
    saved_tokens, sha256(coalesce(n.ends, '')) as ends_sha256
from nodes n left join children using (key) join below using (key)
left join nodes p on n.depth > 0 and p.key = substr(n.key, 1, length(n.key) - 32)
"""

ORACLES: dict[str, str] = {
    "op6_decontamination": OP6, "op7_warc_zip": OP7, "op9_mixing": OP9, "op10_url_filters": OP10,
    "op11_centroids": _op11(), "op12_secret_scan": _op12(), "op13_prefix_trie": OP13,
}
