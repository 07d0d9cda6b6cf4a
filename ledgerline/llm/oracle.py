"""DuckDB SQL of the queries that SQL can express."""

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op1_warc_revisits": """
with bodies as (select page_id, coalesce(html, '') as body from pages),
firsts as (select body, min(page_id) as first_id from bodies where strlen(body) >= 100 group by body)
select b.page_id, cast(strlen(b.body) as bigint) as payload_bytes, sha256(b.body) as payload_digest,
  case when f.first_id < b.page_id then 'revisit' else 'response' end as record_type,
  case when f.first_id < b.page_id then f.first_id end as refers_to
from bodies b left join firsts f on b.body = f.body
""",
    "op2_line_dedup": f"""
with docs as (select doc_id, row_number() over () as nr, string_split(coalesce(text, ''), chr(10)) as lines from documents),
pieces as (
  select doc_id, nr, unnest(lines) as line, unnest(range(len(lines))) as pos from docs),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {AZ}) as key from pieces),
often as (select key from keyed where key <> '' group by key having count(distinct nr) >= 10),
marked as (select k.*, o.key is not null as gone from keyed k left join often o on k.key = o.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id, nr
""",
    "op4_decontaminate": f"""
with docs as (select doc_id, row_number() over () as nr, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
items as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark),
sized as (select item_id, words, least(len(words), 10) as n from items where len(words) > 0),
starts as (select item_id, words, n, unnest(range(1, len(words) - n + 2)) as s from sized),
windows as (select distinct item_id, n, array_to_string(words[s:s + n - 1], ' ') as win from starts),
places as (select nr, words, unnest(range(1, len(words) + 1)) as pos from docs),
tried as (select p.nr, p.pos, l.n, array_to_string(p.words[p.pos:p.pos + l.n - 1], ' ') as win from places p cross join (select distinct n from windows) l where p.pos + l.n - 1 <= len(p.words)),
found as (select t.nr, t.pos, t.n, w.item_id from tried t join windows w on t.n = w.n and t.win = w.win),
covered as (select nr, count(distinct word) as n_hit from (select nr, unnest(range(pos, pos + n)) as word from found) group by nr),
named as (select nr, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct nr, cast(item_id as varchar) as item from found) group by nr)
select d.doc_id, cast(len(d.words) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
  sha256(coalesce(i.names, '')) as items_sha256, c.n_hit is not null as contaminated
from docs d left join covered c on d.nr = c.nr left join named i on d.nr = i.nr
""",
    "op6_mix_sources": """
with docs as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))) as key
  from documents),
totals as (
  select source, sum(size) as source_size,
    [3.0, 1.0, 2.0][cast((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1 as int)] :: double as weight
  from docs group by source),
ends as (select *, cast(source_size as double) as z, 1.5 * cast(sum(source_size) over () as double) as budget from totals),
levels as (
  select a.source, a.z, a.weight,
    (a.budget - (select coalesce(sum(2.0 * b.z), 0.0) from ends b where 2.0 * b.z / b.weight < 2.0 * a.z / a.weight))
    / (select sum(b.weight) from ends b where 2.0 * b.z / b.weight >= 2.0 * a.z / a.weight) as level
  from ends a),
chosen as (select min_by(level, z / weight) as level from levels where weight * level <= 2.0 * z),
targets as (select t.source, cast(t.source_size as bigint) as source_size, least(e.weight * c.level, 2.0 * e.z) as target from totals t join ends e on t.source is not distinct from e.source, chosen c),
classed as (
  select *, case when length(bin(size)) <= 5 then size else length(bin(size)) * 16 + (size >> (length(bin(size)) - 5)) % 16 end as class from docs),
slotted as (
  select *, ('0x' || substr(key, 1, 12))::bigint % cast(ceil(count(*) over (partition by source, class) / 2000.0) as bigint) as slot from classed),
ranked as (
  select s.doc_id, s.size, t.source_size, t.target,
    row_number() over (partition by s.source order by class, slot, size, key) as nth,
    case when t.source_size > 0 then t.target / t.source_size else 0.0 end as e,
    ('0x' || substr(md5('7|' || coalesce(s.source, '') || '|' || case when s.source is null then 'true' else 'false' end), 1, 12))::bigint / 281474976710656.0 :: double as u
  from slotted s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target, cast((floor(u + nth * e) - floor(u + (nth - 1) * e)) as bigint) * size as taken from ranked
""",
    "op10_url_filter": f"""
with parts as (
  select page_id, url,
    case when url like '%://%' then translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), {AZ}) else '' end as host,
    case when url like '%://%' then regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
rules as (
  select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) r(verdict, name, start)),
fits as (
  select p.page_id, p.url, r.name || r.start as rule, r.verdict,
    row_number() over (partition by p.page_id, p.url order by length(r.name || r.start) desc) as nr
  from (select distinct page_id, url, host, path from parts) p join rules r on (p.host = r.name or suffix(p.host, '.' || r.name)) and prefix(p.path, r.start)),
plain as (
  select *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\\.', '') as name,
    regexp_replace(path, '(/|/?index\\.html?|\\.html?)$', '') as way,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), ''), '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sid|session)(=|$)'))) as args
  from parts),
canonical as (
  select *, case when name <> '' then name || way || case when len(args) > 0 then '?' || array_to_string(args, '&') else '' end end as canon from plain),
listed as (select distinct canon from canonical where regexp_matches(host, '(^|\\.)(ads?|adserver|track|tracker|tracking)[0-9]*[-.]') or substr(md5(canon), 1, 1) in ('3', 'c'))
select c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, case when l.canon is not null then 'block' else 'allow' end) as verdict
from canonical c left join fits f on c.page_id is not distinct from f.page_id and c.url = f.url and f.nr = 1
left join listed l on c.canon = l.canon
""",
    "op12_lexical_search": f"""
with docs as (select row_number() over () as nr, doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
items as (select row_number() over () as inr, item_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark),
asked as (select inr, item_id, term, count(*) as q from (select inr, item_id, unnest(words) as term from items) group by all),
totals as (select count(*) as docs, cast(sum(len(words)) as bigint) as length from docs where len(words) > 0),
held as (select nr, doc_id, n, term, count(*) as tf from (select nr, doc_id, cast(len(words) as bigint) as n, unnest(words) as term from docs) group by all),
wanted as (select * from held where term in (select term from asked)),
weights as (select term, cast(floor(1000 * ln((2 * t.docs + 2) / (2 * f.df + 1))) as bigint) as w from (select term, count(*) as df from wanted group by term) f, totals t),
scored as (
  select a.inr, a.item_id, h.nr, h.doc_id, sum(a.q * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 12 * (100 - 25 + (25 * h.n * t.docs) // t.length)))) as score
  from asked a join wanted h on a.term = h.term join weights w on a.term = w.term, totals t
  group by a.inr, a.item_id, h.nr, h.doc_id),
ranked as (select *, row_number() over (partition by inr order by score desc, doc_id nulls last) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, cast(score as bigint) as score from ranked where rank <= 20
""",
    "op13_source_divergence": f"""
with docs as (select row_number() over () as nr, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x60\\x7B-\\x7F]+') as words from documents),
said as (select nr, lang, source, unnest(words) as term from docs),
kept as (select lang, term from said group by lang, term having count(distinct nr) >= 30),
counts as (select s.lang, s.source, s.term, count(*) as n from said s join kept k on s.lang = k.lang and s.term = k.term group by all),
sizes as (select lang, count(*) as v from kept group by lang),
sums as (select lang, source, sum(n) as total from counts group by lang, source),
groups as (
  select g.lang, g.source, coalesce(z.v, 0) as v, cast(coalesce(s.total, 0) as bigint) as total
  from (select distinct lang, source from docs) g left join sizes z on g.lang = z.lang left join sums s on g.lang = s.lang and g.source = s.source),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as p
  from groups g join kept k on g.lang = k.lang left join counts c on g.lang = c.lang and g.source = c.source and k.term = c.term),
apart as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, b.source as item, coalesce(d.value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source left join apart d on a.lang = d.lang and a.source = d.source and b.source = d.item),
whole as (select s.lang, s.term, 1 + (1000000000 * (sum(s.n) + 5)) // (any_value(t.total) + 5 * any_value(t.v)) as q from shares s join (select lang, sum(total) as total, any_value(v) as v from groups group by lang) t on s.lang = t.lang group by s.lang, s.term),
marked as (select s.lang, s.source, s.term as item, s.p - w.q as value from shares s join whole w on s.lang = w.lang and s.term = w.term where s.n > 0 and s.p > w.q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pairs
  union all
  select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from marked)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 50
""",
}
