"""DuckDB SQL with the same rows as the corpus queries."""

from __future__ import annotations

from marketloom.llm import url_filter as urls

SPACE = r"[\x20\x09-\x0D]+"


def words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{SPACE}'), lambda x: x <> '')"


def quality_rules(table: str = "documents") -> str:
    return f"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, {words("text")} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from {table}),
grams as (
  select r, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
  from (select r, w, unnest(range(1, len(w) - 1)) as i from base where len(w) >= 3)),
repeated as (select r, i from (select r, i, count(*) over (partition by r, a, b, c) as n from grams) where n > 1),
covered as (select r, count(distinct i + k) as n from repeated, (values (0), (1), (2)) as ks(k) group by r),
measured as (
  select r, doc_id, len(w) as n_words, length(regexp_replace(t, '{SPACE}', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words, len(l) as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper
  from base left join covered c using (r)),
bits as (
  select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
    + (case when 4 * n_symbols > n_words then 4 else 0 end) + (case when 10 * n_dup_lines > 3 * n_lines then 8 else 0 end)
    + (case when 2 * n_upper > word_chars then 16 else 0 end)
    + (case when word_chars < 2 * n_words or word_chars > 25 * n_words then 32 else 0 end) as fail_bits
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed,
       fail_bits = 0 as kept, n_lines, n_upper, fail_bits
from bits"""


QUALITY_RULES = quality_rules()

RULE_ABLATIONS = f"""
with ledger as materialized (select fail_bits from ({QUALITY_RULES})),
rules(rule, bit, policies) as (values
  ('few_words', 0, ['base', 'v1', 'v2']), ('repeated_words', 1, ['base', 'v1', 'v2']), ('symbols', 2, ['v1', 'v2']),
  ('repeated_lines', 3, ['v1']), ('capitals', 4, ['v1', 'v2']), ('odd_word_length', 5, ['v1'])),
members as (select unnest(policies) as policy, rule, bit from rules),
masks as (select policy, sum(1 << bit)::bigint as mask from members group by policy)
select policy, rule, bit, count(*) as n_docs, count(*) filter ((fail_bits >> bit) & 1 = 1) as n_failed,
       count(*) filter (fail_bits & mask = 1 << bit) as n_only, count(*) filter (fail_bits & (mask | 3) = 0) as n_kept
from members join masks using (policy) cross join ledger
group by policy, rule, bit"""


def unit_hash(seed: str, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}|' || coalesce(cast({key} as varchar), '')), 1, 13))::bigint / {float(1 << 52)})"


def mix_sources(table: str = "documents") -> str:
    return f"""
with sized as (select *, len({words("text")}) as size from {table}),
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, row_number() over (order by encode(source) nulls last) - 1 as k from per_source),
caps as (
  select *, [5.0::double, 2.0::double, 1.0::double][k % 3 + 1] as weight, 2.0::double * source_size as cap,
         1.5::double * sum(source_size) over () as total
  from weighted),
leveled as (
  select *, cap / weight as ratio,
    (total - coalesce(sum(cap) over (order by cap / weight, k rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by cap / weight, k rows between current row and unbounded following) as level
  from caps),
final as (select *, (select arg_min(level, (ratio, k)) from leveled where level <= ratio) as common from leveled),
targets as (select source, source_size, least(cap, coalesce(common * weight, cap)) as target from final),
rated as (
  select s.*, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate
  from sized s join targets t on s.source is not distinct from t.source),
taken as (
  select *, floor(rate)::bigint + (case when {unit_hash("mix-1", "doc_id")} < rate - floor(rate) then 1 else 0 end) as copies
  from rated)
"""


MIX_SOURCES = mix_sources() + "select doc_id, size, source_size, target, size * copies as taken from taken"


def exact_dedup(table: str = "documents") -> str:
    return f"""
with texts as (
  select doc_id, length(coalesce(text, '')) as size, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') as t from {table}),
best as (
  select t, count(*) as group_size, arg_min(doc_id, (-size, doc_id)) as keep_id from texts group by t)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256
from texts join best using (t)"""


EXACT_DEDUP = exact_dedup()


def url_filter() -> str:
    fits = []
    for action, rule in sorted(urls.RULES, key=lambda r: -len(r[1])):
        domain, slash, rest = rule.partition("/")
        test = f"(host = '{domain}' or ends_with(host, '.{domain}')) and starts_with(path, '{slash + rest}')"
        fits.append((test, rule, action))
    rule = "case " + " ".join(f"when {t} then '{r}'" for t, r, _ in fits) + " end"
    action = "case " + " ".join(f"when {t} then '{a}'" for t, _, a in fits) + " end"
    lower = f"translate(regexp_extract(rest, '^[^/?#]*'), '{urls._UPPER}', '{urls._LOWER}')"
    levels = []
    for k in range(urls.ORDER + 1):
        prior = f"join p{k - 1} q on q.gram = right(c.gram, {k})" if k else ""
        qa, qr = ("q.pa", "q.pr") if k else (f"(1 / {urls.ALPHABET}::double)",) * 2
        context = f"left(gram, {k})" if k else "''"
        levels.append(f"""
c{k} as (select right(gram, {k + 1}) as gram, sum(accepted) as a, sum(rejected) as r from windows group by 1),
s{k} as (select {context} as ctx, sum(a) as na, sum(r) as nr, count(*) filter (a > 0) as ta, count(*) filter (r > 0) as tr
         from c{k} group by 1),
p{k} as (
  select c.gram, case when na > 0 then (c.a + ta * {qa}) / (na + ta)::double else {qa} end as pa,
         case when nr > 0 then (c.r + tr * {qr}) / (nr + tr)::double else {qr} end as pr
  from c{k} c join s{k} s on s.ctx = {context.replace("gram", "c.gram")} {prior})""")
    return f"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
hosts as (
  select page_id, {lower} as host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from cut),
ruled as (select *, host || path as string, {rule} as rule, {action} as action from hosts),
strings as (
  select string, count(*) filter (action = 'allow') as accepted, count(*) filter (action = 'block') as rejected,
         {unit_hash(urls.SEED, "string")} < {urls.HELD_OUT} as test
  from ruled group by string),
cuts as (
  select string, test, accepted, rejected,
         unnest([substr(repeat(chr(2), {urls.ORDER}) || string || chr(3), i, {urls.ORDER + 1})
                 for i in range(1, length(string) + 2)]) as gram
  from strings),
windows as (
  select gram, sum(case when test then 0 else accepted end) as accepted, sum(case when test then 0 else rejected end) as rejected
  from cuts group by gram),
{",".join(levels)},
scores as (
  select string, round(sum(ln(pa) - ln(pr)) / count(*), 6) as score
  from cuts join p{urls.ORDER} p using (gram) group by string),
bins as (
  select floor(greatest(-{urls.CLIP}, least({urls.CLIP}, score)) * {urls.BINS}) as step, sum(accepted) as a, sum(rejected) as r
  from scores join strings using (string) where test and accepted + rejected > 0 group by 1),
graded as (
  select step, (step + coalesce(lag(step) over (order by step), step)) / {2.0 * urls.BINS} as middle, round((sum(a) over () - coalesce(sum(a) over below, 0)) / (sum(a) over ())::double
                     + coalesce(sum(r) over below, 0) / (sum(r) over ())::double, 9) as quality
  from bins where (select sum(a) from bins) > 0 and (select sum(r) from bins) > 0
  window below as (order by step rows between unbounded preceding and 1 preceding)),
threshold as (select coalesce(arg_min(middle, (-quality, step)), 0.0) as threshold from graded)
select page_id, host, path, rule, coalesce(action, case when score >= threshold then 'allow' else 'block' end) as verdict, score
from ruled join scores using (string), threshold"""


def line_dedup(table: str = "documents") -> str:
    split = "string_split(coalesce(text, ''), chr(10))"
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with lines as (
  select doc_id, generate_subscripts({split}, 1) as i, unnest({split}) as line from {table}),
keyed as (
  select *, translate(trim(line, {blank}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
marked as (select doc_id, i, line, coalesce(keeper <> doc_id, false) as gone from keyed left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id"""


LINE_DEDUP = line_dedup()


def fill_middle(table: str = "documents") -> str:
    draw = "('0x' || substr(h, {}, 8))::bigint"
    return f"""
with drawn as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as h from {table}),
placed as (
  select doc_id, t, n, least({draw.format(1)} % (n + 1), {draw.format(9)} % (n + 1)) as a,
         greatest({draw.format(1)} % (n + 1), {draw.format(9)} % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or {draw.format(17)} % 100 >= 90
              then 'plain' when {draw.format(25)} % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
parts as (select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from placed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from parts"""


FILL_MIDDLE = fill_middle()


def source_divergence(table: str = "documents", min_docs: int = 3, top: int = 200) -> str:
    share = "1 + (1000000000::hugeint * ({} + 1)) // ({} + {})"
    return f"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from {table}),
groups as (select distinct lang, source from docs),
found as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
per_doc as (select r, lang, source, term, count(*) as n from found group by all),
kept as (select lang, term, sum(n)::bigint as total from per_doc group by lang, term having count(*) >= {min_docs}),
counts as (select lang, source, term, sum(n)::bigint as n from per_doc group by lang, source, term),
langs as (select lang, count(*) as v, sum(total)::bigint as size from kept group by lang),
filled as (
  select g.lang, g.source, k.term, k.total, coalesce(c.n, 0) as n
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sizes as (select lang, source, sum(n)::bigint as size from filled group by lang, source),
shares as (
  select f.lang, f.source, f.term, f.n, ({share.format("f.n", "s.size", "l.v")})::hugeint as p,
         ({share.format("f.total", "l.size", "l.v")})::hugeint as q
  from filled f join sizes s on s.lang = f.lang and s.source = f.source join langs l on l.lang = f.lang),
summed as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pairs
  union all
  select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from terms)
select lang, source, part, item, value, rank::integer as rank from ranked where part = 'pair' or rank <= {top}"""


SOURCE_DIVERGENCE = source_divergence()
