"""The same results in DuckDB SQL, where SQL can express them.

Not in SQL: tokenizing (3, 6) and span scans with code-point positions (5, 8);
the tests compare those with brute force.
"""

from __future__ import annotations

from . import mixing, quality, urls

_WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    bounds = []
    for rule in quality.RULES:
        bounds += [f"coalesce({rule.measure} < {rule.low}, false)"] if rule.low is not None else []
        bounds += [f"coalesce({rule.measure} > {rule.high}, false)"] if rule.high is not None else []
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '{_WORD}') as words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines from d),
runs as (select r, i, md5(array_to_string(words[i:i+7], ' ')) as h
  from (select r, words, unnest(range(1, len(words) - 6)) as i from w)),
again as (select r, i from (select r, i, count(*) over (partition by r, h) as n from runs) where n > 1),
covered as (select r, count(distinct i + k) as n_repeat_words from again, range(8) as s(k) group by r),
m as (select doc_id, len(words) as n_words, len(array_to_string(words, '')) as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines,
  len(list_filter(words, lambda x: lower(x) in ({stop}))) as n_stop, len(regexp_extract_all(t, '!')) as bangs,
  len(regexp_extract_all(t, '[A-Z]')) as capitals,
  len(list_filter(lines, lambda x: regexp_matches(ltrim(x), '^[-*•‣▪]'))) as bullets,
  len(list_filter(lines, lambda x: regexp_matches(rtrim(x), '(\\.\\.\\.|…)$'))) as ellipses
  from w left join covered using (r)),
v as (select *, word_chars / nullif(n_words, 0) as mean_word_chars, n_symbols / nullif(n_words, 0) as symbols_per_word,
  bangs / nullif(n_words, 0) as bangs_per_word, capitals / nullif(word_chars, 0) as capital_ratio,
  n_stop / nullif(n_words, 0) as stop_word_ratio, n_dup_lines / nullif(n_lines, 0) as dup_line_ratio,
  bullets / nullif(n_lines, 0) as bullet_line_ratio, ellipses / nullif(n_lines, 0) as ellipsis_line_ratio,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not ({" or ".join(bounds)}) as kept from v
"""


def _level(level: str, source: str, parent: str) -> str:
    low, high = urls.STRENGTH
    return f"""
g_{level} as (select {level}, mu, cast(sum(n) as double) as n, cast(sum(k) as double) as k from {source} group by all),
s_{level} as (select (sum(k * (k - 1)) - sum(n * (n - 1) * mu * mu)) / nullif(sum(n * (n - 1) * mu * (1 - mu)), 0) as rho
  from g_{level}),
m_{level} as (select case when rho is null then {urls.DEFAULT_STRENGTH}
  when rho > 1 / ({high} + 1) then greatest(1 / least(rho, 1.0) - 1, {low}) else {high} end as m from s_{level}),
p_{level} as (select {level}, (k + m * mu) / (n + m) as post, n + m as total from g_{level}, m_{level}),
f_{level} as (select f.* exclude (mu), p.post as mu, p.total as total_{level}
  from {source} f join p_{level} p using ({level}))"""


def _urls() -> str:
    ordered = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))

    def fits(rule) -> str:
        return f"(host = '{rule[0]}' or ends_with(host, '.{rule[0]}')) and starts_with(path, '{rule[1]}')"

    name = " ".join(f"when {fits(r)} then '{r[0]}{r[1]}'" for r in ordered)
    said = " ".join(f"when {fits(r)} then '{r[2]}'" for r in ordered)
    double = ", ".join(f"'{s}'" for s in urls.DOUBLE_SUFFIXES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with cut as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
o as (select doc_id as page_id, max(case when quality = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) as bad
  from labels where (quality is not null or toxic is not null) and doc_id is not null group by doc_id),
c as (select host, count(*) as n, sum(bad) as k from (select distinct page_id, host from p where page_id is not null)
  join o using (page_id) group by host),
h0 as (select host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as name from (select distinct host from p)),
h1 as (select host, name, string_split(name, '.') as labels from h0),
h2 as (select host, name, array_to_string(labels[-2:], '.') as two, array_to_string(labels[-3:], '.') as three,
  labels[-1] as one from h1),
h as (select host, case when two in ({double}) then two else one end as suffix,
  case when two in ({double}) then three else two end as domain, coalesce(n, 0) as n, coalesce(k, 0) as k
  from h2 left join c using (host)),
top as (select coalesce(sum(k) / nullif(sum(n), 0), 0.0) as mu0 from h),
f as (select h.*, mu0 as mu from h, top),
{_level("suffix", "f", "mu")},
{_level("domain", "f_suffix", "suffix")},
{_level("host", "f_domain", "domain")}
select page_id, host, path, case {name} end as rule,
  case {said} else case when host <> '' and greatest(mu - {urls.Z} * sqrt(mu * (1 - mu) / (total_host + 1)), 0) > {urls.MAX_BAD}
    then 'block' else 'allow' end end as verdict
from p left join f_host using (host)
"""


def _mixing() -> str:
    return f"""
with v as (select source, sum(length(coalesce(text, '')) + 1) as volume from documents group by source),
w as (select source, volume, pow(cast(volume as double), {mixing.FLATTEN}) as weight from v),
l as (select source, weight / sum(weight) over () * sum(volume) over () / volume as rate from w),
logs as (select source, k, -rate + k * ln(rate) - coalesce(list_sum([ln(j) for j in range(1, k + 1)]), 0) as log
  from l, range(0, 2000) as s(k) where k <= ceil(rate + 12 * sqrt(rate) + 30)),
steps as (select source, k, sum(exp(log)) over (partition by source order by k) as reached from logs),
drawn as (select *, cast('0x' || substr(md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)
  / 4503599627370496.0 as u from documents),
n as (select d.doc_id, d.text, d.lang, d.source, d.n_chars, (select count(*) from steps s
  where s.source is not distinct from d.source and s.reached <= d.u) as times from drawn d)
select doc_id, text, lang, source, n_chars, cast(copy as integer) as copy,
  md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '') || ':' || copy) as mix_key
from (select *, unnest(range(1, times + 1)) as copy from n)
"""


_NGRAMS = f"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w from documents),
g as (select distinct r, md5(array_to_string(w[i:i+2], ' ')) as s
  from (select r, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) as i from d)),
n as (select r, count(*) as n from g group by r),
common as (select a.r as a, b.r as b, count(*) as c from g a join g b on a.s = b.s and a.r < b.r group by all),
links as (select a, b from common join n x on x.r = a join n y on y.r = b where 100 * c >= 90 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach as (select r, r as to_r from d union select reach.r, both_ways.b from reach join both_ways on both_ways.a = reach.to_r)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from d left join n using (r)
join (select reach.r, min(t.doc_id) as component_id from reach join d t on t.r = reach.to_r group by reach.r) c using (r)
"""

_CHAT = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
shown as (select *, '<turn ' || replace(replace(replace(role, '\', '\\'), '>', '\g'), chr(10), '\n') || '>' || chr(10)
  || regexp_replace(text, '<(\\*)(/?turn|\|)', '<\\\1\2', 'g') || '</turn>' || chr(10) as piece from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(piece)) as bigint) as formatted_chars
from shown group by conv_id
"""

_VECTORS = """
with recursive v as (select row_number() over () as r, vec_id, label, [cast(x as double) for x in embedding] as e from embeddings),
u as (select * from v where label is not null and e is not null),
pairs as (select a.r as a, b.r as b from u a join u b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach as (select r, r as t from v union select reach.r, pairs.b from reach join pairs on pairs.a = reach.t),
least_id as (select reach.r, min(w.vec_id) as component_id from reach join v w on w.r = reach.t group by reach.r),
counts as (select a as r, count(*) as n_links from pairs group by a)
select v.vec_id, coalesce(n_links, 0) as n_links, component_id, v.vec_id = component_id as kept
from v join least_id using (r) left join counts using (r)
"""

_AUDIT = f"""
with recursive d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '{_WORD}') as words, min(doc_id) over (partition by t) as first from d),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
f as (select part, case when len(words) < 50 then 1 else 0 end
  + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
  + case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) then 4 else 0 end
  + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
  + case when doc_id > first then 16 else 0 end as failed,
  coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from w left join l using (doc_id)),
g as (select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, failed),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
o as (select letter as filter_order, bit as mask from letters
  union all select filter_order || letter, mask + bit from o join letters on (mask & bit) = 0),
s as (select filter_order, k as step, bit, list_sum([case letter_at when 'A' then 1 when 'B' then 2 when 'C' then 4
    when 'D' then 8 else 16 end for letter_at in string_split(substr(filter_order, 1, k - 1), '') if letter_at <> '']) as before
  from o, range(1, 6) as r(k) join letters on letter = substr(filter_order, k, 1) where length(filter_order) = 5),
c as (select part, filter_order, cast(step as integer) as step, bit,
  sum(case when (failed & (coalesce(before, 0) | bit)) = 0 then n else 0 end) as kept,
  sum(case when (failed & coalesce(before, 0)) = 0 and (failed & bit) > 0 then n else 0 end) as removed,
  sum(case when (failed & coalesce(before, 0)) > 0 and (failed & bit) > 0 then n else 0 end) as redundant,
  sum(case when failed = bit then n else 0 end) as unique_fails,
  sum(case when (failed & coalesce(before, 0)) = 0 and (failed & bit) > 0 then good else 0 end) as good_lost,
  sum(case when (failed & coalesce(before, 0)) = 0 and (failed & bit) > 0 then toxic else 0 end) as toxic_lost
  from g, s group by part, filter_order, step, bit)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, bit) as bigint) as shapley from c
"""

_PASSAGES = f"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
s as (select r, doc_id, i, md5(array_to_string(w[i:i+49], ' ')) as h
  from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from d)),
known as (select r, i from (select r, doc_id, i, min(doc_id) over (partition by h) as first from s) where first < doc_id),
gone as (select r, list(distinct i + k) as ctr from known, range(50) as x(k) group by r),
k as (select doc_id, len(w) as n_words, len(coalesce(ctr, [])) as n_removed,
  case when ctr is null then w else list_filter(w, lambda x, i: not list_contains(ctr, i)) end as kept
  from d left join gone using (r))
select doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k
"""


def _clusters(rounds: int = 3) -> str:
    steps = ["""
with v as (select row_number() over () as r, vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (select row_number() over (order by h nulls last, v) - 1 as c, v as ctr
  from (select sha256('1:' || vec_id) as h, v from v order by h nulls last, v limit 16))"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} as materialized (select r, vec_id, v, min(d * 16 + c) % 16 as c, min(d * 16 + c) // 16 as d from (select r, vec_id, v, c,
  cast(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v, ctr)]) as bigint) as d from v, c{n})
  group by r, vec_id, v)""")
        steps.append(f"""
c{n + 1} as materialized (select c, coalesce(moved, ctr) as ctr from c{n} left join (select c, list(m order by i) as moved from
  (select c, i, (s - (((s % n) + n) % n)) // n as m from (select c, i, cast(sum(v[i]) as bigint) as s, count(*) as n
  from a{n}, range(1, 65) as x(i) group by c, i)) group by c) using (c))""")
    last = f"a{rounds}"
    return ",".join(steps) + f"""
select vec_id, cast({last}.c as integer) as cluster, d as distance,
  cast(sum(d) over (partition by {last}.c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(ctr, ',')) as centroid_sha256 from {last} join c{rounds} on c{rounds}.c = {last}.c
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": _quality(),
        "op2_url_filters": _urls(),
        "op4_mixing": _mixing(),
        "op7_ngram_join": _NGRAMS,
        "op9_chat_formatting": _CHAT,
        "op10_embedding_dedup": _VECTORS,
        "op11_filter_audit": _AUDIT,
        "op12_substring_dedup": _PASSAGES,
        "op13_centroid_clustering": _clusters(),
    }
