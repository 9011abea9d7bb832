"""DuckDB SQL for the queries that SQL can express, written without the operators' shortcuts.

The licence texts, spellings, patterns and rules are the operators' own fixed values.
"""

from __future__ import annotations

from functools import reduce

from passagecraft.llm import licence_scan, url_graph
from passagecraft.llm.known_licences import KNOWN
from passagecraft.llm.line_dedup import MIN_CHARS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Every window is written out.
SUBSTRINGS = f"""
with w as (select doc_id, {WORDS} as ws from documents),
windows as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k from w, unnest(range(1, len(ws) - 11)) as r(i)),
firsts as (select k, min(doc_id) as low from windows group by k),
gone as (select distinct doc_id, i + j as pos from windows join firsts using (k), unnest(range(0, 13)) as s(j) where low < doc_id),
words as (select doc_id, i as pos, ws[i] as word from w, unnest(range(1, len(ws) + 1)) as r(i)),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as t from words anti join gone using (doc_id, pos) group by doc_id)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)
"""

# Lines pos distance 1 agree once one character is masked, or one is the other less a character.
LINES = f"""
with recursive l as (
  select doc_id, i as pos, ls[i] as line from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
  unnest(range(1, len(ls) + 1)) as r(i) where length(ls[i]) >= {MIN_CHARS}),
d as (select line, row_number() over (order by line) as id from (select distinct line from l)),
cut as (select id, i, substring(line, 1, i - 1) as x, substring(line, i + 1) as y from d, unnest(range(1, length(line) + 1)) as r(i)),
masked as (select i, hash(x) as hx, hash(y) as hy, min(id) as low, list(distinct id) as ids from cut group by all having count(distinct id) > 1),
links as (
  select low as a, unnest(ids) as b from masked
  union select c.id, d.id from cut c join d on c.x || c.y = d.line),
both_ways as (select a, b from links where a != b union select b, a from links where a != b),
reach as (select a, b from both_ways union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
roots as (select a as id, least(a, min(b)) as root from reach group by a),
classed as (select doc_id, pos, line, coalesce(root, id) as root from l join d using (line) left join roots using (id)),
ranked as (
  select *, row_number() over w as place, first_value(line) over w as stays from classed
  window w as (partition by root order by doc_id, pos)),
gone as (select doc_id, pos, line != stays as near from ranked where place > 1),
counts as (select doc_id, count(*) as n, count(*) filter (near) as near from gone group by doc_id),
every as (select doc_id, i as pos, ls[i] as line from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null), unnest(range(1, len(ls) + 1)) as r(i)),
kept as (select doc_id, string_agg(line, chr(10) order by pos) as t from every anti join gone using (doc_id, pos) group by doc_id)
select doc_id, coalesce(len(string_split(text, chr(10))), 0)::bigint as n_lines, coalesce(n, 0)::bigint as n_removed,
  coalesce(near, 0)::bigint as n_near, sha256(coalesce(t, '')) as kept_sha256
from documents left join counts using (doc_id) left join kept using (doc_id)
"""


def _rule(column: str) -> str:
    """The longest rule that fits; ``column`` is what to give of it: the rule, its verdict, or the path ('whole')."""
    cases = sorted(url_graph.RULES, key=lambda r: -len(r[1] + r[2]))
    return "case " + " ".join(
        f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}') then '{dict(verdict=verdict, rule=host + path, whole=path)[column]}'"
        for verdict, host, path in cases) + " end"


def _host(url: str) -> str:
    rest = f"case when strpos({url}, '://') > 0 then substring({url}, strpos({url}, '://') + 3) else '' end"
    return f"coalesce(translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{url_graph.UPPER}', '{url_graph.LOWER}'), '')"


def _url_filter() -> str:
    rest = "case when strpos(url, '://') > 0 then substring(url, strpos(url, '://') + 3) else '' end"
    damping, out = url_graph.DAMPING, [f"""
with p as (select page_id, html, {_host('url')} as host, coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') as path from pages),
found as (select page_id, host, path, {_rule('rule')} as rule, {_rule('verdict')} as verdict, {_rule('whole')} as part from p),
seeds as (select host, bool_or(verdict = 'allow') as a, bool_or(verdict = 'block') as b, bool_or(verdict = 'block' and part = '/') as w from found where host != '' group by host),
marked as (select host, coalesce(a, false) and not coalesce(b, false) as t, coalesce(w, false) and not coalesce(a, false) as u from seeds),
r0 as (select host, case when t then 1.0::double / (select count(*) from marked where t) else 0 end as trust,
  case when u then 1.0::double / (select count(*) from marked where u) else 0 end as distrust from marked where t or u),
targets as (select host as src, unnest(regexp_extract_all(html, {_quoted(url_graph.LINK)}, 1)) as target from p),
links as (select distinct src, {_host("case when starts_with(target, '//') then 'x:' || target else target end")} as dst from targets),
edges as (select src, dst, count(*) over (partition by src) as n_out, count(*) over (partition by dst) as n_in from links where src != '' and dst != '' and src != dst)"""]
    for k in range(url_graph.ROUNDS):
        out.append(f"""r{k + 1} as (select host, sum(trust) as trust, sum(distrust) as distrust from (
  select dst as host, {damping} * trust / n_out as trust, 0 as distrust from r{k} join edges on host = src
  union all select src, 0, {damping} * distrust / n_in from r{k} join edges on host = dst
  union all select host, {1 - damping} * trust, {1 - damping} * distrust from r0) group by host)""")
    return ",\n".join(out) + f"""
select page_id, f.host, path, rule,
  coalesce(verdict, case when distrust > {url_graph.DISTRUST_RATIO} * trust then 'block' when trust is not null then 'allow' end, 'allow') as verdict
from found f left join r{url_graph.ROUNDS} r on f.host = r.host
"""


def _canonical(text: str) -> str:
    bare = f"regexp_replace(lower({text}), {_quoted(licence_scan.COPYRIGHT_LINE)}, '', 'g')"
    spaced = f"' ' || replace(regexp_replace({bare}, {_quoted(licence_scan.NOT_WORD)}, '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    return reduce(lambda c, s: f"replace({c}, ' {s[0]} ', ' {s[1]} ')", licence_scan.SPELLINGS.items(), spaced)


def _tight(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def _licences() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, _, text in KNOWN)
    return f"""
with known as (select distinct name, sha256({_tight(_canonical('t'))}) as digest from (values {known}) v(name, t)),
canon as (select doc_id, {_canonical('text')} as c from documents),
whole as (select doc_id, case when {_tight('c')} != '' then sha256({_tight('c')}) end as digest, c from canon),
lines as (select doc_id, {_tight('line')} as line from (select doc_id, unnest(string_split(c, chr(10))) as line from canon)),
units as (select doc_id, digest from whole union all select doc_id, sha256(line) from lines where line != ''),
named as (select doc_id, string_agg(distinct name, ',' order by name) as licences from units join known using (digest) group by doc_id)
select doc_id, digest, (select min(name) from known k where k.digest = whole.digest) as text_licence, coalesce(licences, '') as licences
from whole left join named using (doc_id)
"""


# The remainders of CRC-32 for half a byte.
CRC_STEPS = [
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
]


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a non-empty text, half a byte at a time, the lower half first."""
    digits = f"hex(encode({text}))"
    halves = f"list_transform(range(1, strlen({text}) * 2 + 1), lambda i: (strpos('0123456789ABCDEF', {digits}[(i - 1) // 2 * 2 + 2 - (i - 1) % 2]) - 1)::BIGINT)"
    step = f"xor(c >> 4, ({CRC_STEPS}::BIGINT[])[(xor(c, h) & 15) + 1])"
    return f"xor(list_reduce(list_prepend({0xFFFFFFFF}::BIGINT, {halves}), lambda c, h: {step}), {0xFFFFFFFF}::BIGINT)"


def _upper_to_lower(text: str) -> str:
    return f"translate({text}, '{url_graph.UPPER}', '{url_graph.LOWER}')"


RESAMPLE = rf"""
with d as (select doc_id, regexp_extract_all({_upper_to_lower("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as ws from documents),
b as (select regexp_extract_all({_upper_to_lower("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as ws from benchmark),
held as (select doc_id, w, count(*) as n from (select doc_id, unnest(ws) as w from d) group by all),
asked as (select w, count(*) as n from (select unnest(ws) as w from b) group by all),
vocab as materialized (select w, {_crc32("w")} % 10000 as bucket from (select w from held union select w from asked)),
s as (select bucket, sum(n) as n from held join vocab using (w) group by bucket),
t as (select bucket, sum(n) as n from asked join vocab using (w) group by bucket),
gains as (select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from s) + 10000)::double
    / ((s.n + 1)::double * ((select coalesce(sum(n), 0) from t) + 10000)::double)))::bigint as gain from s left join t using (bucket)),
weights as (select doc_id, sum(n) as n, floor(sum(n * gain)::double / sum(n))::bigint as weight
  from held join vocab using (w) join gains using (bucket) group by doc_id),
scored as (select doc_id, len(ws)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from d left join weights using (doc_id)),
able as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as total from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * total // 100 then place end::bigint as rank
from scored left join able using (doc_id)
"""

# Words one edit apart agree once a character is masked in both, or left out of one.
SPELLING = rf"""
with recursive runs as (select doc_id, unnest(regexp_extract_all({_upper_to_lower("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents where text is not null),
held as materialized (select doc_id, run, count(*) as n from runs where length(run) >= 5 group by all),
summed as materialized (select run, n, {_crc32("doc_id || ':' || run")} as h from held),
spelt as (select case when h % 97 = 0 then substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) else run end as word, n from summed),
words as materialized (select word, sum(n)::bigint as n from spelt where length(word) >= 5 group by word having sum(n) >= 3),
cut as materialized (select word, i, substring(word, 1, i - 1) || substring(word, i + 1) as rest from words, unnest(range(1, length(word) + 1)) as r(i)),
less as (select distinct c.word as a, w.word as b from cut c join words w on c.rest = w.word),
near as (
  select a.word, b.word as other from cut a join cut b using (i, rest) where a.word != b.word
  union all select a, b from less union all select b, a from less),
most as (select near.word, count(*) as n_near, max(n) as form_n, arg_max(other, (n, -place)) as form
  from near join (select word as other, n, row_number() over (order by encode(word)) as place from words) using (other) group by near.word),
judged as (select word, n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * n then form end as form, case when form_n >= 2 * n then form_n end as form_n
  from words left join most using (word)),
path as (select word, word as root from words union all select path.word, judged.form from path join judged on path.root = judged.word where form is not null)
select word, form, root, n, n_near, form_n from judged join (
  select path.word, root from path join judged on root = judged.word where judged.form is null) using (word)
"""

ORACLES = {
    "op1_line_dedup": LINES,
    "op4_substring_dedup": SUBSTRINGS,
    "op6_url_filter": _url_filter(),
    "op9_licence_scan": _licences(),
    "op12_importance_resampling": RESAMPLE,
    "op13_spelling_variants": SPELLING,
}
