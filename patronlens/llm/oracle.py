"""SQL for the operators that SQL can express, for DuckDB over the same tables.

The others (op2, op4, op5, op7, op9) are tested against brute force in tests/llm.
"""

from __future__ import annotations

from patronlens.llm.chat import DIRECTING, PART, UNKNOWN
from patronlens.llm.filter_audit import FEWEST_WORDS, FILTERS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS
from patronlens.llm.licenses import COPYRIGHT, KNOWN, SPELLINGS
from patronlens.llm.merkle import FIELDS
from patronlens.llm.minhash import LIKENESS
from patronlens.llm.mixing import PASSES, SEED, SHARE, WEIGHTS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    rules = [
        ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""),
        ("access", "AKIA[A-Z0-9]+"),
        ("hex", "[0-9a-f]+"),
    ]
    value = r"""^(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
    parts = []
    for order, (kind, pattern) in enumerate(rules):
        # Cutting at a mark that stands for each match gives the gaps between matches.
        mark = "chr(57344)"
        measure = {"assign": f"length(regexp_extract(hit, {_quoted(value)}, 1)) >= 6", "access": "length(hit) >= 20", "hex": "length(hit) >= 24"}[kind]
        parts.append(f"""
  select doc_id, row, '{kind}' as kind, {order} as o, sum(length(gap) + length(hit)) over (partition by row order by pos) as stop, length(hit) as n
       , {measure} as ok
  from (select doc_id, row, unnest(hits) as hit, unnest(gaps[1:length(hits)]) as gap, unnest(range(length(hits))) as pos
        from (select doc_id, row, regexp_extract_all(t, {_quoted(pattern)}) as hits
                   , string_split(regexp_replace(t, {_quoted(pattern)}, {mark}, 'g'), {mark}) as gaps
              from texts))""")
    return f"""
with texts as (select doc_id, row_number() over () as row, coalesce(text, '') as t from documents)
, found as ({" union all ".join(parts)})
, spans as (
  select row, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex
       , string_agg(kind || ':' || (stop - n)::bigint || ':' || stop::bigint, ',' order by stop - n, o) as spans
  from found where ok group by row)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex
     , sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join spans using (row)"""


def _chat() -> str:
    directing = ", ".join(_quoted(d) for d in DIRECTING)
    plain = "replace(coalesce({0}, ''), '<|', '< |')"
    return f"""
with turns as (
  select distinct conv_id as d, coalesce(floor(turn / {PART}), -1)::bigint as part, turn as t
       , coalesce(role, {_quoted(UNKNOWN)}) as s, {plain.format("text")} as x
  from conversations)
, voices as (select distinct d, s as perspective from turns where s not in ({directing}))
, shown as (
  select turns.d, part, perspective, t, turns.s, x, turns.s = perspective as own
       , '<|im_start|>' || case when turns.s = perspective then 'assistant' when turns.s in ({directing}) then turns.s
           else 'user name=' || {plain.format("turns.s")} end || chr(10) as head
       , x || '<|im_end|>' || chr(10) as body
  from turns join voices on turns.d is not distinct from voices.d)
, placed as (
  select *, sum(length(head) + length(body)) over (partition by d, part, perspective order by t nulls first, s, x) as stop from shown)
select d as conv_id, perspective, part, count(*)::bigint as n_turns
     , string_agg(head || body, '' order by t nulls first, s, x) as text
     , coalesce(string_agg((stop - length(body))::bigint || '-' || stop::bigint, ',' order by stop) filter (own), '') as mask
     , coalesce(sum(length(body)) filter (own), 0)::bigint as n_masked
from placed group by d, part, perspective"""


def _mix() -> str:
    top, bottom = SHARE
    weight = "case (r - 1) % {} {} end".format(len(WEIGHTS), " ".join(f"when {i} then {w}" for i, w in enumerate(WEIGHTS)))
    return f"""
with recursive sized as (
  select doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents)
, sources as (
  select *, {weight} as w, {PASSES} * source_size as stop
  from (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as r from sized group by source))
, rounds as (
  select 0 as k, {top} * sum(source_size)::hugeint as above, {bottom} * sum(w)::hugeint as below from sources
  union all
  select k + 1, a, b from (
    select k, above, below
         , {top} * (select sum(source_size)::hugeint from sources) - {bottom} * (select coalesce(sum(stop), 0)::hugeint from sources where w * above > stop * below) as a
         , {bottom} * (select coalesce(sum(w), 0)::hugeint from sources where w * above <= stop * below) as b
    from rounds)
  where b > 0 and (a, b) <> (above, below))
, final as (select above, below from rounds order by k desc limit 1)
, targets as (
  select source, source_size, r
       , case when w * above > stop * below then stop::double else (w * above)::double / below::double end as target
  from sources, final)
, units as (select doc_id, source, size, count(*)::bigint as n from sized group by all)
, queued as (
  select u.doc_id, u.source, u.size, r, target, pass, u.size * n as tokens
       , ('0x' || substr(md5('{SEED}:' || pass || ':' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as shuffle
  from units u join targets t on u.source is not distinct from t.source, range({PASSES}) as p(pass))
, timed as (
  select *, coalesce(sum(tokens) over (partition by r order by pass, shuffle, doc_id nulls first, size)::double / nullif(target, 0), 0) as finish from queued)
, merged as (
  select doc_id, source, size, sum(tokens) over (order by finish, r, pass, shuffle, doc_id nulls first, size) as ahead from timed)
, chosen as (
  select doc_id, source, size, count(*) as n from merged
  where ahead <= (select {top} * sum(size)::hugeint // {bottom} from sized) group by all)
select s.doc_id, s.size, t.source_size, t.target, (s.size * coalesce(c.n, 0))::bigint as taken
from sized s join targets t on s.source is not distinct from t.source
left join chosen c on s.doc_id is not distinct from c.doc_id and s.source is not distinct from c.source and s.size = c.size"""


def _substrings() -> str:
    return """
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents)
, starts as (select doc_id, w, unnest(range(length(w) - 19)) as pos from words where length(w) >= 20)
, windows as (select doc_id, pos, list_aggregate(w[pos + 1:pos + 20], 'string_agg', ' ') as content from starts)
, later as (
  select doc_id, pos from windows
  qualify (doc_id, pos) > (first_value(doc_id) over (partition by content order by doc_id, pos), first_value(pos) over (partition by content order by doc_id, pos)))
, gone as (select distinct doc_id, unnest(range(pos, pos + 20)) as pos from later)
, lists as (select doc_id, list(pos) as dead from gone group by doc_id)
, kept as (
  select doc_id, w, coalesce(length(dead), 0) as n_removed
       , list_filter(range(length(w)), lambda i: not list_contains(coalesce(dead, []), i)) as left_over
  from words left join lists using (doc_id))
select doc_id, length(w)::bigint as n_words, n_removed::bigint as n_removed
     , sha256(coalesce(list_aggregate(list_transform(left_over, lambda i: w[i + 1]), 'string_agg', ' '), '')) as kept_sha256
from kept"""


def _canonical_lines(text: str) -> str:
    out = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for other, kept in SPELLINGS:
        out = f"replace({out}, {_quoted(other)}, {_quoted(kept)})"
    spaced = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n\\x{{00a9}}]+', ' ', 'g')"
    lines = f"list_transform(string_split({spaced}, chr(10)), lambda x: trim(x, ' '))"
    return f"list_filter({lines}, lambda x: x <> '' and not regexp_matches(x, {_quoted(COPYRIGHT)}))"


def _licenses() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    return f"""
with names as (
  select sha256(array_to_string({_canonical_lines("text")}, ' ')) as digest, min(license) as license
  from (values {known}) as k(license, text) group by 1)
, texts as (select row_number() over () as row, doc_id, {_canonical_lines("text")} as lines from documents)
, alone as (select row, license from (select row, sha256(unnest(lines)) as digest from texts) join names using (digest))
, notices as (select row, string_agg(distinct license, ',' order by license) as notices, count(*) as n from alone group by row)
, whole as (select row, doc_id, sha256(array_to_string(lines, ' ')) as digest from texts)
select doc_id, digest as canonical_sha256, license, coalesce(notices, '') as notices, coalesce(n, 0)::bigint as n_notices
from whole left join names using (digest) left join notices using (row)"""


def _minhash() -> str:
    least, of = LIKENESS
    return f"""
with recursive texts as (
  select row_number() over () as row, doc_id
       , regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents)
, sets as (
  select row, doc_id
       , case when length(w) < 2 then w else list_distinct(list_transform(range(1, length(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
  from texts)
, single as (select row, length(s) as n, unnest(s) as shingle from sets)
, links as (
  select a.row as a, b.row as b from single a join single b using (shingle) group by a.row, b.row, a.n, b.n
  having {of} * count(*) >= {least} * (a.n + b.n - count(*)))
, reached as (select a, b from links union select reached.a, links.b from reached join links on reached.b = links.a)
, least as (select a as row, min(doc_id) as component_id from reached join sets on row = b group by a)
select doc_id, length(s)::bigint as n_shingles, case when length(s) > 0 then component_id else doc_id end as component_id
     , doc_id is not distinct from case when length(s) > 0 then component_id else doc_id end as kept
from sets left join least using (row)"""


def _filter_audit() -> str:
    letters = ", ".join(f"({i}, '{letter}')" for i, letter in enumerate(FILTERS))
    names = [f"o{i}" for i in range(len(FILTERS))]
    apart = " and ".join(f"{a}.i <> {b}.i" for k, a in enumerate(names) for b in names[:k])
    return f"""
with letters as (select * from (values {letters}) as l(i, letter))
, orders as (
  select {" || ".join(f"{o}.letter" for o in names)} as filter_order, [{", ".join(f"{o}.i" for o in names)}] as bits
  from {", ".join(f"letters {o}" for o in names)} where {apart})
, steps as (
  select filter_order, step, bits[step] as bit, list_sum(list_transform(bits[1:step], lambda b: 1 << b))::bigint as after
  from orders, range(1, {len(FILTERS) + 1}) as s(step))
, texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents)
, counted as (
  select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w, min(doc_id) over (partition by t) as least from texts)
, masked as (
  select doc_id, part
       , (length(w) < {FEWEST_WORDS})::int + 2 * (100 * length(list_distinct(w)) < {LEAST_DISTINCT} * length(w))::int
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t))::int
         + 8 * regexp_matches(t, '{SYMBOLS}')::int + 16 * coalesce(doc_id > least, false)::int as mask
  from counted)
, marks as (
  select doc_id, max((quality is not distinct from 1)::int) as good, max((toxic is not distinct from 1)::int) as toxic from labels group by doc_id)
, cells as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from masked left join marks using (doc_id) group by part, mask)
, walked as (
  select part, filter_order, step, bit
       , sum(case when mask & after = 0 then n else 0 end)::bigint as kept
       , sum(case when mask & after = 1 << bit then n else 0 end)::bigint as removed
       , sum(case when mask & (1 << bit) <> 0 and mask & after <> 1 << bit then n else 0 end)::bigint as redundant
       , sum(case when mask = 1 << bit then n else 0 end)::bigint as unique_fails
       , sum(case when mask & after = 1 << bit then good else 0 end)::bigint as good_lost
       , sum(case when mask & after = 1 << bit then toxic else 0 end)::bigint as toxic_lost
  from cells, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
     , sum(removed) over (partition by part, bit)::bigint as shapley
from walked"""


def _merkle() -> str:
    def leaf(count: str) -> str:
        said = [f"case when {c} is null then '-' else strlen({c}::varchar)::varchar || ':' || {c}::varchar end" for c in (count if f == "n_chars" else f for f in FIELDS)]
        return f"sha256({' || '.join(said)})"

    def tree(name: str, nodes: str) -> str:
        return f"""
{name} as (
  select lang, 0 as level, i, n, h from {nodes}
  union all
  select lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i)) from {name} where n > 1 group by lang, level, i // 2, n)"""

    # The polynomial of CRC-32, bit by bit.
    byte = "list_reduce(range(8), lambda c, b: xor(c >> 1, (c & 1) * 3988292384), xor(crc, code))"
    crc = f"xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda s: unicode(s)::bigint), lambda crc, code: {byte}, 4294967295::bigint), 4294967295::bigint)"
    return f"""
with recursive digests as (
  select doc_id, lang, {leaf("n_chars")} as leaf, case when {crc} % 7 = 0 then {leaf("(n_chars + 1)")} end as forged from documents)
, leaves as (
  select doc_id, lang, leaf, forged, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n
       , row_number() over () as row from digests)
, low as (select lang, i, n, leaf as h from leaves)
, {tree("lower_tree", "low")}
, subroots as (
  select lang as sub, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n, h from lower_tree where n = 1)
, high as (select null as lang, i, n, h from subroots)
, {tree("upper_tree", "high")}
, steps as (
  select row, l.level as level, l.i >> l.level as spot, s.h as sibling
  from (select row, lang, i, n, unnest(range((select max(level) + 1 from lower_tree))) as level from leaves) l
  left join lower_tree s on s.lang is not distinct from l.lang and s.level = l.level and s.i = xor(l.i >> l.level, 1)
  where (1::bigint << l.level) < l.n
  union all
  select row, 1000 + l.level, l.spot >> l.level, s.h
  from (select row, u.i as spot, u.n as m, unnest(range((select max(level) + 1 from upper_tree))) as level
        from leaves join subroots u on u.sub is not distinct from leaves.lang) l
  left join upper_tree s on s.level = l.level and s.i = xor(l.spot >> l.level, 1)
  where (1::bigint << l.level) < m)
, proofs as (
  select row, string_agg(coalesce(sibling, ''), '' order by level) as proof
       , list(case when spot & 1 = 1 then '<' else '>' end || coalesce(sibling, '') order by level) as path
  from steps group by row)
, top as (select h as root from upper_tree where n = 1)
, folded as (
  select doc_id, leaf, u.h as subroot, root, sha256(coalesce(proof, '')) as proof_sha256
       , list_reduce([coalesce(forged, leaf)] || coalesce(path, []), lambda h, s: sha256(case when s[1] = '<' then s[2:] || h else h || s[2:] end)) as folded_root
  from leaves join subroots u on u.sub is not distinct from leaves.lang left join proofs using (row), top)
select *, folded_root = root as verified from folded"""


ORACLE = {
    "op1_secrets": _secrets(),
    "op3_chat": _chat(),
    "op6_substrings": _substrings(),
    "op8_mix": _mix(),
    "op10_licenses": _licenses(),
    "op11_minhash": _minhash(),
    "op12_filter_audit": _filter_audit(),
    "op13_merkle": _merkle(),
}
