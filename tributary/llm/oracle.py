"""SQL for the queries that SQL can express."""

from tributary.llm import quality

_NEAR_DUPLICATES = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.n >= 75 * (x.n + y.n - c.n)),
edges as (select a, b from links union select b, a from links),
reached as (
  select doc_id as a, doc_id as b from documents
  union select r.a, e.b from reached r join edges e on r.b = e.a),
component as (select a as doc_id, min(b) as component_id from reached group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes using (doc_id) join component using (doc_id)
"""


def _quality():
    per_thousand = "case when {of} > 0 then {x} * 1000 // {of} else 0 end"
    measures = {
        "symbols": per_thousand.format(x="n_symbols", of="n_words"),
        "stutter": per_thousand.format(x="n_stutter", of="n_words"),
        "same_lines": per_thousand.format(x="n_dup_lines", of="n_lines"),
        "word_length": per_thousand.format(x="word_chars", of="n_words") + " // 10",
    }
    bins = " union all ".join(
        f"select lang, source, '{m}' as measure, {m} // {quality.BIN} as bin from measured"
        " where not base_failed"
        for m in measures
    )
    levels, wide = [], []
    for name, keys in (("own", "lang, source"), ("by_lang", "lang"), ("everything", "1")):
        cut = keys if keys != "1" else ""
        by = f"{cut}{', ' if cut else ''}measure"
        select = f"{cut}, " if cut else ""
        levels.append(f"""
{name}_bins as (select {select}measure, bin, count(*) as n from bins group by {by}, bin),
{name}_upto as (select *, sum(n) over (partition by {by} order by bin) as upto,
  sum(n) over (partition by {by}) as total from {name}_bins),
{name}_fences as (select {select}measure, max(total) as n,
  min(bin) filter (upto * 4 >= total) * {quality.BIN} as q1,
  min(bin) filter (upto * 4 >= total * 3) * {quality.BIN} as q3 from {name}_upto group by {by})""")
        on = " and ".join(f"f.{k} = m.{k}" for k in cut.split(", ") if k) or "true"
        wide.append(f"""
{name}_rows as (select m.doc_id, max(f.n) as n, bool_and({{verdict}}) as fine
  from measured m left join {name}_fences f on {on} group by m.doc_id)""")
    verdicts = []
    for m, (below, above) in quality.SLACK.items():
        high = f"m.{m} <= f.q3 + 3 * (f.q3 - f.q1) + {above}"
        low = "" if below is None else f" and m.{m} >= f.q1 - 3 * (f.q3 - f.q1) - {below}"
        verdicts.append(f"when '{m}' then {high}{low}")
    verdict = f"case f.measure {' '.join(verdicts)} else true end"
    wide = [x.format(verdict=verdict) for x in wide]
    listed = ", ".join(f"{v} as {k}" for k, v in measures.items())
    return rf"""
with texts as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 6)) as i,
    unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as x
  from texts),
again as (select doc_id, i, count(*) over (partition by doc_id, x) as n from windows),
covered as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as p from again where n > 1) group by doc_id),
counted as (
  select doc_id, lang, source, len(w) as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as n_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_stutter
  from texts left join covered using (doc_id)),
measured as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, {listed}
  from counted),
bins as ({bins}),{','.join(levels)},{','.join(wide)}
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and case when o.n >= {quality.ENOUGH} then o.fine
    when b.n >= {quality.ENOUGH} then b.fine when e.n >= {quality.ENOUGH} then e.fine
    else true end as kept
from measured m join own_rows o using (doc_id) join by_lang_rows b using (doc_id)
  join everything_rows e using (doc_id)
"""


_REPAIR = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
hit as (
  select *, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 20 as d
  from keyed),
rows_ as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
    case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case d when 3 then 2 else 1 end)) as copy
  from hit where d <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role,
      md5(concat_ws(':', coalesce(conv_id::varchar, ' '), length(role)::varchar, role, text)), copy) as i,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as bare,
    substr(role, 1, 1) as initial
  from rows_),
numbered as (
  select *, row_number() over (partition by conv_id, role, text order by i) as seen from placed),
judged as (
  select *, bare = '' as blank, bare <> '' and seen > 1 as duplicate,
    bare <> '' and seen = 1 and right(bare, 1) not in ('.', '!', '?') as truncated,
    lag(initial) over (partition by conv_id order by i) || initial as pair
  from numbered),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) as n, count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
states(state, need) as (values ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
inserts(state, letters, extra, after) as (
  select state, '', 0, state from states union all select state, 'I', 5, need from states
  union all values ('', 'II', 10, 'a'), ('s', 'II', 10, 'a')),
edits(edit) as (values ('D'), ('K'), ('R')),
best as (
  select conv_id, 0::bigint as i, '' as state, 0::bigint as cost, '' as audit from counted
  union all
  select conv_id, i, state, cost, audit from (
    select b.conv_id, r.i,
      case edit when 'D' then n.after when 'R' then s.need else r.initial end as state,
      b.cost + n.extra + case edit when 'D' then 2 when 'R' then 1 else 0 end
        + case when edit <> 'D' and truncated then 5 else 0 end as cost,
      b.audit || n.letters || edit as audit
    from best b join inserts n on n.state = b.state join states s on s.state = n.after
    join judged r on r.conv_id is not distinct from b.conv_id and r.i = b.i + 1 cross join edits
    where edit = 'D' or (not r.blank and not r.duplicate and (edit = 'R'
      or r.initial = s.need or (r.initial = 's' and s.state = '')))
  ) qualify row_number() over (partition by conv_id, i, state order by cost, audit) = 1),
ended as (
  select c.conv_id, arg_min(b.audit || n.letters, (b.cost + n.extra, b.audit || n.letters)) as audit,
    min(b.cost + n.extra) as cost
  from counted c join best b on b.conv_id is not distinct from c.conv_id and b.i = c.n
  join inserts n on n.state = b.state where n.after in ('', 'a') group by c.conv_id),
letters as (
  select conv_id, audit, unnest(range(1, length(audit) + 1)) as pos from ended),
used as (
  select conv_id, pos, substr(audit, pos, 1) as letter,
    length(replace(substr(audit, 1, pos), 'I', '')) as i,
    length(replace(substr(audit, 1, pos), 'D', '')) as k,
    ltrim(audit, 'D') as live from letters),
written_ as (
  select u.*, case when letter <> 'I' then r.text else '' end as text, r.role,
    first_value(coalesce(r.initial, '')) over w = 's' and substr(live, 1, 1) = 'K' as system
  from used u left join judged r on r.conv_id is not distinct from u.conv_id and r.i = u.i
  where letter <> 'D' window w as (partition by u.conv_id order by pos)),
shas as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role
    when (k - system::int) % 2 = 1 then 'user' else 'assistant' end || ':' || text,
    chr(10) order by pos)) as sha
  from written_ group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join ended e on e.conv_id is not distinct from o.conv_id
left join shas s on s.conv_id is not distinct from o.conv_id
"""

_PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from lists group by lang),
runs as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2),
    lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
  from lists, range(1, 6) t(m) where len(w) >= m),
often as (
  select lang, phrase, m, count(*) as f from runs group by all having count(*) >= 100),
cuts as (
  select lang, phrase, m, f as a, unnest(range(1, m)) as k, string_split(phrase, ' ') as w
  from often where m > 1),
scores as (
  select c.lang, c.phrase, c.m, c.a, c.k, x.f as l, y.f as r, t.n,
    (1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as score
  from cuts c join totals t on t.lang = c.lang
  join often x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:k], ' ')
  join often y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
least as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
held as (
  select c.lang, c.phrase from often c join often d on d.lang = c.lang and d.m > c.m and c.m > 1
    and d.f >= c.f and contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')),
placed as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from least anti join held using (lang, phrase))
select lang, rank, phrase, a, l, r, n, score::bigint as score from placed where rank <= 2000
"""


def statements():
    """SQL by name of the query."""
    return {
        "op2_near_duplicates": _NEAR_DUPLICATES,
        "op4_quality_rules": _quality(),
        "op11_conversation_repair": _REPAIR,
        "op12_phrases": _PHRASES,
    }
