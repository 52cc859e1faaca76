"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

HOST_RULES = rf"""
with docs as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents),
words as (
  select rid, unnest(w) as w, unnest(range(len(w))) as i from (select rid, {WORDS} as w from docs)
),
windows as (
  select rid, i, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o || ' ' || lead(w, 4) over o as g
  from words window o as (partition by rid order by i)
),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from windows where g is not null) where n > 1),
covered as (
  select rid, sum(least(5, coalesce(i - before, 5))) as n_repeat_words
  from (select rid, i, lag(i) over (partition by rid order by i) as before from twice) group by rid
),
lines as (
  select rid, count(*) - count(distinct line) as n_dup_lines
  from (select rid, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
),
measured as (
  select doc_id, source, len({WORDS})::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from docs left join covered using (rid) left join lines using (rid)
),
failed as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured),
hosts as (select source, count(*) as n, count(*) filter (base_failed) as f from failed group by source),
prior as (
  select m, greatest(1.0, least(1e6, case when v > 0 then m * (1 - m) / v - 1 else 1e6 end)) as w
  from (select avg(f / n) as m, var_pop(f / n) as v from hosts)
),
verdicts as (select source, (f + m * w) / (n + w) <= 0.5 as host_ok from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and host_ok as kept
from failed join verdicts on failed.source is not distinct from verdicts.source
"""

MIX_SOURCES = rf"""
with sized as (
  select doc_id, source, md5(coalesce(text, '')) as digest, len({WORDS})::bigint as size from documents
),
sources as (select source, sum(size)::bigint as s from sized group by source),
weighted as (
  select source, s, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as w from sources
),
levels as (
  select source, s, w, 3.0::double * s / w as ratio, sum(s) over () as total,
    sum(s) over o as s_before, sum(w) over () - coalesce(sum(w) over o, 0) as w_left
  from weighted window o as (order by 3.0::double * s / w, source nulls last rows between unbounded preceding and 1 preceding)
),
tried as (select *, (total::double - 3.0::double * coalesce(s_before, 0)::double) / w_left as level from levels),
final as (select coalesce(min_by(level, ratio) filter (ratio > level), max(ratio)) as level from tried),
planned as (
  select source, s, case when 3.0::double * s <= level * w then 3.0::double * s else level * w end as target from weighted, final
),
rated as (
  select doc_id, digest, size, s as source_size, target, case when s > 0 then target / s else 0.0 end as rate
  from sized join planned on sized.source is not distinct from planned.source
),
copied as (
  select *, (floor(rate) + (case when
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null') || ':' || digest), 1, 13))::bigint / (2 ** 52) < rate - floor(rate) then 1 else 0 end))::bigint as copies
  from rated
)
select doc_id, size, source_size, target, copies * size as taken, copies from copied
"""

EXACT_DEDUP = r"""
with prints as (
  select row_number() over () as rid, doc_id,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents
)
select doc_id, first_value(doc_id) over o as keep_id, count(*) over (partition by text_sha256)::bigint as group_size,
  row_number() over o = 1 as kept, text_sha256
from prints window o as (partition by text_sha256 order by doc_id nulls last, rid)
"""

COLLOCATIONS = r"""
with plain as (
  select row_number() over () as rid, coalesce(lang, 'und') as lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') as pieces
  from documents
),
pieces as (select rid, lang, unnest(pieces) as piece, unnest(range(len(pieces))) as p from plain),
words as (
  select rid, lang, p, unnest(w) as w, unnest(range(len(w))) as i
  from (select *, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces)
),
ahead as (
  select lang, w as w1, lead(w, 1) over o as w2, lead(w, 2) over o as w3, lead(w, 3) over o as w4
  from words window o as (partition by rid, p order by i)
),
counted as (
  select lang, 1 as k, w1 as phrase, count(*) as f from ahead group by all
  union all select lang, 2, w1 || ' ' || w2 as phrase, count(*) from ahead where w2 is not null group by all
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 as phrase, count(*) from ahead where w3 is not null group by all
  union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 as phrase, count(*) from ahead where w4 is not null group by all
),
totals as (select lang, sum(f)::bigint as n from counted where k = 1 group by lang),
often as (select *, string_split(phrase, ' ') as ws from counted where f >= 30),
candidates as (select * from often where k >= 2),
cuts as (
  select c.lang, c.phrase, c.f as a, c.cut, x.f as l, y.f as r, ((2000000::hugeint * c.f) // (x.f + y.f))::bigint as score
  from (select *, unnest(range(1, k)) as cut from candidates) c
  join often x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  join often y on y.lang = c.lang and y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
sized as (select lang, ws, k, f, unnest(range(2, k)) as size from candidates where k > 2),
inside as (select lang, ws, f, size, unnest(range(1, k - size + 2)) as first from sized),
covering as (
  select lang, array_to_string(ws[first:first + size - 1], ' ') as phrase, max(f) as f from inside group by all
),
ranked as (
  select l.lang, row_number() over (partition by l.lang order by score desc, a desc, l.phrase) as rank, l.phrase, a, l, r, n, score
  from lowest l join totals using (lang) left join covering c on c.lang = l.lang and c.phrase = l.phrase
  where c.f is null or 100 * c.f < 80 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

SQL: dict[str, str] = {"op6_host_rules": HOST_RULES, "op9_mix_sources": MIX_SOURCES, "op11_exact_dedup": EXACT_DEDUP, "op13_phrase_collocations": COLLOCATIONS}
