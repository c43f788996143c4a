"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from .chat import GUARD

SQL: dict[str, str] = {}

SQL["op3_host_rules"] = r"""
with words as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), grams as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)
), often as (
  select doc_id, g from grams group by all having count(*) > 1
), covered as (
  select doc_id, count(distinct p) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as p from grams semi join often using (doc_id, g)) group by doc_id
), lines as (
  select doc_id, sum(n - 1) as n from (
    select doc_id, line, count(*) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from words)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by all) group by doc_id
), base as (
  select doc_id, source, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(lines.n, 0)::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words
  from words left join covered using (doc_id) left join lines using (doc_id)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
), failures as (
  select source, count(*) as n, [count(*) filter (n_words < 50), count(*) filter (100 * n_repeat_words > 50 * n_words),
    count(*) filter (10 * n_symbols > word_chars), count(*) filter (20 * n_dup_lines > n_words)] as f from judged group by source
), rates as (
  select source, n, r, f[r] as f from failures, range(1, 5) as x(r)
), prior as (
  select r, m, case when v > 1e-12 then least(1e6, greatest(1.0, m * (1 - m) / v - 1)) else 1e6 end as k
  from (select r, avg(f / n) as m, var_pop(f / n) as v from rates group by r)
), posterior as (
  select source, m, (f + m * k) / (n + k) as p, n + k as t from rates join prior using (r)
), rejected as (
  select source, bool_or(p - 1.645 * sqrt(p * (1 - p) / (t + 1)) > least(0.5, greatest(0.25, 2 * m))) as gone from posterior group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not gone as kept
from judged join rejected on judged.source is not distinct from rejected.source
"""

_GUARD = GUARD.replace("'", "''")
SQL["op7_chat"] = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(18 + length(role) + length(text) + len(regexp_extract_all(text, '{_GUARD}')))::bigint as formatted_chars
from rows group by conv_id
"""
