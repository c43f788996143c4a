"""DuckDB statements for the registered queries, written apart from the operators."""

from __future__ import annotations

import json
from pathlib import Path

#: The words that the statements need, in a file of their own: an error in the functions' tables doesn't reach them.
WORDS = json.loads((Path(__file__).parent / "words.json").read_text("utf-8"))
DOMAINS, INTENTS = WORDS["domains"], WORDS["intents"]
HEALTH_TERMS, LINK_WORDS, SINGLISH, TAMILISH = (WORDS[k] for k in ("health_terms", "link_words", "singlish", "tamilish"))

SQL: dict[str, str] = {}
W = r"[\p{L}\p{N}_]"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words)) + "]"


_SCRIPTS = r"""
 base as (select *, coalesce(text, '') as t from documents),
 counted as (select *, regexp_replace(t, '[\s.,!?;:()\[\]{}"''\x1c-\x1f-]', '', 'g') as s from base),
 n as (select *, length(s) as total, length(regexp_replace(s, '[^\x{0D80}-\x{0DFF}]', '', 'g')) as si, length(regexp_replace(s, '[^\x{0B80}-\x{0BFF}]', '', 'g')) as ta,
   length(regexp_replace(s, '[^A-z\x{00C0}-\x{024F}]', '', 'g')) as la from counted),
 shares as (select *, si / total as sinhala, ta / total as tamil, la / total as latin, (total - si - ta - la) / total as other from n),
 scripts as (select *, greatest(sinhala, tamil, latin, other) as top,
   (sinhala >= 0.2)::int + (tamil >= 0.2)::int + (latin >= 0.2)::int + (other >= 0.2)::int as many from shares),
 named as (select *, case when total = 0 or length(trim(t)) < 3 then 'unknown'
   when top >= 0.7 and sinhala = top then 'sinhala_script' when top >= 0.7 and tamil = top then 'tamil_script' when top >= 0.7 and latin = top then 'latin'
   when many >= 2 then 'mixed' else 'unknown' end as script_type, greatest(sinhala, tamil, latin) as best from scripts),
 detected as (select *, case script_type when 'sinhala_script' then 'sinhala' when 'tamil_script' then 'tamil' when 'latin' then 'english'
   when 'mixed' then case when sinhala = best then 'sinhala' when tamil = best then 'tamil' else 'mixed' end else 'unknown' end as language,
   case script_type when 'sinhala_script' then sinhala when 'tamil_script' then tamil when 'latin' then latin when 'mixed' then best else 0.0 end as confidence from named)
"""
SQL["language_distribution"] = f"with {_SCRIPTS} select language, script_type, count(*) as n from detected group by all"
SQL["script_shares"] = f"with {_SCRIPTS} select doc_id, " + ", ".join(f"case when total > 0 then round({c}, 6) end as {c}" for c in ("sinhala", "tamil", "latin", "other")) + " from shares"
SQL["detect_language"] = f"""with {_SCRIPTS} select doc_id, language, round(confidence, 6) as confidence, script_type, script_type = 'mixed' as is_mixed_script,
 case when script_type = 'mixed' then case when sinhala = best then 'sinhala' when tamil = best then 'tamil' else 'latin' end end as dominant_script from detected"""
SQL["script_flags"] = rf"""with {_SCRIPTS} select doc_id, si > 0 as has_sinhala, ta > 0 as has_tamil, coalesce(si > 0.1 * total or ta > 0.1 * total, false) as is_native,
 length(regexp_replace(regexp_replace(t, '[^\sA-z\x{{00C0}}-\x{{024F}}]', '', 'g'), '^\s+|\s+$', '', 'g')) as latin_chars from n"""

_TOKENS = rf"""
 tok as (select doc_id, coalesce(text, '') as text, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{W}+'), lambda x: regexp_full_match(x, '[a-z]+')) as w from documents),
 con as (select *, list_filter(w, lambda x: not list_contains({_list(HEALTH_TERMS)}, x)) as c from tok),
 hit as (select *, list_filter(c, lambda x: list_contains({_list(SINGLISH)}, x)) as hs, list_filter(c, lambda x: list_contains({_list(TAMILISH)}, x)) as ht from con),
 score as (select *, case when len(c) > 0 then len(hs) / len(c) else 0 end as s, case when len(c) > 0 then len(ht) / len(c) else 0 end as t from hit),
 tagged as (select doc_id, text, i, w[i] as word, case when list_contains({_list(SINGLISH)}, w[i]) then 'singlish' when list_contains({_list(TAMILISH)}, w[i]) then 'tamilish'
   when list_contains({_list(HEALTH_TERMS)}, w[i]) then 'english' end as lang from (select *, unnest(range(1, len(w) + 1)) as i from tok where len(w) >= 2)),
 moved as (select *, lag(lang) over (partition by doc_id order by i) as before from tagged where lang is not null),
 switches as (select *, row_number() over (partition by doc_id order by i) - 1 as number from moved where before is not null and before <> lang)
"""
SQL["romanized_class"] = f"""with {_TOKENS}, kinds as (select *, case when len(w) = 0 then 'unknown' when s >= 0.3 and t >= 0.3 then 'mixed' when s >= 0.3 then 'singlish'
 when t >= 0.3 then 'tamilish' else 'pure_english' end as k from score), mixed as (select distinct doc_id from switches)
 select doc_id, k as classification, round(case k when 'unknown' then 0 when 'mixed' then greatest(s, t) when 'singlish' then least(1, s + 0.3) when 'tamilish' then least(1, t + 0.3)
 else 1 - greatest(s, t) end, 6) as confidence, round(s, 6) as singlish_score, round(t, 6) as tamilish_score, case when k = 'unknown' then 0.0 else round(1 - greatest(s, t), 6) end as english_score,
 (len(hs) + len(ht))::int as n_matched, case k when 'singlish' then 'sinhala' when 'tamilish' then 'tamil' when 'mixed' then case when s > t then 'sinhala' else 'tamil' end end as target,
 mixed.doc_id is not null as is_code_mixed from kinds left join mixed using (doc_id)"""
SQL["code_switches"] = f"""with {_TOKENS} select doc_id, number::int as number, (instr(lower(text), word) - 1)::int as start_pos, (instr(lower(text), word) - 1 + length(word))::int as end_pos,
 before as from_lang, lang as to_lang, word as text_segment from switches"""
SQL["marker_counts"] = f"with {_TOKENS} select marker, count(*) as n from (select unnest(list_concat(hs, ht)) as marker from hit) group by all"

SQL["clean_text"] = r"""
with a as (select doc_id, regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '[^\P{C}\n]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g') as t from documents),
b as (select doc_id, list_reduce(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+$', '', 'g')), lambda x, y: x || chr(10) || y) as t from a)
select doc_id, sha256(regexp_replace(t, '^\s+|\s+$', '', 'g')) as cleaned_sha256 from b"""
SQL["normalized_spelling"] = rf"""
with w as (select doc_id, lower(text) as t, regexp_extract_all(lower(text), '{W}+') as w from documents)
select doc_id, (length(t) - len(list_filter(w, lambda x: x in ('kohenda', 'vacine'))) * 0 - len(list_filter(w, lambda x: x = 'kohenda')) + len(list_filter(w, lambda x: x = 'vacine')))::int as n from w"""
SQL["sentence_counts"] = r"""
select doc_id, len(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[^.!?]*[.!?]|[^.!?]+$'), lambda x: regexp_replace(x, '\s', '', 'g')), lambda x: x <> ''))::int as n_sentences from documents"""
SQL["health_numbers"] = r"""
select doc_id, coalesce(array_to_string(regexp_extract_all(coalesce(text, ''), '\d\d\d?(?:[.]\d)?°?[CF°]?'), '|'), '') as temperatures,
 len(regexp_extract_all(coalesce(text, ''), '\d\d?(?::\d\d)?\s*(?:pm|PM|am|AM)?'))::int as n_times from documents"""


def _edge(body: str) -> str:
    return f"(?i)(^|[^\\p{{L}}\\p{{N}}_])(?:{body})($|[^\\p{{L}}\\p{{N}}_])".replace("'", "''")


def _intents(source: str, keys: str) -> str:
    counts = ",\n ".join("(" + " + ".join(f"regexp_matches(t, '{_edge(b)}')::int" for b in bodies) + f") as c{i}" for i, bodies in enumerate(INTENTS.values()))
    best = "greatest(" + ", ".join(f"least(c{i}, 2)" for i in range(len(INTENTS))) + ")"
    which = lambda what: "case " + " ".join(f"when least(c{i}, 2) = best then {what(i, n)}" for i, n in enumerate(INTENTS)) + " end"
    return f"""with a as (select {keys}, coalesce(text, '') as t from {source}), b as (select *, {counts} from a), c as (select *, {best} as best from b)
 select {keys}, case when best > 0 then {which(lambda i, n: f"'{n}'")} when contains(t, '?') then 'general_info' else 'unknown' end as intent,
 case when best = 1 then 0.7 when best = 2 then 1.0 when contains(t, '?') then 0.3 else 0.0 end::double as confidence,
 case when best > 0 then {which(lambda i, n: f"c{i}")} when contains(t, '?') then 1 else 0 end::int as n_patterns from c"""


SQL["intent_primary"] = _intents("conversations", "conv_id, turn")


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_OWN = "(values " + ", ".join(f"({-1 - i}, {_q(t)})" for i, t in enumerate(WORDS["sentences"])) + ") own(id, t)"
#: Documents and the sentences of the domain: id, text.
_BOTH = f"(select doc_id as id, coalesce(text, '') as t from documents union all select id, t from {_OWN})"


def _domain_counts(source: str, keys: str) -> str:
    def test(k: str) -> str:
        escaped = "".join(c if c.isalnum() or ord(c) > 127 or c == " " else "\\" + c for c in k)
        if k.isascii():
            return f"regexp_matches(t, '{_edge(escaped)}')::int"
        after = "[\\p{L}\\p{N}_]" if not (k[-1].isalnum()) else "($|[^\\p{L}\\p{N}_])"
        return f"regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_]){escaped}{after}')::int"

    counts = ",\n ".join("(" + " + ".join(test(k) for k in kws) + f") as c{i}" for i, kws in enumerate(DOMAINS.values()))
    return f"select {keys}, t, {counts} from {source}"


def _domains() -> str:
    def test(k: str) -> str:
        escaped = "".join(c if c.isalnum() or ord(c) > 127 or c == " " else "\\" + c for c in k)
        if k.isascii():
            return f"regexp_matches(t, '{_edge(escaped)}')::int"
        # a boundary after a combining mark asks for a word character next, before one for none
        after = "[\\p{L}\\p{N}_]" if not (k[-1].isalnum()) else "($|[^\\p{L}\\p{N}_])"
        return f"regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_]){escaped}{after}')::int"

    counts = ",\n ".join("(" + " + ".join(test(k) for k in kws) + f") as c{i}" for i, kws in enumerate(DOMAINS.values()))
    best = "greatest(" + ", ".join(f"least(c{i}, 3)" for i in range(len(DOMAINS))) + ")"
    which = "case " + " ".join(f"when least(c{i}, 3) = best then '{n}'" for i, n in enumerate(DOMAINS)) + " end"
    total = " + ".join(f"c{i}" for i in range(len(DOMAINS)))
    return f"""with a as (select doc_id, coalesce(text, '') as t from documents), b as (select *, {counts} from a), c as (select *, {best} as best from b)
 select doc_id, case when best > 0 then {which} else 'general' end as primary_domain,
 case best when 1 then 0.65 when 2 then 0.9 when 3 then 1.0 else case when t = '' then 0.0 else 0.3 end end::double as confidence, ({total})::int as n_keywords from c"""


SQL["domain_primary"] = _domains()

_QA = """
 q as (select concat_ws('-', conv_id, turn) as id, conv_id, turn, text as question_text, answer_text,
   case conv_id % 3 when 0 then 'sinhala' when 1 then 'tamil' else 'english' end as question_language, case when conv_id % 2 = 0 then 'dengue' else 'opd' end as domain, conv_id % 5 = 0 as verified,
   1700000000 + conv_id * 60 + turn as created from (select *, lead(text) over w as answer_text, lead(role) over w as next_role from conversations window w as (partition by conv_id order by turn))
   where role = 'user' and next_role = 'assistant')
"""
SQL["qa_filtered"] = f"with {_QA} select id, question_language, domain, verified from q where question_language = 'tamil' and domain = 'opd' order by created desc, id limit 20"
SQL["qa_review_page"] = f"with {_QA} select id, domain from (select * from q order by created desc, id limit 50) where not verified"
SQL["qa_verified"] = f"""with {_QA} select verified or domain = 'opd' as verified, case when domain = 'opd' then 'b' else 'a' end as reviewer_id, case when domain = 'opd' then null else 'x' end as review_notes,
 count(*) as n from q group by all"""
SQL["multilingual_qa"] = f"""with {_QA}, x as (select *, unnest([question_language, 'sinhala', 'tamil', 'english']) as language, unnest([false, true, true, true]) as translated from q)
 select language, translated, count(*) as n, sum(length(question_text) + case when translated then length(language) + 3 else 0 end)::bigint as chars, round(sum(case when translated then 0.8 * 0.9 else 0.8 end), 3)::double as weight
 from x where not (translated and language = question_language) group by all"""
SQL["stand_in_translation"] = """select doc_id, language, case language when 'sinhala' then 'sin_Sinh' when 'tamil' then 'tam_Taml' else 'eng_Latn' end as code,
 sha256('[' || language || '] ' || text) as translated_sha256 from documents, unnest(['sinhala', 'tamil', 'english']) as l(language)"""

_HASH = r"""
 norm as (select *, regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[\s\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]+', ' ', 'g'), '[^\p{L}\p{N}_\s]', '', 'g'), '^\s+|\s+$', '', 'g') as t from documents),
 hashed as (select *, sha256(t) as content_hash from norm)
"""
SQL["content_hashes"] = f"with {_HASH} select doc_id, content_hash from hashed"
SQL["duplicate_groups"] = f"with {_HASH} select content_hash, min(doc_id) as first_id, count(*) as n_rows from hashed group by all having count(*) > 1"
SQL["duplicate_lookup"] = f"""with {_HASH}, known as (select content_hash, min(doc_id) as original_id from hashed where source = 'src0' group by all)
 select doc_id as new_id, original_id, 1.0::double as similarity, true as is_exact from hashed join known using (content_hash) where source <> 'src0'"""
_SETS = f"""{_HASH}, sets as (select doc_id, list_sort(list_distinct(list_filter(string_split(t, ' '), lambda x: x <> ''))) as s from hashed),
 big as (select * from sets where len(s) >= 5), cls as (select s, min(doc_id) as class_id from big group by s)"""
SQL["token_set_classes"] = f"with {_SETS} select doc_id, class_id, len(s)::int as n_tokens from big join cls using (s)"
SQL["near_duplicates"] = f"""with {_SETS}, tk as (select class_id, len(s) as n, unnest(s) as token from cls), common as (
 select a.class_id as id_a, b.class_id as id_b, a.n as na, b.n as nb, count(*) as c from tk a join tk b on a.token = b.token and a.class_id < b.class_id
 where least(a.n, b.n) >= 0.89 * greatest(a.n, b.n) group by all)
 select id_a, id_b, round(c / (na + nb - c), 6) as similarity from common where c / (na + nb - c) >= 0.9"""
_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+'), lambda x: x <> ''))"
SQL["content_versions"] = f"""with {_HASH}, l as (select *, {_WORDS} as words, lag(content_hash) over (partition by source order by doc_id) as before from hashed),
 v as (select * from l where before is null or before <> content_hash),
 x as (select *, row_number() over w as version_number, lag(content_hash) over w as previous_hash, words - lag(words) over w as delta from v window w as (partition by source order by doc_id))
 select source, doc_id, version_number::int as version_number, content_hash, previous_hash, case when version_number > 1 then 'Updated from version ' || (version_number - 1) end as changes_summary,
 case when version_number > 1 then case when delta > 0 then 'Added ~' || delta || ' words' when delta < 0 then 'Removed ~' || -delta || ' words' else 'Minor changes (same word count)' end end as diff_summary from x"""

_QUEUE = """
 q as (select event_id::varchar as id, event_id, 'https://site' || (user_id % 7) || '.example.org/p/' || event_id as url, 'site' || (user_id % 7) || '.example.org' as domain, value as priority_score, ts,
   case event_id % 5 when 0 then 'pending' when 1 then 'pending' when 2 then 'processing' when 3 then 'completed' else 'failed' end as status, (event_id % 4)::int as attempts from events)
"""
_DUE = "status = 'pending' and ts <= timestamp '2024-01-10 00:00:00'"
SQL["next_urls"] = f"with {_QUEUE} select id, priority_score, domain from q where {_DUE} order by priority_score desc nulls first, ts, id limit 10"
SQL["next_urls_of_domain"] = f"with {_QUEUE} select id, priority_score from q where {_DUE} and domain = 'site3.example.org' order by priority_score desc nulls first, ts, id limit 5"
SQL["pending_ocr"] = f"with {_QUEUE} select id, status from q where status = 'pending' order by ts, id limit 5"
SQL["queue_statistics"] = f"""with {_QUEUE} select {", ".join(f"count(*) filter (status = '{s}') as {s}" for s in ("pending", "processing", "completed", "failed"))}, count(*) as total from q"""
SQL["queue_claim"] = f"""with {_QUEUE}, c as (select *, {_DUE} and domain = 'site1.example.org' as hit from q)
 select case when hit then 'processing' else status end as status, attempts + hit::int as attempts, count(*) as n from c group by all"""
SQL["queue_transition"] = f"""with {_QUEUE}, p as (select *, event_id % 3 = 0 as ok, attempts + 1 as tried from q where status = 'processing')
 select id, case when ok then 'completed' when tried < 3 then 'pending' else 'failed' end as status, case when ok then attempts else tried end as attempts, case when not ok then 'timeout' end as last_error,
 case when ok then 'ctx' || id end as context_id, case when not ok and tried < 3 then (60 * 2 ** tried)::bigint end as wait_s from p"""
SQL["unexpired_rows"] = f"with {_QUEUE} select status, count(*) as n from q where not (status = 'completed' and ts < timestamp '2024-01-05 00:00:00') group by all"
SQL["throttled_starts"] = f"with {_QUEUE} select domain, (count(*) - 1) * 2.0::double as last_start, count(*) as n from q where status = 'pending' group by all"
SQL["new_queue_rows"] = f"""with {_QUEUE} select url, domain, round(0.5 * 0.4 + 0.9 * 0.3 + 0.5 * 0.2, 6)::double as priority_score, 'pending' as status, 0 as attempts from q where status = 'completed'
 and url not in (select url from q where status = 'pending')"""
SQL["jobs_due"] = """with e as (select event_id, ts, lag(ts) over (partition by user_id order by event_id) as last from events)
 select event_id, last is null or floor(epoch(ts)) - floor(epoch(last)) >= 43200 as crawl_due, dayofweek(ts) = 0 and (last is null or floor(epoch(ts)) - floor(epoch(last)) >= 86400) as audit_due from e"""

_HOST = r"regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
SQL["priority_scores"] = f"""with p as (select page_id, {_HOST} as host from pages),
 s as (select *, case page_id % 5 when 0 then 1.0 when 1 then 0.8 when 2 then 0.5 when 3 then 0.3 else 0.5 end::double as base,
  case when contains(host, 'epid.gov.lk') or contains(host, 'health.gov.lk') then 0.95 when contains(host, 'moh.gov.lk') then 0.9 when contains(host, 'gov.lk') then 0.85 else 0.7 end::double as rel from p)
 select page_id, host, round(least(1, base * 0.4 + rel * 0.3 + least((page_id % 45) / 30, 1) * 0.3 + (page_id % 10) / 10 * 0.2), 6)::double as score from s"""
_TITLE = r"regexp_replace(regexp_replace(regexp_extract(html, '(?is)<(?:h1|h2)(?:\s[^>]*)?>(.*?)</(?:h1|h2)\s*>', 1), '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g')"
_SUM = " + ".join(f"(contains(u, '{w}')::int * 0.15 + contains(t, '{w}')::int * 0.10)" for w in LINK_WORDS)
SQL["link_relevance"] = f"""with p as (select page_id, {_TITLE} as title, lower(url) as u from pages), q as (select *, lower(title) as t from p)
 select page_id, title, round(greatest(0, least(1, {_SUM} + contains(u, 'gov.lk')::int * 0.3 - (starts_with(u, 'http') and not contains(u, 'gov.lk'))::int * 0.2)), 6)::double as score from q"""
_LINKS = f"""p as (select page_id, {_HOST} as host, html, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1) as links from pages),
 l as (select *, list_filter(links, lambda x: not regexp_matches(x, '(?i)^https?://') or regexp_extract(x, '^[a-zA-Z]+://([^/?#]*)', 1) = host) as inside,
 list_filter(links, lambda x: regexp_matches(x, '(?i)^https?://') and regexp_extract(x, '^[a-zA-Z]+://([^/?#]*)', 1) <> host) as outside from p)"""
SQL["page_links"] = f"with {_LINKS} select page_id, least(len(inside), 20)::int as n_internal, least(len(outside), 10)::int as n_external, least(length(html), 50000)::int as n_html, host as domain, 'Unknown' as agency from l"
_FIXED = "hospital clinic doctor vaccine dengue report"
_LSUM = " + ".join(f"contains(u, '{w}')::int * 0.15" for w in LINK_WORDS)
_FIXED_SUM = sum(0.1 for w in LINK_WORDS if w in _FIXED)
SQL["relevant_links"] = f"""with {_LINKS}, u as (select lower(unnest(list_slice(inside, 1, 20))) as u from l),
 s as (select greatest(0, least(1, {_LSUM} + {_FIXED_SUM:.1f} + contains(u, 'gov.lk')::int * 0.3 - (starts_with(u, 'http') and not contains(u, 'gov.lk'))::int * 0.2)) as score from u)
 select case when score > 0.8000001 then 'high' else 'medium' end as priority, count(*) as n from s where score > 0.5000001 group by all"""
SQL["asset_types"] = """with p as (select case when page_id % 4 = 0 then 'pdf' else e end as asset_type from pages,
 unnest(['unknown', 'html', 'html', 'pdf', 'html', 'html', 'html', 'image', 'image', 'document']) as x(e)) select asset_type, count(*) as n from p group by all"""
SQL["asset_statistics"] = r"""with p as (select len(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) as n, len(regexp_extract_all(html, '(?is)<img\s[^>]*?src\s*=\s*["'']([^"'']*)["'']', 1)) as m from pages)
 select count(*) as total_documents, sum((n + 2) // 3)::bigint as pdf_assets, sum((n + 1) // 3 + m)::bigint as image_assets, count(*) filter (n > 0) as ocr_required, 0 as html_pages from p"""
SQL["allowed_pages"] = rf"""with p as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as site, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path from pages)
 select page_id, url from p where not (starts_with(path, '/en') and site in (select site from p where page_id % 2 = 0))"""

_AUDIT = """
 a as (select coalesce(case lang when 'en' then 'english' when 'de' then 'sinhala' when 'fr' then 'tamil' end, 'unknown') as language,
  case when doc_id % 9 = 0 then case when doc_id % 18 = 0 then 'singlish' else 'mixed' end end as romanized,
  case when doc_id % 50 = 0 then 'mental_health' when doc_id % 7 = 0 then 'dengue' else 'general' end as domain, coalesce(nullif(source, ''), 'unknown') as region from documents),
 d as (select 'language' as category_type, language as category_value, count(*) as n from a group by all union all select 'romanized', romanized, count(*) from a where romanized is not null group by all
  union all select 'domain', domain, count(*) from a group by all union all select 'region', region, count(*) from a group by all),
 th as (select * from (values ('language', 'sinhala', 20.0), ('language', 'tamil', 15.0), ('language', 'english', 10.0), ('domain', 'mental_health', 5.0), ('domain', 'maternal_health', 5.0), ('domain', 'child_health', 5.0)) t(category_type, category_value, min_pct)),
 al as (select category_type, category_value, coalesce(n, 0) as current_count, min_pct::double as min_pct, total, coalesce(n, 0) / total * 100 as pct from th left join d using (category_type, category_value), (select count(*) as total from a) where total > 0),
 bad as (select *, case when category_type = 'language' then case when pct < min_pct / 2 then 'critical' else 'high' end when pct > 0 then 'medium' else 'high' end as severity, floor(total * min_pct / 100)::bigint as expected_minimum from al where pct < min_pct)
"""
SQL["audit_distributions"] = f"with {_AUDIT} select category_type, category_value, n from d"
SQL["audit_percentages"] = f"""with {_AUDIT} select count(*) as total_documents, {", ".join(f"round(count(*) filter (language = '{x}') / count(*) * 100, 6) as {x}_percentage" for x in ("sinhala", "tamil", "english"))},
 round(count(romanized) / count(*) * 100, 6) as romanized_percentage from a"""
SQL["audit_alerts"] = f"with {_AUDIT} select category_type, category_value, severity, current_count, expected_minimum, round(pct, 6) as current_pct, min_pct from bad"
SQL["audit_gaps"] = f"""with {_AUDIT} select category_type, category_value, current_count as "current", expected_minimum - current_count as needed,
 case when category_value in ('tamil', 'sinhala', 'mental_health', 'maternal_health') then 3 else 2 end as n_suggestions from bad where severity in ('high', 'critical')"""
SQL["language_shares"] = f"with {_AUDIT} select category_value, n, round_even(n * 100 / sum(n) over (), 1) as share from d where category_type = 'language'"
SQL["corpus_snapshot"] = f"with {_AUDIT} select (select count(*) from a) as total_documents, 12 as total_qa_pairs, (select count(*) from d where category_type = 'region')::int as n_regions, (select n from d where category_value = 'english') as english"

SQL["table_upsert"] = """with d as (select doc_id as id, lang, source from documents), n as (select id * 2 as id, 'xx' as lang, source from d where id % 3 = 0)
 select id, lang, source from d where id not in (select id from n) union all select id, lang, source from n"""
SQL["table_patch"] = "select doc_id as id, case when doc_id % 4 = 0 and doc_id % 8 <> 0 then 'yy' else lang end as lang, source from documents"
SQL["orphan_labels"] = "select doc_id, quality, toxic from labels where doc_id not in (select doc_id from documents where doc_id % 2 = 0)"
SQL["system_status"] = f"with {_QA}, {_QUEUE.replace(' q as', ' queue as')} select (select count(*) from documents) as documents, (select count(*) from q) as qa_pairs, (select count(*) from q where verified) as verified, (select count(*) from queue where status = 'pending') as pending"
SQL["gazetteer"] = "select * from (values ('hospital', 15::bigint, 22::bigint), ('disease', 7, 19), ('symptom', 7, 25), ('clinic', 7, 21)) t(category, names, aliases)"

_EMAIL = r"\b[%+.0-9A-Z_a-z-]+@[.0-9A-Za-z-]+[.][|A-Za-z]{2,}\b"
SQL["email_spans"] = f"""with e as (select doc_id, regexp_extract_all(text, '{_EMAIL}') as m, regexp_split_to_array(text, '{_EMAIL}') as p from documents),
 k as (select *, unnest(range(1, len(m) + 1)) as k from e)
 select doc_id, m[k] as email, (list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::int as start from k"""


# -- entities --
_ALIASES = "(values " + ", ".join(f"({_q(c)}, {_q(a)}, {_q(n)})" for c, a, n in WORDS["aliases"]) + ") al(type, alias, normalized)"
_NAMES = "(values " + ", ".join(f"({_q(c)}, {_q(a)}, {_q(n)})" for c, a, n in WORDS["names"]) + ") nm(type, low, normalized)"
_ORDINAL = "case type when 'hospital' then 0 when 'disease' then 10 when 'symptom' then 20 else 30 end"
_PATTERNS = [
    ("time", r"\b\d{1,2}:\d{2}\s*(?:am|pm)?\b"), ("time", r"\b\d{1,2}\s*(?:am|pm)\b"), ("time", r"\b(?:morning|afternoon|evening|night)\b"), ("date", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"),
    ("date", r"\b(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday)\b"), ("date", r"\b(?:weekday|weekend)s?\b"), ("phone", r"\b0\d{9}\b"), ("phone", r"\b\+94\s?\d{9}\b"),
]


def _spans(source: str, pattern: str, text: str = "t") -> str:
    """id, start and m of the matches of a pattern; a letter that isn't ASCII beside one undoes it, as the class of words has it."""
    cut = f"string_split(regexp_replace({text}, '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1))"
    return f"""select id, start, m from (select id, {text} as whole, p[i] as m, list_sum(list_transform(p[1:i - 1], lambda x: length(x)))::int as start from
 (select *, unnest(range(2, len(p) + 1, 2)) as i from (select id, {text}, {cut} as p from {source} where regexp_matches({text}, '{pattern}'))))
 where not (ascii(substr(whole, start, 1)) > 127 and regexp_matches(substr(whole, start, 1), '{W}') and regexp_matches(m, '^{W}'))
 and not (ascii(substr(whole, start + length(m) + 1, 1)) > 127 and regexp_matches(substr(whole, start + length(m) + 1, 1), '{W}') and regexp_matches(m, '{W}$'))"""


def _entities(source: str, fold: bool) -> str:
    """CTEs that end in ``kept`` (id, start, stop, type, said, normalized, confidence, n) over a table (id, t)."""
    found = " union all ".join(f"select id, start, start + length(m) as stop, '{kind}' as type, m as said, null as normalized, 0.95::double as confidence, {100 + k} as ordinal from ({_spans('low', '(?i)' + p)})" for k, (kind, p) in enumerate(_PATTERNS))
    return rf"""low as (select id, {"lower(t)" if fold else "t"} as t, lower(t) as l from {source}),
 parts as (select id, t, l, type, alias, normalized, string_split(l, alias) as p from low, {_ALIASES} where contains(l, alias)),
 places as (select *, (list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * length(alias))::int as start from (select *, unnest(range(1, len(p))) as i from parts)),
 by_alias as (select id, start, start + length(alias) as stop, type, substr(t, start + 1, length(alias)) as said, normalized, 0.9::double as confidence, {_ORDINAL} as ordinal from places
  where regexp_matches(substr(l, start, 1), '^{W}$') <> regexp_matches(alias, '^{W}') and regexp_matches(substr(l, start + length(alias) + 1, 1), '^{W}$') <> regexp_matches(alias, '{W}$')),
 by_name as (select id, instr(l, low) - 1 as start, instr(l, low) - 1 + length(low) as stop, type, substr(t, instr(l, low), length(low)) as said, normalized, 1.0::double as confidence, {_ORDINAL} + 1 as ordinal from low as texts, {_NAMES} where contains(l, low)),
 every as (select * from by_alias union all select * from by_name union all {found}),
 lined as (select *, row_number() over (partition by id order by start, confidence desc, ordinal, stop, type, said) as n from every),
 walk as (select id, n, stop as last, true as kept from lined where n = 1 union all
  select l.id, l.n, case when l.start >= w.last then l.stop else w.last end, l.start >= w.last from walk w join lined l on l.id = w.id and l.n = w.n + 1),
 kept as (select lined.* from lined join walk using (id, n) where kept)"""


_FOUND = f"with recursive {_entities(_BOTH, True)}"
SQL["entity_rows"] = f"""{_FOUND} select id as doc_id, start::int as start, stop::int as "end", type, said as text, normalized, confidence from kept"""
SQL["entity_counts"] = f"{_FOUND} select type, count(*) as n from kept group by all"
SQL["entity_summary"] = f"{_FOUND} select id, type, array_to_string(list_sort(list(distinct coalesce(normalized, said))), '|') as names from kept group by id, type"

# -- domains and intents of tables and sentences --
_PER_DOMAIN = f"with c as ({_domain_counts(_BOTH, 'id')})"
_UNPIVOT = "unnest([" + ", ".join(f"struct_pack(domain := '{n}', k := c{i})" for i, n in enumerate(DOMAINS)) + "]) as d"
SQL["domain_tags"] = f"{_PER_DOMAIN} select id, d.domain as domain, round(least(1.0, 0.4 + 0.25 * d.k), 6)::double as confidence, d.k::int as n_keywords from (select id, {_UNPIVOT} from c) where d.k > 0"
_FIRST = "greatest(" + ", ".join(f"least(c{i}, 3)" for i in range(len(DOMAINS))) + ")"
SQL["domain_labels"] = f"""{_PER_DOMAIN}, p as (select case when {_FIRST} = 0 then 'general' {" ".join(f"when least(c{i}, 3) = {_FIRST} then '{n}'" for i, n in enumerate(DOMAINS))} end as domain from c)
 select domain, case domain {" ".join(f"when '{k}' then {_q(v)}" for k, v in WORDS["domain_descriptions"].items())} else 'Unknown domain' end as description, count(*) as n from p group by all"""
_DENGUE = ", ".join(f"case when regexp_matches(t, '{_edge(k) if k.isascii() else '(^|[^' + W[1:-1] + '])' + k + ('($|[^' + W[1:-1] + '])' if k[-1].isalnum() else W)}') then {_q(k.lower())} end" for k in DOMAINS["dengue"])
SQL["dengue_keywords"] = f"select id, keywords from (select id, array_to_string(list_sort(list_distinct(list_filter([{_DENGUE}], lambda x: x is not null))), '|') as keywords from {_BOTH}) where keywords <> ''"
_TURNS = f"(select conv_id as id, turn, coalesce(text, '') as t from conversations union all select id, 0, t from {_OWN})"
_PER_INTENT = ", ".join("struct_pack(intent := '" + n + "', k := " + " + ".join(f"regexp_matches(t, '{_edge(b)}')::int" for b in bodies) + ")" for n, bodies in INTENTS.items())
SQL["intent_scores"] = f"select id, turn, i.intent as intent, round(least(1.0, 0.4 + 0.3 * i.k), 6)::double as score, i.k::int as n_patterns from (select id, turn, unnest([{_PER_INTENT}]) as i from {_TURNS}) where i.k > 0"
SQL["intent_examples"] = "select * from (values " + ", ".join(f"('{k}', {n}::bigint)" for k, n in WORDS["intent_examples"].items()) + ") t(intent, n)"

# -- personal data and masking --
_PHONE_OR_NIC = [("PHONE", r"\b0\d{9}\b"), ("PHONE", r"\b\+94\s?\d{9}\b"), ("PHONE", r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b"), ("PHONE", r"\b\d{10}\b"), ("EMAIL", _EMAIL), ("NIC", r"\b\d{9}[VXvx]\b"), ("NIC", r"\b\d{12}\b")]
_ALL_PRIVATE = " union all ".join(f"select '{k}' as kind from ({_spans('texts', p)})" for k, p in _PHONE_OR_NIC)
SQL["pii_counts"] = f"with texts as (select doc_id as id, coalesce(text, '') as t from documents) select kind, count(*) as n from ({_ALL_PRIVATE}) group by all"
_FIX = "lower(cleaned)"
for _wrong, _right in WORDS["spellings"].items():
    _FIX = f"regexp_replace({_FIX}, '\\b{_wrong}\\b', '{_right}', 'g')"
_CLEANED = SQL["clean_text"].strip().replace("select doc_id, sha256(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) as cleaned_sha256 from b", "select doc_id, regexp_replace(t, '^\\s+|\\s+$', '', 'g') as cleaned from b")
_MASKED = f"""texts as (select doc_id as id, {_FIX} as t from ({_CLEANED})), private as (select id, sum(1) as n from ({" union all ".join(f"select id from ({_spans('texts', p)})" for _, p in _PHONE_OR_NIC)}) group by id),
 cleaned as (select id as doc_id, coalesce(n, 0) as n_pii, regexp_replace(t, '{_EMAIL}', '[REDACTED]', 'g') as text from texts left join private using (id))"""
SQL["masked_texts"] = rf"""with {_MASKED} select doc_id, sha256(text) as cleaned_sha256, n_pii > 0 as pii_removed, n_pii::int as n_pii,
 len(list_filter(list_transform(regexp_extract_all(text, '[^.!?]*[.!?]|[^.!?]+$'), lambda x: regexp_replace(x, '\s', '', 'g')), lambda x: x <> ''))::int as n_sentences from cleaned"""

# -- the annotation pipeline, from its parts --
_CLEAN_TEXTS = "(select doc_id as id, text as t from cleaned)"
SQL["annotated_documents"] = f"""with recursive {_MASKED}, {_entities(_CLEAN_TEXTS, False)},
 lang as ({SQL["detect_language"]}), rom as ({SQL["romanized_class"]}), hashes as ({SQL["content_hashes"]}),
 doms as ({SQL["domain_primary"].replace("from documents", "from cleaned")}), ints as ({_intents("cleaned", "doc_id")}), ents as (select id as doc_id, count(*) as n from kept group by id)
 select doc_id as id, lang.language as detected_language, lang.confidence as language_confidence, coalesce(lang.script_type = 'latin' and rom.classification in ('singlish', 'tamilish', 'mixed'), false) as is_romanized,
 case when lang.script_type = 'latin' then rom.classification end as romanized_type, ints.intent as intent, doms.primary_domain as domain, coalesce(ents.n, 0)::int as n_entities, hashes.content_hash as content_hash
 from lang join rom using (doc_id) join hashes using (doc_id) join doms using (doc_id) join ints using (doc_id) left join ents using (doc_id)"""

# -- pages --
_SAY = lambda c: f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g'))"
_FAQ = [
    r"(?is)<(?:b|strong|h\d)[^>]*>\s*(?:Q[.:]\s*)?(.+?)\s*</(?:b|strong|h\d)>\s*<(?:div|p)[^>]*>\s*(?:A[.:]\s*)?(.+?)\s*</(?:div|p)>",
    r"(?is)(?:Question[.:]\s*|Q[.:]\s*)(.+?)[\r\n]+(?:Answer[.:]\s*|A[.:]\s*)(.+?)(?:\z|\n\n)",
    r"(?is)(?:\d+[).]\s*)(.+[?])\s*[\r\n]+(.+?)(?:\z|\n\n|\d+[).])",
]
_PAIRED = " union all ".join(f"select page_id, {k} as form, unnest(range(1, len(q) + 1)) as i, unnest(q) as q, unnest(a) as a from (select page_id, regexp_extract_all(html, '{p}', 1) as q, regexp_extract_all(html, '{p}', 2) as a from pages)" for k, p in enumerate(_FAQ))
SQL["faq_pairs"] = f"""with p as ({_PAIRED}), c as (select page_id, form, i, {_SAY("q")} as question, {_SAY("a")} as answer from p)
 select page_id, (row_number() over (partition by page_id order by form, i) - 1)::int as number, question, answer, 0.8::double as confidence from c where length(question) > 10 and length(answer) > 10"""
_TEXTS = lambda tags: f"list_transform(regexp_extract_all(html, '(?is)<(?:{tags})(?:\\s[^>]*)?>(.*?)</(?:{tags})\\s*>', 1), lambda x: regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g'))"
SQL["text_chunks"] = f"""with p as (select page_id, unnest(string_split(array_to_string({_TEXTS("p|article")}, chr(10) || chr(10)), chr(10) || chr(10))) as chunk from pages)
 select page_id, count(*) as n_chunks from p where len(list_filter(regexp_split_to_array(chunk, '\\s+'), lambda x: x <> '')) >= 10 group by page_id"""
SQL["page_extract"] = f"""select page_id, ({_TEXTS("h1|h2")})[1] as title, sha256(array_to_string({_TEXTS("p|article")}, chr(10))) as content_sha256, ({_TEXTS("time")})[1] as date from pages"""
SQL["context_fields"] = r"""select page_id, url as source_url, 'HTML' as original_format, 0.9::double as reliability_score,
 least(len(regexp_extract_all(html, '(?is)<img\s[^>]*?src\s*=\s*["'']([^"'']*)["'']', 1)), 10)::int as n_images, least(len(regexp_extract_all(html, '(?is)<(?:video|source)\s[^>]*?src\s*=\s*["'']([^"'']*)["'']', 1)), 5)::int as n_videos,
 false as ocr_required, false as language_detected, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as title,
 coalesce(nullif(regexp_extract(html, '(?is)<html\s[^>]*?lang\s*=\s*["'']([^"'']*)["'']', 1), ''), 'si') as language from pages"""

# -- requests, lookups and rankings --
_SOURCES = f"""s as (select page_id as ordinal, {_HOST} as id, 'Agency ' || (page_id % 3) as agency, case when page_id % 3 = 0 then 0.5 else 0.0 end::double as reliability, page_id % 2 = 0 as seeded, 't' || (page_id % 4) as topic from pages where page_id % 5 > 0)"""
SQL["source_rows"] = f"with {_SOURCES} select ordinal, id, agency, reliability, 'west' as region, '' as notes, seeded::int as n_seeds from s where id <> ''"
SQL["source_seeds"] = f"with {_SOURCES} select id, nullif(count(*) filter (seeded), 0) as n_urls, 1 + count(distinct topic) as n_topics from s where id <> '' group by id"
SQL["source_lookup"] = f"with {_SOURCES} select ordinal, id, agency from s where id = (select min(id) from s where id <> '') order by ordinal desc limit 1"
SQL["version_history"] = f"with v as ({SQL['content_versions']}) select source, max(version_number) as versions, arg_max(content_hash, version_number) as latest_hash from v group by source"
SQL["latest_statistics"] = "select ts::date as snapshot_date, count(*) as total_documents from events group by all order by snapshot_date desc limit 1"
SQL["full_status"] = rf"""with {_QUEUE}, p as (select len(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) as n, len(regexp_extract_all(html, '(?is)<img\s[^>]*?src\s*=\s*["'']([^"'']*)["'']', 1)) as m from pages),
 c as ({SQL["queue_statistics"].split(" select ", 1)[0].replace("with ", "", 1) and "select " + ", ".join(f"count(*) filter (status = '{x}') as {x}" for x in ("pending", "processing", "completed", "failed")) + ", count(*) as total from q"})
 select c.*, (select count(*) from p) as total_documents, (select sum(n) from p)::bigint as pdf_assets, (select sum(m) from p)::bigint as image_assets, (select count(*) from p where n > 0) as ocr_required, 1704844800::bigint as at from c"""
SQL["review_cards"] = f"with {_QA} select substr(id, 1, 8) as short_id, substr(question_text, 1, 80) as question, case when verified then 'general' else domain end as domain from q"
SQL["document_reads"] = f"with {_HASH} select * from (select doc_id::varchar as id, source, content_hash from hashed where doc_id = 7) union all select * from (select doc_id::varchar as id, source, content_hash from hashed where content_hash = (select content_hash from hashed where doc_id = 7) order by id limit 1)"
SQL["discovered_links"] = f"""with {_LINKS}, u as (select distinct unnest(list_slice(inside, 1, 20)) as url from l),
 s as (select url, greatest(0, least(1, {" + ".join(f"contains(lower(url), '{w}')::int * 0.15" for w in LINK_WORDS)} + contains(lower(url), 'gov.lk')::int * 0.3 - (starts_with(lower(url), 'http') and not contains(lower(url), 'gov.lk'))::int * 0.2)) as score from u)
 select url, round(score, 6)::double as score, case when score > 0.2000001 then 'high' else 'medium' end as priority from s"""
SQL["ocr_queue_rows"] = r"""with l as (select page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1) as x from pages),
 e as (select page_id, unnest(range(1, len(x) + 1)) as i, unnest(x) as u from l), k as (select page_id, i, case when i % 2 = 1 then u || '.pdf' else u end as u from e),
 d as (select *, row_number() over (partition by page_id order by i) as n from k where regexp_matches(lower(regexp_replace(regexp_replace(u, '[?#].*$', ''), '^[a-zA-Z]+://[^/]*', '')), '\.pdf$'))
 select page_id::varchar as context_id, 'pdfs-raw/' || page_id || '/' || string_split(u, '/')[-1] as storage_path, 'pdf' as asset_type, 'medium' as priority, 'pending' as status, 3 as max_attempts from d where n <= 5"""
SQL["crawl_summary"] = f"with {_QUEUE} select count(*) as processed, count(*) filter (status = 'completed') as successful, count(*) filter (status = 'failed') as failed from q where status in ('completed', 'failed')"
SQL["ocr_batch_counts"] = f"with {_QUEUE} select count(*) as processed, count(*) filter (attempts <> 3) as successful, count(*) filter (attempts = 3) as failed from q where status = 'pending'"
SQL["ocr_transition"] = f"""with {_QUEUE}, n as (select case when status <> 'processing' then status when attempts % 2 = 0 then 'completed' else 'failed' end as s,
 case when status = 'processing' and attempts % 2 = 1 then 'blank page' end as last_error, attempts + (status = 'processing' and attempts % 2 = 1)::int as attempts from q)
 select s as status, last_error, count(*) as n, sum(attempts)::bigint as attempts from n group by all"""
SQL["queue_batch"] = f"""with p as (select url, {_HOST} as domain from pages), s as (select *, case when contains(domain, 'epid.gov.lk') or contains(domain, 'health.gov.lk') then 0.95 when contains(domain, 'moh.gov.lk') then 0.9
 when contains(domain, 'gov.lk') then 0.85 else 0.7 end::double as rel from p)
 select sha256(url) as id, url, domain, 'Ministry' as source_agency, 'high' as priority, round(0.8 * 0.4 + rel * 0.3, 6)::double as priority_score, 'pending' as status, 3 as max_attempts from s"""
SQL["similarity_ranks"] = f"""with near as ({SQL["near_duplicates"]}), e as (select id_a as id, id_b as other, similarity from near union all select id_b, id_a, similarity from near)
 select id, other, similarity, row_number() over (partition by id order by similarity desc, other)::int as rank from e"""
SQL["audit_report"] = f"""with {_AUDIT}, t as (select count(*) as total from a), named as (select category_type as kind, array_to_string(list_transform(string_split(category_value, '_'), lambda w: upper(w[1]) || w[2:]), ' ') as name, category_value as v, n from d),
 x as (select 0 as o, 0 as k, '# Corpus Bias Audit Report' as line union all select 1, 0, '**Date:** 2024-01-10' union all select 2, 0, '' union all select 3, 0, '## Summary'
 union all select 4, 0, '- **Total Documents:** ' || format('{{:,}}', total) from t union all select 5, 0, '- **Total Q&A Pairs:** 12' union all select 6, 0, '' union all select 7, 0, '## Language Distribution'
 union all select 8, row_number() over (order by n desc, v), '- ' || name || ': ' || format('{{:,}}', n) || ' (' || printf('%.1f', n * 100.0 / total) || '%)' from named, t where kind = 'language'
 union all select 9, 0, '' union all select 10, 0, '## Domain Distribution'
 union all select 11, row_number() over (order by n desc, v), '- ' || name || ': ' || format('{{:,}}', n) || ' (' || printf('%.1f', n * 100.0 / total) || '%)' from named, t where kind = 'domain')
 select row_number() over (order by o, k) - 1 as number, line from x"""
