"""Reference SQL (DuckDB) for the registered queries, over the same tables."""

from __future__ import annotations

SPACE = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _strip(column: str) -> str:
    """HTML strip; known entities are parked on control characters."""
    marks = (("amp", 1, "&"), ("lt", 2, "<"), ("gt", 3, ">"), ("quot", 4, '"'))
    sql = f"regexp_replace({column}, '<[^>]*>', ' ', 'g')"
    for name, code, _ in marks:
        sql = f"regexp_replace({sql}, '&{name};', chr({code}), 'gi')"
    sql = f"regexp_replace({sql}, '&(?:#[0-9]+|[a-z]+);', ' ', 'gi')"
    for _, code, char in marks:
        sql = f"replace({sql}, chr({code}), '{char}')"
    return f"trim(regexp_replace({sql}, '{SPACE}+', ' ', 'g'))"


def _published(number: str) -> str:
    return f"(timestamp '2024-01-01' + to_days(cast({number} % 30 as integer)) + to_hours({number} % 24))"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.000Z')"


def _pick(values: str, index: str) -> str:
    return f"([{', '.join(repr(v) for v in values.split())}])[cast(({index}) % {len(values.split())} as integer) + 1]"


SEVERITIES = "CRITICAL HIGH MEDIUM LOW INFO"
CATEGORIES = "BEDROCK_AGENTCORE AI_GENERAL AWS_SECURITY OTHER"

ARTICLES = f"""
articles as (
  select sha256(text) id, 'Report ' || doc_id || ' from ' || source || ' in ' || lang title,
         'https://example.com/' || source || '/' || doc_id url, source,
         {_pick("rss nvd arxiv x", "doc_id")} source_type, text content,
         {_published("doc_id")} published_at, cast(doc_id % 4 as integer) source_ord, doc_id pos,
         cast({_published("doc_id")} as date) run_date
  from documents)"""

ANALYZED = (
    ARTICLES
    + f""",
analyzed as (
  select *, 'Summary of report ' || pos summary, {_pick(SEVERITIES, "pos")} severity,
         {_pick(CATEGORIES, "pos // 5")} category, cast((pos * 37) % 101 as integer) score,
         case pos % 3 when 0 then [] when 1 then [source] else [source, source_type] end products,
         run_date digest_date
  from articles),
rated as (
  select *,
    case severity when 'CRITICAL' then 5 when 'HIGH' then 4 when 'MEDIUM' then 3 when 'LOW' then 2 else 1 end rank5,
    case category when 'BEDROCK_AGENTCORE' then true
      when 'AI_GENERAL' then severity in ('CRITICAL', 'HIGH', 'MEDIUM') and score >= 30
      when 'AWS_SECURITY' then severity in ('CRITICAL', 'HIGH') and score >= 50
      else severity = 'CRITICAL' end included,
    case category when 'BEDROCK_AGENTCORE' then 'BEDROCK' when 'AI_GENERAL' then 'AI'
      when 'AWS_SECURITY' then 'AWS' else 'OTHER' end label,
    case severity when 'CRITICAL' then '#dc2626' when 'HIGH' then '#ea580c' when 'MEDIUM' then '#d97706'
      when 'LOW' then '#2563eb' else '#6b7280' end sev_color,
    case category when 'BEDROCK_AGENTCORE' then '#7c3aed' when 'AI_GENERAL' then '#0891b2'
      when 'AWS_SECURITY' then '#059669' else '#6b7280' end cat_color
  from analyzed)"""
)

RANKED = (
    ANALYZED
    + """,
ranked as (
  select *, row_number() over (partition by digest_date order by rank5 desc, score desc, source_ord, pos) as "rank"
  from rated where included),
totals as (
  select digest_date, count(*) total_scraped, count(*) filter (included) total_included from rated group by 1)"""
)

UNIQUE = (
    ARTICLES
    + """,
uniq as (
  select * exclude (n) from (
    select *, row_number() over (partition by id order by source_ord, pos) n from articles) where n = 1)"""
)

# Every line of every document, numbered from zero.
LINES = r"""
lines as (
  select doc_id, source, unnest(string_split(clean, chr(10))) line,
         unnest(range(len(string_split(clean, chr(10))))) i
  from (select *, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', ' ', 'g') clean from documents))"""

FEED_ROWS = (
    LINES
    + f""",
feed_rows as (
  select 'Item ' || doc_id || '-' || i title, 'https://example.com/' || source || '/' || doc_id || '/' || i url, source,
         {_strip("'<p>' || line || '</p>'")} content, {_published("doc_id")} ts, doc_id * 1048576 + i pos
  from lines)"""
)

PAPER_ROWS = f"""
paper_rows as (
  select 'https://arxiv.org/abs/' || doc_id || '.' || i url,
         {_pick("Adversarial Security Prompt_injection Databases LLM Storage", "doc_id + i")} topic,
         {_pick("cs.CR cs.AI cs.LG cs.DB", "doc_id + i")} class, doc_id, i,
         trim(regexp_replace(line, '{SPACE}+', ' ', 'g')) content, {_published("(doc_id + i)")} ts,
         doc_id * 1048576 + i pos
  from lines),
papers as (select *, replace(topic, '_', ' ') || ' study ' || doc_id || '-' || i title from paper_rows)"""

CVE_ROWS = f"""
cve_rows as (
  select *, case when s >= 9 then 'CRITICAL' when s >= 7 then 'HIGH' when s >= 4 then 'MEDIUM' else 'LOW' end sev,
         'CVE-' || doc_id || '-' || i title
  from (select *, ((doc_id + i) % 101) / cast(10 as double) s, (doc_id + i) % 4 kind from lines)),
cves as (
  select sha256('https://nvd.nist.gov/vuln/detail/' || title) id, title,
         'https://nvd.nist.gov/vuln/detail/' || title url,
         case when kind = 2 then '' else
           'CVSS ' || regexp_replace(cast(s as varchar), '\\.0$', '') || ' (' || sev || '). ' end || line content,
         {_published("(doc_id + i)")} ts, doc_id * 1048576 + i pos,
         case when kind <> 2 then sev end base_severity, (doc_id + i) % 7 = 0 rejected
  from cve_rows)"""

REPLIES = (
    UNIQUE
    + f""",
texts as (
  select *, '{{"summary": "Reply on report ' || pos || '", "severity": "' ||
      case when pos % 13 = 0 then 'EXTREME' else {_pick(SEVERITIES, "pos")} end ||
      '", "relevance_category": "' || {_pick(CATEGORIES, "pos // 5")} || '", "relevance_score": ' ||
      case when pos % 17 = 0 then '"' || pos || '"' when pos % 41 = 0 then '85.5' when pos % 43 = 0 then '150'
           when pos % 47 = 0 then '-10' else cast(pos * 37 % 101 as varchar) end ||
      ', "reasoning": "rated ' || pos || '", "affected_products": ' ||
      case when pos % 23 = 0 then '["Alpha", 42, null, "Beta"]' when pos % 5 = 0 then '[]' else '["Gamma"]' end ||
      '}}' base
  from uniq),
replies as (
  select *, case when pos % 29 = 0 then null when pos % 11 = 0 then 'No rating for report ' || pos
      when pos % 31 = 0 then '[1]' when pos % 37 = 0 then 'null'
      when pos % 19 = 0 then base || ' and that is all'
      when pos % 7 = 0 then '```json' || chr(10) || base || chr(10) || '```' else base end reply
  from texts),
cleaned as (
  select *, trim(regexp_replace(regexp_replace(reply, '^```(?:json)?{SPACE}*', '', 'i'), '{SPACE}*```$', ''),
                 ' ' || chr(9) || chr(10)) c
  from replies),
valued as (
  select * exclude (c), case when json_valid(c) and json_type(c) <> 'NULL' then cast(c as json) end j from cleaned),
status as (
  select *, case when reply is null then 'missing' when j is null then 'fallback' else 'parsed' end triage_status
  from valued),
parsed as (
  select id, pos, source, source_type, triage_status,
    case triage_status when 'parsed' then
      case when json_type(j, '$.summary') = 'VARCHAR' then j ->> '$.summary' else '' end
      when 'fallback' then left(content, 300) end summary,
    case triage_status when 'parsed' then
      case when j ->> '$.severity' in ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'INFO') then j ->> '$.severity' else 'LOW' end
      when 'fallback' then 'INFO' end severity,
    case triage_status when 'parsed' then
      case when j ->> '$.relevance_category' in ('BEDROCK_AGENTCORE', 'AI_GENERAL', 'AWS_SECURITY')
           then j ->> '$.relevance_category' else 'OTHER' end
      when 'fallback' then 'OTHER' end category,
    case triage_status when 'parsed' then cast(
      case when json_type(j, '$.relevance_score') in ('UBIGINT', 'BIGINT', 'DOUBLE')
           then floor(greatest(0, least(100, cast(j ->> '$.relevance_score' as double))) + 0.5) else 0 end as integer)
      when 'fallback' then 0 end score,
    case triage_status when 'parsed' then
      case when json_type(j, '$.reasoning') = 'VARCHAR' then j ->> '$.reasoning' else '' end
      when 'fallback' then 'Failed to parse Bedrock response: ' || left(reply, 200) end reasoning,
    case triage_status when 'parsed' then
      coalesce(array_to_string(list_transform(
        list_filter(json_extract(j, '$.affected_products[*]'), lambda x: json_type(x) = 'VARCHAR'), lambda x: x ->> '$'), ','), '')
      when 'fallback' then '' end products
  from status)"""
)

METRICS = f"""
metrics as (
  select ts, {_pick("RssScraper NvdScraper ArxivScraper XScraper Processor Filter Notifier", "user_id")} fn,
         case event_type when 'purchase' then 'succeeded' when 'error' then 'failed' when 'signup' then 'timed_out' end
           status,
         event_type = 'error' is_error, value duration, cast(event_type = 'view' as integer) sends,
         cast(event_type = 'click' as integer) bounces,
         cast(cast(value as decimal(18,2)) / 1000 as decimal(18,6)) cost
  from events)"""

# The day-by-day loop: the next send of an id is its first candidate date more
# than seven days after the last send.
SENDS = """,
sends as (
  select id, min(d) d from candidates group by id
  union all
  select s.id, min(c.d) d from sends s join candidates c on c.id = s.id and c.d > s.d + 7 group by s.id, s.d)"""

CANDIDATES = ",\ncandidates as (select distinct id, run_date d from rated where included)"


def _with(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + "".join(parts) + "\n"


def _mentions(words: str) -> str:
    return f"regexp_matches(t, '(?:^|[^a-z0-9])(?:{words})(?:[^a-z0-9]|$)')"


_TEXT_HEAD = (
    "repeat('=', 60) || chr(10) || 'DAILY INTELLIGENCE DIGEST — ' || digest_date || chr(10) || total_included || "
    "' items included / ' || total_scraped || ' scraped' || chr(10) || repeat('=', 60) || chr(10)"
)
_TEXT_FOOT = (
    "chr(10) || repeat('-', 60) || chr(10) || 'Daily Intelligence Digest' || chr(10) || "
    "'Assembled automatically once a day'"
)
_DATE = "strftime(published_at, '%b %-d, %Y')"

_RENDER = """,
last as (select digest_date, total_scraped, total_included,
                greatest(0, cast(ceil(total_included / cast(500 as double)) as bigint) - 1) last_page from totals),
pages as (select digest_date, ("rank" - 1) // 500 page, {agg} items from ranked group by 1, 2),
parts as (
  select l.digest_date, coalesce(p.page, 0) page,
         case when coalesce(p.page, 0) = 0 then {head} else {between} end || coalesce(p.items, '') ||
         case when coalesce(p.page, 0) = l.last_page then {foot} else '' end body
  from (select * from last {extra}) l left join pages p on p.digest_date = l.digest_date)
select digest_date, page, sha256(body) body_sha, cast(length(body) as integer) body_len from parts"""

_TEXT = _RENDER.format(
    agg=f"""string_agg(chr(10) || '[' || severity || '] [' || label || '] ' || title || chr(10) || summary || chr(10) ||
         case when len(products) > 0 then 'Affected: ' || array_to_string(products, ', ') || chr(10) else '' end ||
         'Source: ' || source || ' — ' || url || chr(10) || 'Published: ' || {_DATE} || chr(10), '' order by "rank")""",
    head=_TEXT_HEAD,
    between="''",
    foot=_TEXT_FOOT,
    extra="",
)


def _badge(text: str, color: str) -> str:
    return f"""'<b style="color:#fff;padding:2px 6px;background:' || {color} || '">' || {text} || '</b>'"""


def _esc(value: str) -> str:
    return (
        f"replace(replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
    )


_HTML = """,
badges as (
  select digest_date, string_agg({badge} || ' ' || n, ' ' order by rank5 desc) badges
  from (select digest_date, severity, sev_color, rank5, count(*) n from rated where included group by all) group by 1)
""".format(badge=_badge("severity", "sev_color")) + _RENDER.format(
    agg=f"""string_agg('<tr><td style="border-left:4px solid ' || sev_color || '">' || {_badge("severity", "sev_color")}
         || ' ' || {_badge("label", "cat_color")} || '<h3><a href="' || {_esc("url")} || '">' || {_esc("title")} ||
         '</a></h3><p>' || {_esc("summary")} || '</p>' ||
         case when len(products) > 0 then '<p>Affected: ' || {_esc("array_to_string(products, ', ')")} || '</p>'
              else '' end ||
         '<p>' || {_esc("source")} || ' · ' || {_DATE} || '</p></td></tr>', '<tr><td><hr></td></tr>' order by "rank")""",
    head="""'<!DOCTYPE html>' || chr(10) || '<html lang="en"><head><meta charset="UTF-8"><title>'
         || 'Daily Intelligence Digest — ' || l.digest_date || '</title></head>' || chr(10) ||
         '<body><h1>Daily Intelligence Digest</h1>' || chr(10) || '<p>' || l.digest_date || ' · ' || total_included ||
         ' included · ' || total_scraped || ' scraped</p>' || chr(10) || '<p>' || coalesce(badges, '') || '</p>' ||
         chr(10) || '<table>'""",
    between="'<tr><td><hr></td></tr>'",
    foot="""'</table>' || chr(10) ||
         '<footer>Daily Intelligence Digest<br>Assembled automatically once a day</footer></body></html>'""",
    extra="left join badges using (digest_date)",
).lstrip()


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    registry = """with per_source as (select source registry, sum(n_chars) amount from documents group by 1),
feeds as (
  select registry, registry name, amount % 2 = 0 enabled from per_source union all
  select registry, registry || '-archive', amount % 3 = 0 from per_source)"""
    sql["source_registry"] = registry + """
select registry, 'rss' kind, name, enabled, cast(null as varchar) error from feeds where enabled
union all
select registry, 'api', 'nvd', amount % 5 > 0 and amount % 2 = 0,
       case when not (amount % 5 > 0 and amount % 2 = 0) then 'NVD source is disabled in sources.json' end
from per_source
union all
select registry, 'api', 'arxiv', amount % 3 > 0,
       case when amount % 3 = 0 then 'ArXiv source is disabled in sources.json' end
from per_source"""
    sql["enabled_articles"] = registry + """
select sha256(text) id, source, doc_id pos from documents where source in (select name from feeds where enabled)"""

    sql["feed_normalize"] = _with(FEED_ROWS) + f"""
select sha256(url) id, title, url, source, content, {_iso("ts")} published, pos from feed_rows"""
    sql["arxiv_normalize"] = _with(LINES, ",", PAPER_ROWS) + f"""
select sha256(url) id, title, url, content, {_iso("ts")} published, pos from papers"""
    sql["paper_topics"] = _with(LINES, ",", PAPER_ROWS) + f"""
select sha256(url) id, title, {_iso("ts")} published from papers
where class in ('cs.CR', 'cs.AI', 'cs.LG') and topic in ('Adversarial', 'Security', 'Prompt_injection', 'LLM')
order by ts desc, sha256(url) limit 100"""
    sql["cve_normalize"] = _with(LINES, ",", CVE_ROWS) + f"""
select id, title, url, content, {_iso("ts")} published, pos, base_severity from cves"""
    sql["cve_recent_severe"] = _with(LINES, ",", CVE_ROWS) + """
select id, title, content, base_severity from cves
where base_severity in ('HIGH', 'CRITICAL') and not rejected
  and ts between timestamp '2024-01-18 06:00:00' and timestamp '2024-01-20 06:00:00'"""
    sql["union_sources"] = _with(FEED_ROWS, ",", PAPER_ROWS, ",", CVE_ROWS) + """
select 0 source_ord, 'rss' source_type, source, count(*) n_rows, cast(sum(length(content)) as bigint) n_chars
from feed_rows group by source
union all select 1, 'nvd', 'NVD', count(*), cast(sum(length(content)) as bigint) from cves
union all select 2, 'arxiv', 'ArXiv', count(*), cast(sum(length(content)) as bigint) from papers"""
    sql["json_round_trip"] = _with(ANALYZED) + f"""
select id, title, content, {_iso("published_at")} published, pos, severity, category, score,
       coalesce(array_to_string(products, ','), '') products from analyzed"""

    sql["strip_html"] = f"select page_id, {_strip('html')} stripped from pages"
    sql["article_ids"] = "select page_id, url, sha256(url) id from pages"
    sql["normalize_urls"] = r"""
select page_id, 'https://arxiv.org/abs/2401.' || page_id paper_url,
       regexp_replace(regexp_replace(url, 'v[0-9]+$', ''), 'http://', 'https://') page_url from pages"""
    sql["lookback_recent"] = _with(ARTICLES) + f"""
select pos, id, {_iso("published_at")} published from articles where published_at >= timestamp '2024-01-19 04:00:00'"""

    sql["policy_filter"] = _with(ANALYZED) + "select pos, id, severity, category, score from rated where included"
    sql["rank_articles"] = _with(RANKED) + 'select digest_date, "rank", pos, id, severity, score from ranked'
    sql["digest_daily"] = _with(RANKED) + """,
pages as (
  select digest_date, ("rank" - 1) // 500 page, string_agg(id || ':' || title, ',' order by "rank") articles
  from ranked group by 1, 2)
select cast(t.digest_date as varchar) digest_date, coalesce(page, 0) page, total_scraped, total_included,
       coalesce(articles, '') articles
from totals t left join pages p on p.digest_date = t.digest_date"""
    sql["rank_small_blocks"] = sql["rank_articles"]
    sql["digest_small_pages"] = sql["digest_daily"].replace("// 500", "// 3")
    sql["digest_counts"] = _with(ANALYZED) + """
select digest_date, count(*) total, count(*) filter (included) included, count(*) filter (not included) excluded
from rated group by 1"""
    sql["severity_counts"] = _with(ANALYZED) + """
select digest_date, severity, cast(rank5 as integer) severity_rank, count(*) n from rated where included group by all"""
    sql["digest_subjects"] = _with(RANKED) + """
select digest_date, 'Daily Intelligence Digest — ' || digest_date || ' (' || total_included ||
       case when total_included = 1 then ' item)' else ' items)' end subject from totals"""
    sql["render_text"] = _with(RANKED) + _TEXT.replace("digest_date || chr(10) || total", "l.digest_date || chr(10) || total")
    sql["render_html"] = _with(RANKED) + _HTML

    sql["dedup_first"] = _with(UNIQUE) + "select id, pos, source_ord, title, content from uniq"
    sql["run_funnel"] = _with(ANALYZED, CANDIDATES_FIRST, SENDS, recursive=True) + """,
seen as (
  select f.*, exists (select 1 from sends s where s.id = f.id and s.d between f.run_date - 7 and f.run_date - 1) seen
  from firsts f)
select run_date, cast(sum(copies) as bigint) raw, count(*) "unique", count(*) filter (not seen) unseen,
       count(*) filter (included and not seen) included, count(*) filter (not included and not seen) excluded,
       count(*) filter (seen) already_sent
from seen group by 1"""
    sql["backfill_digests"] = _with(ANALYZED, CANDIDATES_FIRST, SENDS, recursive=True) + """,
uniq as (
  select * from (
    select *, row_number() over (partition by id, run_date order by source_ord, pos) n from rated) where n = 1),
fresh as (
  select *, exists (select 1 from sends s where s.id = u.id and s.d = u.run_date) sent from uniq u
  where not exists (select 1 from sends s where s.id = u.id and s.d between u.run_date - 7 and u.run_date - 1)),
placed as (
  select *, row_number() over (partition by run_date order by rank5 desc, score desc, source_ord, pos) "rank"
  from fresh where sent),
pages as (
  select run_date, ("rank" - 1) // 500 page, string_agg(title, ',' order by "rank") articles from placed group by 1, 2)
select t.run_date digest_date, coalesce(page, 0) page, total_scraped, total_included, coalesce(articles, '') articles
from (select run_date, count(*) total_scraped, count(*) filter (sent) total_included from fresh group by 1) t
left join pages p on p.run_date = t.run_date"""
    errors = """,
errors as (select source_type, source || ': ' || triage_status error, pos from parsed where triage_status <> 'parsed')
"""
    sql["source_stats"] = _with(REPLIES) + errors + """
select source_type, article_count, coalesce(error_count, 0) error_count
from (select source_type, count(*) article_count from uniq group by 1) a
full join (select source_type, count(*) error_count from errors group by 1) e using (source_type)"""
    sql["source_errors"] = _with(REPLIES) + errors + """
select source_type, (n - 1) // 500 page, string_agg(error, '|' order by n) errors
from (select *, row_number() over (partition by source_type order by pos) n from errors) group by 1, 2"""

    sent = ",\nsent as (select distinct id, digest_date sent_date from rated where included)\n"
    sql["scrape_errors"] = f"""
select 'rss' source_type, source, source || ': malformed XML' error, count(*) n from documents where doc_id % 7 = 0 group by all
union all
select 'nvd', 'NVD', 'NVD: unreadable page', count(*) n from documents where doc_id % 13 = 0 having n > 0
union all
select 'arxiv', 'ArXiv', 'ArXiv: malformed XML', count(*) n from documents where doc_id % 11 = 0 having n > 0
union all
select name, name, error, count(*) n from ({sql["source_registry"]}) where kind = 'api' and not enabled group by all"""
    sql["landed_run"] = _with(LINES, ",", PAPER_ROWS, ",", CVE_ROWS) + f""",
items as (
  select 'https://example.com/' || source || '/' || doc_id || '/' || i url, source, 'Item ' || doc_id || '-' || i title,
         trim(regexp_replace(line, '{SPACE}+', ' ', 'g')) content, {_published("doc_id")} ts
  from lines where source in (select source from documents group by 1 having sum(n_chars) % 3 > 0)),
newest as (
  select * from papers where doc_id % 5 <> 0 and class in ('cs.CR', 'cs.AI', 'cs.LG')
    and topic in ('Adversarial', 'Security', 'Prompt_injection', 'LLM') order by ts desc, sha256(url) limit 100)
select 'rss' source_type, source, sha256(url) id, title, content, {_iso("ts")} published, null error from items
where ts >= timestamp '2024-01-19 04:00:00'
union all
select 'arxiv', 'ArXiv', sha256(url), title, content, {_iso("ts")}, null from newest where ts >= timestamp '2024-01-19 04:00:00'
union all
select 'nvd', 'nvd', null, null, '1', null, 'NVD source is disabled in sources.json'
union all
select 'arxiv', 'ArXiv', null, null, count(*)::varchar, null,
       'ArXiv: invalid date ' || strftime(ts, '%Y-17-%dT%H:%M:%SZ') || ' in ' || url
from papers where doc_id % 5 = 0 group by ts, url"""
    sql["bad_dates"] = _with(LINES, ",", PAPER_ROWS, ",", CVE_ROWS) + f"""
select 'rss' source_type, 'Item ' || doc_id || '-' || i item,
       strftime(case when case when doc_id % 2 = 0 then doc_id % 3 = 0 else doc_id % 5 = 0 end
         then timestamp '2024-02-01 06:00:00' else {_published("doc_id")} end, '%b %-d, %Y') shown from lines
union all
select 'nvd', 'error', 'NVD: invalid date ' || strftime(ts, '%Y-17-%dT%H:%M:%S.000') || ' in ' || title from cves
where (pos // 1048576) % 5 = 0
union all
select 'arxiv', 'error', 'ArXiv: invalid date ' || strftime(ts, '%Y-17-%dT%H:%M:%SZ') || ' in ' || url from papers where doc_id % 5 = 0"""
    sql["render_small_pages"] = f"""
select digest_date, 'text' kind, page, body_sha from ({sql["render_text"]})
union all select digest_date, 'html', page, body_sha from ({sql["render_html"]})""".replace("// 500", "// 3").replace("cast(500 as", "cast(3 as")
    sql["seen_window"] = _with(ANALYZED) + sent + """
select distinct cast(sent_date + cast(k as integer) as date) run_date, id from sent, range(1, 8) t(k)"""
    sql["unseen_articles"] = _with(ANALYZED) + sent + """
select id, run_date, pos from (
  select id, run_date, pos, row_number() over (partition by id, run_date order by source_ord, pos) n from articles) a
where n = 1 and not exists (
  select 1 from sent s where s.id = a.id and s.sent_date between a.run_date - 7 and a.run_date - 1)"""
    sql["unseen_bucketed"] = sql["unseen_articles"]
    sql["seen_backfill"] = _with(ANALYZED, CANDIDATES, SENDS, recursive=True) + "select id, cast(d as date) sent_date from sends"
    sql["stream_seen"] = sql["seen_backfill"].replace("sent_date from", "sent_date, false late from")
    sql["stored_seen_window"] = _with(ANALYZED) + sent + """
select distinct id from sent where sent_date in (date '2024-01-06', date '2024-01-08')"""
    sql["score_hook"] = _with(ARTICLES) + f""",
prompts as (
  select pos, length('Title: ' || title || chr(10) || 'Source: ' || source || ' (' || source_type || ')' || chr(10) ||
       'Published: ' || {_iso("published_at")} || chr(10) || 'URL: ' || url || chr(10) || chr(10) || 'Content:' ||
       chr(10) || left(content, 4000)) n from articles)
select pos, 'parsed' triage_status, n::varchar summary, 'HIGH' severity, (n % 100)::int score from prompts"""
    sql["retention_expired"] = _with(ANALYZED) + """
select 'raw' dataset, run_date, count(*) n_rows from articles where run_date < date '2024-04-12' - 7 group by 2
union all
select 'processed', run_date, count(*) from analyzed where run_date < date '2024-04-12' - 30 group by 2
union all
select 'digests', run_date, count(*) from rated where included and run_date < date '2024-04-12' - 90 group by 2
union all
select 'sent_ids', run_date, count(distinct id) from rated where included and run_date < date '2024-04-12' - 90 group by 2"""

    sql["run_counts"] = _with(REPLIES) + """,
judged as (
  select triage_status, case category when 'BEDROCK_AGENTCORE' then true
      when 'AI_GENERAL' then severity in ('CRITICAL', 'HIGH', 'MEDIUM') and score >= 30
      when 'AWS_SECURITY' then severity in ('CRITICAL', 'HIGH') and score >= 50
      else severity = 'CRITICAL' end included
  from parsed)
select date '2024-01-20' run_date, (select count(*) from articles) raw, count(*) unseen,
       count(*) filter (triage_status = 'missing') quarantined,
       count(*) filter (triage_status <> 'missing' and included) included,
       count(*) filter (triage_status <> 'missing' and not included) excluded from judged"""
    sql["retention_stored"] = sql["retention_expired"]
    sql["build_prompts"] = _with(ARTICLES) + f"""
select pos, 'Title: ' || title || chr(10) || 'Source: ' || source || ' (' || source_type || ')' || chr(10) ||
       'Published: ' || {_iso("published_at")} || chr(10) || 'URL: ' || url || chr(10) || chr(10) || 'Content:' ||
       chr(10) || left(content, 4000) prompt from articles"""
    sql["parse_triage"] = _with(REPLIES) + """
select id, pos, triage_status, summary, severity, category, score, reasoning, products from parsed"""
    sql["rule_triage"] = _with(LINES, ",", PAPER_ROWS) + f""",
texts as (select *, lower(title || ' ' || content) t from papers),
rules as (
  select *, case when {_mentions("bedrock|agent core|agentcore")} then 'BEDROCK_AGENTCORE'
    when {_mentions("llm|large language model|jailbreak|prompt injection|model poisoning|adversarial|ai|pytorch|"
                    "tensorflow|langchain")} then 'AI_GENERAL'
    when {_mentions("linux|openssl|apache|nginx|python|node[.]js|docker")}
      and not {_mentions("iam|s3|lambda|ec2|cloudformation|sagemaker|kms|vpc|ecs|eks")} then 'OTHER'
    when {_mentions("iam|s3|lambda|ec2|cloudformation|sagemaker|kms|vpc|ecs|eks")} then 'AWS_SECURITY'
    else 'OTHER' end category
  from texts)
select sha256(url) id,
  case when {_mentions("active exploitation|actively exploited|zero-day")} then 'CRITICAL'
    when {_mentions("unpatched|proof of concept|poc|exploit")} then 'HIGH'
    when {_mentions("patched|theoretical|vulnerability|attack")} then 'MEDIUM'
    when {_mentions("update|minor|security")} then 'LOW' else 'INFO' end severity,
  category, case when category = 'OTHER' then 0 else 60 end score
from rules"""

    bucket = "time_bucket(interval '{}', ts) window_start"
    five, hour, day = (bucket.format(p) for p in ("5 minutes", "1 hour", "1 day"))
    sql["error_alarms"] = _with(METRICS) + f"""
select window_start, alarm, count(*) n from (
  select {five}, lower(fn) || '-errors' alarm from metrics where is_error
  union all select {five}, 'run-failures' from metrics where status = 'failed'
  union all select {five}, 'run-timeouts' from metrics where status = 'timed_out') group by 1, 2"""
    sql["hourly_status"] = _with(METRICS) + f"""
select {hour}, count(*) filter (status = 'succeeded') succeeded, count(*) filter (status = 'failed') failed,
       count(*) filter (status = 'timed_out') timed_out from metrics group by 1"""
    sql["hourly_errors"] = _with(METRICS) + f"""
select {hour}, fn, count(*) filter (is_error) errors from metrics group by 1, 2"""
    sql["hourly_p95"] = _with(METRICS) + f"""
select {hour}, fn, round(quantile_cont(duration, 0.95), 6) p95 from metrics group by 1, 2"""
    sql["p95_of_all"] = _with(METRICS) + "select round(quantile_cont(duration, 0.95), 6) p95 from metrics"
    sql["sketched_p95"] = _with(METRICS) + """
select 'day' period, cast(ts as date) "day", fn, count(*) n, true "near" from metrics group by 2, 3
union all
select 'month', cast(date_trunc('month', ts) as date), fn, count(*), true from metrics group by 2, 3"""
    sql["rate_alarm"] = _with(METRICS) + f"""
select window_start, sends, bounces, round(bounces / cast(sends + bounces as double), 9) bounce_rate from (
  select {hour}, cast(sum(sends) as bigint) sends, cast(sum(bounces) as bigint) bounces from metrics group by 1)
where sends + bounces > 0 and bounces / cast(sends + bounces as double) >= 0.05"""
    sql["daily_sends"] = _with(METRICS) + f"""
select {day}, cast(sum(sends) as bigint) sends, cast(sum(bounces) as bigint) bounces from metrics group by 1"""
    sql["budget_alerts"] = _with(METRICS) + """,
days as (select cast(ts as date) "day", sum(cost) cost from metrics group by 1),
spent as (
  select "day", sum(cost) over (partition by date_trunc('month', "day") order by "day") month_to_date from days)
select "day", cast(month_to_date as double) month_to_date,
       cast(case when month_to_date * 100 / 20 > 100 then 100 else 80 end as integer) alert_percent
from spent where month_to_date * 100 / 20 > 80"""

    sql["stream_dedup"] = _with(ARTICLES) + """
select id, pos from articles
qualify row_number() over (partition by id order by (pos + 1) % 3, source_ord, pos) = 1"""
    sql["stream_dedup_days"] = _with(ARTICLES, recursive=True) + """,
firsts as (
  select id, pos, published_at seen_at, (dayofmonth(published_at) - 1) // 5 landing from articles
  qualify row_number() over (partition by id, landing order by source_ord, pos) = 1),
kept as (
  select id, min(seen_at) seen_at from firsts group by id
  union all
  select k.id, min(f.seen_at) from kept k join firsts f on f.id = k.id and f.seen_at > k.seen_at + interval 5 days
  group by k.id, k.seen_at)
select firsts.id, pos from firsts join kept using (id, seen_at)"""
    sql["stream_seen_days"] = sql["stream_seen"]
    late = REPLIES.replace("case when pos % 29 = 0 then null", "case when pos % 29 = 0 or pos % 5 >= 3 then null")
    sql["late_replies"] = _with(late) + "select id, pos, triage_status, summary, severity, category, score from parsed"
    closed = "(select max(ts) from metrics) - interval '10 minutes'"
    sql["stream_alarms"] = sql["error_alarms"].replace("\nselect", "\nselect * from (select", 1) + f"""
) where window_start + interval '5 minutes' <= {closed}"""
    landed = METRICS.replace("select ts,", "select ts, least(2, (dayofmonth(ts) - 1) // 10 + cast(user_id % 10 = 0 as integer)) landing,")
    sql["stream_late"] = _with(landed) + f""",
marks as (select landing + 1 landing, max(max(ts)) over (order by landing) - interval '10 minutes' passed from metrics group by landing),
signals as (
  select *, {five} from (
    select ts, landing, lower(fn) || '-errors' alarm from metrics where is_error
    union all select ts, landing, 'run-failures' from metrics where status = 'failed'
    union all select ts, landing, 'run-timeouts' from metrics where status = 'timed_out')),
judged as (
  select s.*, coalesce(window_start + interval '5 minutes' <= passed, false) late from signals s left join marks using (landing))
select 'late' kind, window_start, alarm, count(*) n from judged where late group by all
union all
select 'alarm', window_start, alarm, count(*) from judged
where not late and window_start + interval '5 minutes' <= (select max(passed) from marks) group by all"""
    sql["stream_budget"] = sql["budget_alerts"] + f""" and "day" + interval '1 day' <= {closed}"""
    sql["stream_p95"] = _with(METRICS) + f"""
select window_start, fn, p95 from (
  select {hour}, fn, quantile_disc(duration, 0.95) p95 from metrics group by 1, 2)
where window_start + interval '1 hour' <= {closed}"""
    return sql


# For the funnel: one row per id and date, the first copy deciding.
CANDIDATES_FIRST = """,
firsts as (
  select id, run_date, count(*) copies, arg_min(included, source_ord * 1000000000000 + pos) included
  from rated group by 1, 2),
candidates as (select id, run_date d from firsts where included)"""
