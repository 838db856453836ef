"""DuckDB SQL that states the expected result of the registered queries.

The input values are the adapters' expressions; every rule is written out here in SQL
for itself.
"""

from __future__ import annotations

import re

from .. import fixed_values as V
from ..sources import adapters as A
from .queries import COMPARED, LATER, LATEST, SAMPLE_SIZE, SEED

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _table(pairs) -> str:
    return "(values " + ", ".join("(" + ", ".join(p) + ")" for p in pairs) + ")"


def _aliases(name: str, pairs: dict[str, str]) -> str:
    rows = _table((_text(k), _text(v)) for k, v in pairs.items())
    return f"{name}(alias, canonical) as {rows}"


def _strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def _select(exprs) -> str:
    return "select " + ", ".join(exprs)


def _of(fields: dict[str, str], missing: str | None = None, prefix: str = "") -> list[str]:
    guard = f"case when not ({missing}) then ({{}}) end" if missing else "{}"
    return [f"{guard.format(e)} as {prefix}{n}" for n, e in fields.items()]


def _regions(raw: str) -> str:
    arms = "".join(
        f" when {' or '.join(f'contains(lower({raw}), {_text(p)})' for p in phrases)} then '{region}'"
        for region, phrases in V.REMOTE_REGION_RULES.items()
    )
    return f"case when {raw} is null or {raw} = '' then null{arms} else 'other' end"


_MONTHS = "[" + ", ".join(f"'{m}'" for m in V.MONTH_NAMES) + "]"
_WORD_AND_YEAR = r"'\((\w+)\s+(\d{4})\)'"
_MONTH_NUMBER = f"list_position({_MONTHS}, lower(regexp_extract(title, {_WORD_AND_YEAR}, 1)))"

PRELUDE = f"""
with
{_aliases("tech_alias", V.TECH_ALIASES)},
{_aliases("city_alias", V.CITY_ALIASES)},
{_aliases("city_country", V.CITY_COUNTRIES)},
{_aliases("country_alias", V.COUNTRY_ALIASES)},
{_aliases("currency_alias", V.CURRENCY_ALIASES)},
prices(model, rate_in, rate_out) as {_table(
    (_text(m), f"{a}::double", f"{b}::double") for m, a, b in V.MODEL_PRICES)},
blocks as (select block, count(*) as n from (select {A.BLOCK} as block from documents) group by block),
thread_1 as ({_select(A.THREAD_STEPS[0])} from blocks),
thread_2 as ({_select(A.THREAD_STEPS[1])} from thread_1),
thread_3 as ({_select(A.THREAD_STEPS[2])} from thread_2),
listed as ({_select(A.THREAD_STEPS[3])} from thread_3),
threads as (
  select id, title,
    case when starts_with(title, 'Ask HN: Who is hiring?') then 'hiring'
         when contains(title, 'Who wants to be hired?') then 'seekers'
         when contains(title, 'Freelancer') then 'freelancer' else 'other' end as kind,
    case when {_MONTH_NUMBER} > 0
         then regexp_extract(title, {_WORD_AND_YEAR}, 2) || '-' || lpad({_MONTH_NUMBER}::varchar, 2, '0')
         when length(created_at) >= 7 then substring(created_at, 1, 7) end as month,
    coalesce(created_at, '') as created_at, num_comments, {A.THREAD_FETCHED} as fetched_at
  from listed),
hiring as (select * from threads where kind = 'hiring'),
posts as (
  select doc_id as id, {A.THREAD_OF_POST}::bigint as thread_id,
    'user' || (doc_id % 97)::varchar as author,
    coalesce({A.POST_CREATED}, '{A.RUN_TS}') as created_at, {A.RAW_HTML} as raw_html,
    (doc_id % 41 = 0)::int as is_deleted, (doc_id % 53 = 0)::int as is_dead,
    '{A.RUN_TS}' as fetched_at,
    case when doc_id % 59 = 0 then '' else {_strip(r"regexp_replace(text, '\n+', chr(10), 'g')")} ||
      case when doc_id % 5 = 0 then chr(10) || 'apply (' || {A.LINK} || ')' else '' end end as body
  from documents),
gated as (
  select id, thread_id, body, is_deleted = 1 or is_dead = 1 or length(body) < 50 as skipped,
    length(body) > 24000 as truncated, substring(body, 1, 24000) as sent
  from posts),
ledger_0 as (select doc_id, text, v from documents, (values (0), (1)) vs(v) where {A.LEDGER_ROWS}),
ledger_1 as ({_select(A.LEDGER_STEPS[0])} from ledger_0),
ledger as ({_select(A.LEDGER_STEPS[1])} from ledger_1),
months as (
  select p.id as post_id, coalesce(nullif(t.month, ''), 'unknown') as month
  from posts p join threads t on t.id = p.thread_id),
docs_all as (
  select l.post_id, l.prompt_version, m.month, l.d, greatest(l.d % 4, 1) as n_jobs
  from ledger l join months m on m.post_id = l.post_id
  where l.status = 'ok' and l.payload = 'document'),
docs as (select * from docs_all where prompt_version = 'v1'),
positions(i) as (values (0), (1), (2)),
fields_0 as (
  select post_id, prompt_version, month, n_jobs, d, {", ".join(_of(A.POST_FIELDS))},
    {", ".join(_of(A.COMPANY_FIELDS, A.COMPANY_MISSING, "company_"))},
    {", ".join(_of(A.WORKPLACE_FIELDS, A.WORKPLACE_MISSING))},
    {", ".join(_of(A.SIGNAL_FIELDS, A.SIGNALS_MISSING))}
  from docs_all),
fields as (
  select * replace (coalesce(post_type, 'job_posting') as post_type), post_type as stated_type
  from fields_0),
roles_0 as (
  select f.*, r.i from fields f left join positions r on r.i < f.d % 4),
roles as (
  select * exclude (i), coalesce(i, 0) as role_pos, i is not null as has_role,
    {", ".join(_of(A.ROLE_FIELDS))},
    {", ".join(_of(A.SALARY_FIELDS, A.SALARY_MISSING + " or i is null"))}
  from roles_0),
roles_k as (
  select * replace (
    case when period = 'year' and "min" < 1000 then "min" * 1000 else "min" end as "min",
    case when period = 'year' and "max" < 1000 then "max" * 1000 else "max" end as "max")
  from roles),
roles_s as (
  select * replace (
    case when "min" > "max" then "max" else "min" end as "min",
    case when "min" > "max" then "min" else "max" end as "max")
  from roles_k),
jobs_all as (
  select s.post_id, role_pos::int as role_pos, prompt_version, company_name, company_stage,
    company_is_yc as is_yc, title_raw, title_guess as title_normalized, seniority, employment_type,
    case when not (period = 'year' and "min" > 2000000) or period is null or "min" is null then "min" end as salary_min,
    case when not (period = 'year' and "max" > 2000000) or period is null or "max" is null then "max" end as salary_max,
    case when currency_raw <> '' then coalesce(c.canonical, upper({_strip("currency_raw")})) end as salary_currency,
    period as salary_period, equity as salary_equity, policy as workplace_policy,
    {_regions("remote_region_raw")} as remote_region, visa_sponsorship, month,
    coalesce(period = 'year' and ("min" > 2000000 or "max" > 2000000), false) as salary_capped,
    post_type, has_role
  from roles_s s left join currency_alias c on c.alias = lower({_strip("currency_raw")})),
jobs as (select * from jobs_all where prompt_version = 'v1'),
named_all as (
  select post_id, prompt_version, month, n_jobs, i, {A.TECHNOLOGY} as tech_raw
  from docs_all, positions where not ({A.TECHNOLOGIES_MISSING})),
technologies_all as (
  select n.*, coalesce(a.canonical, lower({_strip("tech_raw")})) as tech,
    (a.canonical is not null)::int as aliased
  from named_all n left join tech_alias a on a.alias = lower({_strip("tech_raw")})),
technologies as (select * from technologies_all where prompt_version = 'v1'),
placed_all as (
  select post_id, prompt_version, month, n_jobs, i, {", ".join(_of(A.LOCATION_FIELDS, None, "raw_"))}
  from docs_all join positions on i < d % 3),
cities_all as (
  select p.*, case when raw_city <> '' then coalesce(c.canonical, {_strip("raw_city")}) end as city,
    case when raw_country_raw <> '' then coalesce(k.canonical, {_strip("raw_country_raw")}) end as stated_country
  from placed_all p left join city_alias c on c.alias = lower({_strip("raw_city")})
    left join country_alias k on k.alias = lower({_strip("raw_country_raw")})),
locations_all as (
  select post_id, prompt_version, month, n_jobs, i, city, raw_region as region,
    case when coalesce(stated_country, '') = '' and city <> '' then x.canonical else stated_country end as country
  from cities_all left join city_country x on x.alias = city),
locations as (select * from locations_all where prompt_version = 'v1'),
classified as (
  select post_id, prompt_version, post_type, company_builds_ai as ai_builds,
    ai_tools_in_workflow as ai_workflow, ai_skills_required as ai_skills
  from fields where prompt_version = 'v1'),
queue as (
  select p.id, t.month from posts p join hiring t on t.id = p.thread_id
  where not exists (select 1 from ledger l where l.post_id = p.id and l.prompt_version = 'v1')),
tried as (
  select g.*, length(sent) as chars, length(sent) % 37 = 0 as failed, length(sent) % 41 = 0 as limited
  from gated g),
pool as (
  select p.id, t.month, coalesce(substring(t.month, 1, 4), '0000') as year,
    md5('{SEED}' || p.id::varchar) as random_order
  from posts p join hiring t on t.id = p.thread_id
  where is_deleted = 0 and is_dead = 0 and length(raw_html) > 100),
ranked as (select *, row_number() over (partition by year order by random_order, id) as place from pool),
sampled as (
  select id, month, year from ranked
  where place <= (select greatest(1, {SAMPLE_SIZE} // count(distinct year)) from pool)
  order by random_order, id limit {SAMPLE_SIZE})
"""


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = PRELUDE + sql


_THREAD = "id, title, kind, month, created_at, num_comments"
_POST = "id, thread_id, author, created_at, raw_html, is_deleted, is_dead, fetched_at"
_LEVEL = f"substring('{V.LEVEL_GLYPHS}', least(floor(n / greatest(max(n) over (), 1) * 7), 7)::int + 1, 1)"

# --- threads and posts ----------------------------------------------------------------------

oracle("thread_pages_source", f"select {_THREAD} from threads")
oracle(
    "thread_items_source",
    f"select {_POST} from posts where thread_id in (select id from threads)",
)
oracle("thread_kinds_and_months", "select id, kind, month from threads")
oracle(
    "threads_upsert",
    """
    select id, case when id % 3 <> 1 then title || ' (edited)' else title end as title, kind, month,
      created_at, case when id % 3 = 1 then num_comments when id % 2 = 0 then num_comments + 1 end as num_comments,
      case when id % 5 <> 0 then fetched_at end as fetched_at
    from threads where id % 5 <> 0 or id % 3 <> 1""",
)
oracle(
    "threads_ingest",
    f"select {_THREAD}, case when id % 5 <> 0 then fetched_at end as fetched_at from threads",
)
oracle(
    "posts_replace",
    f"""
    select id, thread_id, case when id % 6 = 0 then 'third' when id % 2 = 0 then 'second' else author end as author,
      created_at, raw_html,
      case when id % 6 = 0 then '{LATEST}' when id % 2 = 0 then '{LATER}' else fetched_at end as fetched_at
    from posts where id % 4 <> 0 or id % 2 = 0""",
)
ORACLES["posts_merged_in_parts"] = ORACLES["posts_replace"]
oracle(
    "ledger_replace",
    f"""
    select post_id, prompt_version, case when status = 'error' then 'ok' else status end as status,
      null::varchar as error,
      case when status = 'error' then '{LATER}' else created_at end as created_at
    from ledger""",
)
ORACLES["ledger_merged_in_parts"] = ORACLES["ledger_replace"]
oracle(
    "threads_mark_fetched",
    f"""
    select id, case when id in (select thread_id from posts where is_dead = 1) then '{LATER}'
      else fetched_at end as fetched_at
    from threads""",
)
_DUE = "(select id from hiring where coalesce(fetched_at, '') = '')"
oracle(
    "posts_ingest",
    f"""
    select id, thread_id, case when thread_id in {_DUE} then author else 'first' end as author,
      is_deleted, is_dead, case when thread_id in {_DUE} then '{LATER}' else fetched_at end as fetched_at
    from posts where id % 4 <> 0 or thread_id in {_DUE}""",
)
oracle(
    "posts_ingested_into_store",
    f"""
    select p.id, thread_id, case when thread_id in {_DUE} then author else 'first' end as author,
      case when thread_id in {_DUE} then '{LATER}' else p.fetched_at end as fetched_at,
      case when thread_id in {_DUE} then '{LATER}' else t.fetched_at end as thread_fetched_at
    from posts p left join threads t on t.id = p.thread_id
    where p.id % 4 <> 0 or thread_id in {_DUE}""",
)
oracle(
    "posts_ingest_marks",
    f"""
    select id, case when id in {_DUE} and id in (select thread_id from posts) then '{LATER}'
      else fetched_at end as fetched_at
    from threads""",
)
oracle(
    "fetch_totals",
    """
    select thread_id, t.month, count(*) as n,
      (sum(count(*)) over (order by t.month nulls first, thread_id))::bigint as running_total
    from posts p join hiring t on t.id = p.thread_id group by thread_id, t.month""",
)
oracle("threads_of_kind", "select id, title, month from threads where kind = 'seekers'")
oracle("thread_lookup", "select * from threads where id = 5")
oracle(
    "unknown_threads",
    "select distinct conv_id as id from conversations where conv_id not in (select id from threads)",
)
oracle("threads_to_fetch", f"select id, month from hiring where id in {_DUE}")
oracle(
    "orphan_rows",
    """
    select 'posts.thread_id' as relation, count(*) as orphans from posts
      where thread_id not in (select id from threads)
    union all select 'ledger.post_id', count(*) from ledger where post_id not in (select id from posts)
    union all select 'technologies.post_id', count(*) from technologies where post_id % 7 = 0""",
)

# --- text -------------------------------------------------------------------------------------

_MARK = "chr(1)"


def _page_text(html: str) -> str:
    """Plain text of the pages, step by step with regular expressions.

    Entities come first, while their end is still marked by the tag behind them. These
    names may lack the semicolon: some titles are cut off right before it.
    """
    x = html
    for entity, char in (("&middot;?", "·"), ("&copy;?", "©"), ("&quot;?", '"'), ("&amp;?", "&")):
        x = f"regexp_replace({x}, '{entity}', '{char}', 'g')"
    x = f"regexp_replace({x}, '<!--.*?-->|<!DOCTYPE html>', '', 'gs')"
    x = f"""replace({x}, 'var t="</p>"', 'var t="' || chr(2) || '/p>"')"""
    x = f"""regexp_replace({x}, '<a href="([^"]*)">([^<]*)</a>', '\\2 (\\1)', 'g')"""
    x = f"regexp_replace({x}, '</?(p|br|div|li|tr|h[1-6])( [^>]*)?>', {_MARK}, 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    x = f"regexp_replace({x}, '^' || {_MARK} || '+', '')"
    x = f"regexp_replace({x}, '\\n?' || {_MARK} || '+', chr(10), 'g')"
    return _strip(f"replace({x}, chr(2), '<')")


oracle("html_text_of_pages", f"select page_id, {_page_text('html')} as text from pages")
_WITHOUT_CODE = "regexp_replace(html, '<(script|style)>.*?</(script|style)>', '', 'gs')"
oracle("html_text_of_pages_clean", f"select page_id, {_page_text(_WITHOUT_CODE)} as text from pages")
oracle("html_text_of_posts", "select id, body as text from posts")
oracle(
    "page_previews",
    f"""
    select page_id, case when length(t) > 500 then substring(t, 1, 500) || '…' else t end as preview
    from (select page_id, {_strip(
        "regexp_replace(replace(replace(html, '<p>', chr(10)), '</p>', ''), '<[^>]+>', '', 'g')"
    )} as t from pages)""",
)
oracle("extraction_gate", "select id, skipped, truncated, length(sent) as chars from gated")

# --- extraction -------------------------------------------------------------------------------

oracle("extraction_queue", "select id, month from queue")
oracle(
    "extraction_queue_of_month",
    """
    select p.id, t.month from posts p join hiring t on t.id = p.thread_id
    where t.month = '2017-01'
      and p.id not in (select post_id from ledger where prompt_version = 'v2')""",
)
oracle(
    "extraction_queue_retrying_errors",
    """
    select p.id, t.month from posts p join hiring t on t.id = p.thread_id
    where p.id not in (select post_id from ledger where prompt_version = 'v1' and status <> 'error')""",
)
oracle(
    "extraction_queue_head",
    "select id, month from queue order by month desc nulls last, id limit 25",
)
_RUN = f"""
    select id as post_id, 'v3' as prompt_version, 1 as schema_version, 'gpt-4o-mini' as model,
      case when status = 'ok' then '{{"post_type": "job_posting", "hiring_count_hint": "' || chars::varchar || '"}}'
        else '{{}}' end as raw_json,
      case when status = 'ok' then chars // 4 end as input_tokens,
      case when status = 'ok' then chars % 50 end as output_tokens,
      status, case when status = 'error' and failed then 'no answer for ' || chars::varchar || ' characters' end as error,
      '{A.RUN_TS}' as created_at
    from (
      select *, case when skipped then 'skipped_empty' when failed or limited then 'error' else 'ok' end as status
      from tried where thread_id in (select id from hiring))"""
oracle("batch_inference", _RUN)
oracle(
    "checked_inference",
    """
    select post_id, status, error, case when status = 'ok' then chars // 4 end as input_tokens,
      case when status = 'ok' then case when kind = 6 then 1 else 0 end end::int as roles,
      case when status = 'ok' then case when kind in (0, 6) then 'job_posting' else 'seeking_work' end end as post_type,
      case when status = 'ok' then 'unstated' end as stage,
      case when status = 'ok' and kind not in (0, 6) then chars::varchar end as hint,
      case when status = 'ok' and kind = 6 then 'other' end as title_guess,
      case when status = 'ok' and kind = 6 then 120.5::double end as salary_max,
      case when status = 'ok' and kind = 6 then 'unstated' end as salary_period
    from (
      select id as post_id, chars, chars % 11 as kind,
        case when skipped then 'skipped_empty' when chars % 11 in (1, 2, 3, 4, 5, 7) then 'error' else 'ok' end as status,
        case when not skipped then case chars % 11
          when 1 then 'roles[0].title_raw: missing'
          when 2 then 'company.stage: ''series_z'' is not allowed; visa_sponsorship: null instead of text'
          when 3 then 'roles[0].salary.min: text instead of a number'
          when 4 then 'locations: text instead of a list; technologies_raw[1]: null instead of text'
          when 5 then 'answer: null instead of an object'
          when 7 then 'workplace: null instead of an object; hiring_count_hint: number instead of text'
        end end as error
      from tried where thread_id in (select id from hiring))""",
)
oracle(
    "resumed_extraction",
    f"""
    select id as post_id,
      case when skipped then 'skipped_empty' when id % 3 = 1 and (failed or limited) then 'error' else 'ok' end as status,
      case when skipped then null when id % 3 = 1 then case when not (failed or limited) then chars // 4 end else 2 end as input_tokens,
      '{A.RUN_TS}' as created_at
    from tried where thread_id in (select id from hiring)""",
)
_COUNTERS = """
    select count(*) as n, count(*) filter (status = 'ok') as ok, count(*) filter (status = 'error') as error,
      count(*) filter (status = 'skipped_empty') as skipped_empty,
      coalesce(sum(input_tokens), 0)::bigint as input_tokens,
      coalesce(sum(output_tokens), 0)::bigint as output_tokens"""
oracle("extraction_counters", f"{_COUNTERS} from ({_RUN})")
oracle(
    "extraction_error_rate",
    """
    select errors, n, errors / greatest(n, 1) as error_rate, errors / greatest(n, 1) > 0.05 as failed
    from (select count(*) filter (status = 'error') as errors, count(*) as n
          from ledger where prompt_version = 'v1')""",
)
oracle(
    "extraction_dry_run",
    """
    select 'gpt-4o-mini' as model, n as posts, n * 500 as input_tokens, n * 200 as output_tokens,
      n * 500 / 1000000 * 0.15::double + n * 200 / 1000000 * 0.6::double as cost
    from (select count(*) as n from queue)""",
)
oracle(
    "ledger_cost",
    """
    select prompt_version, model, input_tokens, output_tokens,
      input_tokens / 1000000 * coalesce(rate_in, 0) + output_tokens / 1000000 * coalesce(rate_out, 0) as cost
    from (select prompt_version, model, coalesce(sum(input_tokens), 0)::bigint as input_tokens,
            coalesce(sum(output_tokens), 0)::bigint as output_tokens
          from ledger group by all)
    left join prices using (model)""",
)
oracle(
    "in_memory_inference",
    """
    select id as post_id, case when n < 50 or n % 37 = 0 or n % 41 = 0 then '{}'
      else '{"post_type": "job_posting", "hiring_count_hint": "' || n::varchar || '"}' end as raw_json
    from (select id, length(body) as n from posts)""",
)

# --- normalization ----------------------------------------------------------------------------

oracle(
    "decodable_extractions",
    """
    select count(*) as n, count(*) filter (payload <> 'document') as undecodable, 0::bigint as type_mismatches
    from ledger where prompt_version = 'v1' and status = 'ok'""",
)
oracle("jobs", "select * exclude (salary_capped, post_type, has_role) from jobs")
oracle(
    "jobs_of_postings_only",
    "select post_id, role_pos, title_raw from jobs where post_type = 'job_posting'",
)
oracle(
    "job_locations",
    """
    select post_id, p.i::int as role_pos, city, region, country
    from locations l join positions p on p.i < n_jobs""",
)
oracle(
    "job_technologies",
    """
    select post_id, p.i::int as role_pos, tech_raw, tech, aliased
    from technologies t join positions p on p.i < n_jobs""",
)
oracle("post_classification", "select * from classified")
oracle(
    "job_ids",
    "select row_number() over (order by post_id, role_pos) as job_id, post_id, role_pos from jobs",
)
oracle(
    "normalized_rebuild",
    """
    select 'jobs' as table_name, 'v2' as prompt_version, count(*) as n from jobs_all where prompt_version = 'v2'
    union all select 'job_locations', 'v2', sum(n_jobs)::bigint from locations_all where prompt_version = 'v2'
    union all select 'job_technologies', 'v2', sum(n_jobs)::bigint from technologies_all where prompt_version = 'v2'
    union all select 'post_classification', 'v2', count(*) from docs_all where prompt_version = 'v2'""",
)
oracle(
    "versions_side_by_side",
    """
    select step::int as step, table_name, prompt_version, n
    from (values (0, 'v1'), (1, 'v1'), (1, 'v2'), (2, 'v2')) states(step, prompt_version) join (
      select 'jobs' as table_name, prompt_version, count(*) as n from jobs_all group by prompt_version
      union all select 'job_locations', prompt_version, sum(n_jobs)::bigint from locations_all group by prompt_version
      union all select 'job_technologies', prompt_version, sum(n_jobs)::bigint from technologies_all group by prompt_version
      union all select 'post_classification', prompt_version, count(*) from docs_all group by prompt_version
    ) using (prompt_version)""",
)
oracle("technology_aliases", "select tech_raw, tech, aliased, count(*) as n from technologies group by all")
oracle("places", "select city, region, country, sum(n_jobs)::bigint as n from locations group by all")
ORACLES["places_by_alias_files"] = ORACLES["places"]
ORACLES["technology_aliases_by_file"] = ORACLES["technology_aliases"]
ORACLES["ledger_cost_by_price_file"] = ORACLES["ledger_cost"]
oracle(
    "field_mismatches",
    f"""
    , good as (select post_id, d from ledger where prompt_version = 'v1' and status = 'ok' and payload = 'document'),
    found as (
      select 'post_type' as field, count(*) as n from good where post_id % 6 = 0 and {A.POST_FIELDS["post_type"]} is not null
      union all select 'roles.salary.min', count(*) from good join positions on i < d % 4
        where post_id % 6 = 1 and not ({A.SALARY_MISSING}) and {A.SALARY_FIELDS["min"]} is not null
      union all select 'locations', count(*) from good where post_id % 6 = 2
      union all select 'company', count(*) from good where post_id % 6 = 3 and not ({A.COMPANY_MISSING})
      union all select 'technologies_raw', count(*) from good where post_id % 6 = 4 and not ({A.TECHNOLOGIES_MISSING}))
    select field, n::bigint as mismatches from found where n > 0""",
)
oracle("salary_rules", "select post_id, role_pos, salary_period, salary_min, salary_max, salary_capped from jobs")
oracle("currencies", "select salary_currency, count(*) as n from jobs group by all")
oracle("remote_regions", "select remote_region, count(*) as n from jobs group by all")

ORACLES["remote_regions_by_table"] = ORACLES["remote_regions"]
oracle(
    "first_phrases",
    """
    select d.doc_id, case when d.text <> '' then coalesce('doc ' || min(r.doc_id)::varchar, 'none') end as value
    from documents d left join (
      select doc_id, lower(substring(text, 7, (2 + doc_id % 40)::int)) as phrase from documents
      where doc_id % 10 = 0 and substring(text, 7, (2 + doc_id % 40)::int) <> ''
    ) r on contains(lower(d.text), r.phrase)
    group by d.doc_id, d.text""",
)

# --- stats and reports ------------------------------------------------------------------------

_PER_MONTH = """
    select t.month, count(p.id) as n from hiring t left join posts p on p.thread_id = t.id
    where t.month is not null group by t.month"""
oracle("threads_per_kind", "select kind, count(*) as n from threads group by kind")
oracle("total_posts", "select count(*) as posts from posts")
oracle("hiring_months", "select min(month) as first_month, max(month) as last_month from hiring")
oracle("posts_per_month", f"select month, n, {_LEVEL} as level from ({_PER_MONTH})")
oracle(
    "sample_posts",
    f"""
    select id, author, substring(created_at, 1, 10) as date,
      case when length(t) > 500 then substring(t, 1, 500) || '…' else t end as preview
    from (select id, author, created_at, {_strip(
        "regexp_replace(replace(replace(raw_html, '<p>', chr(10)), '</p>', ''), '<[^>]+>', '', 'g')"
    )} as t from posts where raw_html is not null order by md5('{SEED}' || id::varchar), id limit 3)""",
)
oracle(
    "stats_summary",
    f"""
    select 'kind' as section, kind as key, count(*) as n from threads group by kind
    union all select 'posts', 'total', count(*) from posts
    union all select 'first_month', min(month), null from hiring
    union all select 'last_month', max(month), null from hiring
    union all select 'month', month, n from ({_PER_MONTH})""",
)
_DUE_NOW = "(select id from hiring where id % 5 = 0 or coalesce(fetched_at, '') = '')"
oracle(
    "ingest_and_stats",
    f"""
    , landed as (select * from posts where id % 4 <> 0 or thread_id in {_DUE_NOW})
    select 'kind' as section, kind as key, count(*) as n from threads group by kind
    union all select 'posts', 'total', count(*) from landed
    union all select 'first_month', min(month), null from hiring
    union all select 'last_month', max(month), null from hiring
    union all select 'month', month, n from ({_PER_MONTH.replace("join posts", "join landed")})""",
)
_STATUS = "select status, count(*) as n from ledger where prompt_version = 'v1' group by status"
_TYPES = "select post_type, n, n / sum(n) over () * 100 as pct from (select post_type, count(*) as n from classified group by all)"
_VISA = """
    select coalesce(nullif(visa_sponsorship, ''), 'null') as visa_sponsorship, n, n / sum(n) over () * 100 as pct
    from (select visa_sponsorship, count(*) as n from jobs group by all)"""
_COVERAGE = "select count(*) as jobs, count(salary_min) as with_salary, count(salary_min) / count(*) * 100 as pct from jobs"


def _top(source: str, key: str, k: int, where: str = "true", n: str = "sum(n_jobs)::bigint") -> str:
    return f"select {key}, {n} as n from {source} where {where} group by {key} order by n desc, {key} limit {k}"


_TECH = _top("technologies", "tech", 20)
_CITY = _top("locations", "city", 20, "city is not null")
_TITLE = _top("jobs", "title_normalized", 10, "title_normalized is not null", "count(*)")
_UNMAPPED = _top("technologies", "tech_raw", 20, "aliased = 0")
oracle("ledger_status", _STATUS)
oracle("post_types", _TYPES)
oracle("jobs_total", "select count(*) as jobs from jobs")
oracle("salary_coverage", _COVERAGE)
oracle("visa_sponsorship", _VISA)
oracle("top_technologies", _TECH)
oracle("top_technologies_of_jobs", _TECH)
oracle(
    "top_technologies_by_post",
    _top("(select distinct post_id, tech from technologies)", "tech", 20, n="count(*)"),
)
oracle("top_cities", _CITY)
oracle("top_titles", _TITLE)
oracle(
    "jobs_per_month",
    f"select month, n, {_LEVEL} as level from (select month, count(*) as n from jobs group by month)",
)
oracle("unmapped_technologies_as_written", _UNMAPPED)
oracle(
    "unmapped_technologies_cleaned",
    _top(f"(select *, lower({_strip('tech_raw')}) as cleaned from technologies)", "cleaned", 20, "aliased = 0"),
)
oracle(
    "full_report",
    f"""
    select 'extraction_status' as section, status as key, n, null::double as pct from ({_STATUS})
    union all select 'post_type', post_type, n, pct from ({_TYPES})
    union all select 'jobs', 'total', jobs, null from ({_COVERAGE})
    union all select 'jobs', 'with_salary', with_salary, pct from ({_COVERAGE})
    union all select 'visa_sponsorship', visa_sponsorship, n, pct from ({_VISA})
    union all select 'technology', tech, n, null from ({_TECH})
    union all select 'city', city, n, null from ({_CITY})
    union all select 'title', title_normalized, n, null from ({_TITLE})
    union all select 'month', month, count(*), null from jobs group by month
    union all select 'unmapped_technology', tech_raw, n, null from ({_UNMAPPED})""",
)

# --- golden set -------------------------------------------------------------------------------

oracle("golden_pool", "select id, month from pool")
oracle("stratified_sample", "select id, month, year from sampled")
oracle(
    "golden_skeletons",
    """
    select p.id as post_id, s.month, p.raw_html,
      case when n < 50 or n % 37 = 0 or n % 41 = 0 then null else n::varchar end as expected_hint
    from sampled s join (select id, raw_html, length(body) as n from posts) p on p.id = s.id
    where p.id not in (select doc_id from labels)""",
)


def _company(d: str) -> str:
    name = A.COMPANY_FIELDS["name"]
    return f"(select case when not ({A.COMPANY_MISSING}) then {name} end from (select {d} as d))"


oracle(
    "golden_source",
    f"""
    select doc_id as post_id, {_company("doc_id")} as llm_company,
      {_company("doc_id + 1 - quality")} as expected_company, length(raw_html) as chars
    from labels join posts on id = doc_id""",
)
oracle("labelled_golden", "select doc_id as post_id from labels where quality = 0")


def _compared(d: str, missing: str = "false") -> str:
    """Fields of the document ``d`` that the evaluation looks at, all NULL for a missing one."""
    role = "d % 4 > 0"
    columns = {
        "post_type": A.POST_FIELDS["post_type"],
        "company_name": f"case when not ({A.COMPANY_MISSING}) then {A.COMPANY_FIELDS['name']} end",
        "workplace_policy": f"case when not ({A.WORKPLACE_MISSING}) then {A.WORKPLACE_FIELDS['policy']} end",
        "visa_sponsorship": A.POST_FIELDS["visa_sponsorship"],
        "salary_min": f"case when {role} and not ({A.SALARY_MISSING}) then {A.SALARY_FIELDS['min']} end",
        "salary_max": f"case when {role} and not ({A.SALARY_MISSING}) then {A.SALARY_FIELDS['max']} end",
        "roles_count": "greatest(d % 4, 1)",
        "title_guess": f"case when {role} then {A.ROLE_FIELDS['title_guess']} end",
    }
    picks = ", ".join(re.sub(r"\bi\b", str(k), A.TECHNOLOGY) for k in range(3))
    cleaned = f"list_transform([{picks}], lambda t: lower({_strip('t')}))"
    columns["techs"] = f"case when not ({A.TECHNOLOGIES_MISSING}) then {cleaned} else [] end"
    empty = {"roles_count": "1", "techs": "[]"}
    body = ", ".join(
        f"case when {missing} then {empty.get(n, 'null')} else ({e}) end as {n}" for n, e in columns.items()
    )
    return f"select post_id, {body} from (select *, {d} as d, 0 as i from pairs)"


_CANONICAL = """
    (select coalesce(list(distinct coalesce(a.canonical, t.name)), [])
     from unnest({}.techs) t(name) left join tech_alias a on a.alias = t.name)"""


def _scores(labelled: str) -> str:
    from ..plans.golden import ACCURACY_FIELDS

    flags = ", ".join(f"(g.{f} is not distinct from w.{f})::double as {f}" for f in ACCURACY_FIELDS)
    return f"""
    , predicted as (
      select post_id, d from ledger where prompt_version = 'v1' and status = 'ok' and payload = 'document'),
    pairs as (
      select l.doc_id as post_id, l.doc_id + 1 - quality as want_d, p.d as got_d
      from labels l left join predicted p on p.post_id = l.doc_id where {labelled}),
    got as ({_compared("got_d", "got_d is null")}),
    want as ({_compared("want_d")}),
    sets as (
      select post_id, {flags}, {_CANONICAL.format("g")} as got_set, {_CANONICAL.format("w")} as want_set
      from got g join want w using (post_id)),
    scores as (
      select * exclude (got_set, want_set),
        case when len(got_set) = 0 and len(want_set) = 0 then 1.0::double
          else len(list_intersect(got_set, want_set)) / greatest(len(got_set), 1) end as tech_precision,
        case when len(got_set) = 0 and len(want_set) = 0 then 1.0::double
          else len(list_intersect(got_set, want_set)) / greatest(len(want_set), 1) end as tech_recall
      from sets)"""


def _means(labelled: str) -> str:
    from ..plans.golden import ACCURACY_FIELDS

    fields = (*ACCURACY_FIELDS, "tech_precision", "tech_recall")
    return _scores(labelled) + " union all ".join(
        f" select 'v1' as prompt_version, '{f}' as field, round(avg({f}), 6) as score, count(*) as n from scores"
        for f in fields
    )


oracle("golden_scores", _scores("quality = 0") + " select * from scores")
oracle("golden_accuracy", _means("quality = 0"))
oracle("golden_accuracy_with_unchanged", _means("true"))

def _drafts() -> str:
    from ..plans.golden import ACCURACY_FIELDS

    flags = ", ".join(f"(g.{f} is not distinct from w.{f})::double as {f}" for f in ACCURACY_FIELDS)
    return f"""
    , pairs as (select doc_id as post_id, doc_id + 1 - quality as want_d from labels where quality = 0),
    want as ({_compared("want_d")}),
    drafted as (
      select p.post_id, version, length(body) as n, length(body) >= 50 as good
      from pairs p join posts on id = p.post_id, (values ('draft 1'), ('draft 2')) v(version)),
    got as (
      select post_id, version,
        case when good then case when version = 'draft 2' then 'job_posting'
          else ['job_posting', 'seeking_work', 'meta_or_other'][n % 3 + 1] end end as post_type,
        case when good and version = 'draft 1' then 'Company ' || (n % 37)::varchar end as company_name,
        null::varchar as workplace_policy,
        case when good and version = 'draft 1' then ['yes', 'no', 'unstated'][n % 3 + 1] end as visa_sponsorship,
        null::double as salary_min, null::double as salary_max,
        case when good and version = 'draft 2' then greatest(n % 4, 1) else 1 end as roles_count,
        null::varchar as title_guess,
        case when not good then [] when version = 'draft 2' then ['python'] when n % 2 = 1 then ['python', 'golang'] else [] end as techs
      from drafted),
    sets as (
      select post_id, version, {flags}, {_CANONICAL.format("g")} as got_set, {_CANONICAL.format("w")} as want_set
      from got g join want w using (post_id)),
    scores as (
      select * exclude (got_set, want_set),
        case when len(got_set) = 0 and len(want_set) = 0 then 1.0::double
          else len(list_intersect(got_set, want_set)) / greatest(len(got_set), 1) end as tech_precision,
        case when len(got_set) = 0 and len(want_set) = 0 then 1.0::double
          else len(list_intersect(got_set, want_set)) / greatest(len(want_set), 1) end as tech_recall
      from sets)"""


def _measures() -> tuple[str, ...]:
    from ..plans.golden import ACCURACY_FIELDS

    return (*ACCURACY_FIELDS, "tech_precision", "tech_recall")


oracle(
    "golden_versions",
    _drafts() + " union all ".join(
        f" select version as prompt_version, '{f}' as field, round(avg({f}), 6) as score, count(*) as n from scores group by version"
        for f in _measures()
    ),
)
oracle(
    "golden_version_changes",
    _drafts() + " union all ".join(
        f"""
    select 'draft 2' as prompt_version, '{f}' as field, count(*) as n, count(*) filter (b.{f} > a.{f}) as gained,
      count(*) filter (b.{f} < a.{f}) as lost, round(avg(a.{f}), 6) as base_score, round(avg(b.{f}), 6) as score
    from scores a join scores b using (post_id) where a.version = 'draft 1' and b.version = 'draft 2' having count(*) > 0"""
        for f in _measures()
    ),
)

# --- data quality -----------------------------------------------------------------------------


def _violations() -> str:
    from ..schemas import POST_DOMAINS, ROLE_DOMAINS

    names = {"post_type": "stated_type", "company.stage": "company_stage", "company.is_yc": "company_is_yc"}
    parts = [
        (field, names.get(field, field.split(".")[-1]), domain, "fields") for field, domain in POST_DOMAINS.items()
    ] + [(f"roles.{f}", f.split(".")[-1], domain, "roles") for f, domain in ROLE_DOMAINS.items()]
    return " union all ".join(
        f"select '{field}' as field, count(*) as violations from {source} where prompt_version = 'v1' "
        f"and {column} not in ({', '.join(_text(x) for x in domain)})"
        for field, column, domain, source in parts
    )


oracle("domain_violations", _violations())
oracle(
    "missing_required",
    """
    select 'roles.title_raw' as "column", count(*) as missing from jobs where has_role and title_raw is null
    union all select 'title', count(*) from threads where title is null
    union all select 'kind', count(*) from threads where kind is null
    union all select 'month', count(*) from threads where month is null
    union all select 'num_comments', count(*) from threads where num_comments is null""",
)
oracle("capped_salaries", "select count(*) as capped_salaries from jobs where salary_capped")
oracle("truncated_posts", "select count(*) as truncated_posts from gated where truncated and not skipped")

# --- datasets ---------------------------------------------------------------------------------

oracle(
    "technologies_per_month",
    "select month, tech, sum(n_jobs)::bigint as n from technologies group by month, tech",
)


def _leaders(source: str, key: str, n: str) -> str:
    return f"""
    select year, place::int as place, name, n from (
      select *, rank() over (partition by year order by n desc) as place,
        row_number() over (partition by year order by n desc, name) as line
      from (select substring(month, 1, 4) as year, {key} as name, {n} as n from {source}
            where {key} is not null group by all))
    where line <= 5"""


oracle("company_leaderboard", _leaders("jobs", "company_name", "count(*)"))
oracle("city_leaderboard", _leaders("locations", "city", "sum(n_jobs)::bigint"))
oracle("technology_leaderboard", _leaders("technologies", "tech", "sum(n_jobs)::bigint"))
oracle("roles_per_month", "select month, title_normalized, count(*) as n from jobs group by all")
_REMOTE = """
    select month, jobs, remote, remote / jobs * 100 as pct from (
      select month, count(*) as jobs, count(*) filter (workplace_policy = 'remote') as remote
      from jobs group by month)"""
oracle("remote_share", _REMOTE)
oracle("exported_dataset", _REMOTE)
oracle(
    "compared_technologies",
    "select month, "
    + ", ".join(f"coalesce(sum(n_jobs) filter (tech = '{t}'), 0)::bigint as {t}" for t in COMPARED)
    + " from technologies group by month",
)

# --- streams ----------------------------------------------------------------------------------

oracle("posts_stream", f"select {_POST} from posts where thread_id in (select id from threads)")
oracle(
    "posts_of_two_runs",
    """
    select id, thread_id, case when thread_id % 3 = 0 then 'late' else author end as author, fetched_at
    from posts where thread_id in (select id from threads)""",
)
oracle(
    "ledger_stream",
    _RUN.replace("'v3' as", "'v1' as"),
)
oracle("posts_table_scan", "select id, thread_id, author from posts where is_dead = 1")
