"""DuckDB SQL of the registered queries."""

from flowlens.llm.url_fixture import DUCKDB, captures_sql, feed_sql

HOST = ("regexp_replace(regexp_extract(lower(url),"
        r" '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)', 1), '[.]+$', '')")
ADDRESS = r"regexp_matches(host, '^(?:[0-9]{1,3}(?:[.][0-9]{1,3}){3}|\[.*)$')"
PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"

URL_FILTERS = f"""
with captures as ({captures_sql('pages')}),
parts as (
  select distinct url, {HOST} as host, list_filter(string_split({PATH}, '/'), lambda s: s <> '') as segs
  from pages where url is not null),
names as (
  select distinct host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain,
    host || '/' || segs[1] as path from parts),
feed as ({feed_sql('names', DUCKDB)}),
entries as (
  select list_name, pattern, listed_at, max(action) as action from feed group by all),
intervals as (
  select * from (
    select list_name, pattern, action, listed_at as valid_from,
      lead(listed_at) over (partition by list_name, pattern order by listed_at) as valid_to from entries)
  where action = 'add'),
keys as (
  select url, unnest(list_distinct(list_concat(
    case when {ADDRESS} then [host] else list_transform(range(1, len(string_split(host, '.')) + 1),
      lambda i: array_to_string(list_slice(string_split(host, '.'), i, -1), '.')) end,
    list_transform(range(1, len(segs) + 1),
      lambda i: host || '/' || array_to_string(list_slice(segs, 1, i), '/'))))) as pattern
  from parts where host <> ''),
active as (
  select distinct c.url, c.fetched_at, i.list_name, i.pattern
  from captures c join keys k on c.url = k.url
  join intervals i on k.pattern = i.pattern and i.valid_from <= c.fetched_at
    and (i.valid_to is null or c.fetched_at < i.valid_to)),
verdicts as (
  select url, fetched_at, string_agg(distinct list_name, ',' order by list_name) as lists,
    count(*) as n, bool_or(list_name = 'allow') as allowed
  from active group by all)
select c.page_id, c.url, c.fetched_at, coalesce(v.lists, '') as lists,
  cast(coalesce(v.n, 0) as bigint) as n_entries,
  coalesce(not v.allowed, false) as blocked
from captures c left join verdicts v on c.url = v.url and c.fetched_at = v.fetched_at
"""

FILL_MIDDLE = r"""
with docs as (
  select doc_id, coalesce(text, '') as text,
    sha256('42:' || coalesce(cast(doc_id as varchar), '')) as digest from documents),
tokens as (
  select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t,
    list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(digest, i, 8) as bigint)) as h
  from docs),
cuts as (
  select *, len(t) as n, least(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) as a,
    greatest(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
      or h[3] % 100 >= 50 then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form
  from tokens),
pieces as (
  select doc_id, text, n, form, array_to_string(t[1:a], '') as pre,
    array_to_string(t[a + 1:b], '') as mid, array_to_string(t[b + 1:], '') as suf from cuts)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(pre) end as prefix_chars,
  case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256
from pieces
"""

ORACLES: dict[str, str] = {"op2_url_filters": URL_FILTERS, "op11_fill_middle": FILL_MIDDLE}
