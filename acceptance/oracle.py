"""DuckDB SQL for every registered query, written as plain brute-force SQL.

The lookups compare every key with every mapping row here, the map dialect splits
into lists and the pivot names its days, so the checks share no method with the
Spark side.
"""

from acceptance.fixtures import API_LIST, CATALOG, LINES, MAPPING, PAGES, STORE

_TEXT_FIELDS = [
    "apiName", "proxyResponseCode", "errorType", "destination", "apiCreatorTenantDomain",
    "platform", "apiMethod", "apiVersion", "gatewayType", "apiCreator", "responseCacheHit",
    "keyType", "apiId", "applicationName", "targetResponseCode", "requestTimestamp",
    "applicationOwner", "userAgent", "eventType", "apiResourceTemplate", "regionId", "userIp",
    "applicationId",
]
_LATENCIES = [
    "backendLatency", "requestMediationLatency", "responseLatency", "responseMediationLatency",
]
_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def _field(name: str) -> str:
    value = "([^,]+)"
    if name in _LATENCIES:
        value = "([0-9]+)"
    elif name == "correlationId":
        value = "([a-f0-9-]{36})"
    elif name == "apiType":
        value = "([^,}]+)"
    return f"nullif(regexp_extract(log, '{name}={value}', 1), '')"


def _fields(names: list[str]) -> str:
    return ", ".join(f"{_field(n)} as {n}" for n in names)


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def _json(key: str) -> str:
    text = " and json_type(value, '$.log') = 'VARCHAR'" if key == "log" else ""
    return f"case when json_valid(value) then case when json_type(value) = 'OBJECT'{text} then json_extract_string(value, '$.{key}') end end"


def _wall(text: str) -> str:
    """Wall clock: the text without its zone, cut to microseconds."""
    return f"try_cast(left(regexp_replace({text}, '(Z|[+-][0-9][0-9]:[0-9][0-9])$', ''), 26) as timestamp)"


_EVERY_RECORD = f"""lines as ({LINES}),
every_record as (select event_id, file_stem, {_json("log")} as log, {_json("time")} as time,
  {_json("stream")} as stream from lines)"""
RECORDS = f"""{_EVERY_RECORD},
records as (select * from every_record where log is not null and time is not null)"""
_TENANT = _field("apiCreatorTenantDomain")
_CLEAN = " and ".join(
    f"not contains(log, '{w}')"
    for w in ("dummy", "admin", "bimtek", "demo", "internal-key-app", "test")
)
_SCOPE = {"national": f"{_TENANT} = 'carbon.super'", "internal": f"{_TENANT} <> 'carbon.super'"}


def _scoped(level: str, cleanse: bool) -> str:
    return f"{_SCOPE[level]}" + (f" and {_CLEAN}" if cleanse else "")


_THIRTEEN = [
    "apiName", "apiCreator", "apiId", "apiCreatorTenantDomain", "backendLatency",
    "requestMediationLatency", "responseMediationLatency", "applicationId", "applicationName",
    "applicationOwner", "userIp", "proxyResponseCode", "targetResponseCode",
]
_TWENTY_NINE = [*_TEXT_FIELDS, *_LATENCIES, "correlationId", "apiType"]
_RECAP_KEYS = "apiCreator, apiName, applicationOwner, applicationName, userIp, apiCreatorTenantDomain"


def _calls(level: str, cleanse: bool, name: str = "calls") -> str:
    return f"""{name} as (select * from (select file_stem, {_fields(_THIRTEEN)} from records
  where {_scoped(level, cleanse)}) c
  where applicationOwner is distinct from apiCreator and proxyResponseCode = '200' and targetResponseCode = '200')"""


def _first(key: str, column: str) -> str:
    """First mapping text, in order, inside the key, else the default label."""
    return (
        f"coalesce((select arg_min(nama_instansi, ord) from mapping m"
        f" where m.{column} is not null and contains({key}, m.{column})), 'Tidak Terdaftar')"
    )


_MAPPING = f"mapping as ({MAPPING})"


def _lookups(column: str, keys: str, name: str = "found") -> str:
    return f"{name} as (select key, {_first('key', column)} as inst from ({keys}) k)"


def _recap(level: str, cleanse: bool, prefix: str = "") -> str:
    column = "akun_nasional" if level == "national" else "domain"
    p = prefix
    return f"""{_calls(level, cleanse, p + "calls")},
{p}counted as (select {_RECAP_KEYS}, count(*) as occurrence from {p}calls group by all),
{_lookups(column, f"select apiCreator as key from {p}counted union select applicationOwner from {p}counted", p + "found")},
{p}recap as (select coalesce(o.inst, 'Tidak Terdaftar') as instansi_pemilik_api, apiCreator, apiName,
  coalesce(r.inst, 'Tidak Terdaftar') as instansi_api_requester,
  apiCreatorTenantDomain, applicationOwner, applicationName, userIp, occurrence
  from {p}counted left join {p}found o on o.key = apiCreator left join {p}found r on r.key = applicationOwner),
{p}usage as (select instansi_pemilik_api, apiCreator, apiName, apiCreatorTenantDomain,
  cast(sum(occurrence) as bigint) as occurrence from {p}recap
  where instansi_pemilik_api is not null and apiCreator is not null and apiName is not null
  and apiCreatorTenantDomain is not null group by all),
{p}per_key as (select apiName as api_name, apiCreator as created_by,
  case when apiCreatorTenantDomain = 'carbon.super' then 'nasional' else apiCreatorTenantDomain end as domain,
  arg_max(occurrence, (instansi_pemilik_api, apiCreatorTenantDomain)) as n,
  arg_min(instansi_pemilik_api, (instansi_pemilik_api, apiCreatorTenantDomain)) as inst
  from {p}usage group by 1, 2, 3)"""


def _updated(catalog: str, per_key: str) -> str:
    return f"""select c.row_id, c.api_provider, c.created_by, c.api_name, c.api_version, c.domain, c.status,
  c.nama_instansi, case when u.n is not null then u.n else c.occurrence end as occurrence
  from {catalog} c left join {per_key} u using (api_name, created_by, domain)"""


def _inserted(catalog: str, per_key: str) -> str:
    return f"""select created_by as api_provider, created_by, api_name, cast(null as varchar) as api_version,
  domain, 'PUBLISHED' as status, inst as nama_instansi, n as occurrence
  from {per_key} u where not exists (select 1 from {catalog} c where c.api_name = u.api_name
  and c.created_by = u.created_by and c.domain = u.domain)"""


def _upserted(catalog: str, per_key: str) -> str:
    return f"""{_updated(catalog, per_key)} union all
  select cast(null as bigint), * from ({_inserted(catalog, per_key)}) i"""


# --- map dialect ----------------------------------------------------------------------

_INTS = [
    "proxyResponseCode", "backendLatency", "requestMediationLatency", "targetResponseCode",
    "responseLatency", "responseMediationLatency",
]
_EVENT_TEXT = [
    "apiName", "destination", "apiCreatorTenantDomain", "platform", "apiMethod", "apiVersion",
    "gatewayType", "apiCreator", "correlationId", "keyType", "apiId", "applicationName",
    "applicationOwner", "userAgent", "eventType", "apiResourceTemplate", "regionId", "userIp",
    "apiContext", "applicationId", "apiType",
]
_PAIRS = r"""pairs as (select *, list_filter(string_split(regexp_extract(log, 'Metric Value: \{(.*?)\}', 1), ', '),
  lambda x: contains(x, '=')) as parts from {source} where regexp_matches(log, 'Metric Value: \{{.*?\}}'))"""


_USAGE_KEYS = ["instansi_pemilik_api", "apiCreator", "apiName", "apiCreatorTenantDomain"]

# A block whose values hold braces at most one level deep, as those of the lines do.
_BALANCED = r"""pairs as (select *, list_filter(string_split(regexp_extract(log, 'Metric Value: \{((?:[^{}\n]|\{[^{}\n]*\})*)\}', 1), ', '),
  lambda x: contains(x, '=')) as parts from records where regexp_matches(log, 'Metric Value: \{.*?\}'))"""


def _pairs(source: str) -> str:
    return _PAIRS.replace("{source}", source).replace("{{", "{").replace("}}", "}")


def _last(key: str) -> str:
    return f"substr(list_filter(parts, lambda x: starts_with(x, '{key}='))[-1], {len(key) + 2})"


def _typed(keep: str) -> str:
    def own(name: str) -> str:
        return (
            f"case when len(list_filter(parts, lambda x: starts_with(x, '{name}='))) > 0"
            f" then nullif({_last(name)}, '') else nullif({name}, '') end"
        )

    ints = [f"case when regexp_full_match({_last(k)}, '[0-9]+') then try_cast({_last(k)} as integer) end as {k}" for k in _INTS]
    text = [f"nullif({_last(k)}, '') as {k}" for k in _EVENT_TEXT]
    return f"""typed as (select {keep}, {", ".join(ints + text)},
  lower({_last("responseCacheHit")}) = 'true' as responseCacheHit,
  strftime({_wall(_last("requestTimestamp"))}, {_STAMP}) as requestTimestamp,
  {own("stream")} as stream, strftime({_wall(own("time"))}, {_STAMP}) as time
  from pairs where (nullif(time, '') is null or {_wall("time")} is not null)
  and (nullif({_last("requestTimestamp")}, '') is null or {_wall(_last("requestTimestamp"))} is not null))"""


# What some pulled records say of their time: nothing readable, or past midnight.
_PULLED_TIME = """case when event_id % 157 = 0 then 'no time' when event_id % 163 = 0 then '2025-06-21T00:00:01+07:00' else time end"""
_HITS = f"select strftime({_wall('time')}, '%Y-%m-%d %H:%M:%S') as second, count(*) as hits from records where "
_ACCOUNTS = f"accounts as (select {_fields(_THIRTEEN)} from records)"
_KEYS = """keys as (select apiCreator as key from accounts where apiCreator is not null
  union select applicationOwner from accounts where applicationOwner is not null)"""
_EXACT = "(select arg_min(nama_instansi, ord) from mapping m where m.akun_nasional = key)"
_OWNER = (
    f"case when exists (select 1 from mapping m where m.akun_nasional = key) then {_EXACT} else"
    " (select arg_min(nama_instansi, ord) from mapping m where m.domain is not null and contains(key, m.domain)) end"
)
_REQUESTER = (
    f"coalesce(case when exists (select 1 from mapping m where m.akun_nasional = key) then {_EXACT} else"
    " (select arg_min(nama_instansi, ord) from mapping m where m.akun_nasional is not null"
    " and (contains(m.akun_nasional, key) or contains(key, m.akun_nasional))) end, 'Tidak Terdaftar')"
)


def _need(word: str) -> str:
    noise = f"satudata|opendata|{word}data|open|-csw|portal|-|_"
    return f"replace(trim(regexp_replace(lower(api_name), '{noise}', '', 'g')), ' ', '')"


def _by_name(kind: str) -> str:
    limit = f" and tipe_instansi = '{kind}'" if kind else ""
    return (
        "(select arg_min(nama_instansi, ord) from mapping m where (contains(replace(lower(nama_instansi), ' ', ''), needle)"
        f" or contains(lower(akun_nasional), needle) or contains(lower(domain), needle)){limit})"
    )


_MAP_INSTITUTION = f"""with {_MAPPING}, api as ({API_LIST}),
needles as (select *, case when contains(lower(api_name), 'prov') then {_need("prov|")}
  when contains(lower(api_name), 'kab') then {_need("kab|")}
  when contains(lower(api_name), 'kota') then {_need("kota|")} else {_need("")} end as needle from api)
select row_id, api_provider, api_name, case when api_provider is null then null
  when contains(api_provider, '@') then {_first("api_provider", "domain")}
  when api_provider <> 'admin' then {_first("api_provider", "akun_nasional")}
  else coalesce(case when contains(lower(api_name), 'prov') then {_by_name("Provinsi")}
    when contains(lower(api_name), 'kab') then {_by_name("Kabupaten")}
    when contains(lower(api_name), 'kota') then {_by_name("Kota")} else {_by_name("")} end, 'Tidak Terdaftar') end as nama_instansi
from needles"""

_DAYS = [f"logs_2025-06-{d}" for d in range(16, 21)]
_DAY_COLUMNS = ", ".join(
    f"""cast(sum(case when file_stem = '{d}' then 1 else 0 end) as bigint) as "{d}\"""" for d in _DAYS
)

_EXTRACT_KEYS = f"""extract_keys as (select strftime({_wall("time")}, {_STAMP}) as log_timestamp,
  {_field("apiName")} as api_name, {_field("apiCreator")} as api_creator,
  {_field("applicationOwner")} as application_owner, {_field("applicationName")} as application_name from records)"""


def _page_entry(key: str) -> str:
    text = " and json_type(line, '$.log') = 'VARCHAR'" if key == "log" else ""
    return f"case when json_valid(line) then case when json_type(line) = 'OBJECT'{text} then json_extract_string(line, '$.{key}') end end"


ORACLE = {
    "scan_log_lines": f"""with {RECORDS}
select event_id, file_stem, split_part(file_stem, '_', 2) as file_date, log, time, stream from records""",
    "scan_scoped": f"""with {RECORDS}
select event_id, time, log, file_stem from records where {_scoped("national", True)}""",
    "file_date_filter": f"""with {RECORDS}
select event_id, file_stem, split_part(file_stem, '_', 2) as file_date, time from records
where split_part(file_stem, '_', 2) between '2025-06-17' and '2025-06-19'""",
    "tenant_scope": f"""with {RECORDS}
select event_id, 'national' as level from records where {_SCOPE["national"]}
union all select event_id, 'internal' from records where {_SCOPE["internal"]}""",
    "cleansed_lines": f"with {RECORDS} select event_id, log from records where {_CLEAN}",
    "line_quality": f"""with {_EVERY_RECORD}, r as (select l.value, e.log, e.time from lines l join every_record e using (event_id))
select count(*) as lines, count(*) filter (where trim(value) <> '') as non_blank,
  count(*) filter (where log is not null) as decoded,
  count(*) filter (where log is not null and time is not null) as complete from r""",
    "label_line_filter": f"""with {RECORDS}
select event_id, 'gateway' as container, log from records
where event_id % 20 <> 0 and regexp_matches(log, 'Metric Name: apim:response')""",
    "time_range": f"""with {RECORDS} select event_id, time from records
where {_wall("time")} >= timestamp '2025-06-17 00:02:00' and {_wall("time")} < timestamp '2025-06-19 00:05:30'""",
    "bad_dates": f"""with {RECORDS}, stamps as (select case when event_id % 211 = 0 then ' junk' || cast(event_id % 10 as varchar)
  when event_id % 223 = 0 then '2025-13-45 00:00:00' else replace(time, 'T', ' ') end as stamp from records)
select distinct split_part(trim(stamp), ' ', 1) as log_timestamp from stamps
where try_cast(split_part(trim(stamp), ' ', 1) as date) is null""",
    "envelope_records": f"""with lines as ({LINES}), pages as ({PAGES}),
series as (select event_id, unnest(cast(json_extract(value, '$.data.result') as json[])) as s from pages where json_valid(value)),
entries as (select event_id, json_extract_string(s, '$.stream.container') as container,
  unnest(cast(json_extract(s, '$.values') as json[])) as e from series),
parsed as (select event_id, container, cast(json_extract_string(e, '$[0]') as bigint) as store_time,
  json_extract_string(e, '$[1]') as line from entries)
select event_id, container, store_time, {_page_entry("log")} as log, {_page_entry("time")} as time,
  {_page_entry("stream")} as stream from parsed
where {_page_entry("log")} is not null and {_page_entry("time")} is not null""",
    "parse_fields_13": f"with {RECORDS} select event_id, {_fields(_THIRTEEN)} from records",
    "parse_fields_29": f"with {RECORDS} select event_id, {_fields(_TWENTY_NINE)} from records",
    "flat_extract": f"""with {RECORDS}
select event_id, strftime({_wall("time")}, {_STAMP}) as log_timestamp,
  strftime({_wall(_field("requestTimestamp"))}, {_STAMP}) as request_timestamp,
  {", ".join(f"{_field(n)} as {_snake(n)}" for n in _TWENTY_NINE if n not in _LATENCIES and n != "requestTimestamp")},
  {", ".join(f"case when {_field(n)} is null then 0 else try_cast({_field(n)} as bigint) end as {_snake(n)}" for n in _LATENCIES)} from records""",
    "metric_map": f"""with {RECORDS}, {_pairs("records")},
long as (select event_id, i, string_split(parts[i], '=')[1] as key, parts[i] as part
  from (select event_id, parts, unnest(range(1, len(parts) + 1)) as i from pairs) p),
last_pair as (select event_id, key, arg_max(part, i) as part from long group by event_id, key),
joined as (select event_id, string_agg(part, '|' order by key) as metrics from last_pair group by event_id)
select event_id, coalesce(metrics, '') as metrics from pairs left join joined using (event_id)""",
    "metric_values_long": f"""with {RECORDS}, {_pairs("records")},
long as (select event_id, i, string_split(parts[i], '=')[1] as key, parts[i] as part
  from (select event_id, parts, unnest(range(1, len(parts) + 1)) as i from pairs) p),
last_pair as (select event_id, key, substr(arg_max(part, i), length(key) + 2) as value from long group by event_id, key),
kinds as (select *, case when lower(value) in ('true', 'false') then 'bool'
  when regexp_full_match(value, '[0-9]+') and try_cast(value as bigint) is not null then 'int' else 'str' end as kind from last_pair)
select event_id, key, kind, case when kind = 'str' then value end as str_value,
  case when kind = 'int' then try_cast(value as bigint) end as int_value,
  case when kind = 'bool' then lower(value) = 'true' end as bool_value from kinds""",
    "typed_events": f"""with {_EVERY_RECORD}, readable as (select * from every_record where log is not null),
{_pairs("readable")}, {_typed("event_id")} select * from typed""",
    "lookup_first_substring": f"""with {RECORDS}, {_MAPPING}, {_ACCOUNTS},
counted as (select apiCreator, applicationOwner, count(*) as occurrence from accounts group by all)
select *, {_first("apiCreator", "akun_nasional")} as creator_national, {_first("apiCreator", "domain")} as creator_internal,
  {_first("applicationOwner", "akun_nasional")} as owner_national from counted""",
    "owner_lookup": f"""with {RECORDS}, {_MAPPING}, {_ACCOUNTS}, {_KEYS} select key, {_OWNER} as nama_instansi from keys""",
    "requester_lookup": f"""with {RECORDS}, {_MAPPING}, {_ACCOUNTS}, {_KEYS} select key, {_REQUESTER} as nama_instansi from keys""",
    "map_institution": _MAP_INSTITUTION,
    "all_dataset": f"""with {RECORDS} select apiName, apiCreator, backendLatency, requestMediationLatency, apiId,
  applicationName, applicationOwner, responseMediationLatency, applicationId
from (select {_fields(_THIRTEEN)} from records where {_scoped("internal", True)}) d""",
    "recap_aggregated": f"with {RECORDS}, {_MAPPING}, {_recap('internal', True)} select * from recap",
    "recap_national": f"with {RECORDS}, {_MAPPING}, {_recap('national', False)} select * from recap",
    "recap_daily_long": f"""with {RECORDS}, {_calls("internal", True)}
select {_RECAP_KEYS}, file_stem, count(*) as occurrence from calls group by all""",
    "recap_daily_pivot": f"""with {RECORDS}, {_MAPPING}, {_recap("internal", True)},
days as (select {_RECAP_KEYS}, {_DAY_COLUMNS} from calls group by {_RECAP_KEYS})
select r.*, {", ".join(f'd."{d}"' for d in _DAYS)} from recap r join days d
  on {" and ".join(f"d.{k} is not distinct from r.{k}" for k in _RECAP_KEYS.split(", "))}""",
    "hits_per_second": f"with {RECORDS} {_HITS} {_scoped('internal', False)} group by 1",
    "hits_summary": f"""with {RECORDS}, h as ({_HITS} {_scoped("national", False)} group by 1)
select max(hits) as maximum_concurrent_hits, arg_min(second, (-hits, second)) as timestamp_of_maximum_hits,
  count(*) as total_unique_seconds, cast(sum(hits) as double) / count(*) as average_hits_per_second from h""",
    "usage_by_date": f"""with {RECORDS}, {_MAPPING}, {_EXTRACT_KEYS},
grouped as (select left(log_timestamp, 10) as log_timestamp, api_name, api_creator, application_owner, application_name,
  count(*) as occurrence from extract_keys where log_timestamp is not null and api_name is not null and api_creator is not null
  and application_owner is not null and application_name is not null group by all),
owners as (select key, {_OWNER} as inst from (select distinct api_creator as key from grouped) k),
requesters as (select key, {_REQUESTER} as inst from (select distinct application_owner as key from grouped) k)
select log_timestamp, o.inst as nama_instansi_pemilik_api, api_name, api_creator, r.inst as nama_instansi_requester,
  application_owner, application_name, occurrence
from grouped left join owners o on o.key = api_creator left join requesters r on r.key = application_owner""",
    "accumulate_usage": f"with {RECORDS}, {_MAPPING}, {_recap('internal', True)} select * from usage",
    "catalog_update": f"""with {RECORDS}, {_MAPPING}, catalog as ({CATALOG}), {_recap("internal", True)}
{_updated("catalog", "per_key")}""",
    "catalog_insert": f"""with {RECORDS}, {_MAPPING}, catalog as ({CATALOG}), {_recap("internal", True)}
{_inserted("catalog", "per_key")}""",
    "catalog_upsert": f"""with {RECORDS}, {_MAPPING}, catalog as ({CATALOG}), {_recap("national", True, "a_")}, {_recap("internal", True, "b_")},
first_step as ({_upserted("catalog", "a_per_key")}) {_upserted("first_step", "b_per_key")}""",
    "scan_text_files": f"""with {RECORDS}
select file_stem, split_part(file_stem, '_', 2) as file_date, log, time, stream from records
where file_stem in ('logs_2025-06-17', 'logs_2025-06-18')""",
    "scan_typed_events": f"""with {_EVERY_RECORD}, readable as (select * from every_record where log is not null),
{_pairs("readable")}, {_typed("file_stem")}
select split_part(file_stem, '_', 2) as day, apiName, proxyResponseCode, responseCacheHit, backendLatency, apiCreator, userIp,
  time, requestTimestamp from typed where split_part(file_stem, '_', 2) between '2025-06-17' and '2025-06-19'""",
    "scan_extract_csv": f"with {RECORDS}, {_EXTRACT_KEYS} select * from extract_keys",
    "scan_mapping": f"with {_MAPPING} select ord, akun_nasional, domain, nama_instansi || ' \"Pusat\", Kota' as nama_instansi, tipe_instansi, 'n' || ord as kode from mapping",
    "scan_catalog": f"with catalog as ({CATALOG}) select api_provider, created_by, api_name, api_version, domain, status, nama_instansi, occurrence, cast(row_id as varchar) as row_id from catalog",
    "land_pulled_events": f"""with {_EVERY_RECORD}, readable as (select event_id, file_stem, log, stream, {_PULLED_TIME} as time from every_record where log is not null and time is not null),
{_pairs("readable")}, {_typed("event_id")}
select left(time, 10) as day, event_id % 2 = 0 as morning, apiName, userIp, time from typed""",
    "land_pulled_records": f"""with {RECORDS}, pulled as (select log, {_PULLED_TIME} as time, 'pod-' || event_id % 3 as pod from records)
select case when {_wall("time")} is null then 'unknown' else left(time, 10) end as file_date, log, time, pod from pulled""",
    "stream_without_repeats": f"with {RECORDS} select distinct time, log from records",
    "stream_hits_per_second": f"with {RECORDS} {_HITS} {_scoped('internal', False)} group by 1",
    "stream_ingest": f"""with {_EVERY_RECORD}, readable as (select * from every_record where log is not null),
{_pairs("readable")}, {_typed("file_stem")}
select split_part(file_stem, '_', 2) as day, apiName, count(*) as events, cast(sum(backendLatency) as bigint) as latency
from typed group by all""",
    "ingest_landed_records": f"""with {_EVERY_RECORD}, readable as (select event_id, file_stem, log, stream, own as time, left(own, 10) as own_day
  from (select *, {_PULLED_TIME} as own from every_record where log is not null and time is not null) x where {_wall("own")} is not null),
{_pairs("readable")}, {_typed("own_day")}
select own_day as day, apiName, userIp, time from typed where own_day between '2025-06-17' and '2025-06-21'""",
    "pull_range": f"with {RECORDS} select log, time, stream from records",
    "pull_pushed": f"""with {RECORDS}, store as ({STORE})
select log, time, stream from records join store using (event_id)
where store_time >= 1750039200000000000 and store_time < 1750104000000000000 and container = 'gateway' and contains(value, 'proxyResponseCode=200')""",
    "metric_map_balanced": f"""with {RECORDS}, {_BALANCED},
long as (select event_id, i, string_split(parts[i], '=')[1] as key, parts[i] as part
  from (select event_id, parts, unnest(range(1, len(parts) + 1)) as i from pairs) p),
last_pair as (select event_id, key, arg_max(part, i) as part from long group by event_id, key),
joined as (select event_id, string_agg(part, '|' order by key) as metrics from last_pair group by event_id)
select event_id, coalesce(metrics, '') as metrics from pairs left join joined using (event_id)""",
    "events_in_time_order": f"""with {_EVERY_RECORD}, readable as (select * from every_record where log is not null),
{_pairs("readable")}, {_typed("file_stem")}
select split_part(file_stem, '_', 2) as day, 0 as out_of_order, count(*) as events from typed group by all""",
    "extract_undivided": f"with {RECORDS}, {_EXTRACT_KEYS} select * from extract_keys",
    "report_in_order": f"""with {RECORDS}, {_MAPPING}, {_recap('internal', True)}
select *, cast(row_number() over (order by {", ".join(f"{k} nulls first" for k in _USAGE_KEYS)}) as integer) as place from usage""",
    "catalog_without_counts": f"with catalog as ({CATALOG}) select api_provider, created_by, api_name, api_version, domain, status, nama_instansi, cast(row_id as varchar) as row_id, cast(null as bigint) as occurrence from catalog",
}
ORACLE["catalog_written_back"] = ORACLE["catalog_upsert"]
ORACLE["stream_landed_days"] = ORACLE["stream_ingest"]
