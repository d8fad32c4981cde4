"""The registered queries as SQL for DuckDB, written from the definitions and not from the Spark code."""

from __future__ import annotations

STAGED = r"""
with n as (select count(*) as n from pages),
fx as (
  select e.event_id as eid,
         cast(e.ts as date) as day,
         cast(cast(e.ts as date) as varchar) as date,
         epoch_us(e.ts) // 1000 as timestamp,
         cast(e.event_id as varchar) as event_id,
         e.event_type as event_name,
         e.user_id,
         'u' || e.user_id as uid,
         e.value,
         cast(json_extract_string(e.props, '$.k') as bigint) as k,
         'v' || (case when e.user_id % 30 = 29 then e.user_id // 3 else (e.user_id + e.event_id % 2) // 3 end) as avid,
         l.page_id,
         l.url as landing_url,
         r.url as referrer_url,
         nullif(regexp_extract(l.url, '^https?://([^/?#]+)', 1), '') as landing_host,
         nullif(regexp_extract(l.url, '[?&]utm_source=([^&#]*)', 1), '') as utm_source,
         nullif(regexp_extract(r.url, '^https?://([^/?#]+)', 1), '') as referrer_host,
         regexp_extract(l.url, '^https?://[^/?#]+([^?#]*)', 1) as landing_path,
         regexp_extract(l.url, '\?([^#]*)', 1) as landing_query
  from events e cross join n
  left join pages l on l.page_id = e.event_id % n.n
  left join pages r on e.event_id % 4 <> 0 and r.page_id = (e.event_id * 7 + 3) % n.n
)
"""

# Hosts of the excluded-referrers fixture.
EXCLUDED_HOSTS = "('spam-farm.example.org', 'www.cheap-pills.example.com')"

SENT = STAGED + r""",
sent as (
  select fx.*, c.copy,
         'event_collector_1-' || (cast(substr(avid, 2) as bigint) % 4) || '-' || (eid * 2 + c.copy) as message_id,
         timestamp + 2000 as publish_ms
  from fx, (values (0), (1)) c(copy)
  where c.copy = 0 or eid % 40 = 5
),
fate as (
  select *, case eid % 100 when 9 then 'empty message' when 7 then 'does not fit the schema'
                           when 13 then 'does not fit the schema' when 17 then 'no event_id' end as reason
  from sent
)
"""

PROCESSED = """
select distinct event_id, date, landing_host as landing_hostname, landing_path as landing_page_path,
       case when landing_query = '' then 0::bigint else len(string_split(landing_query, '&')) end as params
from fate where reason is null and eid % 50 <> 0
"""

SOURCED = STAGED + f""",
src as (
  select *,
    coalesce(utm_source,
      case when referrer_host is not null and referrer_host is distinct from landing_host
                and referrer_host not in {EXCLUDED_HOSTS} then referrer_host end) as source,
    case when utm_source is null and referrer_host is not null and referrer_host is distinct from landing_host
                and referrer_host not in {EXCLUDED_HOSTS} then 'referral' end as medium
  from fx
),
touches as (select * from src where event_name in ('click', 'view') and source is not null)
"""

PAIRS = SOURCED + """,
conv as (select * from src where event_name = 'purchase'),
pairs as (
  select c.event_id as conversion, c.uid, c.value, t.event_id as touch, t.source, t.medium,
         row_number() over (partition by c.event_id order by t.timestamp, t.event_id) as place,
         row_number() over (partition by c.event_id order by t.timestamp desc, t.event_id desc) as place_from_end,
         count(*) over (partition by c.event_id) as touches
  from conv c join touches t on t.uid = c.uid
   and (t.timestamp, t.event_id) < (c.timestamp, c.event_id)
   and c.timestamp - t.timestamp <= 7 * 86400000
)
"""


def _one_touch(place: str) -> str:
    return PAIRS + f"""
select c.event_id, c.uid as profile, p.source, p.medium, p.touch as touch_event_id, c.value
from conv c left join pairs p on p.conversion = c.event_id and p.{place} = 1
"""


def _shares(count_units: str, value_units: str) -> str:
    """Shares in units of 1e-9, rounded half up as integers."""
    return PAIRS + f""",
units as (select *, cast(round(value * 1000000) as hugeint) * 1000 as v from pairs),
shares as (select uid, touch, source, {count_units} as c, {value_units} as w from units)
select touch as event_id, uid as profile, source, cast(sum(c) as double) / 1e9 as conversions,
       cast(sum(w) as double) / 1e9 as value
from shares group by 1, 2, 3
union all
select event_id, uid, null, 1.0, value from conv where event_id not in (select conversion from pairs)
"""


def _half_up(amount: str, parts: str) -> str:
    return f"(2 * {amount} + {parts}) // (2 * {parts})"


EVEN_COUNT, EVEN_VALUE = _half_up("1000000000", "touches"), _half_up("v", "touches")


def _by_position(even: str, end: str, inner: str) -> str:
    return (
        f"case when touches <= 2 then {even} when place = 1 or place_from_end = 1 then {end} "
        f"else {_half_up(inner, '(touches - 2)')} end"
    )


FIGURES = STAGED + """,
figures as (
  select user_id % 3 as net, day, date, page_id, landing_url, landing_host, landing_path,
         coalesce(utm_source, landing_host) as source,
         count(*) filter (where event_name = 'view') as impressions,
         count(*) filter (where event_name = 'click') as clicks,
         count(distinct user_id) as reach,
         cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
  from fx where event_name in ('click', 'view')
  group by all
),
rows_all as (
  select f.*, s.inserted_at, 'acc' || (page_id % 2) as ad_account_id,
         case when page_id % 10 = 9 then 'ghost' else 'c' || (page_id % 10) end as campaign,
         case when s.inserted_at = 1 then (cents // 2) / 100.0::double else cents / 100.0::double end as cost
  from figures f, (values (1), (2)) s(inserted_at)
),
current_rows as (
  select * from rows_all r
  where inserted_at = (select max(inserted_at) from rows_all m
                       where m.net = r.net and m.ad_account_id = r.ad_account_id and m.day = r.day)
),
manual as (
  select date, page_id, landing_url, landing_host, landing_path, coalesce(utm_source, landing_host) as source,
         count(distinct user_id) as reach, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
  from fx where event_name = 'signup' group by all
)
"""


def _network(number: int, name: str, term: str, adset: str) -> str:
    group_id = "'as1'" if adset else "cast(null as varchar)"
    group_name = "'first set'" if adset else "cast(null as varchar)"
    campaign_id = "'c' || (page_id % 10)" if adset else "cast(null as varchar)"
    return f"""
select date, '{name}' as data_source, source, 'cpc' as medium, campaign, {term} as term,
       landing_host as landing_hostname, landing_path as landing_page_path, cost, 'USD' as currency,
       impressions, reach, clicks, cast(page_id as varchar) as ad_id,
       {group_id} as adgroup_id, {group_name} as adgroup_name, {campaign_id} as campaign_id
from current_rows where net = {number}
"""


NO_TEXT = "cast(null as varchar)"
FACEBOOK = _network(0, "facebook_ads", NO_TEXT, "adset")
GOOGLE = _network(1, "google_ads", "'kw'", "")
TIKTOK = _network(2, "tiktok_ads", NO_TEXT, "")
MANUAL = f"""
select date, 'manual', source, 'cpc', 'c' || (page_id % 10), {NO_TEXT}, landing_host, {NO_TEXT},
       cents / 100.0::double, 'USD', cast(null as bigint), reach, cast(null as bigint), cast(page_id as varchar),
       {NO_TEXT}, {NO_TEXT}, {NO_TEXT}
from manual where page_id % 10 <> 3
"""
UNIFIED = f"{FACEBOOK} union all {GOOGLE} union all {TIKTOK} union all {MANUAL}"


def _components(links: str) -> str:
    return STAGED.replace("with n as", "with recursive n as", 1) + f""",
links as ({links}),
ways as (select a, b from links union select b, a from links),
walk(node, root) as (
  select distinct node, node from (select 'avid:' || avid as node from fx union select 'ext:user_id:' || uid from fx
                                   union select a from links union select b from links)
  union
  select w.b, walk.root from walk join ways w on w.a = walk.node
),
profiles as (select node, min(root) as profile_id from walk group by node)
"""


LINKS = "select distinct 'avid:' || avid as a, 'ext:user_id:' || uid as b from fx"
CONTACTS = LINKS + """
    union select 'avid:' || avid, 'email:u' || user_id || '@example.com' from fx where eid % 10 = 0
    union select 'avid:' || avid, 'phone:1555' || user_id from fx where eid % 10 = 5"""

DEALS = STAGED + """,
deals as (
  select 'd' || user_id as id, ['created', 'paid', 'refunded'][k % 3 + 1] as status, value,
         case when k % 3 >= 1 then value else 0 end as paid_value,
         case when k % 3 = 2 then value / 2 else 0 end as refund_value,
         case when user_id % 2 = 0 then 'USD' else 'EUR' end as currency, event_id as state_event_id
  from fx where event_name = 'signup'
  qualify row_number() over (partition by user_id order by timestamp desc, event_id desc) = 1
)
"""

GEO = STAGED + """,
places as (
  select case when user_id % 4 <> 3 then ['Americas', 'Europe', 'Europe'][user_id % 4 + 1] end as continent,
         case when user_id % 4 <> 3 then ['US', 'DE', 'FR'][user_id % 4 + 1] end as country,
         case when user_id % 4 <> 3 then 'city' || (user_id % 8) end as city, uid
  from fx
)
"""

DEVICES = STAGED + """,
devices as (
  select ['desktop', 'mobile', 'tablet'][eid % 3 + 1] as category,
         ['ios', 'android', 'windows'][user_id % 3 + 1] as operating_system,
         case when eid % 2 = 0 then 'firefox' else 'chrome' end as browser, uid
  from fx
)
"""

KEPT = "not (event_name = 'signup' and referrer_url is not null)"

# Column paths of the raw table with their type, and the rows that hold a value there.
PATHS = """
date|date|all
timestamp|bigint|all
event_id|string|all
event_name|string|all
event_params[].key|string|all
event_params[].value.string_value|string|all
event_params[].value.int_value|bigint|all
event_params[].value.double_value|double|all
event_params[].value.boolean_value|boolean|
user_data.first_name|string|
user_data.last_name|string|
user_data.full_name|string|
user_data.gender|string|
user_data.age|bigint|all
user_data.phone_number|string|eid % 10 = 5
user_data.email|string|eid % 10 = 0
user_data.country|string|
user_data.region|string|
user_data.city|string|
user_properties[].key|string|all
user_properties[].value.string_value|string|all
user_properties[].value.int_value|bigint|eid % 100 = 7
user_properties[].value.double_value|double|
user_properties[].value.boolean_value|boolean|
user_external_ids[].key|string|all
user_external_ids[].value|string|all
avid|string|all
ad_data[].ad_network|string|event_name in ('click', 'view')
ad_data[].values[].key|string|event_name in ('click', 'view')
ad_data[].values[].value|string|event_name in ('click', 'view')
deal.id|string|event_name = 'signup'
deal.status|string|event_name = 'signup'
deal.manager|string|
deal.value|double|event_name = 'signup'
deal.paid_value|double|event_name = 'signup'
deal.refund_value|double|event_name = 'signup'
deal.currency|string|event_name = 'signup'
deal.promo_action|string|
deal.discount_amount|double|
deal.discount_percentage|double|
deal.payment_method|string|
deal.custom_params[].key|string|
deal.custom_params[].value.string_value|string|
deal.custom_params[].value.int_value|bigint|
deal.custom_params[].value.double_value|double|
deal.custom_params[].value.boolean_value|boolean|
offers[].id|string|event_name = 'view' and eid % 3 >= 1
offers[].name|string|event_name = 'view' and eid % 3 >= 1
offers[].value|double|event_name = 'view' and eid % 3 >= 1
offers[].currency|string|event_name = 'view' and eid % 3 >= 1
offers[].promo_action|string|
offers[].discount_amount|double|
offers[].discount_percentage|double|event_name = 'view' and eid % 3 >= 2
order.id|string|event_name = 'purchase'
order.status|string|event_name = 'purchase'
order.manager|string|
order.value|double|event_name = 'purchase'
order.paid_value|double|event_name = 'purchase'
order.refund_value|double|event_name = 'purchase'
order.currency|string|event_name = 'purchase'
order.shipping|double|
order.tax|double|
order.promo_action|string|
order.discount_amount|double|
order.discount_percentage|double|
order.payment_method|string|
order.custom_params[].key|string|
order.custom_params[].value.string_value|string|
order.custom_params[].value.int_value|bigint|
order.custom_params[].value.double_value|double|
order.custom_params[].value.boolean_value|boolean|
products[].id|string|event_name = 'purchase' and eid % 4 >= 1
products[].name|string|
products[].brand|string|
products[].category|string|event_name = 'purchase' and eid % 4 >= 1
products[].sku|string|
products[].quantity|bigint|event_name = 'purchase' and eid % 4 >= 1
products[].value|double|event_name = 'purchase' and eid % 4 >= 1
products[].currency|string|event_name = 'purchase' and eid % 4 >= 1
products[].promo_action|string|
products[].discount_amount|double|event_name = 'purchase' and eid % 4 >= 2
products[].discount_percentage|double|event_name = 'purchase' and eid % 4 >= 3
transaction.id|string|event_name = 'purchase'
transaction.status|string|event_name = 'purchase'
transaction.value|double|event_name = 'purchase'
transaction.currency|string|event_name = 'purchase'
transaction.tax|double|
transaction.payment_method|string|
transaction.deal_id|string|event_name = 'purchase' and eid % 2 = 0
transaction.order_id|string|event_name = 'purchase'
transaction.custom_params[].key|string|
transaction.custom_params[].value.string_value|string|
transaction.custom_params[].value.int_value|bigint|
transaction.custom_params[].value.double_value|double|
transaction.custom_params[].value.boolean_value|boolean|
geo.continent|string|user_id % 4 <> 3
geo.sub_continent|string|
geo.country|string|user_id % 4 <> 3
geo.region|string|
geo.city|string|user_id % 4 <> 3
device_info.category|string|all
device_info.mobile_brand_name|string|
device_info.mobile_model_name|string|
device_info.operating_system|string|all
device_info.operating_system_version|string|
device_info.language|string|
device_info.timezone|string|
device_info.timezone_offset_seconds|bigint|all
device_info.ip|string|
device_info.screen_resolution|string|
device_info.web_info.browser|string|all
device_info.web_info.browser_version|string|
device_info.web_info.user_agent|string|
is_test_event|boolean|eid % 50 <> 1
"""


def _contracts() -> str:
    counts = []
    for line in PATHS.strip().splitlines():
        path, kind, rule = line.split("|")
        condition = {"all": "true", "": "false"}.get(rule, rule)
        counts.append(
            f"select '{path}' as path, '{kind}' as type, count(*) filter (where {condition}) as rows_set from fx"
        )
    return STAGED + " union all ".join(counts)


MATERIALIZED = """
select event_name, date, count(*) as events, cast(sum(cast(value as decimal(38, 6))) as double) as total
from fx group by 1, 2
"""


def _units() -> str:
    return STAGED + " union all ".join(
        f"select '{unit}' as unit, "
        f"substr(replace(cast(make_timestamp(timestamp * 1000) as varchar), ' ', '-'), 1, {length}) as partition_time, "
        "count(*) as events from fx group by all"
        for unit, length in (("HOUR", 13), ("DAY", 10), ("MONTH", 7), ("YEAR", 4))
    )


ORACLES: dict[str, str] = {
    "ingest_raw_events": SENT + """
select event_id, date, timestamp, event_name, avid,
       3 + cast(referrer_url is not null as bigint) as params,
       case when event_name = 'purchase' then eid % 4 else 0 end as product_lines,
       case when event_name not in ('click', 'view') then 0 when eid % 3 = 0 then 2::bigint else 1 end as ad_networks,
       case when event_name = 'purchase' then value else 0 end as order_value,
       eid % 50 = 0 as is_test
from fate where reason is null
""",
    "ingest_unknown_fields": SENT + """
select message_id, coalesce(reason, case eid % 20 when 3 then 'unknown fields: extra'
                                                  when 4 then 'unknown fields: device_info.zip' end) as reason
from fate where reason is not null or eid % 20 in (3, 4)
""",
    "ingest_filter": SENT + """
select event_id, date, event_name from fate where reason is null and event_name = 'purchase'
""",
    "ingest_quarantine": SENT + "select message_id, reason from fate where reason is not null",
    "land_messages": SENT + """
select 'bigquery_raw_events_1' as subscription_name, message_id, publish_ms,
       '{"event_name":"' || event_name || '"}' as attributes,
       case when eid % 100 not in (7, 9, 17) then event_id end as data_event_id
from fate
""",
    "replay_window": SENT + """
select event_id, date, event_name from fate
where reason is null and publish_ms >= (select max(publish_ms) - 2678400000 from fate)
""",
    "replay_into_table": SENT + """
select distinct event_id, date, event_name from fate
where reason is null and day <> (select max(day) from fate where reason is null)
""",
    "ingest_fanout": SENT + """
select 'sink' as consumer, event_name, count(*) as events from fate where reason is null group by 1, 2
union all
select 'processor', event_name, count(distinct event_id) from fate where reason is null and eid % 50 <> 0 group by 1, 2
""",
    "process_events_stream": SENT + PROCESSED,
    "process_events_late": SENT + PROCESSED,
    "dedupe_events": STAGED + "select event_id, timestamp, event_name from fx",
    "table_contracts": _contracts(),
    "bootstrap_twice": FIGURES + """
select 'raw_events' as table_name, count(*) as rows_stored from fx
union all select 'identified_events', 0
union all select 'ad_costs', 0
union all select 'facebook_ads_ad_costs', count(*) from rows_all where net = 0
union all select 'google_ads_ad_costs', count(*) from rows_all where net = 1
union all select 'tiktok_ads_ad_costs', count(*) from rows_all where net = 2
union all select 'excluded_referrers', 1
""",
    "partition_by_unit": _units(),
    "retention_survivors": STAGED + """
select date, count(*) as events from fx where day >= (select max(day) - interval 10 day from fx) group by 1
""",
    "partition_guard": STAGED + "select date, count(*) as events from fx group by 1",
    "excluded_referrers": STAGED + f"""
select referrer_host, count(*) as events from fx where referrer_host in {EXCLUDED_HOSTS} group by 1
""",
    "materialize_truncate": STAGED + MATERIALIZED,
    "materialize_append": STAGED + f"select * from ({MATERIALIZED}) union all select * from ({MATERIALIZED})",
    "materialize_empty": STAGED + MATERIALIZED,
    "config_enriched": STAGED + """
select event_id, user_id % 5 as project_id,
       case when user_id % 5 = 3 then 'Europe/Berlin' else 'UTC' end as timezone, 'USD' as currency,
       cast(greatest(user_id % 5, 1) as double) as threshold, user_id % 5 = 2 and event_name = 'error' as ignored
from fx
""",
    "job_last_run": STAGED + """,
runs as (
  select ['check_unattributed_events_share', 'check_ad_costs_without_visits', 'calculate_events_attribution',
          'update_facebook_ad_costs', 'update_google_ad_costs', 'update_tiktok_ad_costs',
          'update_manual_ad_costs'][k % 7 + 1] as job,
         user_id % 5 as project_id, timestamp as started_ms, timestamp + k as ended_ms,
         case when event_name = 'error' then 'error' else 'success' end as status
  from fx
)
select job, project_id, coalesce(max(started_ms) filter (where status = 'success'), 0) as last_run,
       last(status order by started_ms, ended_ms, status) as last_status, count(*) as runs
from runs group by 1, 2
""",
    "scan_network_costs": FIGURES + """
select ['facebook_ads', 'google_ads', 'tiktok_ads'][net + 1] as network, cast(inserted_at as bigint) as inserted_at,
       date, ad_account_id, cast(page_id as varchar) as ad_id, case when net = 1 then 'kw' end as keyword,
       case when net = 0 then 'as1' end as adset_id, cost
from rows_all
""",
    "facebook_costs_current": FIGURES + FACEBOOK,
    "google_costs_current": FIGURES + GOOGLE,
    "tiktok_costs_current": FIGURES + TIKTOK,
    "ad_costs_unified": FIGURES + UNIFIED,
    "manual_costs_rejected": FIGURES + """
select date, cast(page_id as varchar) as ad_id, 'n/a' as cost, 'cost does not parse' as reason
from manual where page_id % 10 = 3
""",
    "check_costs_without_visits": FIGURES + """,
visits as (
  select distinct day, coalesce(utm_source, landing_host) as source, 'c' || (page_id % 10) as campaign,
         case when user_id % 3 = 1 then 'kw' end as term
  from fx where event_name in ('click', 'view')
),
costs as (select *, case when net = 1 then 'kw' end as term from current_rows where cost > 0)
select c.date, ['facebook_ads', 'google_ads', 'tiktok_ads'][c.net + 1] as data_source, c.source, c.campaign, c.term,
       cast(c.page_id as varchar) as ad_id, c.cost
from costs c
where not exists (select 1 from visits v where v.day = c.day and v.source is not distinct from c.source
                  and v.campaign is not distinct from c.campaign and v.term is not distinct from c.term)
""",
    "identity_components": _components(LINKS) + "select node, profile_id from profiles",
    "identity_with_contacts": _components(CONTACTS) + "select node, profile_id from profiles",
    "identified_events": _components(LINKS) + """
select f.event_id, f.date, f.event_name, p.profile_id, cast(1 as bigint) as inserted_at
from fx f join profiles p on p.node = 'avid:' || f.avid
""",
    "purchase_revenue_by_source": PAIRS + """
select coalesce(p.source, '(unattributed)') as source, count(*) as purchases,
       cast(sum(cast(c.value as decimal(38, 6))) as double) as revenue
from conv c left join pairs p on p.conversion = c.event_id and p.place_from_end = 1
group by 1
""",
    "attribution_last_touch": _one_touch("place_from_end"),
    "attribution_first_touch": _one_touch("place"),
    "attribution_linear": _shares(EVEN_COUNT, EVEN_VALUE),
    "attribution_position": _shares(
        _by_position(EVEN_COUNT, "400000000", "200000000"), _by_position(EVEN_VALUE, "v * 4 // 10", "(v * 2 // 10)")
    ),
    "attribution_by_profile": _components(LINKS) + f""",
src as (
  select f.*, p.profile_id,
    coalesce(utm_source,
      case when referrer_host is not null and referrer_host is distinct from landing_host
                and referrer_host not in {EXCLUDED_HOSTS} then referrer_host end) as source,
    case when utm_source is null and referrer_host is not null and referrer_host is distinct from landing_host
                and referrer_host not in {EXCLUDED_HOSTS} then 'referral' end as medium
  from fx f join profiles p on p.node = 'avid:' || f.avid
),
seen as (
  select *,
    last_value(case when event_name in ('click', 'view') and source is not null
                    then {{'at': timestamp, 'id': event_id, 'source': source, 'medium': medium}} end ignore nulls)
      over (partition by profile_id order by timestamp, event_id rows between unbounded preceding and 1 preceding) as t
  from src
)
select event_id, profile_id as profile, value,
       case when timestamp - t.at <= 7 * 86400000 then t.source end as source,
       case when timestamp - t.at <= 7 * 86400000 then t.medium end as medium,
       case when timestamp - t.at <= 7 * 86400000 then t.id end as touch_event_id
from seen where event_name = 'purchase'
""",
    "check_unattributed_share": SOURCED + f""",
conv as (select * from src where event_name in ('purchase', 'signup') and {KEPT}),
flags as (
  select date, event_name,
         exists (select 1 from touches t where t.uid = conv.uid
                 and (t.timestamp, t.event_id) < (conv.timestamp, conv.event_id)
                 and conv.timestamp - t.timestamp <= 7 * 86400000) as attributed
  from conv
),
shares as (select date, event_name, count(*) as total, count(*) filter (where not attributed) as unattributed
           from flags group by 1, 2)
select *, unattributed / total as share, 100 * (unattributed / total) > 1 as breach from shares
""",
    "ignored_events": STAGED + f"""
select event_id, event_name from fx
where event_name <> 'error' and {KEPT}
  and not (event_name = 'view' and landing_url = 'http://ththre.example.com/fr/825?page=2&ref=x')
""",
    "campaign_performance": FIGURES.replace(STAGED, PAIRS) + f""",
costs as ({UNIFIED}),
parts as (
  select source, cast(cost as decimal(38, 6)) as cost, impressions, clicks, reach,
         cast(null as decimal(38, 6)) as revenue, 0 as conversions from costs
  union all
  select p.source, null, null, null, null, cast(c.value as decimal(38, 6)), 1
  from conv c left join pairs p on p.conversion = c.event_id and p.place_from_end = 1
),
totals as (
  select source, cast(sum(cost) as double) as cost, cast(sum(impressions) as bigint) as impressions,
         cast(sum(clicks) as bigint) as clicks, max(reach) as max_reach, cast(sum(revenue) as double) as revenue,
         cast(sum(conversions) as bigint) as conversions
  from parts group by 1
)
select *, cost / nullif(clicks, 0) as cpc, clicks / nullif(impressions, 0) as ctr, revenue / nullif(cost, 0) as roas
from totals
""",
    "param_lookup": STAGED + """
select event_id, k, value, landing_url as landing_page_url, referrer_url, uid as external_id,
       case when event_name in ('click', 'view') and user_id % 3 = 1 then 'c' || (page_id % 10) end as google_campaign
from fx
""",
    "external_ids": STAGED + "select event_id, 'user_id' as key, uid as value from fx",
    "ad_data_flat": STAGED + """,
visits as (select *, ['facebook_ads', 'google_ads', 'tiktok_ads'][user_id % 3 + 1] as network
           from fx where event_name in ('click', 'view'))
select event_id, network as ad_network, 'campaign_id' as key, 'c' || (page_id % 10) as value from visits
union all select event_id, network, 'ad_id', cast(page_id as varchar) from visits
union all select event_id, 'affiliate', 'partner', 'p' || (k % 5) from visits where eid % 3 = 0
""",
    "product_lines": STAGED + """,
lines as (select fx.*, i from fx, (values (1), (2), (3)) s(i) where event_name = 'purchase' and i <= eid % 4)
select event_id, 'p' || ((k + i) % 20) as product_id, 'cat' || i as category, 'USD' as currency,
       cast(i as bigint) as quantity, value,
       i * (value * (1 - (case when i = 3 then 20 else 0 end)::double / 100)
            - (case when i = 2 then 1 else 0 end)::double) as net_value
from lines
union all
select event_id, null, null, null, null, null, null from fx where event_name <> 'purchase' or eid % 4 = 0
""",
    "offer_lines": STAGED + """,
lines as (select fx.*, i from fx, (values (1), (2)) s(i) where event_name = 'view' and i <= eid % 3)
select event_id, 'o' || k || '_' || i as offer_id, 'offer ' || i as offer_name, 'USD' as currency, value,
       value * (1 - (case when i = 2 then 10 else 0 end)::double / 100) - 0::double as net_value
from lines
union all
select event_id, null, null, null, null, null from fx where event_name <> 'view' or eid % 3 = 0
""",
    "url_parts": STAGED + """
select event_id, landing_host as landing_hostname, landing_path as landing_page_path, landing_query as params from fx
""",
    "external_referrals": STAGED + f"""
select event_id, referrer_host from fx
where referrer_host is not null and referrer_host not in {EXCLUDED_HOSTS}
  and referrer_host is distinct from landing_host
""",
    "real_events": STAGED + "select event_id, event_name from fx where eid % 50 <> 0",
    "local_dates": STAGED + """,
local as (select *, cast(cast(make_timestamp((timestamp + (user_id % 5 - 2) * 14400000) * 1000) as date) as varchar)
                    as local_date from fx)
select event_id, date, local_date, local_date <> date as date_differs from local
""",
    "local_dates_in_zone": STAGED + """,
local as (select *, cast(cast(make_timestamp((timestamp + 9 * 3600000) * 1000) as date) as varchar) as local_date
          from fx)
select event_id, date, local_date, local_date <> date as date_differs from local
""",
    "variant_slot_violations": STAGED + """
select event_id, 'user_properties' as list, 'plan' as key, cast(2 as bigint) as slots_set from fx where eid % 100 = 7
""",
    "order_state": STAGED + """
select event_id as id, 'paid' as status, value, value as paid_value, 0::double as refund_value, 'USD' as currency,
       event_id as state_event_id
from fx where event_name = 'purchase'
""",
    "deal_state": DEALS + "select * from deals",
    "deal_balance": DEALS + """
select currency, count(*) as records, cast(sum(cast(paid_value as decimal(38, 6))) as double) as paid_value,
       cast(sum(cast(refund_value as decimal(38, 6))) as double) as refund_value,
       cast(sum(cast(paid_value as decimal(38, 6))) - sum(cast(refund_value as decimal(38, 6))) as double) as net_value
from deals group by 1
""",
    "transaction_links": DEALS + """,
t as (select 't' || event_id as transaction_id, value, 'USD' as currency,
             case when eid % 7 = 0 then 'missing' else event_id end as order_id,
             case when eid % 2 = 0 then 'd' || user_id end as deal_id
      from fx where event_name = 'purchase')
select transaction_id, t.value, t.currency, order_id, deal_id,
       case when o.event_id is not null then 'paid' end as order_status, o.event_id is not null as has_order,
       d.status as deal_status, d.id is not null as has_deal
from t left join fx o on o.event_name = 'purchase' and o.event_id = t.order_id
left join deals d on d.id = t.deal_id
""",
    "geo_rollup": GEO + """
select continent, country, city, cast(grouping(continent, country, city) as bigint) as level, count(*) as events,
       count(distinct uid) as profiles
from places group by rollup (continent, country, city)
""",
    "device_cube": DEVICES + """
select category, operating_system, browser, cast(grouping(category, operating_system, browser) as bigint) as level,
       count(*) as events, count(distinct uid) as profiles
from devices group by cube (category, operating_system, browser)
""",
}

# Messages that do not fit are not in the table; copies of the others are one event.
_FROM_TOPIC = "fx as (select * from everything where eid % 100 not in (7, 9, 13, 17)),"
ORACLES["attribution_from_topic"] = ORACLES["attribution_by_profile"].replace("\nfx as (", "\neverything as (", 1).replace(
    "links as (", _FROM_TOPIC + "\nlinks as (", 1
)

# Figures of the campaign report with credit in place of conversions, and per currency.
ORACLES["campaign_performance_linear"] = FIGURES.replace(STAGED, PAIRS) + f""",
costs as ({UNIFIED}),
units as (select *, cast(round(value * 1000000) as hugeint) * 1000 as v from pairs),
shares as (select touch, source, medium, {EVEN_COUNT} as c, {EVEN_VALUE} as w from units),
credit as (
  select source, medium, cast(sum(c) as double) / 1e9 as c, cast(sum(w) as double) / 1e9 as w
  from shares group by touch, source, medium
  union all
  select null, null, 1.0, value from conv where event_id not in (select conversion from pairs)
),
parts as (
  select source, 'cpc' as medium, campaign, term, cast(cost as decimal(38, 6)) as cost, impressions, clicks, reach,
         cast(null as decimal(38, 6)) as revenue, cast(0 as decimal(38, 12)) as conversions from costs
  union all
  select source, medium, null, null, null, null, null, null, cast(w as decimal(38, 6)), cast(c as decimal(38, 12)) from credit
)
select source, medium, campaign, cast(null as varchar) as content, term, cast(sum(cost) as double) as cost,
       cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks, max(reach) as max_reach,
       cast(sum(revenue) as double) as revenue, cast(sum(conversions) as double) as conversions
from parts group by source, medium, campaign, term
"""
ORACLES["campaign_performance_by_currency"] = ORACLES["campaign_performance"].replace(
    "select *, cost / nullif(clicks", "select *, 'USD' as currency, cost / nullif(clicks"
)
ORACLES["costs_without_visits_by_source"] = FIGURES.replace(STAGED, SOURCED) + f""",
costs as ({UNIFIED})
select c.date, c.data_source, c.source, c.campaign, c.term, c.ad_id, c.cost from costs c
where c.cost > 0 and not exists (select 1 from src v where v.event_name in ('click', 'view') and v.date = c.date
                                 and v.source is not distinct from c.source)
"""
ORACLES["attribution_linear_by_event"] = PAIRS.replace(
    "event_name = 'purchase'", "event_name in ('purchase', 'signup')"
).replace("select c.event_id as conversion,", "select c.event_id as conversion, c.event_name, t.date,") + f""",
shares as (select uid, touch, event_name, date, source, {EVEN_COUNT} as c from pairs)
select touch as event_id, event_name, date, uid as profile, source, cast(sum(c) as double) / 1e9 as conversions,
       cast(sum(c) as double) / 1e9 as value
from shares group by touch, event_name, date, uid, source
union all
select event_id, event_name, date, uid, null, 1.0, 1.0 from conv where event_id not in (select conversion from pairs)
"""
ORACLES["jobs_end_to_end"] = FIGURES.replace(STAGED, SOURCED) + f""",
costs as ({UNIFIED})
select 'identified_events' as table_name, count(*) as rows_stored from fx
union all select 'ad_costs', count(*) from costs
union all select 'attributed_events', count(*) from fx where event_name = 'purchase'
union all select 'unattributed_shares', count(distinct date) from fx where event_name = 'purchase'
union all select 'costs_without_visits', count(*) from costs c
  where c.cost > 0 and not exists (select 1 from src v where v.event_name in ('click', 'view') and v.date = c.date
                                   and v.source is not distinct from c.source)
union all select 'manual_costs_rejected', count(*) from manual where page_id % 10 = 3
union all select 'job_states', 7
"""

ORACLES["ingest_quoted_fields"] = ORACLES["ingest_unknown_fields"].replace("'unknown fields: extra'", "'does not fit the schema'")
ORACLES["replay_ten_days"] = SENT + """
select event_id, date, event_name from fate where reason is null and publish_ms >= (select max(publish_ms) - 864000000 from fate)
"""
ORACLES["clustered_files"] = STAGED + "select date, count(*) as events, cast(0 as bigint) as unordered from fx group by 1"
ORACLES["raw_events_loaded"] = SENT + "select distinct event_id, date, event_name from fate where reason is null"
ORACLES["raw_events_compacted"] = STAGED + """
select date, count(*) as events, day < (select max(day) from fx) or count(distinct eid % 4) <= 2 as compact from fx group by date, day
"""
ORACLES["landed_survivors"] = SENT + """,
days as (select message_id, cast(make_timestamp((publish_ms + (eid * 2 + copy) % 10 * 86400000) * 1000) as date) as day from fate)
select message_id, cast(day as varchar) as publish_date from days where day >= (select max(day) - interval 31 day from days)
"""
ORACLES["ordered_by_key"] = STAGED + """
select avid, event_id, row_number() over (partition by avid order by timestamp, event_id) as position from fx
"""
ORACLES["dedupe_incremental"] = ORACLES["dedupe_events"]
ORACLES["partition_guard_by_unit"] = STAGED + """,
local as (select cast(make_timestamp((timestamp + (user_id % 5 - 2) * 14400000) * 1000) as date) as day from fx),
inner_days as (select * from local where day between (select min(day) + interval 9 day from local) and (select min(day) + interval 19 day from local))
select unit, cast(day as varchar) as date, count(*) as events from inner_days, (values ('HOUR'), ('DAY'), ('MONTH'), ('YEAR')) u(unit)
group by unit, day
"""
ORACLES["identity_incremental"] = ORACLES["identified_events"]
ORACLES["attribution_incremental"] = ORACLES["attribution_by_profile"] + " and day < (select max(day) from fx)"
_INNER = "where day between (select min(day) + interval 5 day from fx) and (select max(day) - interval 5 day from fx)"
ORACLES["geo_rollup_from_days"] = ORACLES["geo_rollup"].replace("as city, uid\n  from fx", f"as city, uid\n  from fx {_INNER}")
ORACLES["device_cube_from_days"] = ORACLES["device_cube"].replace("as browser, uid\n  from fx", f"as browser, uid\n  from fx {_INNER}")

# The split variants must give the same rows.
for _name in ("identity_components", "attribution_linear", "attribution_by_profile"):
    ORACLES[f"{_name}_split"] = ORACLES[_name]
