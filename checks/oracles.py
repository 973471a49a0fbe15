"""SQL counterparts of the registered queries, over the same ``events`` table.

They are written out from the definition of each result, independently of the
stream specifications that drive the Spark side.
"""

from __future__ import annotations

from checks import shop
from checks.mapping import (
    AS_TEXT,
    FIELDS,
    KAFKA_TIMESTAMP,
    NO_FIELD,
    NO_JSON,
    NO_OBJECT,
    NUMBERS,
    OFFSET,
    PARTITION,
)
from tidemark.functions.rounding import round2

BRONZE_FIELDS = {name: ", ".join(f'"{field}"' for field in FIELDS[name]) for name in FIELDS}

USABLE = {
    "payments": "event_id is not null and merchant_id is not null "
    "and amount is not null and status is not null",
    "user_events": "event_id is not null and user_id is not null and event_type is not null",
    "system_logs": "event_id is not null and service is not null "
    "and level is not null and latency_ms is not null",
}

VALID = {
    "payments": "amount > 0 and currency in ('USD', 'CAD', 'EUR', 'GBP') "
    "and status in ('completed', 'failed', 'pending')",
    "user_events": "event_type in ('page_view', 'click', 'signup', 'add_to_cart', "
    "'checkout', 'purchase') and device in ('mobile', 'desktop', 'tablet')",
    "system_logs": "level in ('INFO', 'WARN', 'ERROR') and latency_ms >= 0 "
    "and cpu_percent between 0 and 100 and memory_percent between 0 and 100",
}


def count_where(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


GOLD = {
    "payments": f"""
select merchant_id, hour, count(*) as total_transactions,
    {count_where("status = 'completed'")} as completed_count,
    {count_where("status = 'failed'")} as failed_count,
    {round2("sum(case when status = 'completed' then amount else 0 end)")} as completed_volume,
    round({count_where("status = 'failed'")} / count(*) * 100, 2) as failure_rate_pct
from hours group by merchant_id, hour""",
    "user_events": f"""
select hour, device, count(*) as total_events,
    {count_where("event_type = 'page_view'")} as page_views,
    {count_where("event_type = 'add_to_cart'")} as add_to_carts,
    {count_where("event_type = 'checkout'")} as checkouts,
    {count_where("event_type = 'purchase'")} as purchases
from hours group by hour, device""",
    "system_logs": f"""
select service, hour, count(*) as total_logs,
    {count_where("level = 'INFO'")} as info_count,
    {count_where("level = 'WARN'")} as warn_count,
    {count_where("level = 'ERROR'")} as error_count,
    {round2("avg(latency_ms)")} as avg_latency_ms,
    {round2("max(latency_ms)")} as max_latency_ms,
    {round2("avg(cpu_percent)")} as avg_cpu_percent,
    round({count_where("level = 'ERROR'")} / count(*) * 100, 2) as error_rate_pct
from hours group by service, hour""",
}


def raw(stream: str) -> str:
    """CTE ``raw``: the stream's Bronze rows."""
    fields = ",\n    ".join(f'{sql} as "{name}"' for name, sql in FIELDS[stream].items())
    return f"""raw as (
  select {fields},
    {PARTITION[stream]} as "partition", {OFFSET} as "offset",
    {KAFKA_TIMESTAMP} as kafka_timestamp
  from events)"""


def parsed(stream: str) -> str:
    """CTEs up to ``parsed``: what the log's records hold of the stream's fields."""
    unread = f"{NO_JSON} or {NO_OBJECT} or {NO_FIELD}"
    fields = ",\n    ".join(
        f'case when {unread}{f" or {AS_TEXT}" if name == NUMBERS[stream] else ""} then null '
        f'else "{name}" end as "{name}"'
        for name in FIELDS[stream]
    )
    return f"""{raw(stream)},
parsed as (select {fields}, "partition", "offset", kafka_timestamp from raw)"""


def silver_parts(stream: str) -> str:
    """CTEs up to ``silver``."""
    kept = ", ".join(f'"{field}"' for field in FIELDS[stream] if field != "timestamp")
    return f"""{raw(stream)},
usable as (select * from raw where {USABLE[stream]}),
valid as (select * from usable where {VALID[stream]}),
ranked as (
  select *, row_number() over (partition by event_id
    order by kafka_timestamp desc, "partition" desc, "offset" desc) as place
  from valid),
silver as (
  select {kept}, "partition", "offset", kafka_timestamp,
    try_cast("timestamp" as timestamp) as event_timestamp
  from ranked where place = 1)"""


def gold_parts(stream: str) -> str:
    """CTEs up to ``gold``."""
    return f"""{silver_parts(stream)},
hours as (select *, date_trunc('hour', event_timestamp) as hour from silver),
gold as ({GOLD[stream]})"""


BASELINE = f"""baseline as (
  select *, round(avg_failure_rate + 2 * stddev_failure_rate, 2) as anomaly_threshold_pct
  from (select merchant_id, {round2("avg(failure_rate_pct)")} as avg_failure_rate,
      {round2("stddev_samp(failure_rate_pct)")} as stddev_failure_rate
    from gold group by merchant_id))"""


def bronze(stream: str) -> str:
    return f"with {parsed(stream)} select * from parsed"


def dq(stream: str) -> str:
    return f"""with {silver_parts(stream)},
counts as (
  select (select count(*) from raw) as total, (select count(*) from usable) as after_nulls,
    (select count(*) from valid) as after_validation,
    (select count(*) from silver) as after_dedup)
select total, after_nulls, after_validation, after_dedup,
  total - after_nulls as dropped_nulls,
  after_nulls - after_validation as dropped_invalid,
  after_validation - after_dedup as dropped_duplicates,
  total - after_dedup as dropped_total,
  round(after_dedup / nullif(total, 0) * 100, 1) as quality_score
from counts"""


def encoded(stream: str, topic: str, key: str) -> str:
    return f"""with {raw(stream)}
select coalesce({key}, 'unknown') as key, '{topic}' as topic, {BRONZE_FIELDS[stream]} from raw"""


def timeline_of(cte, name: str) -> str:
    return f"""
with p as (with {cte("payments")} select * from {name}),
u as (with {cte("user_events")} select * from {name}),
s as (with {cte("system_logs")} select * from {name}){TIMELINE}"""


TIMELINE = """
select 'raw-payments' as topic, merchant_id as entity, kafka_timestamp,
  '💳 PAYMENT   | ' || coalesce(merchant_id, 'None') || ' | $'
    || coalesce(cast(amount as varchar), 'None') || ' ' || coalesce(currency, 'None')
    || ' | ' || coalesce(upper(status), 'None') as line
from p
union all
select 'raw-user-events', user_id, kafka_timestamp,
  '👤 USER      | ' || coalesce(user_id, 'None') || ' | ' || coalesce(event_type, 'None')
    || ' | ' || coalesce(page, 'None') || ' | ' || coalesce(device, 'None')
from u
union all
select 'raw-system-logs', service, kafka_timestamp,
  case level when 'INFO' then '🟢' when 'WARN' then '🟡' when 'ERROR' then '🔴' else '⚪' end
    || ' SYSTEM    | ' || coalesce(service, 'None') || ' | ' || coalesce(level, 'None')
    || ' | ' || coalesce(message, 'None')
    || ' | latency=' || coalesce(cast(latency_ms as varchar), 'None') || 'ms'
from s"""

TOPICS = {
    "payments": ("raw-payments", "merchant_id"),
    "user_events": ("raw-user-events", "user_id"),
    "system_logs": ("raw-system-logs", "service"),
}


DAILY_PAYMENTS = f"""
select merchant_id, date_trunc('day', hour) as day,
    cast(sum(total_transactions) as bigint) as total_transactions,
    cast(sum(completed_count) as bigint) as completed_count,
    cast(sum(failed_count) as bigint) as failed_count,
    {round2("sum(completed_volume)")} as completed_volume,
    round(sum(failed_count) / sum(total_transactions) * 100, 2) as failure_rate_pct
from gold group by merchant_id, day"""

WEEKLY_USER_EVENTS = """
select cast(date_trunc('week', hour) as timestamp) as week, device,
    cast(sum(total_events) as bigint) as total_events,
    cast(sum(page_views) as bigint) as page_views,
    cast(sum(add_to_carts) as bigint) as add_to_carts,
    cast(sum(checkouts) as bigint) as checkouts,
    cast(sum(purchases) as bigint) as purchases
from gold group by week, device"""

# A pattern lies in one partition: between partitions the log has no order.
ESCALATIONS = """,
placed as (
  select *, row_number() over (partition by service order by "partition", "offset") as position,
    lag(level, 1) over in_order as one, lag(level, 2) over in_order as two,
    lag(level, 3) over in_order as three
  from silver window in_order as (partition by service, "partition" order by "offset"))
select event_id, service, level, "partition", "offset", position from placed
where level = 'ERROR' and one = 'WARN' and two = 'WARN' and three = 'WARN'"""

# From the definition: a user got as far as a stage if there is a chain of events, each after
# the one before it, through all stages up to that one. Walking a user's events in order, an
# event ends such a chain if its stage follows one that some earlier event has ended.
STAGES_REACHED = """,
walked as (
  select user_id, event_type, event_timestamp, row_number() over in_order as step
  from silver where event_timestamp is not null
  window in_order as (partition by user_id
    order by event_timestamp, kafka_timestamp, "partition", "offset")),
v as (select *, min(case when event_type = 'page_view' then step end)
  over (partition by user_id) as viewed from walked),
c as (select *, min(case when event_type = 'add_to_cart' and step > viewed then step end)
  over (partition by user_id) as carted from v),
k as (select *, min(case when event_type = 'checkout' and step > carted then step end)
  over (partition by user_id) as checked from c),
p as (select *, min(case when event_type = 'purchase' and step > checked then step end)
  over (partition by user_id) as bought from k)"""
FUNNEL = f"""{STAGES_REACHED}
select (select count(distinct user_id) from silver) as users,
  count(distinct case when viewed is not null then user_id end) as page_view_users,
  count(distinct case when carted is not null then user_id end) as add_to_cart_users,
  count(distinct case when checked is not null then user_id end) as checkout_users,
  count(distinct case when bought is not null then user_id end) as purchase_users
from p"""

JOURNEYS = f"""{STAGES_REACHED}
select user_id, max(case when step = viewed then event_timestamp end) as page_view_at,
  max(case when step = carted then event_timestamp end) as add_to_cart_at,
  max(case when step = checked then event_timestamp end) as checkout_at,
  max(case when step = bought then event_timestamp end) as purchase_at,
  cast(count(distinct viewed) + count(distinct carted) + count(distinct checked)
    + count(distinct bought) as int) as stages_reached
from (select user_id from silver group by user_id) left join p using (user_id) group by user_id"""

EXPIRED_CARTS = """,
moments as (
  select user_id, event_timestamp as added_at, bool_or(event_type = 'purchase') as paid
  from silver where event_timestamp is not null and event_type in ('add_to_cart', 'purchase')
  group by user_id, event_timestamp),
following as (select *, lead(added_at) over (partition by user_id order by added_at) as next_at
  from moments)
select user_id, added_at from following
where not paid and (next_at is null or next_at > added_at + interval 1 hour)
  and added_at + interval 1 hour <= timestamp '2024-01-31 00:00:00'"""

ABANDONED = """
select user_id, max(case when event_type = 'add_to_cart' then event_timestamp end)
    as last_add_to_cart,
  max(case when event_type = 'purchase' then event_timestamp end) as last_purchase
from silver group by user_id
having last_add_to_cart is not null
  and (last_purchase is null or last_purchase < last_add_to_cart)"""


def gold_of(stream: str) -> str:
    return f"(with {gold_parts(stream)} select * from gold)"


INCIDENTS = f"""
with g as {gold_of("user_events")},
p as (
  select hour, count(*) as n from (
    select hour, failure_rate_pct as rate,
      {round2("avg(failure_rate_pct) over (partition by merchant_id)")} as mean,
      {round2("stddev_samp(failure_rate_pct) over (partition by merchant_id)")} as spread
    from {gold_of("payments")}) where rate > round(mean + 2 * spread, 2) group by hour),
s as (
  select hour, count(*) as n from (
    select hour, error_rate_pct as rate,
      {round2("avg(error_rate_pct) over (partition by service)")} as mean,
      {round2("stddev_samp(error_rate_pct) over (partition by service)")} as spread
    from {gold_of("system_logs")}) where rate > round(mean + 2 * spread, 2) group by hour),
u as (
  select hour, count(*) as n from (
    select hour, checkouts,
      {round2("avg(checkouts) over (partition by device)")} as mean,
      {round2("stddev_samp(checkouts) over (partition by device)")} as spread
    from (
      select device, hour, coalesce(sum(checkouts), 0) as checkouts
      from (select distinct hour from (
            select unnest(generate_series(hour, hour + interval 24 hour, interval 1 hour)) as hour
            from (select distinct hour from g where hour is not null))
          where hour <= (select max(hour) from g))
        cross join (select distinct device from g where hour is not null)
        left join g using (device, hour) group by device, hour))
  where checkouts < mean - 2 * spread group by hour),
hours as (select hour from p union select hour from s union select hour from u)
select hours.hour, coalesce(p.n, 0) as failing_merchants, coalesce(s.n, 0) as failing_services,
  coalesce(u.n, 0) as dropping_devices,
  cast(p.n is not null as int) + cast(s.n is not null as int) + cast(u.n is not null as int)
    as streams
from hours left join p on p.hour = hours.hour left join s on s.hour = hours.hour
  left join u on u.hour = hours.hour"""

# Windows of Silver's rows: an event lies in one window, that of its latest copy.
HALF_MINUTES = f"""
select merchant_id, time_bucket(interval 30 seconds, event_timestamp) as window_start,
    time_bucket(interval 30 seconds, event_timestamp) + interval 30 seconds as window_end,
    count(*) as total_transactions,
    {count_where("status = 'completed'")} as completed_count,
    {count_where("status = 'failed'")} as failed_count,
    {round2("sum(case when status = 'completed' then amount else 0 end)")} as completed_volume,
    round({count_where("status = 'failed'")} / count(*) * 100, 2) as failure_rate_pct
from silver where event_timestamp is not null group by merchant_id, window_start, window_end"""

BY_CURRENCY = f"""with {silver_parts("payments")},
gold as (
  select merchant_id, currency, date_trunc('hour', event_timestamp) as hour,
    count(*) as total_transactions,
    round({count_where("status = 'failed'")} / count(*) * 100, 2) as failure_rate_pct
  from silver group by 1, 2, 3)"""

DAILY_LOGS = f"""with {silver_parts("system_logs")},
hours as (select *, date_trunc('day', event_timestamp) as day from silver)
{GOLD["system_logs"].replace("hour", "day").replace("days", "hours")}"""


def positions(stream: str) -> str:
    _, key = TOPICS[stream]
    return f"""with {raw(stream)}
select {key}, "partition", "offset",
  row_number() over (partition by {key} order by "partition", "offset") as position
from raw"""


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for stream in FIELDS:
        found[f"bronze_{stream}"] = bronze(stream)
        found[f"stream_bronze_{stream}"] = bronze(stream)
        found[f"silver_{stream}"] = f"with {silver_parts(stream)} select * from silver"
        found[f"dq_{stream}"] = dq(stream)
        found[f"gold_{stream}_hourly"] = f"with {gold_parts(stream)} select * from gold"
        found[f"layers_roundtrip_{stream}"] = f"with {gold_parts(stream)} select * from gold"
        found[f"encode_roundtrip_{stream}"] = encoded(stream, *TOPICS[stream])
    for stream in ("payments", "user_events"):
        found[f"silver_{stream}_incremental"] = found[f"silver_{stream}"]
    found["stream_bronze_payments_resume"] = bronze("payments")
    found["payments_baseline"] = f"with {gold_parts('payments')}, {BASELINE} select * from baseline"
    found["payments_flagged_hours"] = f"""with {gold_parts('payments')}, {BASELINE}
select g.merchant_id, g.hour, g.failure_rate_pct, b.anomaly_threshold_pct, g.total_transactions
from gold g join baseline b on g.merchant_id = b.merchant_id
where g.failure_rate_pct > b.anomaly_threshold_pct
order by g.failure_rate_pct desc, g.merchant_id nulls first, g.hour nulls first"""
    found["layers_flagged_hours"] = found["payments_flagged_hours"]
    found["payments_top_failure_hours"] = f"""with {gold_parts('payments')}
select * from gold order by failure_rate_pct desc, merchant_id nulls first, hour nulls first limit 5"""
    found["system_logs_top_error_hours"] = f"""with {gold_parts('system_logs')}
select * from gold order by error_rate_pct desc, service nulls first, hour nulls first limit 5"""
    payments = raw("payments")
    found["report_total_events"] = f"with {payments} select count(*) as total_events from raw"
    found["report_failures_by_merchant"] = f"""with {payments}
select merchant_id, count(*) as failures from raw where status = 'failed'
group by merchant_id order by failures desc, merchant_id nulls first"""
    found["report_volume_by_currency"] = f"""with {payments}
select currency, count(*) as transactions, {round2("sum(amount)")} as total_volume,
  {round2("avg(amount)")} as avg_amount
from raw where status = 'completed' group by currency order by total_volume desc"""
    found["report_status_breakdown"] = f"""with {payments}
select merchant_id, status, count(*) as "count" from raw group by merchant_id, status
order by merchant_id nulls first, status nulls first"""
    found["unified_timeline"] = timeline_of(raw, "raw")
    found["unified_log_timeline"] = timeline_of(parsed, "parsed")
    found["payments_trace"] = f"""with {payments}
select kafka_timestamp, '← partition=' || cast("partition" as varchar)
  || ' offset=' || cast("offset" as varchar) || ' | ' || coalesce(merchant_id, 'None')
  || ' | $' || coalesce(cast(amount as varchar), 'None') || ' ' || coalesce(currency, 'None')
  || ' | ' || coalesce(status, 'None') as line
from raw"""
    found["entity_sequence"] = positions("payments")
    found["entity_sequence_user_events"] = positions("user_events")
    found["entity_sequence_system_logs"] = positions("system_logs")
    gold = f"with {gold_parts('payments')}"
    found["payments_versus_last_week"] = f"""{gold}
select g.merchant_id, g.hour, g.failure_rate_pct, e.failure_rate_pct as last_week_pct,
  round(g.failure_rate_pct - e.failure_rate_pct, 2) as change_pct
from gold g left join gold e
  on e.merchant_id = g.merchant_id and e.hour = g.hour - interval 7 days"""
    found["payments_daily"] = f"{gold} {DAILY_PAYMENTS}"
    found["user_events_weekly"] = f"with {gold_parts('user_events')} {WEEKLY_USER_EVENTS}"
    found["payments_flagged_hours_with_history"] = f"""{gold}, {BASELINE},
enough as (select merchant_id from gold group by merchant_id having count(*) >= 168)
select g.merchant_id, g.hour, g.failure_rate_pct, b.anomaly_threshold_pct, g.total_transactions
from gold g join baseline b on g.merchant_id = b.merchant_id
where g.failure_rate_pct > b.anomaly_threshold_pct
  and g.merchant_id in (select merchant_id from enough)"""
    found["payments_percentile_thresholds"] = f"""{gold}
select merchant_id, {round2("quantile_cont(failure_rate_pct, 0.95)")} as anomaly_threshold_pct
from gold group by merchant_id"""
    found["payments_percentile_by_days"] = f"""{gold}
select merchant_id, quantile_disc(failure_rate_pct, 0.95) as anomaly_threshold_pct
from gold group by merchant_id"""
    found["service_escalations"] = f"with {silver_parts('system_logs')} {ESCALATIONS}"
    found["service_escalations_in_chunks"] = found["service_escalations"]
    found["entity_sequence_in_runs"] = found["entity_sequence_user_events"]
    found["system_logs_daily"] = found["system_logs_daily_from_gold"] = DAILY_LOGS
    found["payments_baseline_by_days"] = found["payments_baseline"]
    found["payments_stored_flagged_hours"] = found["payments_flagged_hours_with_history"]
    found["payments_by_currency_versus_last_week"] = f"""{BY_CURRENCY}
select g.merchant_id, g.currency, g.hour, g.failure_rate_pct,
  e.failure_rate_pct as last_week_pct,
  round(g.failure_rate_pct - e.failure_rate_pct, 2) as change_pct
from gold g left join gold e on e.merchant_id = g.merchant_id and e.currency = g.currency
  and e.hour = g.hour - interval 7 days"""
    found["payments_by_currency_flagged_hours"] = f"""{BY_CURRENCY},
base as (select merchant_id, currency, {round2("avg(failure_rate_pct)")} as mean,
    {round2("stddev_samp(failure_rate_pct)")} as spread from gold group by 1, 2)
select g.merchant_id, g.currency, g.hour, g.failure_rate_pct,
  round(mean + 2 * spread, 2) as anomaly_threshold_pct, g.total_transactions
from gold g join base b on g.merchant_id = b.merchant_id and g.currency = b.currency
where g.failure_rate_pct > round(mean + 2 * spread, 2)"""
    found["merchant_dated_keys"] = f"""with {payments}
select coalesce(merchant_id, 'unknown') || '_' || coalesce(strftime(kafka_timestamp, '%Y-%m-%d'),
  'unknown') as dated_key, count(*) as events from raw group by 1"""
    found |= shop.all_oracles()
    found["user_funnel"] = f"with {silver_parts('user_events')} {FUNNEL}"
    found["user_journeys"] = f"with {silver_parts('user_events')} {JOURNEYS}"
    found["expired_carts"] = f"with {silver_parts('user_events')} {EXPIRED_CARTS}"
    found["abandoned_carts"] = f"with {silver_parts('user_events')} {ABANDONED}"
    found["incident_hours"] = INCIDENTS
    found["user_busy_keys_live"] = f"""with {raw("user_events")},
volumes as (select user_id, count(*) as events from raw where user_id is not null group by user_id),
level as (select avg(events) as mean from volumes)
select user_id, events, round(mean, 2) as mean_events from volumes cross join level
where events > mean"""
    for stream in FIELDS:
        found[f"dq_{stream}_observed"] = f"""select total, after_nulls, after_validation,
  dropped_nulls, dropped_invalid, 0::bigint as unnoted_batches from ({dq(stream)})"""
    found["user_key_load"] = f"""with {raw("user_events")},
volumes as (select user_id, count(*) as events from raw where user_id is not null group by user_id),
level as (select avg(events) as mean from volumes)
select user_id, events, round(mean, 2) as mean_events, events > 10 * mean as hot
from volumes cross join level"""
    found["payments_half_minutes"] = f"with {silver_parts('payments')} {HALF_MINUTES}"
    found["retained_payments"] = f"""with {raw("payments")} select * from raw
where kafka_timestamp >= timestamp '2024-01-31 00:00:00' - interval 7 days"""
    found["retained_system_logs"] = f"""with {raw("system_logs")} select * from raw
where kafka_timestamp >= timestamp '2024-01-31 00:00:00' - interval 24 hours"""
    return found
