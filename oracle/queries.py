"""Independent DuckDB SQL answers, one per registered query key.

Written directly in SQL over the adapter CTEs (``oracle.adapters``) so the
Spark DataFrame code and these answers share only the inputs.  Dialect
notes: ``date_diff`` counts unit boundaries; ``//`` truncates toward zero;
division returns DOUBLE, so percentages are rounded at 9 digits before the
decimal cast; sums over integers are HUGEINT and are cast to BIGINT.
"""

from __future__ import annotations

HOME = "ASIA"


def _pct2(n: str, d: str) -> str:
    return f"cast(round(cast({n} as double) * 100 / nullif({d}, 0), 9) as decimal(5,2))"


def _int_avg(x: str) -> str:
    return f"cast(sum({x}) // nullif(count({x}), 0) as int)"


def _hours(a: str, b: str) -> str:
    return f"cast(date_diff('hour', {a}, {b}) as int)"


def _minutes(a: str, b: str) -> str:
    return f"cast(date_diff('minute', {a}, {b}) as int)"


def _round_even(x: str, digits: int = 2) -> str:
    return f"(round_even(({x}) * {10 ** digits}, 0) / {10 ** digits})"


def _calendar(ts: str) -> str:
    return (f"cast(year({ts}) as int) as year, cast(month({ts}) as int) as month, "
            f"cast(quarter({ts}) as int) as quarter, dayname({ts}) as day_of_week, "
            f"cast(hour({ts}) as int) as hour_of_day, strftime({ts}, '%Y-%m') as year_month")


SITE_REGION = "(select s.site_id, s.site_name, r.region_name, r.country from dim_site s join dim_region r on s.region_id = r.region_id)"

TICKET_EXTRACT = f"""
select t.ticket_id, t.client_id, c.client_name, c.industry, c.region_group, p.priority_name,
  t.created_at, t.resolved_at, t.first_response_at, t.agent_interactions, t.survey_results,
  {_hours('t.created_at', 't.resolved_at')} as resolution_hours,
  {_hours('t.created_at', 't.first_response_at')} as response_hours,
  case when p.priority_name = 'Critical' and date_diff('hour', t.created_at, t.resolved_at) <= 4 then 'Met'
       when p.priority_name = 'High' and date_diff('hour', t.created_at, t.resolved_at) <= 8 then 'Met'
       when p.priority_name = 'Medium' and date_diff('hour', t.created_at, t.resolved_at) <= 24 then 'Met'
       when p.priority_name = 'Low' and date_diff('hour', t.created_at, t.resolved_at) <= 48 then 'Met'
       else 'Breached' end as sla_status,
  case when c.hq_country = '{HOME}' then '{HOME}' else 'International' end as region_type,
  {_calendar('t.created_at')}
from fact_ticket t join dim_client c on t.client_id = c.client_id
join dim_priority p on t.priority_id = p.priority_id
where t.resolved_at is not null"""

INCIDENT_EXTRACT = f"""
select i.incident_id, i.client_id, c.client_name, c.industry, c.region_group, sr.site_name, sr.region_name,
  sr.country, p.priority_name, i.opened_at, i.resolved_at, i.reassignment_count, i.reopen_count, i.made_sla,
  {_hours('i.opened_at', 'i.resolved_at')} as resolution_hours,
  case when sr.country = '{HOME}' then '{HOME}' else 'International' end as region_type,
  {_calendar('i.opened_at')}
from fact_incident i join dim_client c on i.client_id = c.client_id
join {SITE_REGION} sr on i.site_id = sr.site_id
join dim_priority p on i.priority_id = p.priority_id
where i.resolved_at is not null"""

Q: dict[str, str] = {}

Q["ticket_kpis"] = f"""
select t.ticket_id, c.client_name, s.site_name, a.agent_name, p.priority_name,
  {_minutes('t.created_at', 't.first_response_at')} as mtta_minutes,
  {_minutes('t.created_at', 't.resolved_at')} as mttr_minutes,
  case when date_diff('minute', t.created_at, t.first_response_at) > t.sla_first_response_min then 1 else 0 end as response_breach,
  case when date_diff('minute', t.created_at, t.resolved_at) > t.sla_resolution_min then 1 else 0 end as resolution_breach
from fact_ticket t join dim_client c on t.client_id = c.client_id join dim_site s on t.site_id = s.site_id
join dim_agent a on t.agent_id = a.agent_id join dim_priority p on t.priority_id = p.priority_id"""

Q["incident_kpis"] = f"""
select i.incident_id, c.client_name, s.site_name, p.priority_name,
  {_minutes('i.opened_at', 'i.acknowledged_at')} as mtta_minutes,
  {_minutes('i.opened_at', 'i.resolved_at')} as mttr_minutes,
  i.reassignment_count, i.reopen_count, i.made_sla
from fact_incident i join dim_client c on i.client_id = c.client_id join dim_site s on i.site_id = s.site_id
join dim_priority p on i.priority_id = p.priority_id"""

Q["operations_view"] = f"""
select t.ticket_id, t.client_id, c.client_name, c.industry, sr.site_name, sr.region_name, sr.country, p.priority_name,
  t.created_at, t.resolved_at, t.status, {_hours('t.created_at', 't.resolved_at')} as resolution_hours,
  case when date_diff('hour', t.created_at, t.resolved_at) <= 24 then 'Within 24h' else 'Over 24h' end as resolution_category,
  'Ticket' as record_type
from fact_ticket t join dim_client c on t.client_id = c.client_id join {SITE_REGION} sr on t.site_id = sr.site_id
join dim_priority p on t.priority_id = p.priority_id where t.resolved_at is not null
union all
select i.incident_id, i.client_id, c.client_name, c.industry, sr.site_name, sr.region_name, sr.country, p.priority_name,
  i.opened_at, i.resolved_at, i.incident_state, {_hours('i.opened_at', 'i.resolved_at')},
  case when date_diff('hour', i.opened_at, i.resolved_at) <= 24 then 'Within 24h' else 'Over 24h' end,
  'Incident'
from fact_incident i join dim_client c on i.client_id = c.client_id join {SITE_REGION} sr on i.site_id = sr.site_id
join dim_priority p on i.priority_id = p.priority_id where i.resolved_at is not null"""

Q["sla_view"] = f"""
select c.client_name, c.industry, c.contract_tier, sr.region_name, sr.country, p.priority_name,
  cast(year(i.opened_at) as int) as year, cast(month(i.opened_at) as int) as month,
  count(*) as incident_count,
  cast(sum(case when i.made_sla = 1 then 1 else 0 end) as bigint) as sla_met,
  cast(sum(case when i.made_sla = 0 then 1 else 0 end) as bigint) as sla_breached,
  {_int_avg("date_diff('hour', i.opened_at, i.resolved_at)")} as avg_resolution_hours
from fact_incident i join dim_client c on i.client_id = c.client_id join {SITE_REGION} sr on i.site_id = sr.site_id
join dim_priority p on i.priority_id = p.priority_id
group by c.client_name, c.industry, c.contract_tier, sr.region_name, sr.country, p.priority_name,
  year(i.opened_at), month(i.opened_at)"""

Q["customer_health"] = f"""
select c.client_name, c.industry, c.contract_tier, c.monthly_contract_value,
  coalesce(t.ticket_count, 0) as ticket_count,
  coalesce(t.avg_resolution_hours, 0) as avg_ticket_resolution,
  coalesce(t.satisfied_pct, cast(0 as decimal(5,2))) as satisfaction_rate,
  coalesce(i.incident_count, 0) as incident_count,
  coalesce(i.avg_resolution_hours, 0) as avg_incident_resolution,
  coalesce(i.sla_compliance_pct, cast(0 as decimal(5,2))) as sla_compliance_pct
from dim_client c
left join (select client_id, count(*) as ticket_count,
    {_int_avg("date_diff('hour', created_at, resolved_at)")} as avg_resolution_hours,
    {_pct2("sum(case when survey_results = 'Satisfied' then 1 else 0 end)", "count(*)")} as satisfied_pct
  from fact_ticket group by client_id) t on c.client_id = t.client_id
left join (select client_id, count(*) as incident_count,
    {_int_avg("date_diff('hour', opened_at, resolved_at)")} as avg_resolution_hours,
    {_pct2("sum(case when made_sla = 1 then 1 else 0 end)", "count(*)")} as sla_compliance_pct
  from fact_incident group by client_id) i on c.client_id = i.client_id"""

Q["ticket_extract"] = TICKET_EXTRACT
Q["incident_extract"] = INCIDENT_EXTRACT

# ------------------------------------------------------------------ analysis
TE = f"te as ({TICKET_EXTRACT})"
IE = f"ie as ({INCIDENT_EXTRACT})"


def _share(n: str, total_sql: str) -> str:
    return f"cast({n} as double) * 100 / nullif(cast(({total_sql}) as double), 0)"


Q["tickets_by_month"] = f"""with {TE}
select year_month, count(*) as ticket_count from te where year_month is not null group by year_month"""

Q["monthly_peaks"] = f"""with {TE}, m as (select year_month, count(*) as n from te where year_month is not null group by year_month)
select avg(n) as avg_monthly_tickets, first(year_month order by n desc, year_month) as peak_month, max(n) as peak_tickets,
  first(year_month order by n, year_month) as low_month, min(n) as low_tickets from m"""


def _value_counts(src: str, key: str, count_name: str, share: bool = True) -> str:
    share_sql = f", {_share('count(*)', f'select count(*) from {src}')} as share_pct" if share else ""
    return f"select {key}, count(*) as {count_name}{share_sql} from {src} where {key} is not null group by {key}"


Q["tickets_by_region_type"] = f"with {TE} " + _value_counts("te", "region_type", "ticket_count")
Q["tickets_by_client"] = f"with {TE} " + _value_counts("te", "client_name", "ticket_count", share=False)
Q["top_clients_by_volume"] = f"""with {TE}, c as ({_value_counts('te', 'client_name', 'ticket_count', share=False)})
select * from c order by ticket_count desc, client_name limit 3"""
Q["tickets_by_priority"] = f"with {TE} " + _value_counts("te", "priority_name", "ticket_count")

_DAYS = ",".join(f"('{d}', {i + 1})" for i, d in enumerate(
    ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]))
Q["day_hour_heatmap"] = f"""with {TE},
days as (select * from (values {_DAYS}) d(day_of_week, day_order)),
p as (select day_of_week, {', '.join(f'count(*) filter (where hour_of_day = {h}) as h{h:02d}' for h in range(24))}
      from te group by day_of_week)
select d.day_of_week, d.day_order, {', '.join(f'coalesce(p.h{h:02d}, 0) as h{h:02d}' for h in range(24))}
from days d left join p on d.day_of_week = p.day_of_week"""

Q["incidents_by_region_type"] = f"with {IE} " + _value_counts("ie", "region_type", "incident_count")
Q["mttr_by_region_type"] = f"""with {IE}
select region_type, avg(resolution_hours) as avg_resolution_hours from ie where region_type is not null group by region_type"""
Q["incident_region_detail"] = f"""with {IE}
select region_name, count(incident_id) as incident_count,
  {_round_even('avg(resolution_hours)')} as avg_resolution_hours,
  {_round_even('avg(reassignment_count)')} as avg_reassignments,
  {_round_even('avg(reopen_count)')} as avg_reopens
from ie where region_name is not null group by region_name"""

Q["mttr_box_stats"] = f"""with {IE},
k as (select region_type, cast(resolution_hours as double) as v from ie where resolution_hours < 100 and region_type is not null),
q as (select region_type, count(v) as n, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median,
        quantile_cont(v, 0.75) as q3 from k group by region_type),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, q3 + 1.5 * (q3 - q1) as upper_fence from q)
select f.region_type, f.n, f.q1, f.median, f.q3, f.iqr, f.lower_fence, f.upper_fence,
  min(case when k.v >= f.lower_fence then k.v end) as whisker_low,
  max(case when k.v <= f.upper_fence then k.v end) as whisker_high,
  count(*) filter (where k.v < f.lower_fence or k.v > f.upper_fence) as outliers
from f join k on f.region_type = k.region_type
group by f.region_type, f.n, f.q1, f.median, f.q3, f.iqr, f.lower_fence, f.upper_fence"""

Q["rework_overall"] = f"""with {IE}
select avg(reassignment_count) as avg_reassignments,
  count(*) filter (where reassignment_count > 0) as reassigned_incidents,
  cast(count(*) filter (where reassignment_count > 0) as double) * 100 / cast(count(*) as double) as reassigned_pct,
  avg(reopen_count) as avg_reopens,
  count(*) filter (where reopen_count > 0) as reopened_incidents,
  cast(count(*) filter (where reopen_count > 0) as double) * 100 / cast(count(*) as double) as reopened_pct
from ie"""

REWORK_BY_CLIENT = f"""select client_name, count(incident_id) as incident_count,
  {_round_even('avg(reassignment_count)')} as avg_reassignments, {_round_even('avg(reopen_count)')} as avg_reopens
from ie where client_name is not null group by client_name"""
Q["rework_by_client"] = f"with {IE} " + REWORK_BY_CLIENT
Q["top_clients_by_rework"] = f"""with {IE}, r as ({REWORK_BY_CLIENT})
select * from r order by avg_reassignments desc, client_name limit 3"""
Q["rework_by_region_type"] = f"""with {IE}
select region_type, avg(reassignment_count) as avg_reassignments, avg(reopen_count) as avg_reopens
from ie where region_type is not null group by region_type"""

REASSIGN_IMPACT = """select bins.reassign_bin, bins.bin_order, a.mean_hours, a.median_hours,
  coalesce(a.incident_count, 0) as incident_count
from (select * from (values ('0', 0), ('1', 1), ('2', 2), ('3', 3), ('4+', 4)) t(reassign_bin, bin_order)) bins
left join (
  select reassign_bin, avg(resolution_hours) as mean_hours,
    quantile_cont(cast(resolution_hours as double), 0.5) as median_hours, count(resolution_hours) as incident_count
  from (select case when reassignment_count > -1 and reassignment_count <= 0 then '0'
                    when reassignment_count > 0 and reassignment_count <= 1 then '1'
                    when reassignment_count > 1 and reassignment_count <= 2 then '2'
                    when reassignment_count > 2 and reassignment_count <= 3 then '3'
                    when reassignment_count > 3 and reassignment_count <= 100 then '4+' end as reassign_bin,
               resolution_hours from ie) b
  where reassign_bin is not null group by reassign_bin) a on bins.reassign_bin = a.reassign_bin"""
Q["reassign_impact"] = f"with {IE} " + REASSIGN_IMPACT
STEP = f"""select avg(d) as hours_per_reassignment
from (select mean_hours - lag(mean_hours) over (order by bin_order) as d from ({REASSIGN_IMPACT}) ri) x"""
Q["reassign_step"] = f"with {IE} " + STEP


def _corr(src: str, cols: list[str]) -> str:
    parts = []
    for a in cols:
        for b in cols:
            both = f"{a} is not null and {b} is not null"
            parts.append(
                f"select '{a}' as x_col, '{b}' as y_col, round(covar_pop({a}, {b}) filter (where {both}) / "
                f"nullif(stddev_pop({a}) filter (where {both}) * stddev_pop({b}) filter (where {both}), 0), 6) as r from {src}")
    return "\nunion all ".join(parts)


Q["corr_tickets"] = f"with {TE} " + _corr("te", ["resolution_hours", "response_hours", "agent_interactions"])
Q["corr_incidents"] = f"with {IE} " + _corr("ie", ["resolution_hours", "reassignment_count", "reopen_count"])
Q["mttr_by_priority"] = f"""with {IE}
select priority_name, {_round_even('avg(resolution_hours)')} as mean_hours,
  {_round_even('quantile_cont(cast(resolution_hours as double), 0.5)')} as median_hours,
  count(resolution_hours) as incident_count
from ie where priority_name is not null group by priority_name"""

Q["ticket_summary"] = f"""with {TE}
select count(*) as total_tickets, avg(resolution_hours) as avg_resolution_hours,
  quantile_cont(cast(resolution_hours as double), 0.5) as median_resolution_hours,
  cast(count(*) filter (where sla_status = 'Met') as double) * 100 / cast(count(*) as double) as sla_compliance_pct
from te"""
Q["incident_summary"] = f"""with {IE}
select count(*) as total_incidents, avg(resolution_hours) as avg_resolution_hours,
  quantile_cont(cast(resolution_hours as double), 0.5) as median_resolution_hours,
  avg(cast(made_sla as double)) * 100 as sla_compliance_pct,
  avg(reassignment_count) as avg_reassignments, avg(reopen_count) as avg_reopens
from ie"""
Q["csat_distribution"] = f"""with {TE}, p as (select * from te where survey_results is not null)
select survey_results, round_even(cast(count(*) as double) / cast((select count(*) from p) as double) * 100 * 10, 0) / 10 as pct
from p group by survey_results"""

Q["insights"] = f"""with {TE}, {IE},
t as (select {_share("count(*) filter (where region_type = '" + HOME + "')", 'select count(*) from te')} as home_share,
             {_share("count(*) filter (where region_type = 'International')", 'select count(*) from te')} as intl_share,
             {_share("count(*) filter (where priority_name = 'Medium')", 'select count(*) from te')} as medium_share from te),
i as (select coalesce(avg(case when region_type = 'International' then resolution_hours end), 0)
           - coalesce(avg(case when region_type = '{HOME}' then resolution_hours end), 0) as gap,
         {_round_even("avg(case when priority_name = 'Critical' then resolution_hours end)")} as critical,
         cast(count(*) filter (where reopen_count > 0) as double) * 100 / cast(count(*) as double) as reopen_rate,
         avg(case when region_type = 'International' then reassignment_count end) as intl_re,
         avg(case when region_type = '{HOME}' then reassignment_count end) as home_re from ie),
top as (select * from ({REWORK_BY_CLIENT}) r order by avg_reassignments desc, client_name limit 1),
step as ({STEP})
select 'home_ticket_share_pct' as metric, cast(null as varchar) as label, home_share as value from t
union all select 'international_ticket_share_pct', null, intl_share from t
union all select 'medium_ticket_share_pct', null, medium_share from t
union all select 'mttr_gap_hours', null, gap from i
union all select 'hours_per_reassignment', null, hours_per_reassignment from step
union all select 'top_rework_client', client_name, avg_reassignments from top
union all select 'critical_mttr_hours', null, critical from i
union all select 'reopen_rate_pct', null, reopen_rate from i
union all select 'focus_region', case when intl_re is null or home_re is null then null
                                      when intl_re > home_re then 'International' else '{HOME}' end, null from i"""

# ------------------------------------------------------------- cleaning, load
AS_OF = "timestamp '2024-06-30 00:00:00'"


def _mix(key: str, lo: int, hi: int, salt: int) -> str:
    m = hi - lo
    return f"cast({lo} + ((({key}) * 7919 + {salt}) % {m} + {m}) % {m} as int)"


def _lifecycle(key: str) -> dict[str, str]:
    days, resp = _mix(key, 1, 180, 11), _mix(key, 5, 120, 23)
    hours, close = _mix(key, 1, 72, 37), _mix(key, 5, 60, 41)
    created = f"({AS_OF} - {days} * interval '1 day')"
    first = f"({created} + {resp} * interval '1 minute')"
    resolved = f"({first} + {hours} * interval '1 hour')"
    return {"days_ago": days, "response_minutes": resp, "resolve_hours": hours, "close_minutes": close,
            "agent_interactions": _mix(key, 1, 10, 53), "created_at": created, "first_response_at": first,
            "resolved_at": resolved, "closed_at": f"({resolved} + {close} * interval '1 minute')"}


TICKET_PRIORITY_CASE = """case priority when '1' then 'Critical' when '2' then 'High' when '3' then 'Medium' when '4' then 'Low'
  when 'Critical' then 'Critical' when 'High' then 'High' when 'Medium' then 'Medium' when 'Low' then 'Low'
  when 'P1' then 'Critical' when 'P2' then 'High' when 'P3' then 'Medium' when 'P4' then 'Low' end"""

Q["rename_map"] = "select subject, answer as survey_results, queue, priority, type, language as source, version, tag_1, seq from raw_ticket"

Q["ticket_priority_rules"] = """select seq, priority,
  cast(case when contains(p, 'CRITICAL') or contains(p, 'P1') then 1 when contains(p, 'HIGH') or contains(p, 'P2') then 2
            when contains(p, 'LOW') or contains(p, 'P4') then 4 else 3 end as int) as priority_id
from (select seq, priority, upper(trim(coalesce(priority, 'NAN'))) as p from raw_ticket) x"""

Q["synthetic_fill"] = "select seq, " + ", ".join(f"{v} as {k}" for k, v in _lifecycle("seq").items()) + " from raw_ticket"

Q["surrogate_key"] = """select seq, 10000 + n as ticket_id, cast(n % 5 + 1 as int) as client_id,
  cast(n % 6 + 1 as int) as site_id, cast(n % 5 + 1 as int) as agent_id
from (select seq, row_number() over (order by seq) - 1 as n from raw_ticket) x"""

Q["ticket_transform"] = f"""select subject, coalesce(answer, 'Neutral') as survey_results, queue,
  coalesce({TICKET_PRIORITY_CASE}, 'Medium') as priority, type, language as source, version, tag_1, seq,
  10000 + row_number() over (order by seq) - 1 as ticket_id,
  1 as client_id, 1 as site_id, 1 as agent_id, 3 as priority_id, 'Closed' as status, 'Standard' as support_level
from raw_ticket"""

Q["default_columns"] = """select seq, 1 as client_id, 1 as site_id, 1 as agent_id, 3 as priority_id, 'Closed' as status,
  'Standard' as support_level, 'Ticket ' || cast(row_number() over (order by seq) - 1 as varchar) as subject
from raw_ticket"""

AGENT_MAP = "(select assignment_group, max(agent_id) as agent_id from dim_agent where assignment_group is not null group by assignment_group)"
Q["agent_lookup"] = f"""select t.seq, t.queue, coalesce(a.agent_id, 1) as agent_id
from raw_ticket t left join {AGENT_MAP} a on t.queue = a.assignment_group"""

_LC = _lifecycle("ticket_id")
Q["load_fact_ticket"] = f"""with t as (
  select subject, coalesce(answer, 'Neutral') as survey_results, queue, coalesce({TICKET_PRIORITY_CASE}, 'Medium') as priority,
    type, language as source, version, tag_1, 10000 + row_number() over (order by seq) - 1 as ticket_id
  from raw_ticket),
r as (select t.*, cast(1 as bigint) as client_id, cast(1 as bigint) as site_id, coalesce(a.agent_id, 1) as agent_id,
        cast(coalesce(p.priority_id, 3) as int) as priority_id
      from t left join {AGENT_MAP} a on t.queue = a.assignment_group
      left join (select priority_name, max(priority_id) as priority_id from dim_priority group by priority_name) p
        on t.priority = p.priority_name)
select r.ticket_id, r.client_id, r.site_id, r.agent_id, r.priority_id,
  {_LC['created_at']} as created_at, {_LC['first_response_at']} as first_response_at,
  {_LC['resolved_at']} as resolved_at, {_LC['closed_at']} as closed_at,
  'Closed' as status, substring(source, 1, 50) as source, substring(type, 1, 100) as topic,
  substring(subject, 1, 200) as subject, '' as body,
  240 as expected_sla_resolve_min, 30 as sla_first_response_min, 180 as sla_resolution_min,
  {_LC['agent_interactions']} as agent_interactions, substring(survey_results, 1, 50) as survey_results,
  substring(version, 1, 100) as product_group, substring(tag_1, 1, 50) as support_level
from r
where r.client_id in (select client_id from dim_client) and r.site_id in (select site_id from dim_site)
  and r.agent_id in (select agent_id from dim_agent) and r.priority_id in (select priority_id from dim_priority)"""

Q["fk_rejects"] = """select b.ticket_id, b.client_id, b.site_id, b.seq,
  case when b.client_id is not null and c.client_id is null then 'client_id not in dim_client'
       when b.site_id is not null and s.site_id is null then 'site_id not in dim_site' end as reject_reason
from batch_ticket b left join (select distinct client_id from dim_client) c on b.client_id = c.client_id
left join (select distinct site_id from dim_site) s on b.site_id = s.site_id
where (b.client_id is not null and c.client_id is null) or (b.site_id is not null and s.site_id is null)"""

Q["pk_dedupe"] = """select ticket_id, client_id, site_id, seq
from (select *, row_number() over (partition by ticket_id order by seq) as rn from batch_ticket) b
where rn = 1 and not exists (select 1 from fact_ticket f where f.ticket_id = b.ticket_id and f.status = 'Closed')"""

INCIDENT_LABEL = """case priority when '1 - Critical' then 'critical' when '2 - High' then 'high'
  when '3 - Moderate' then 'moderate' when '4 - Low' then 'low' end"""
INCIDENT_CLEAN = f"""select number as incident_id,
  case s when 'nat' then 'new' when '7' then 'resolved' when '6' then 'closed' else s end as incident_state,
  cast(active as int) as active, cast(made_sla as int) as made_sla, cast(reassignment_count as int) as reassignment_count,
  sys_mod_count as modification_count,
  coalesce(try_strptime(trim(opened_at), '%d/%m/%Y %H:%M'), try_strptime(trim(opened_at), '%d/%m/%Y %H:%M:%S'),
           try_cast(opened_at as timestamp)) as opened_at,
  try_cast(trim(split_part(impact, '-', 1)) as int) as impact,
  try_cast(trim(split_part(urgency, '-', 1)) as int) as urgency,
  priority, {INCIDENT_LABEL} as priority_name, nullif(vendor, '?') as vendor,
  trim(assignment_group) as assignment_group, lower(trim(contact_type)) as contact_type
from (select *, case when lower(trim(nullif(incident_state, '-100'))) <> 'nan'
                     then lower(trim(nullif(incident_state, '-100'))) end as s from raw_incident) x"""
Q["incident_clean"] = INCIDENT_CLEAN


def _incident_priority(code: str, name: str) -> str:
    c = f"trim(coalesce({code}, '3'))"
    n = f"lower(coalesce({name}, ''))"
    return (f"cast(case when contains({c}, '1') or contains({n}, 'critical') then 1 "
            f"when contains({c}, '2') or contains({n}, 'high') then 2 "
            f"when contains({c}, '4') or contains({n}, 'low') then 4 else 3 end as int)")


Q["incident_priority_rules"] = f"""select incident_id, priority, priority_name, {_incident_priority('priority', 'priority_name')} as priority_id
from (select number as incident_id, priority, {INCIDENT_LABEL} as priority_name from raw_incident) x"""

Q["incident_rejects"] = f"""select incident_id,
  case when impact is null then 'impact is not an integer' when urgency is null then 'urgency is not an integer' end as reject_reason
from ({INCIDENT_CLEAN}) c where impact is null or urgency is null"""

Q["incident_load_rejects"] = f"""select incident_id, reject_reason from ({Q['incident_rejects']}) r
union all select incident_id, 'incident_id is repeated' from (
  select incident_id, row_number() over (partition by incident_id) as nth from ({INCIDENT_CLEAN}) c
  where impact is not null and urgency is not null) x where nth > 1"""

Q["incident_impute"] = f"""select incident_id, opened_at,
  coalesce(resolved_at, opened_at + {_mix('incident_id', 1, 72, 37)} * interval '1 hour') as resolved_at,
  resolved_at is null as resolved_imputed from fact_incident"""

_ORDER = ", ".join(f"{c} nulls first" for c in ["opened_at", "incident_state", "impact", "urgency", "priority", "vendor",
                                                  "assignment_group", "made_sla", "active", "reassignment_count",
                                                  "modification_count"])
Q["load_fact_incident"] = f"""with c as ({INCIDENT_CLEAN}),
f as (select *, row_number() over (partition by incident_id order by {_ORDER}) as rn
      from c where impact is not null and urgency is not null),
o as (select *, coalesce(opened_at, {AS_OF} - {_mix('incident_id', 1, 180, 11)} * interval '1 day') as op from f where rn = 1)
select incident_id, cast(null as bigint) as ticket_id, cast(1 as bigint) as client_id, cast(1 as bigint) as site_id,
  {_incident_priority('priority', 'priority_name')} as priority_id, op as opened_at,
  op + {_mix('incident_id', 1, 72, 37)} * interval '1 hour' as resolved_at,
  substring(incident_state, 1, 50) as incident_state, active, reassignment_count, 0 as reopen_count, made_sla,
  substring(contact_type, 1, 50) as contact_type, impact, urgency, substring(assignment_group, 1, 100) as assignment_group
from o"""

METRICS_CLEAN = """select seq, try_cast(site_id as int) as site_id, try_cast(timestamp_utc as timestamp) as timestamp_utc,
  try_cast(cpu_util_pct as double) as cpu_util_pct, try_cast(mem_util_pct as double) as mem_util_pct,
  try_cast(link_util_pct as double) as link_util_pct, try_cast(latency_ms as double) as latency_ms,
  try_cast(packet_loss_pct as double) as packet_loss_pct from raw_metrics"""
Q["metrics_clean"] = METRICS_CLEAN
_MCOLS = {"cpu_util_pct": "decimal(5,2)", "mem_util_pct": "decimal(5,2)", "link_util_pct": "decimal(5,2)",
          "latency_ms": "decimal(8,2)", "packet_loss_pct": "decimal(5,2)"}
_REASON = ("case when site_id is null then 'site_id is missing' when timestamp_utc is null then 'timestamp_utc is not a time' "
           + " ".join(f"when {c} is null then '{c} is not a number' when try_cast({c} as {t}) is null then '{c} does not fit {t}'"
                      for c, t in _MCOLS.items())
           + " when not known then 'site_id not in dim_site' end")
METRICS_REASONED = f"""(select m.*, s.site_id is not null as known, {_REASON.replace('site_id is null', 'm.site_id is null')} as reject_reason
  from ({METRICS_CLEAN}) m left join (select distinct cast(site_id as int) as site_id from dim_site) s on m.site_id = s.site_id)"""
Q["metrics_rejects"] = f"select seq, reject_reason from {METRICS_REASONED} r where reject_reason is not null"
ACCEPTED_METRICS = (f"select seq, site_id, timestamp_utc, "
                    + ", ".join(f"cast({c} as {t}) as {c}" for c, t in _MCOLS.items())
                    + f" from {METRICS_REASONED} r where reject_reason is null")
Q["load_fact_metrics"] = f"""select row_number() over (order by seq) as metric_id, site_id, timestamp_utc, {', '.join(_MCOLS)}
from ({ACCEPTED_METRICS}) a"""

Q["stage_support"] = f"""select row_number() over (order by support_id) as support_id, support_id as source_id,
  substring(body, 1, 4000) as body, substring(assignment_group, 1, 100) as assignment_group,
  substring(priority_name, 1, 50) as priority_name, substring(support_level, 1, 50) as support_level,
  {AS_OF} as load_date, length(body) as body_chars from raw_support"""

Q["lifecycle_times"] = """select ticket_id, created_at,
  coalesce(first_response_at, created_at + 30 * interval '1 minute') as est_first_response_at,
  coalesce(resolved_at, created_at + 120 * interval '1 minute') as est_resolved_at,
  coalesce(closed_at, coalesce(resolved_at, created_at + 120 * interval '1 minute') + 15 * interval '1 minute') as est_closed_at
from fact_ticket"""

Q["dim_time"] = """with b as (select min(d) as lo, max(d) as hi from (
    select cast(created_at as date) as d from fact_ticket union all select cast(opened_at as date) from fact_incident) x),
g as (select lo, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as d from b)
select cast(date_diff('day', lo, d) + 1 as int) as time_id, d as date, cast(day(d) as int) as day,
  cast(month(d) as int) as month, cast(quarter(d) as int) as quarter, cast(year(d) as int) as year from g"""

Q["schema_intersect"] = "select client_id, client_name, industry, size_segment, hq_country, region_group, contract_tier from dim_client"

Q["table_counts"] = "\nunion all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {src}" for name, src in [
        ("dim_client", "dim_client"), ("dim_site", "dim_site"), ("dim_agent", "dim_agent"), ("dim_priority", "dim_priority"),
        ("dim_region", "dim_region"), ("fact_ticket", "fact_ticket"), ("fact_incident", "fact_incident"),
        ("fact_metrics", "fact_metrics"), ("stg_it_support", "raw_support"), ("stg_tech_support", "raw_tech_support")])

# ------------------------------------------------------------------ business
Q["executive_summary"] = f"""with i as (
  select f.*, sr.region_name, p.priority_name from fact_incident f join {SITE_REGION} sr on f.site_id = sr.site_id
  join dim_priority p on f.priority_id = p.priority_id),
r as (select region_name, count(*) as n from i group by region_name),
top as (select first(region_name order by n desc, region_name) as top_region, max(n) as top_n from r),
tot as (select count(*) as total_incidents, count(*) filter (where made_sla = 0) as sla_breaches,
          avg(case when priority_name = 'Critical' then date_diff('hour', opened_at, resolved_at) end) / 24.0 as crit from i)
select tot.total_incidents, top.top_region, top.top_n as top_region_incidents,
  cast(top.top_n as double) * 100 / cast(tot.total_incidents as double) as top_region_share_pct,
  tot.sla_breaches, cast(tot.total_incidents - tot.sla_breaches as double) * 100 / cast(tot.total_incidents as double) as sla_compliance_pct,
  tot.crit as critical_avg_resolution_days, 4 as critical_target_hours
from tot, top"""

Q["penalty_exposure"] = """with ib as (select client_id, cast(sum(case when made_sla = 0 then 1 else 0 end) as bigint) as n from fact_incident group by client_id),
tb as (select client_id, cast(sum(case when date_diff('minute', created_at, resolved_at) > sla_resolution_min then 1 else 0 end) as bigint) as n
       from fact_ticket group by client_id)
select c.client_id, c.client_name, c.penalty_per_breach, coalesce(ib.n, 0) as incident_breaches, coalesce(tb.n, 0) as ticket_breaches,
  coalesce(ib.n, 0) + coalesce(tb.n, 0) as total_breaches,
  cast(cast(coalesce(ib.n, 0) + coalesce(tb.n, 0) as decimal(18,0)) * c.penalty_per_breach as decimal(18,2)) as penalty_exposure
from dim_client c left join ib on c.client_id = ib.client_id left join tb on c.client_id = tb.client_id"""


def _dec_avg(x: str, precision: int) -> str:
    """Exact decimal mean of a scale-2 decimal, rounded half up to scale 6."""
    cents = f"cast(sum({x}) * 100 as hugeint)"
    n = f"count({x})"
    q = (f"case when {cents} >= 0 then ({cents} * 20000 + {n}) // (2 * {n}) "
         f"else -((-{cents} * 20000 + {n}) // (2 * {n})) end")
    return f"cast(cast({q} as decimal(18,0)) * cast(0.000001 as decimal(7,6)) as decimal({precision},6))"


_MEAN_P = {"cpu_util_pct": 9, "mem_util_pct": 9, "link_util_pct": 9, "latency_ms": 12, "packet_loss_pct": 9}


def _capacity(src: str, keys: str, key_cols: str) -> str:
    aggs = ", ".join(f"{_dec_avg(m, p)} as {m}_mean, max({m}) as {m}_max, "
                     f"round(quantile_cont(cast({m} as double), 0.95), 6) as {m}_p95" for m, p in _MEAN_P.items())
    return f"select {key_cols}, count(*) as samples, {aggs} from {src} group by {keys}"


Q["capacity_hourly"] = _capacity("fact_metrics", "site_id, date_trunc('hour', timestamp_utc)",
                                 "site_id, date_trunc('hour', timestamp_utc) as hour")
Q["capacity_by_region"] = _capacity(
    f"(select m.*, sr.region_name from fact_metrics m join {SITE_REGION} sr on m.site_id = sr.site_id) x",
    "region_name, cast(timestamp_utc as date)", "region_name, cast(timestamp_utc as date) as day")

Q["sla_config_minutes"] = f"""with t as (select p.priority_name, t.created_at, t.resolved_at,
    case p.priority_name when 'Critical' then 60 when 'High' then 240 when 'Medium' then 480 when 'Low' then 1440 end as sla_minutes,
    date_diff('minute', t.created_at, t.resolved_at) as m
  from fact_ticket t join dim_priority p on t.priority_id = p.priority_id)
select priority_name, sla_minutes, count(*) as ticket_count, count(*) filter (where resolved_at is not null) as resolved_count,
  count(*) filter (where resolved_at is not null and m > sla_minutes) as breached_count,
  count(*) filter (where resolved_at is not null and m <= sla_minutes) as within_sla_count,
  {_pct2("count(*) filter (where resolved_at is not null and m <= sla_minutes)", "count(*) filter (where resolved_at is not null)")} as compliance_pct
from t group by priority_name, sla_minutes"""

Q["sla_contract_terms"] = """select c.client_id, c.client_name, c.response_time_sla_min, c.resolution_time_sla_min, count(*) as ticket_count,
  count(*) filter (where date_diff('minute', t.created_at, t.first_response_at) > c.response_time_sla_min) as response_breaches,
  count(*) filter (where date_diff('minute', t.created_at, t.resolved_at) > c.resolution_time_sla_min) as resolution_breaches
from fact_ticket t join dim_client c on t.client_id = c.client_id
group by c.client_id, c.client_name, c.response_time_sla_min, c.resolution_time_sla_min"""

_GROUPS = {HOME: ["NATION_2", "NATION_7", "NATION_12", "NATION_17"],
           "International": ["NATION_0", "NATION_1", "NATION_3", "NATION_4"]}
_MEMBERS = ", ".join(f"('{r}', '{g}')" for g, rs in _GROUPS.items() for r in rs)
Q["region_rollup"] = f"""with m as (select * from (values {_MEMBERS}) t(region_name, region_group)),
i as (select f.*, sr.region_name from fact_incident f join {SITE_REGION} sr on f.site_id = sr.site_id)
select coalesce(m.region_group, 'Unassigned') as region_group, count(distinct i.region_name) as regions, count(*) as incident_count,
  cast(sum(case when made_sla = 1 then 1 else 0 end) as bigint) as sla_met,
  cast(sum(case when made_sla = 0 then 1 else 0 end) as bigint) as sla_breached,
  {_int_avg("date_diff('hour', opened_at, resolved_at)")} as avg_resolution_hours
from i left join m on i.region_name = m.region_name group by coalesce(m.region_group, 'Unassigned')"""

Q["datediff_boundaries"] = """select incident_id, cast(date_diff('minute', opened_at, acknowledged_at) as int) as minutes_to_ack,
  cast(date_diff('hour', opened_at, resolved_at) as int) as hours_to_resolve,
  cast(date_diff('day', opened_at, resolved_at) as int) as days_to_resolve,
  date_sub('hour', opened_at, resolved_at) as elapsed_hours_to_resolve from fact_incident"""

Q["date_features"] = f"select ticket_id, created_at, {_calendar('created_at')} from fact_ticket"

# ----------------------------------------------------------------- profiling
RAW_COLUMNS = {
    "raw_incident": ["number", "incident_state", "impact", "urgency", "priority", "vendor", "opened_at", "made_sla",
                     "active", "reassignment_count", "assignment_group", "contact_type", "sys_mod_count"],
    "raw_ticket": ["subject", "answer", "queue", "priority", "type", "language", "version", "tag_1", "seq"],
    "raw_metrics": ["asset_id", "site_id", "timestamp_utc", "cpu_util_pct", "mem_util_pct", "link_util_pct",
                    "latency_ms", "packet_loss_pct", "seq"],
    "raw_support": ["support_id", "body", "assignment_group", "priority_name", "support_level"],
}
Q["profile_shape"] = "\nunion all ".join(
    f"select '{t}' as table_name, count(*) as row_count, {len(c)} as column_count, '{','.join(c)}' as columns from {t}"
    for t, c in RAW_COLUMNS.items())
Q["profile_missing"] = "\nunion all ".join(
    f"select {i + 1} as column_position, '{c}' as column_name, count(*) filter (where {c} is null) as missing_count from raw_incident"
    for i, c in enumerate(RAW_COLUMNS["raw_incident"]))
Q["profile_duplicates"] = "\nunion all ".join(
    f"select '{t}' as table_name, count(*) as row_count, count(*) - (select count(*) from (select distinct * from {t}) d) as duplicate_rows from {t}"
    for t in ["raw_incident", "raw_ticket", "raw_metrics", "batch_ticket"])

_NUM = ["number", "reassignment_count", "sys_mod_count"]
_CAT = ["incident_state", "impact", "urgency", "priority", "vendor", "opened_at", "made_sla", "active",
        "assignment_group", "contact_type"]
_POS = {c: i + 1 for i, c in enumerate(RAW_COLUMNS["raw_incident"])}
_num_parts = [
    f"""select {_POS[c]} as column_position, '{c}' as column_name, count({c}) as count, cast(null as bigint) as unique,
  cast(null as varchar) as top, cast(null as bigint) as freq, round(avg(cast({c} as double)), 6) as mean,
  round(stddev_samp(cast({c} as double)), 6) as std, min(cast({c} as double)) as min,
  round(quantile_cont(cast({c} as double), 0.25), 6) as q25, round(quantile_cont(cast({c} as double), 0.5), 6) as q50,
  round(quantile_cont(cast({c} as double), 0.75), 6) as q75, max(cast({c} as double)) as max from raw_incident""" for c in _NUM]
_cat_parts = [
    f"""select {_POS[c]} as column_position, '{c}' as column_name, coalesce(cast(sum(n) as bigint), 0) as count, count(*) as unique,
  first(value order by n desc, value) as top, max(n) as freq, cast(null as double) as mean, cast(null as double) as std,
  cast(null as double) as min, cast(null as double) as q25, cast(null as double) as q50, cast(null as double) as q75,
  cast(null as double) as max
from (select cast({c} as varchar) as value, count(*) as n from raw_incident where {c} is not null group by 1) g""" for c in _CAT]
Q["profile_describe"] = "\nunion all ".join(_num_parts + _cat_parts)

_TEXT = ["incident_state", "impact", "urgency", "priority", "vendor", "opened_at", "assignment_group", "contact_type"]
_TEXT_LONG = "\n union all ".join(f"select '{c}' as column_name, {c} as value from raw_incident" for c in _TEXT)
Q["profile_key_columns"] = f"""with v as ({_TEXT_LONG})
select column_name, count(distinct value) as distinct_count from v where value is not null
group by column_name having count(distinct value) < 20"""
Q["profile_unique"] = f"""with v as ({_TEXT_LONG}),
c as (select column_name, value, count(*) as row_count from v group by column_name, value),
k as (select column_name from c where value is not null group by column_name having count(*) < 20)
select c.column_name, c.value, c.row_count from c join k on c.column_name = k.column_name"""
Q["profile_date_ranges"] = "\nunion all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, min({c}) as min_value, max({c}) as max_value from {t}"
    for t, cols in [("fact_ticket", ["created_at", "first_response_at", "resolved_at", "closed_at"]),
                    ("fact_incident", ["opened_at", "acknowledged_at", "resolved_at"]),
                    ("fact_metrics", ["timestamp_utc"])] for c in cols)

# ------------------------------------------------------------------- quality
FK_EDGES = [
    ("dim_site", "client_id", "dim_client", "client_id"), ("dim_site", "region_id", "dim_region", "region_id"),
    ("fact_ticket", "client_id", "dim_client", "client_id"), ("fact_ticket", "site_id", "dim_site", "site_id"),
    ("fact_ticket", "agent_id", "dim_agent", "agent_id"), ("fact_ticket", "priority_id", "dim_priority", "priority_id"),
    ("fact_incident", "client_id", "dim_client", "client_id"), ("fact_incident", "site_id", "dim_site", "site_id"),
    ("fact_incident", "priority_id", "dim_priority", "priority_id"), ("fact_metrics", "site_id", "dim_site", "site_id"),
]
FK_AUDIT = "\nunion all ".join(
    f"select '{ch}' as child_table, '{col}' as fk_column, '{par}' as parent_table, count(*) as orphan_rows from {ch} c "
    f"where c.{col} is not null and not exists (select 1 from {par} p where p.{pk} = c.{col})"
    for ch, col, par, pk in FK_EDGES)
Q["fk_audit"] = FK_AUDIT


def _nullpct(c: str) -> str:
    return f"round_even(cast(count(*) filter (where {c} is null) as double) * 100 / count(*) * 10000, 0) / 10000"


_CHECKS = {
    "fact_ticket": [("completeness", "resolved_at null pct", _nullpct("resolved_at"), 10),
                    ("completeness", "survey_results null pct", _nullpct("survey_results"), 10),
                    ("validity", "resolved before created", "count(*) filter (where resolved_at < created_at)", 0),
                    ("validity", "responded before created", "count(*) filter (where first_response_at < created_at)", 0),
                    ("uniqueness", "duplicate ticket_id", "count(*) - count(distinct ticket_id)", 0)],
    "fact_incident": [("completeness", "made_sla null pct", _nullpct("made_sla"), 5),
                      ("completeness", "resolved_at null pct", _nullpct("resolved_at"), 10),
                      ("validity", "resolved before opened", "count(*) filter (where resolved_at < opened_at)", 0),
                      ("uniqueness", "duplicate incident_id", "count(*) - count(distinct incident_id)", 0)],
    "fact_metrics": [("range", "cpu_util_pct outside 0-100", "count(*) filter (where cpu_util_pct < 0 or cpu_util_pct > 100)", 0),
                     ("range", "packet_loss_pct outside 0-100", "count(*) filter (where packet_loss_pct < 0 or packet_loss_pct > 100)", 0),
                     ("completeness", "latency_ms null pct", _nullpct("latency_ms"), 1)],
    "dim_client": [("completeness", "industry null pct", _nullpct("industry"), 5),
                   ("uniqueness", "duplicate client_id", "count(*) - count(distinct client_id)", 0)],
}
_METRIC_ROWS = "\nunion all ".join(
    [f"select child_table as table_name, 'referential' as validation_type, fk_column || ' -> ' || parent_table as validation_metric, "
     f"cast(orphan_rows as decimal(20,4)) as metric_value, cast(0 as decimal(20,4)) as threshold_value from ({FK_AUDIT}) fk"]
    + [f"select '{t}', '{ty}', '{m}', cast({expr} as decimal(20,4)), cast({thr} as decimal(20,4)) from {t}"
       for t, checks in _CHECKS.items() for ty, m, expr, thr in checks])
VALIDATION_LOG = f"""select row_number() over (order by table_name, validation_type, validation_metric) as validation_id,
  {AS_OF} as validation_date, table_name, validation_type, validation_metric, metric_value, threshold_value,
  coalesce(case when threshold_value = 0 then case when metric_value = 0 then 'PASS' else 'FAIL' end
                else case when metric_value <= threshold_value then 'PASS' else 'FAIL' end end, 'FAIL') as validation_status,
  cast(null as varchar) as notes
from ({_METRIC_ROWS}) m"""
Q["validation_log"] = VALIDATION_LOG
Q["dq_score"] = f"""select count(*) as checks_total, count(*) filter (where validation_status = 'PASS') as checks_passed,
  count(*) filter (where validation_status <> 'PASS') as checks_failed,
  {_pct2("count(*) filter (where validation_status = 'PASS')", "count(*)")} as dq_score_pct
from ({VALIDATION_LOG}) v"""

# --------------------------------------------------------- sources and sinks
Q["csv_roundtrip"] = "select support_id, body, assignment_group, priority_name, support_level from raw_support"
Q["optional_source"] = """select 'customer' as source_name, 'loaded' as status, count(*) as row_count from customer
union all select 'orders', 'loaded', count(*) from orders
union all select 'ticket_archive', 'missing', cast(0 as bigint)"""
Q["sample_first_n"] = "select * from raw_ticket order by seq limit 100"
_FT_TYPES = [("agent_id", "bigint"), ("priority_id", "int"), ("created_at", "timestamp"), ("first_response_at", "timestamp"),
             ("resolved_at", "timestamp"), ("closed_at", "timestamp"), ("status", "varchar"), ("source", "varchar"),
             ("topic", "varchar"), ("subject", "varchar"), ("body", "varchar"), ("expected_sla_resolve_min", "int"),
             ("sla_first_response_min", "int"), ("sla_resolution_min", "int"), ("agent_interactions", "int"),
             ("survey_results", "varchar"), ("product_group", "varchar"), ("support_level", "varchar")]
Q["append_aligned"] = ("select ticket_id, client_id, site_id, "
                       + ", ".join(f"cast(null as {t}) as {c}" for c, t in _FT_TYPES) + " from batch_ticket")
_DIMS = ["dim_region", "dim_client", "dim_site", "dim_agent", "dim_priority"]
Q["dim_reload"] = "\nunion all ".join(
    f"select '{d}' as table_name, {i + 1} as load_order, count(*) as rows_loaded from {d}" for i, d in enumerate(_DIMS))

_REPEATS = f"select coalesce(sum(n - 1), 0) as n from (select count(*) as n from ({INCIDENT_CLEAN}) c where impact is not null and urgency is not null group by incident_id) x"


def _load_report(raw_ticket: str = "raw_ticket", raw_incident: str = "raw_incident", raw_metrics: str = "raw_metrics") -> str:
    """Report rows as (table_name, input, accepted, rejected, duplicates) of a
    run over the given sources."""
    on = lambda sql: (sql.replace("from raw_ticket", f"from {raw_ticket}").replace("from raw_incident", f"from {raw_incident}")
                      .replace("from raw_metrics", f"from {raw_metrics}"))
    return f"""
  {' union all '.join(f"select '{d}' as table_name, count(*) as input_rows, count(*) as accepted_rows, 0 as rejected_rows, 0 as duplicate_rows from {d}" for d in _DIMS)}
  union all select 'fact_ticket', (select count(*) from {raw_ticket}), n, (select count(*) from {raw_ticket}) - n, 0
    from (select count(*) as n from ({on(Q['load_fact_ticket'])}) x) y
  union all select 'fact_incident', (select count(*) from {raw_incident}),
    (select count(*) from ({on(Q['load_fact_incident'])}) x),
    (select count(*) from ({on(Q['incident_rejects'])}) x) + ({on(_REPEATS)}), ({on(_REPEATS)})
  union all select 'fact_metrics', (select count(*) from {raw_metrics}), (select count(*) from ({on(Q['load_fact_metrics'])}) x),
    (select count(*) from ({on(Q['metrics_rejects'])}) x), 0
  union all select 'stg_it_support', count(*), count(*), 0, 0 from raw_support
  union all select 'stg_tech_support', count(*), count(*), 0, 0 from raw_tech_support"""


def _told(report: str, failed: str = "''", skipped: str = "''") -> str:
    lost = f"table_name in ({failed}, {skipped})"
    count = lambda c, x: f"case when {lost} then null else cast({x} as bigint) end as {c}"
    return f"""select table_name,
  case when table_name in ({failed}) then 'failed' when table_name in ({skipped}) then 'skipped' else 'loaded' end as status,
  case when table_name in ({failed}) then '[USER_RAISED_EXCEPTION] planted fault SQLSTATE: P0001'
       when table_name in ({skipped}) then 'dim_agent was not loaded' end as error,
  {count('input_rows', 'input_rows')}, {count('accepted_rows', 'accepted_rows')}, {count('rejected_rows', 'rejected_rows')},
  {count('duplicate_rows', 'duplicate_rows')}, {count('unaccounted_rows', 'input_rows - accepted_rows - rejected_rows')}
from ({report}) r"""


LOAD_REPORT = _told(_load_report())
Q["load_report"] = LOAD_REPORT
Q["load_report_faults"] = _told(_load_report(), "'dim_agent', 'fact_metrics'", "'fact_ticket'")
_RAW_INCIDENT_ORDER = ", ".join(f"{c} nulls first" for c in [
    "number", "incident_state", "impact", "urgency", "priority", "vendor", "opened_at", "made_sla", "active",
    "reassignment_count", "assignment_group", "contact_type", "sys_mod_count"])
Q["load_report_sample"] = _told(_load_report(
    "(select * from raw_ticket order by seq limit 100) rt", f"(select * from raw_incident order by {_RAW_INCIDENT_ORDER} limit 100) ri",
    "(select * from raw_metrics order by seq limit 100) rm"))
Q["audit_log"] = f"""with rep as ({LOAD_REPORT})
select cast(1 as bigint) as audit_id, 'deskflow_load_20240630_000000' as process_name,
  cast(sum(accepted_rows) as varchar) as rows_processed, 'COMPLETED' as status, {AS_OF} as run_timestamp,
  'rejected=' || cast(sum(rejected_rows) as varchar) as notes
from rep where table_name in ('fact_ticket', 'fact_incident', 'fact_metrics')"""

# ----------------------------------------------------------------- streaming
Q["metrics_incremental"] = ACCEPTED_METRICS
Q["tickets_incremental"] = Q["load_fact_ticket"]

# ------------------------------------------------------- quantiles by group
Q["mttr_quantiles_by_client"] = f"""with {IE}
select client_name, count(resolution_hours) as n, quantile_cont(cast(resolution_hours as double), 0.25) as q0,
  quantile_cont(cast(resolution_hours as double), 0.5) as q1, quantile_cont(cast(resolution_hours as double), 0.95) as q2
from ie where resolution_hours is not null group by client_name"""

# ------------------------------------------------------------------- renames
Q["rename_incident"] = """select number as incident_id, incident_state, impact, urgency, priority as priority_id, vendor, opened_at,
  made_sla, active, reassignment_count, assignment_group, contact_type, sys_mod_count as modification_count from raw_incident"""
Q["rename_it_support"] = """select support_id, "Body" as body, "Department" as assignment_group, "Priority" as priority_name,
  "Tags" as support_level from raw_support_named"""
Q["rename_tech_support"] = "select support_id, body, assignment_group, priority_name, support_level from raw_tech_support"
# (source, column, name, status, whether the target table has the name)
_RENAME_STEPS = [
    ("raw_ticket", "subject", "subject", "kept", True), ("raw_ticket", "answer", "survey_results", "renamed", True),
    ("raw_ticket", "queue", "queue", "kept", False), ("raw_ticket", "priority", "priority", "kept", False),
    ("raw_ticket", "type", "type", "kept", False), ("raw_ticket", "language", "source", "renamed", True),
    ("raw_ticket", "version", "version", "kept", False), ("raw_ticket", "tag_1", "tag_1", "kept", False),
    ("raw_ticket", "seq", "seq", "kept", False), ("raw_ticket", "body", "body", "absent", True),
    ("raw_ticket", "ticket_type", "topic", "absent", True), ("raw_ticket", "assignment_group", "assignment_group", "absent", False),
    ("raw_ticket", "priority_level", "priority_name", "absent", False),
    ("raw_ticket", "product_version", "product_group", "absent", True), ("raw_ticket", "tags", "support_level", "absent", True),
    ("raw_incident", "number", "incident_id", "renamed", True), ("raw_incident", "incident_state", "incident_state", "kept", True),
    ("raw_incident", "impact", "impact", "kept", True), ("raw_incident", "urgency", "urgency", "kept", True),
    ("raw_incident", "priority", "priority_id", "renamed", True), ("raw_incident", "vendor", "vendor", "kept", False),
    ("raw_incident", "opened_at", "opened_at", "kept", True), ("raw_incident", "made_sla", "made_sla", "kept", True),
    ("raw_incident", "active", "active", "kept", True), ("raw_incident", "reassignment_count", "reassignment_count", "kept", True),
    ("raw_incident", "assignment_group", "assignment_group", "kept", True), ("raw_incident", "contact_type", "contact_type", "kept", True),
    ("raw_incident", "sys_mod_count", "modification_count", "renamed", False),
    ("raw_incident", "reopen_count", "reopen_count", "absent", True), ("raw_incident", "caller_id", "caller_id", "absent", True),
    ("raw_incident", "sys_created_at", "acknowledged_at", "absent", True), ("raw_incident", "sys_updated_at", "updated_at", "absent", False),
    ("raw_incident", "u_symptom", "u_symptom", "absent", True), ("raw_incident", "cmdb_ci", "configuration_item", "absent", False),
    ("raw_incident", "assigned_to", "assigned_to", "absent", True), ("raw_incident", "knowledge", "knowledge_flag", "absent", False),
    ("raw_incident", "u_priority_confirmation", "priority_confirmed_flag", "absent", False),
    ("raw_incident", "notify", "notification_type", "absent", False), ("raw_incident", "closed_code", "closed_code", "absent", True),
    ("raw_incident", "resolved_by", "resolved_by", "absent", True), ("raw_incident", "resolved_at", "resolved_at", "absent", True),
    ("raw_incident", "closed_at", "closed_at", "absent", True), ("raw_incident", "priority_level", "priority_name", "absent", False),
    ("raw_support_named", "support_id", "support_id", "kept", True), ("raw_support_named", "Body", "body", "renamed", True),
    ("raw_support_named", "Department", "assignment_group", "renamed", True),
    ("raw_support_named", "Priority", "priority_name", "renamed", True), ("raw_support_named", "Tags", "support_level", "renamed", True),
    ("raw_tech_support", "support_id", "support_id", "kept", True), ("raw_tech_support", "body", "body", "kept", True),
    ("raw_tech_support", "assignment_group", "assignment_group", "kept", True),
    ("raw_tech_support", "priority_name", "priority_name", "kept", True), ("raw_tech_support", "support_level", "support_level", "kept", True)]
Q["rename_report"] = "\nunion all ".join(
    f"select '{s}' as source_name, '{c}' as source_column, '{t}' as target_column, '{how}' as status, {inside} as in_target, "
    + ("cast(null as bigint)" if how == "absent" else f'(select count("{c}") from {s})') + " as non_null_rows"
    for s, c, t, how, inside in _RENAME_STEPS)

# ----------------------------------------------------------------- csv lines
Q["csv_corrupt"] = """with l as (select *, case when k % 29 = 0 then 'too few fields' when k % 31 = 0 then 'too many fields'
    when k % 37 = 0 then 'client_id is not of type bigint' when k % 41 = 0 then 'placed is not of type date' end as reject_reason from csv_lines)
select case when reject_reason is null then k end as order_id, case when reject_reason is null then cust end as client_id,
  case when reject_reason is null then amount end as amount, case when reject_reason is null then cast(day as date) end as placed,
  case when reject_reason is null then note end as note,
  case when k % 29 = 0 then k || ',' || cust
       when k % 31 = 0 then k || ',' || cust || ',' || amount || ',' || day || ',' || quoted || ',extra'
       when k % 37 = 0 then k || ',C' || cust || ',' || amount || ',' || day || ',' || quoted
       when k % 41 = 0 then k || ',' || cust || ',' || amount || ',2024-13-45,' || quoted end as record, reject_reason
from l"""

# ------------------------------------------------------------------ catalog
def _catalog() -> str:
    from deskflow import schemas  # table column lists (specification constants)

    counts = {
        "dim_region": "select count(*) from dim_region", "dim_client": "select count(*) from dim_client",
        "dim_site": "select count(*) from dim_site", "dim_agent": "select count(*) from dim_agent",
        "dim_priority": "select count(*) from dim_priority",
        "fact_ticket": f"select count(*) from ({Q['load_fact_ticket']}) x",
        "fact_incident": f"select count(*) from ({Q['load_fact_incident']}) x",
        "fact_metrics": f"select count(*) from ({Q['load_fact_metrics']}) x",
        "stg_it_support": "select count(*) from raw_support", "stg_tech_support": "select count(*) from raw_tech_support",
    }
    parts = []
    for name, schema in schemas.TABLES.items():
        n = f"({counts[name]})" if name in counts else "cast(0 as bigint)"
        parts.append(f"select '{name}' as table_name, {len(schema.fields)} as column_count, "
                     f"'{','.join(schema.names)}' as columns, {n} as row_count")
    return "\nunion all ".join(parts)


Q["schema_catalog"] = _catalog()
