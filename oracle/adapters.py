"""DuckDB SQL for the fixture adapters (same shapes as deskflow.sources.fixtures).

Used only by the independent SQL answers in ``oracle.queries``; prepended as
CTEs to each answer.
"""

ADAPTERS = {
    "dim_region": """
select n_nationkey as region_id, n_name as region_name, r_name as country
from nation join region on n_regionkey = r_regionkey""",
    "dim_client": """
select c_custkey as client_id, c_name as client_name,
  case when c_custkey % 31 = 0 then null else c_mktsegment end as industry,
  case when c_acctbal < 0 then 'Small' when c_acctbal < 5000 then 'Medium' else 'Large' end as size_segment,
  r_name as hq_country, n_name as region_group,
  case when c_acctbal < 2500 then 'Bronze' when c_acctbal < 6000 then 'Silver' else 'Gold' end as contract_tier,
  cast(c_acctbal as decimal(10,2)) as monthly_contract_value,
  cast(99 + (c_custkey % 10) * 0.1 as decimal(5,2)) as sla_uptime_target,
  cast(15 + 15 * (c_custkey % 4) as int) as response_time_sla_min,
  cast(240 * (1 + c_custkey % 6) as int) as resolution_time_sla_min,
  cast(500 + 250 * (c_custkey % 5) as decimal(10,2)) as penalty_per_breach,
  date '2020-01-01' + cast(c_custkey % 365 as int) as contract_start,
  date '2023-01-01' + cast(c_custkey % 365 as int) as contract_end
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "dim_site": """
select s_suppkey as site_id, s_suppkey as client_id, s_name as site_name, r_name as country,
  n_name as state_region, n_name as city, s_nationkey as region_id,
  cast(s_suppkey * 37 % 180 - 90 as decimal(9,6)) as latitude,
  cast(s_suppkey * 53 % 360 - 180 as decimal(9,6)) as longitude,
  case s_suppkey % 3 when 0 then 'HQ' when 1 then 'Branch' else 'DC' end as site_type
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "dim_agent": """
select p_partkey as agent_id, p_name as agent_name, p_brand as assignment_group, p_type as team from part""",
    "dim_priority": """
select * from (values (1,'Critical',1),(2,'High',2),(3,'Medium',3),(4,'Low',4)) t(priority_id, priority_name, severity_rank)""",
    "fact_ticket": """
select ticket_id, client_id, site_id, agent_id, priority_id, created_at,
  created_at + rmin * INTERVAL '1' MINUTE as first_response_at,
  case when ticket_id % 11 = 0 then null else created_at + (rmin + smin) * INTERVAL '1' MINUTE end as resolved_at,
  case when ticket_id % 11 = 0 then null else created_at + (rmin + smin + 15) * INTERVAL '1' MINUTE end as closed_at,
  case when ticket_id % 11 = 0 then 'Open' else 'Closed' end as status,
  240 as expected_sla_resolve_min, 30 as sla_first_response_min, 180 as sla_resolution_min,
  agent_interactions, survey_results
from (select o_orderkey as ticket_id, case when o_custkey % 20 = 3 then o_custkey - 1 else o_custkey end as client_id,
  case when o_orderkey % 97 = 0 then null else o_orderkey % 10 end as site_id, o_orderkey % 200 as agent_id,
  cast(case substring(o_orderpriority, 1, 1) when '1' then 1 when '2' then 2 when '5' then 4 else 3 end as int) as priority_id,
  o_orderdate + cast(o_orderkey * 37 % 1440 as int) * INTERVAL '1' MINUTE as created_at,
  cast(o_orderkey * 53 % 61 as int) as rmin, cast(o_orderkey * 101 % 4320 as int) as smin,
  cast(1 + o_orderkey % 9 as int) as agent_interactions,
  case when o_orderkey % 17 = 0 then null when o_orderstatus = 'F' then 'Satisfied' when o_orderstatus = 'O' then 'Neutral' else 'Dissatisfied' end as survey_results
  from orders) x""",
    "fact_incident": """
select incident_id, client_id, site_id, priority_id, opened_at,
  opened_at + amin * INTERVAL '1' MINUTE as acknowledged_at,
  case when incident_id % 13 = 0 then null else opened_at + (amin + (1 + reassignment_count) * hmin) * INTERVAL '1' MINUTE end as resolved_at,
  incident_state, reassignment_count, reopen_count, made_sla
from (select l_orderkey * 10 + l_linenumber + (nth - 1) * 10000000000000 as incident_id, case when o_custkey % 10 = 0 then o_custkey + 1 else o_custkey end as client_id, l_suppkey as site_id,
  cast(1 + l_partkey % 4 as int) as priority_id,
  l_shipdate + cast(l_partkey * 37 % 1440 as int) * INTERVAL '1' MINUTE as opened_at,
  cast(l_partkey * 53 % 61 as int) as amin, cast(l_suppkey * 101 % 1440 as int) as hmin,
  cast(l_linenumber - 1 as int) as reassignment_count, cast(l_partkey % 3 as int) as reopen_count,
  case when l_partkey % 50 = 0 then null when l_returnflag = 'R' then 0 else 1 end as made_sla,
  case l_linestatus when 'F' then 'closed' else 'resolved' end as incident_state
  from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_shipdate,
     l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as nth from lineitem) l
  join orders on l_orderkey = o_orderkey) x""",
    "fact_metrics": """
select event_id as metric_id, user_id % 10 as site_id, ts as timestamp_utc,
  cast(event_id * 11 % 101 as decimal(5,2)) as cpu_util_pct,
  cast(event_id * 7 % 101 as decimal(5,2)) as mem_util_pct,
  cast(event_id * 13 % 101 as decimal(5,2)) as link_util_pct,
  cast(value as decimal(8,2)) as latency_ms,
  cast(event_id % 5 as decimal(5,2)) as packet_loss_pct
from events""",
    "raw_incident": """
select l_orderkey * 10 + l_linenumber as number,
  case l_partkey % 7 when 0 then ' New ' when 1 then '-100' when 2 then 'nat' when 3 then '7' when 4 then '6' when 5 then 'Resolved' else null end as incident_state,
  case l_partkey % 5 when 0 then '1 - High' when 1 then '2 - Medium' when 2 then '3 - Low' when 3 then '?' else null end as impact,
  case l_suppkey % 4 when 0 then '1 - High' when 1 then '2 - Medium' when 2 then '3 - Low' else 'x' end as urgency,
  case l_partkey % 6 when 0 then '1 - Critical' when 1 then '2 - High' when 2 then '3 - Moderate' when 3 then '4 - Low' when 4 then '5 - None' else null end as priority,
  case l_suppkey % 4 when 0 then '?' else 'v' || cast(l_suppkey as varchar) end as vendor,
  case l_partkey % 9 when 0 then '?' else cast(day(l_shipdate) as varchar) || '/' || cast(month(l_shipdate) as varchar) || '/' || cast(year(l_shipdate) as varchar) || ' ' || cast(l_partkey % 24 as varchar) || ':' || substring(cast(100 + l_partkey % 60 as varchar), 2, 2) end as opened_at,
  l_returnflag <> 'R' as made_sla, l_linestatus = 'O' as active,
  l_linenumber - 1 as reassignment_count,
  '  Group ' || cast(l_suppkey % 20 as varchar) || ' ' as assignment_group, ' EMail ' as contact_type,
  l_quantity as sys_mod_count
from lineitem""",
    "raw_ticket": """
select 'Subject ' || cast(o_orderkey as varchar) as subject, o_orderstatus as answer,
  case when o_orderkey % 23 = 0 then 'Unknown Queue' else 'Brand#' || cast(1 + o_orderkey % 25 as varchar) end as queue,
  case o_orderkey % 9 when 0 then '1' when 1 then 'High' when 2 then 'high' when 3 then 'P4' when 4 then ' critical ' when 5 then 'Low' when 6 then '2 - High' when 7 then 'Medium' else null end as priority,
  'Incident' as type, 'en' as language, 'v' || cast(o_orderkey % 3 as varchar) as version, 'Standard' as tag_1, o_orderkey as seq
from orders""",
    "raw_metrics": """
select cast(event_id % 3 as varchar) as asset_id,
  case when event_id % 41 = 0 then null else cast(user_id % 10 as varchar) end as site_id,
  case when event_id % 37 = 0 then 'bad time' else strftime(ts, '%Y-%m-%d %H:%M:00') end as timestamp_utc,
  case when event_id % 29 = 0 then '1000.00' else cast(event_id % 100 as varchar) end as cpu_util_pct,
  cast(event_id * 7 % 101 as varchar) as mem_util_pct, cast(event_id * 13 % 101 as varchar) as link_util_pct,
  case when event_id % 31 = 0 then 'n/a' else cast(event_id % 500 as varchar) end as latency_ms,
  '0.1' as packet_loss_pct, event_id as seq
from events""",
    "batch_ticket": """
select o_orderkey as ticket_id,
  case when o_orderkey % 101 = 0 then o_custkey + 1000000 else o_custkey end as client_id,
  case when o_orderkey % 103 = 0 then -1 else o_orderkey % 10 end as site_id, 0 as seq
from orders
union all
select o_orderkey as ticket_id, o_custkey as client_id, o_orderkey % 10 as site_id, 1 as seq
from orders where o_orderkey % 50 = 0""",
    "raw_support": """
select d.doc_id as support_id, d.text as body, d.source as assignment_group,
  case l.quality when 1 then 'high' when 0 then 'low' else null end as priority_name, d.lang as support_level
from documents d left join labels l on d.doc_id = l.doc_id""",
    "raw_support_named": """
select support_id, body as "Body", assignment_group as "Department", priority_name as "Priority", support_level as "Tags"
from raw_support""",
    "csv_lines": """
select o_orderkey as k, o_custkey as cust, o_custkey * 7 as amount, strftime(o_orderdate, '%Y-%m-%d') as day,
  case when o_orderkey % 5 = 0 then 'late, "urgent"' else 'none' end as note,
  case when o_orderkey % 5 = 0 then '"late, ""urgent"' || '""' else 'none' end as quoted
from orders""",
    "raw_tech_support": """
select conv_id * 1000 + turn as support_id, text as body, role as assignment_group,
  cast(null as varchar) as priority_name, 'turn ' || cast(turn as varchar) as support_level
from conversations""",
}


def with_adapters(sql: str) -> str:
    """Prefix a query with the adapter CTEs it mentions."""
    import re

    used = [name for name in ADAPTERS if re.search(rf"\b{name}\b", sql)]
    if "raw_support_named" in used and "raw_support" not in used:
        used.append("raw_support")
    if not used:
        return sql
    ctes = ",\n".join(f"{name} as ({ADAPTERS[name]}\n)" for name in ADAPTERS if name in used)
    body = sql.lstrip()
    if body[:5].lower() == "with ":
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
