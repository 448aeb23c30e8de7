"""Service KPI views: per-record KPIs, the operations feed, SLA and customer
health dashboards, and the analysis extracts.

Inputs are DataFrames with the warehouse schemas (``deskflow.schemas``).
Facts are aggregated before they meet a dimension wherever the result is
per dimension row, so a ticket x incident fan-out never occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deskflow import schemas
from deskflow.functions.clean import home_or_international
from deskflow.functions.numeric import int_avg, pct2, sum_flag
from deskflow.functions.temporal import calendar_parts, hours_crossed, minutes_crossed
from deskflow.operators.joins import join_dim


def ticket_kpis(fact_ticket: DataFrame, dim_client: DataFrame, dim_site: DataFrame,
                dim_agent: DataFrame, dim_priority: DataFrame) -> DataFrame:
    """Per ticket: time to acknowledge and resolve (minute boundaries) and
    the two breach flags (an unresolved ticket is not a breach)."""
    t = fact_ticket.select("ticket_id", "client_id", "site_id", "agent_id", "priority_id", "created_at",
                           "first_response_at", "resolved_at", "sla_first_response_min", "sla_resolution_min")
    t = join_dim(t, dim_client.select("client_id", "client_name"), "client_id")
    t = join_dim(t, dim_site.select("site_id", "site_name"), "site_id")
    t = join_dim(t, dim_agent.select("agent_id", "agent_name"), "agent_id")
    t = join_dim(t, dim_priority.select("priority_id", "priority_name"), "priority_id")
    mtta = minutes_crossed("created_at", "first_response_at")
    mttr = minutes_crossed("created_at", "resolved_at")
    return t.select(
        "ticket_id", "client_name", "site_name", "agent_name", "priority_name",
        mtta.alias("mtta_minutes"), mttr.alias("mttr_minutes"),
        F.when(mtta > F.col("sla_first_response_min"), 1).otherwise(0).alias("response_breach"),
        F.when(mttr > F.col("sla_resolution_min"), 1).otherwise(0).alias("resolution_breach"),
    )


def incident_kpis(fact_incident: DataFrame, dim_client: DataFrame, dim_site: DataFrame,
                  dim_priority: DataFrame) -> DataFrame:
    i = fact_incident.select("incident_id", "client_id", "site_id", "priority_id", "opened_at", "acknowledged_at",
                             "resolved_at", "reassignment_count", "reopen_count", "made_sla")
    i = join_dim(i, dim_client.select("client_id", "client_name"), "client_id")
    i = join_dim(i, dim_site.select("site_id", "site_name"), "site_id")
    i = join_dim(i, dim_priority.select("priority_id", "priority_name"), "priority_id")
    return i.select(
        "incident_id", "client_name", "site_name", "priority_name",
        minutes_crossed("opened_at", "acknowledged_at").alias("mtta_minutes"),
        minutes_crossed("opened_at", "resolved_at").alias("mttr_minutes"),
        "reassignment_count", "reopen_count", "made_sla",
    )


def _site_region(dim_site: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Snowflake branch: site -> region, joined once and reused."""
    return join_dim(dim_site.select("site_id", "site_name", "region_id"),
                    dim_region.select("region_id", "region_name", "country"), "region_id").drop("region_id")


def _resolution_category(hours) -> F.Column:
    return F.when(hours <= 24, "Within 24h").otherwise("Over 24h")


def operations_view(fact_ticket: DataFrame, fact_incident: DataFrame, dim_client: DataFrame,
                    dim_site: DataFrame, dim_region: DataFrame, dim_priority: DataFrame) -> DataFrame:
    """Resolved tickets and resolved incidents in one feed (union all)."""
    client = dim_client.select("client_id", "client_name", "industry")
    site = _site_region(dim_site, dim_region)
    prio = dim_priority.select("priority_id", "priority_name")

    def branch(fact: DataFrame, id_col: str, start: str, status: str, kind: str) -> DataFrame:
        f = fact.where(F.col("resolved_at").isNotNull()).select(
            F.col(id_col).alias("ticket_id"), "client_id", "site_id", "priority_id",
            F.col(start).alias("created_at"), "resolved_at", F.col(status).alias("status"))
        f = join_dim(join_dim(join_dim(f, client, "client_id"), site, "site_id"), prio, "priority_id")
        hours = hours_crossed("created_at", "resolved_at")
        return f.select("ticket_id", "client_id", "client_name", "industry", "site_name", "region_name", "country",
                        "priority_name", "created_at", "resolved_at", "status",
                        hours.alias("resolution_hours"), _resolution_category(hours).alias("resolution_category"),
                        F.lit(kind).alias("record_type"))

    return branch(fact_ticket, "ticket_id", "created_at", "status", "Ticket").unionByName(
        branch(fact_incident, "incident_id", "opened_at", "incident_state", "Incident"))


def sla_view(fact_incident: DataFrame, dim_client: DataFrame, dim_site: DataFrame,
             dim_region: DataFrame, dim_priority: DataFrame) -> DataFrame:
    """Incidents by client x region x priority x month: count, met,
    breached, integer average resolution hours (unresolved rows counted,
    left out of the average)."""
    i = fact_incident.select("client_id", "site_id", "priority_id", "opened_at", "resolved_at", "made_sla")
    i = join_dim(i, dim_client.select("client_id", "client_name", "industry", "contract_tier"), "client_id")
    i = join_dim(i, _site_region(dim_site, dim_region).drop("site_name"), "site_id")
    i = join_dim(i, dim_priority.select("priority_id", "priority_name"), "priority_id")
    return (i.groupBy("client_name", "industry", "contract_tier", "region_name", "country", "priority_name",
                      F.year("opened_at").alias("year"), F.month("opened_at").alias("month"))
            .agg(F.count(F.lit(1)).alias("incident_count"),
                 sum_flag(F.col("made_sla") == 1).alias("sla_met"),
                 sum_flag(F.col("made_sla") == 0).alias("sla_breached"),
                 int_avg(hours_crossed("opened_at", "resolved_at")).alias("avg_resolution_hours")))


def customer_health(dim_client: DataFrame, fact_ticket: DataFrame, fact_incident: DataFrame) -> DataFrame:
    """One row per client, zero-filled: ticket and incident counts, integer
    average resolution hours, satisfaction and SLA compliance percentages."""
    t = (fact_ticket.groupBy("client_id")
         .agg(F.count(F.lit(1)).alias("ticket_count"),
              int_avg(hours_crossed("created_at", "resolved_at")).alias("avg_resolution_hours"),
              pct2(sum_flag(F.col("survey_results") == "Satisfied"), F.count(F.lit(1))).alias("satisfied_pct")))
    i = (fact_incident.groupBy("client_id")
         .agg(F.count(F.lit(1)).alias("incident_count"),
              int_avg(hours_crossed("opened_at", "resolved_at")).alias("avg_resolution_hours"),
              pct2(sum_flag(F.col("made_sla") == 1), F.count(F.lit(1))).alias("sla_compliance_pct")))
    c = dim_client.select("client_id", "client_name", "industry", "contract_tier", "monthly_contract_value")
    # Both sides are one row per client: a shuffle join on client_id; the
    # aggregates are already hash-partitioned by client_id.
    out = c.join(t, "client_id", "left").join(i.withColumnRenamed("avg_resolution_hours", "avg_inc_hours"),
                                               "client_id", "left")
    zero_dec = F.lit(0).cast("decimal(5,2)")
    return out.select(
        "client_name", "industry", "contract_tier", "monthly_contract_value",
        F.coalesce("ticket_count", F.lit(0).cast("long")).alias("ticket_count"),
        F.coalesce("avg_resolution_hours", F.lit(0)).alias("avg_ticket_resolution"),
        F.coalesce("satisfied_pct", zero_dec).alias("satisfaction_rate"),
        F.coalesce("incident_count", F.lit(0).cast("long")).alias("incident_count"),
        F.coalesce("avg_inc_hours", F.lit(0)).alias("avg_incident_resolution"),
        F.coalesce("sla_compliance_pct", zero_dec).alias("sla_compliance_pct"),
    )


def ticket_extract(fact_ticket: DataFrame, dim_client: DataFrame, dim_priority: DataFrame,
                   home_country: str) -> DataFrame:
    """Resolved tickets with hours, SLA status by priority hours and calendar
    columns (the analysis input)."""
    t = fact_ticket.where(F.col("resolved_at").isNotNull()).select(
        "ticket_id", "client_id", "priority_id", "created_at", "resolved_at", "first_response_at",
        "agent_interactions", "survey_results")
    t = join_dim(t, dim_client.select("client_id", "client_name", "industry", "region_group", "hq_country"), "client_id")
    t = join_dim(t, dim_priority.select("priority_id", "priority_name"), "priority_id")
    res_h = hours_crossed("created_at", "resolved_at")
    met = None
    for name, limit in schemas.SLA_HOURS_BY_PRIORITY.items():
        cond = (F.col("priority_name") == name) & (res_h <= limit)
        met = cond if met is None else (met | cond)
    return t.select(
        "ticket_id", "client_id", "client_name", "industry", "region_group", "priority_name",
        "created_at", "resolved_at", "first_response_at", "agent_interactions", "survey_results",
        res_h.alias("resolution_hours"), hours_crossed("created_at", "first_response_at").alias("response_hours"),
        F.when(met, "Met").otherwise("Breached").alias("sla_status"),
        home_or_international("hq_country", home_country).alias("region_type"),
        *[v.alias(k) for k, v in calendar_parts("created_at").items()],
    )


def incident_extract(fact_incident: DataFrame, dim_client: DataFrame, dim_site: DataFrame,
                     dim_region: DataFrame, dim_priority: DataFrame, home_country: str) -> DataFrame:
    i = fact_incident.where(F.col("resolved_at").isNotNull()).select(
        "incident_id", "client_id", "site_id", "priority_id", "opened_at", "resolved_at",
        "reassignment_count", "reopen_count", "made_sla")
    i = join_dim(i, dim_client.select("client_id", "client_name", "industry", "region_group"), "client_id")
    i = join_dim(i, _site_region(dim_site, dim_region), "site_id")
    i = join_dim(i, dim_priority.select("priority_id", "priority_name"), "priority_id")
    return i.select(
        "incident_id", "client_id", "client_name", "industry", "region_group", "site_name", "region_name",
        "country", "priority_name", "opened_at", "resolved_at", "reassignment_count", "reopen_count", "made_sla",
        hours_crossed("opened_at", "resolved_at").alias("resolution_hours"),
        home_or_international("country", home_country).alias("region_type"),
        *[v.alias(k) for k, v in calendar_parts("opened_at").items()],
    )


def register_views(spark, fact_ticket: DataFrame, fact_incident: DataFrame, dims: dict[str, DataFrame],
                   home_country: str) -> list[str]:
    """Register the KPI views as temporary views for SQL users; each is the
    lazy DataFrame above, inlined and optimised with the query using it."""
    frames = {
        "ticket_kpis": ticket_kpis(fact_ticket, dims["dim_client"], dims["dim_site"], dims["dim_agent"], dims["dim_priority"]),
        "incident_kpis": incident_kpis(fact_incident, dims["dim_client"], dims["dim_site"], dims["dim_priority"]),
        "operations_feed": operations_view(fact_ticket, fact_incident, dims["dim_client"], dims["dim_site"],
                                           dims["dim_region"], dims["dim_priority"]),
        "sla_dashboard": sla_view(fact_incident, dims["dim_client"], dims["dim_site"], dims["dim_region"], dims["dim_priority"]),
        "customer_health": customer_health(dims["dim_client"], fact_ticket, fact_incident),
        "ticket_extract": ticket_extract(fact_ticket, dims["dim_client"], dims["dim_priority"], home_country),
        "incident_extract": incident_extract(fact_incident, dims["dim_client"], dims["dim_site"], dims["dim_region"],
                                             dims["dim_priority"], home_country),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
