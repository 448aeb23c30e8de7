"""Business questions beyond the dashboards: executive headline, penalty
exposure, infrastructure capacity, SLA under configured and contracted
targets, region-group rollup, and the time-difference and calendar columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deskflow import schemas
from deskflow.functions.numeric import first_label_of_max, int_avg, pct2, share_pct, sum_flag
from deskflow.functions.temporal import (calendar_parts, day_start, days_crossed, elapsed_hours, hour_start,
                                         hours_crossed, minutes_crossed)
from deskflow.functions.util import local_rows
from deskflow.operators.joins import join_dim

METRICS = ["cpu_util_pct", "mem_util_pct", "link_util_pct", "latency_ms", "packet_loss_pct"]


def _incidents_by_region(fact_incident, dim_site, dim_region, dim_priority) -> DataFrame:
    site = join_dim(dim_site.select("site_id", "region_id"), dim_region.select("region_id", "region_name"), "region_id")
    i = fact_incident.select("site_id", "priority_id", "opened_at", "resolved_at", "made_sla")
    i = join_dim(i, site.drop("region_id"), "site_id")
    return join_dim(i, dim_priority.select("priority_id", "priority_name"), "priority_id")


def executive_summary(fact_incident, dim_site, dim_region, dim_priority, critical_target_hours: int = 4) -> DataFrame:
    """Largest region's share of incidents, SLA compliance and breaches,
    and the critical-priority mean resolution in days against its target."""
    i = _incidents_by_region(fact_incident, dim_site, dim_region, dim_priority)
    critical = F.when(F.col("priority_name") == "Critical", hours_crossed("opened_at", "resolved_at"))
    # One pass over the incidents: sums per region, then over the regions.
    per_region = i.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("made_sla") == 0).alias("breaches"),
        F.sum(critical).alias("critical_hours"), F.count(critical).alias("critical_n"))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("long"))

    row = per_region.agg(first_label_of_max("region_name", "n").alias("top_region"), F.max("n").alias("top_region_incidents"),
                         total("n").alias("total_incidents"), total("breaches").alias("sla_breaches"),
                         total("critical_hours").alias("critical_hours"), total("critical_n").alias("critical_n"))
    n, breaches = F.col("total_incidents"), F.col("sla_breaches")
    critical_avg = F.try_divide(F.col("critical_hours").cast("double"), F.col("critical_n").cast("double"))
    return row.select(
        "total_incidents", "top_region", "top_region_incidents",
        share_pct(F.col("top_region_incidents"), n).alias("top_region_share_pct"),
        "sla_breaches", share_pct(n - breaches, n).alias("sla_compliance_pct"),
        (critical_avg / 24.0).alias("critical_avg_resolution_days"),
        F.lit(critical_target_hours).alias("critical_target_hours"))


def penalty_exposure(dim_client, fact_ticket, fact_incident) -> DataFrame:
    """Per client: incident breaches (made_sla = 0) plus ticket resolution
    breaches (minutes over the ticket's target) times the client's penalty
    per breach.  Facts are counted per client before the join."""
    inc = fact_incident.groupBy("client_id").agg(sum_flag(F.col("made_sla") == 0).alias("incident_breaches"))
    mttr = minutes_crossed("created_at", "resolved_at")
    tic = fact_ticket.groupBy("client_id").agg(sum_flag(mttr > F.col("sla_resolution_min")).alias("ticket_breaches"))
    c = dim_client.select("client_id", "client_name", "penalty_per_breach")
    out = c.join(inc, "client_id", "left").join(tic, "client_id", "left")
    ib = F.coalesce("incident_breaches", F.lit(0).cast("long"))
    tb = F.coalesce("ticket_breaches", F.lit(0).cast("long"))
    return out.select(
        "client_id", "client_name", "penalty_per_breach", ib.alias("incident_breaches"), tb.alias("ticket_breaches"),
        (ib + tb).alias("total_breaches"),
        ((ib + tb).cast("decimal(18,0)") * F.col("penalty_per_breach")).cast("decimal(18,2)").alias("penalty_exposure"))


def _capacity_aggs() -> list:
    aggs = [F.count(F.lit(1)).alias("samples")]
    for m in METRICS:
        x = F.col(m)
        aggs += [F.avg(x).alias(f"{m}_mean"), F.max(x).alias(f"{m}_max"),
                 F.round(F.percentile(x.cast("double"), 0.95), 6).alias(f"{m}_p95")]
    return aggs


def capacity_hourly(fact_metrics: DataFrame) -> DataFrame:
    """Per site and hour: samples; exact mean (decimal), max and p95 of each
    utilisation, latency and loss measure."""
    return fact_metrics.groupBy("site_id", hour_start("timestamp_utc").alias("hour")).agg(*_capacity_aggs())


def capacity_by_region(fact_metrics: DataFrame, dim_site: DataFrame, dim_region: DataFrame) -> DataFrame:
    site = join_dim(dim_site.select("site_id", "region_id"), dim_region.select("region_id", "region_name"), "region_id")
    m = join_dim(fact_metrics, site.select(F.col("site_id").cast("long").alias("site_id"), "region_name"), "site_id")
    return m.groupBy("region_name", day_start("timestamp_utc").alias("day")).agg(*_capacity_aggs())


def sla_config_minutes(fact_ticket: DataFrame, dim_priority: DataFrame,
                       minutes: Mapping[str, int] = schemas.SLA_MINUTES_BY_PRIORITY) -> DataFrame:
    """Resolution within the configured minutes for the ticket's priority."""
    t = join_dim(fact_ticket.select("priority_id", "created_at", "resolved_at"),
                 dim_priority.select("priority_id", "priority_name"), "priority_id")
    limits = F.create_map(*[F.lit(x) for kv in minutes.items() for x in kv])
    t = t.withColumn("sla_minutes", F.try_element_at(limits, F.col("priority_name")).cast("int"))
    mttr = minutes_crossed("created_at", "resolved_at")
    resolved = F.col("resolved_at").isNotNull()
    within = F.count_if(resolved & (mttr <= F.col("sla_minutes")))
    return (t.groupBy("priority_name", "sla_minutes")
            .agg(F.count(F.lit(1)).alias("ticket_count"), F.count_if(resolved).alias("resolved_count"),
                 F.count_if(resolved & (mttr > F.col("sla_minutes"))).alias("breached_count"),
                 within.alias("within_sla_count"), pct2(within, F.count_if(resolved)).alias("compliance_pct")))


def sla_contract_terms(fact_ticket: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Tickets against each client's own response and resolution targets."""
    c = dim_client.select("client_id", "client_name", "response_time_sla_min", "resolution_time_sla_min")
    t = fact_ticket.select("client_id", "created_at", "first_response_at", "resolved_at").join(c, "client_id")
    return (t.groupBy("client_id", "client_name", "response_time_sla_min", "resolution_time_sla_min")
            .agg(F.count(F.lit(1)).alias("ticket_count"),
                 F.count_if(minutes_crossed("created_at", "first_response_at") > F.col("response_time_sla_min")).alias("response_breaches"),
                 F.count_if(minutes_crossed("created_at", "resolved_at") > F.col("resolution_time_sla_min")).alias("resolution_breaches")))


def region_rollup(fact_incident, dim_site, dim_region, assignments: Mapping[str, Sequence[str]],
                  unassigned: str = "Unassigned") -> DataFrame:
    """Incidents rolled up to configured region groups (membership by region
    name; regions in no group are reported as ``unassigned``)."""
    spark = fact_incident.sparkSession
    members = local_rows(spark, [(r, g) for g, regions in assignments.items() for r in regions],
                         "region_name string, region_group string")
    site = join_dim(dim_site.select("site_id", "region_id"), dim_region.select("region_id", "region_name"), "region_id")
    i = join_dim(fact_incident.select("site_id", "opened_at", "resolved_at", "made_sla"),
                 site.select("site_id", "region_name"), "site_id")
    i = i.join(members, "region_name", "left").withColumn(
        "region_group", F.coalesce(F.col("region_group"), F.lit(unassigned)))
    return (i.groupBy("region_group")
            .agg(F.countDistinct("region_name").alias("regions"), F.count(F.lit(1)).alias("incident_count"),
                 sum_flag(F.col("made_sla") == 1).alias("sla_met"), sum_flag(F.col("made_sla") == 0).alias("sla_breached"),
                 int_avg(hours_crossed("opened_at", "resolved_at")).alias("avg_resolution_hours")))


def datediff_boundaries(fact_incident: DataFrame) -> DataFrame:
    """Boundary counts (minutes, hours, days) next to elapsed whole hours."""
    return fact_incident.select(
        "incident_id", minutes_crossed("opened_at", "acknowledged_at").alias("minutes_to_ack"),
        hours_crossed("opened_at", "resolved_at").alias("hours_to_resolve"),
        days_crossed("opened_at", "resolved_at").alias("days_to_resolve"),
        elapsed_hours("opened_at", "resolved_at").alias("elapsed_hours_to_resolve"))


def date_features(fact_ticket: DataFrame) -> DataFrame:
    return fact_ticket.select("ticket_id", "created_at",
                              *[v.alias(k) for k, v in calendar_parts("created_at").items()])
