"""Ticket and incident analysis reports: volume, MTTR, rework, correlation,
summaries and insight lines.

Inputs are the extracts from ``deskflow.plans.views`` (resolved rows with
hours and calendar columns).  Grouping follows dataframe-library habits:
null group keys are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from deskflow import schemas
from deskflow.functions.clean import reassign_bin
from deskflow.functions.numeric import round_even, share_pct
from deskflow.functions.util import local_rows
from deskflow.operators import stats


# ------------------------------------------------------------ ticket volume
def tickets_by_month(te: DataFrame) -> DataFrame:
    return (te.where(F.col("year_month").isNotNull()).groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("ticket_count")).orderBy("year_month"))


def monthly_peaks(te: DataFrame) -> DataFrame:
    """Average monthly tickets, peak and lowest month (earliest on ties).
    Months without tickets are absent, not zero."""
    p = stats.peaks(tickets_by_month(te), "year_month", "ticket_count")
    return p.select(F.col("avg_count").alias("avg_monthly_tickets"), F.col("peak_label").alias("peak_month"),
                    F.col("peak_count").alias("peak_tickets"), F.col("low_label").alias("low_month"),
                    F.col("low_count").alias("low_tickets"))


def tickets_by_region_type(te: DataFrame) -> DataFrame:
    return stats.value_counts(te, "region_type", "ticket_count")


def tickets_by_client(te: DataFrame) -> DataFrame:
    return stats.value_counts(te, "client_name", "ticket_count", share_name=None)


def top_clients_by_volume(te: DataFrame, n: int = 3) -> DataFrame:
    return tickets_by_client(te).orderBy(F.desc("ticket_count"), "client_name").limit(n)


def tickets_by_priority(te: DataFrame) -> DataFrame:
    return stats.value_counts(te, "priority_name", "ticket_count")


def day_hour_heatmap(te: DataFrame) -> DataFrame:
    """Tickets by weekday (Monday first) x hour 0-23, zero-filled."""
    return stats.crosstab_fixed(te, "day_of_week", schemas.DAY_ORDER, "hour_of_day", range(24),
                                lambda h: f"h{h:02d}", order_name="day_order")


# ------------------------------------------------------------ incidents
def incidents_by_region_type(ie: DataFrame) -> DataFrame:
    return stats.value_counts(ie, "region_type", "incident_count")


def mttr_by_region_type(ie: DataFrame) -> DataFrame:
    return (ie.where(F.col("region_type").isNotNull()).groupBy("region_type")
            .agg(F.avg("resolution_hours").alias("avg_resolution_hours")))


def incident_region_detail(ie: DataFrame) -> DataFrame:
    return (ie.where(F.col("region_name").isNotNull()).groupBy("region_name")
            .agg(F.count("incident_id").alias("incident_count"),
                 round_even(F.avg("resolution_hours")).alias("avg_resolution_hours"),
                 round_even(F.avg("reassignment_count")).alias("avg_reassignments"),
                 round_even(F.avg("reopen_count")).alias("avg_reopens"))
            .orderBy(F.desc("incident_count"), "region_name"))


def mttr_box_stats(ie: DataFrame, cutoff: int = 100) -> DataFrame:
    """Box-plot numbers of resolution hours by region type, below a cutoff."""
    kept = ie.where((F.col("resolution_hours") < cutoff) & F.col("region_type").isNotNull())
    return stats.box_stats(kept, "region_type", "resolution_hours")


# ------------------------------------------------------------ rework
def rework_overall(ie: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return ie.agg(
        F.avg("reassignment_count").alias("avg_reassignments"),
        F.count_if(F.col("reassignment_count") > 0).alias("reassigned_incidents"),
        share_pct(F.count_if(F.col("reassignment_count") > 0), n).alias("reassigned_pct"),
        F.avg("reopen_count").alias("avg_reopens"),
        F.count_if(F.col("reopen_count") > 0).alias("reopened_incidents"),
        share_pct(F.count_if(F.col("reopen_count") > 0), n).alias("reopened_pct"))


def rework_by_client(ie: DataFrame) -> DataFrame:
    return (ie.where(F.col("client_name").isNotNull()).groupBy("client_name")
            .agg(F.count("incident_id").alias("incident_count"),
                 round_even(F.avg("reassignment_count")).alias("avg_reassignments"),
                 round_even(F.avg("reopen_count")).alias("avg_reopens"))
            .orderBy(F.desc("avg_reassignments"), "client_name"))


def top_clients_by_rework(ie: DataFrame, n: int = 3) -> DataFrame:
    return rework_by_client(ie).orderBy(F.desc("avg_reassignments"), "client_name").limit(n)


def rework_by_region_type(ie: DataFrame) -> DataFrame:
    return (ie.where(F.col("region_type").isNotNull()).groupBy("region_type")
            .agg(F.avg("reassignment_count").alias("avg_reassignments"),
                 F.avg("reopen_count").alias("avg_reopens")))


def reassign_impact(ie: DataFrame) -> DataFrame:
    """Resolution hours by reassignment bin (0, 1, 2, 3, 4+): mean, exact
    median, count; every bin is listed, empty ones with count 0."""
    label, order = reassign_bin("reassignment_count")
    agg = (ie.select(label.alias("reassign_bin"), "resolution_hours").where(F.col("reassign_bin").isNotNull())
           .groupBy("reassign_bin")
           .agg(F.avg("resolution_hours").alias("mean_hours"),
                F.median(F.col("resolution_hours").cast("double")).alias("median_hours"),
                F.count("resolution_hours").alias("incident_count")))
    bins = local_rows(ie.sparkSession, [(lab, i) for i, lab in enumerate(schemas.REASSIGN_BIN_LABELS)],
                      "reassign_bin string, bin_order int")
    return (bins.join(agg, "reassign_bin", "left")
            .select("reassign_bin", "bin_order", "mean_hours", "median_hours",
                    F.coalesce("incident_count", F.lit(0).cast("long")).alias("incident_count"))
            .orderBy("bin_order"))


def reassign_step(ie: DataFrame) -> DataFrame:
    """Average change in mean resolution hours from one bin to the next."""
    return stats.lag_diff_mean(reassign_impact(ie), "bin_order", "mean_hours").select(
        F.col("mean_step").alias("hours_per_reassignment"))


# ------------------------------------------------------------ correlation
def corr_tickets(te: DataFrame) -> DataFrame:
    cols = [c for c in ["resolution_hours", "response_hours", "agent_interactions"] if c in te.columns]
    return stats.correlation_long(te, cols)


def corr_incidents(ie: DataFrame) -> DataFrame:
    return stats.correlation_long(ie, ["resolution_hours", "reassignment_count", "reopen_count"])


def mttr_by_priority(ie: DataFrame) -> DataFrame:
    return (ie.where(F.col("priority_name").isNotNull()).groupBy("priority_name")
            .agg(round_even(F.avg("resolution_hours")).alias("mean_hours"),
                 round_even(F.median(F.col("resolution_hours").cast("double"))).alias("median_hours"),
                 F.count("resolution_hours").alias("incident_count")))


# ------------------------------------------------------------ summaries
def ticket_summary(te: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return te.agg(n.alias("total_tickets"), F.avg("resolution_hours").alias("avg_resolution_hours"),
                  F.median(F.col("resolution_hours").cast("double")).alias("median_resolution_hours"),
                  share_pct(F.count_if(F.col("sla_status") == "Met"), n).alias("sla_compliance_pct"))


def incident_summary(ie: DataFrame) -> DataFrame:
    return ie.agg(F.count(F.lit(1)).alias("total_incidents"),
                  F.avg("resolution_hours").alias("avg_resolution_hours"),
                  F.median(F.col("resolution_hours").cast("double")).alias("median_resolution_hours"),
                  (F.avg(F.col("made_sla").cast("double")) * 100).alias("sla_compliance_pct"),
                  F.avg("reassignment_count").alias("avg_reassignments"),
                  F.avg("reopen_count").alias("avg_reopens"))


def csat_distribution(te: DataFrame) -> DataFrame:
    return stats.normalized_counts(te, "survey_results", "pct", digits=1)


# ------------------------------------------------------------ insights
def insights(te: DataFrame, ie: DataFrame, home: str) -> DataFrame:
    """Computed insight lines as (metric, label, value) rows.  Ticket figures
    come from one aggregation; incident figures, including the mean
    resolution per reassignment bin behind the per-reassignment step, from a
    second; the worst client from a per-client aggregation."""
    n = F.count(F.lit(1))
    t = te.agg(
        share_pct(F.count_if(F.col("region_type") == home), n).alias("home_ticket_share_pct"),
        share_pct(F.count_if(F.col("region_type") == "International"), n).alias("international_ticket_share_pct"),
        share_pct(F.count_if(F.col("priority_name") == "Medium"), n).alias("medium_ticket_share_pct"))
    intl, dom = F.col("region_type") == "International", F.col("region_type") == home
    label, _ = reassign_bin("reassignment_count")
    bin_means = [F.avg(F.when(label == b, F.col("resolution_hours"))) for b in schemas.REASSIGN_BIN_LABELS]
    i = ie.agg(
        (F.coalesce(F.avg(F.when(intl, F.col("resolution_hours"))), F.lit(0.0))
         - F.coalesce(F.avg(F.when(dom, F.col("resolution_hours"))), F.lit(0.0))).alias("mttr_gap_hours"),
        round_even(F.avg(F.when(F.col("priority_name") == "Critical", F.col("resolution_hours")))).alias("critical_mttr_hours"),
        share_pct(F.count_if(F.col("reopen_count") > 0), n).alias("reopen_rate_pct"),
        _focus(F.avg(F.when(intl, F.col("reassignment_count"))), F.avg(F.when(dom, F.col("reassignment_count"))),
               home).alias("focus_region"),
        F.array(*bin_means).alias("bin_means"))
    i = i.withColumn("hours_per_reassignment", _mean_step(F.col("bin_means"), len(bin_means)))
    top = top_clients_by_rework(ie, 1)

    shares = ["home_ticket_share_pct", "international_ticket_share_pct", "medium_ticket_share_pct"]
    figures = ["mttr_gap_hours", "hours_per_reassignment", "critical_mttr_hours", "reopen_rate_pct"]
    top = top.select(F.lit("top_rework_client").alias("metric"), F.col("client_name").cast("string").alias("label"),
                     F.col("avg_reassignments").cast("double").alias("value"))
    return _stacked(t, shares).unionByName(_stacked(i, figures, ["focus_region"])).unionByName(top)


def _stacked(row: DataFrame, values: Sequence[str], labels: Sequence[str] = ()) -> DataFrame:
    """(metric, label, value) rows from the columns of one row, which is
    computed once."""
    lines = [f"'{c}', cast(null as string), cast(`{c}` as double)" for c in values]
    lines += [f"'{c}', cast(`{c}` as string), cast(null as double)" for c in labels]
    return row.selectExpr(f"stack({len(lines)}, {', '.join(lines)}) as (metric, label, value)")


def _mean_step(means, n: int):
    """Mean of the defined consecutive differences of an array of bin means
    (a difference is undefined when either side is null)."""
    diffs = [means[k] - means[k - 1] for k in range(1, n)]
    total = sum((F.coalesce(d, F.lit(0.0)) for d in diffs), F.lit(0.0))
    defined = sum((F.when(d.isNotNull(), 1).otherwise(0) for d in diffs), F.lit(0))
    return F.when(defined > 0, total / defined)


def _focus(intl_avg, home_avg, home: str):
    """Region to focus on: the one with more reassignments (home on ties);
    null when either group is missing."""
    return (F.when(intl_avg.isNull() | home_avg.isNull(), F.lit(None))
            .when(intl_avg > home_avg, F.lit("International")).otherwise(F.lit(home)))
