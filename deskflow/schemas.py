"""Target table schemas, foreign-key edges and business-rule constants.

The warehouse is a fact constellation: three facts (tickets, incidents,
infrastructure metrics) share five dimensions; a date dimension, two staging
tables and two log tables complete it.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DT = T.TimestampNTZType(), T.DateType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# ---------------------------------------------------------------------------
# These must equal the source system's tables and rules for
# equal results.
# ---------------------------------------------------------------------------

# dim_client is the union of the DDL columns and the columns the loaders use.
DIM_CLIENT = _schema(
    ("client_id", L), ("client_name", S), ("industry", S), ("size_segment", S),
    ("hq_country", S), ("region_group", S), ("contract_tier", S),
    ("monthly_revenue", dec(10, 2)), ("monthly_contract_value", dec(10, 2)),
    ("sla_uptime_target", dec(5, 2)), ("response_time_sla_min", I),
    ("resolution_time_sla_min", I), ("penalty_per_breach", dec(10, 2)),
    ("contract_start", DT), ("contract_end", DT),
)
# dim_client as the DDL declares it (used to show the column intersection).
DIM_CLIENT_DDL = _schema(
    ("client_id", L), ("client_name", S), ("industry", S), ("size_segment", S),
    ("hq_country", S), ("region_group", S), ("contract_tier", S), ("monthly_revenue", dec(10, 2)),
)
DIM_REGION = _schema(("region_id", I), ("region_name", S), ("country", S))
DIM_SITE = _schema(
    ("site_id", L), ("client_id", L), ("site_name", S), ("country", S), ("state_region", S),
    ("city", S), ("region_id", I), ("latitude", dec(9, 6)), ("longitude", dec(9, 6)), ("site_type", S),
)
DIM_AGENT = _schema(("agent_id", L), ("agent_name", S), ("assignment_group", S), ("team", S))
DIM_PRIORITY = _schema(("priority_id", I), ("priority_name", S), ("severity_rank", I))
DIM_TIME = _schema(("time_id", I), ("date", DT), ("day", I), ("month", I), ("quarter", I), ("year", I))

FACT_TICKET = _schema(
    ("ticket_id", L), ("client_id", L), ("site_id", L), ("agent_id", L), ("priority_id", I),
    ("created_at", TS), ("first_response_at", TS), ("resolved_at", TS), ("closed_at", TS),
    ("status", S), ("source", S), ("topic", S), ("subject", S), ("body", S),
    ("expected_sla_resolve_min", I), ("sla_first_response_min", I), ("sla_resolution_min", I),
    ("agent_interactions", I), ("survey_results", S), ("product_group", S), ("support_level", S),
)
FACT_INCIDENT = _schema(
    ("incident_id", L), ("ticket_id", L), ("client_id", L), ("site_id", L), ("priority_id", I),
    ("opened_at", TS), ("acknowledged_at", TS), ("resolved_at", TS), ("closed_at", TS),
    ("incident_state", S), ("active", I), ("reassignment_count", I), ("reopen_count", I),
    ("made_sla", I), ("caller_id", S), ("contact_type", S), ("location", S), ("category", S),
    ("sub_category", S), ("u_symptom", S), ("impact", I), ("urgency", I),
    ("assignment_group", S), ("assigned_to", S), ("closed_code", S), ("resolved_by", S),
)
FACT_METRICS = _schema(
    ("metric_id", L), ("site_id", I), ("timestamp_utc", TS), ("cpu_util_pct", dec(5, 2)),
    ("mem_util_pct", dec(5, 2)), ("link_util_pct", dec(5, 2)), ("latency_ms", dec(8, 2)),
    ("packet_loss_pct", dec(5, 2)),
)
STG_SUPPORT = _schema(
    ("support_id", L), ("body", S), ("assignment_group", S), ("priority_name", S),
    ("support_level", S), ("load_date", TS),
)
DATA_VALIDATION_LOG = _schema(
    ("validation_id", L), ("validation_date", TS), ("table_name", S), ("validation_type", S),
    ("validation_metric", S), ("metric_value", dec(20, 4)), ("threshold_value", dec(20, 4)),
    ("validation_status", S), ("notes", S),
)
ETL_AUDIT_LOG = _schema(
    ("audit_id", L), ("process_name", S), ("rows_processed", S), ("status", S),
    ("run_timestamp", TS), ("notes", S),
)

TABLES: dict[str, T.StructType] = {
    "dim_region": DIM_REGION, "dim_client": DIM_CLIENT, "dim_site": DIM_SITE,
    "dim_agent": DIM_AGENT, "dim_priority": DIM_PRIORITY, "dim_time": DIM_TIME,
    "fact_ticket": FACT_TICKET, "fact_incident": FACT_INCIDENT, "fact_metrics": FACT_METRICS,
    "stg_it_support": STG_SUPPORT, "stg_tech_support": STG_SUPPORT,
    "data_validation_log": DATA_VALIDATION_LOG, "etl_audit_log": ETL_AUDIT_LOG,
}

# Dimensions in dependency order (a parent loads before its children).
DIMENSION_LOAD_ORDER = ["dim_region", "dim_client", "dim_site", "dim_agent", "dim_priority"]

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("dim_site", "client_id", "dim_client", "client_id"),
    ("dim_site", "region_id", "dim_region", "region_id"),
    ("fact_ticket", "client_id", "dim_client", "client_id"),
    ("fact_ticket", "site_id", "dim_site", "site_id"),
    ("fact_ticket", "agent_id", "dim_agent", "agent_id"),
    ("fact_ticket", "priority_id", "dim_priority", "priority_id"),
    ("fact_incident", "client_id", "dim_client", "client_id"),
    ("fact_incident", "site_id", "dim_site", "site_id"),
    ("fact_incident", "priority_id", "dim_priority", "priority_id"),
    ("fact_metrics", "site_id", "dim_site", "site_id"),
]

PRIMARY_KEYS = {
    "fact_ticket": "ticket_id", "fact_incident": "incident_id", "fact_metrics": "metric_id",
    "dim_client": "client_id", "dim_site": "site_id", "dim_agent": "agent_id",
    "dim_priority": "priority_id", "dim_region": "region_id",
}

# Priority dimension rows (id, name, severity rank).
PRIORITY_ROWS = [(1, "Critical", 1), (2, "High", 2), (3, "Medium", 3), (4, "Low", 4)]

# Ticket priority text -> priority name (exact, case-sensitive; unmatched -> Medium).
TICKET_PRIORITY_MAP = {
    "1": "Critical", "2": "High", "3": "Medium", "4": "Low",
    "Critical": "Critical", "High": "High", "Medium": "Medium", "Low": "Low",
    "P1": "Critical", "P2": "High", "P3": "Medium", "P4": "Low",
}
TICKET_PRIORITY_DEFAULT = "Medium"

# Incident priority label -> cleaned priority name (unmatched -> null).
INCIDENT_PRIORITY_LABELS = {
    "1 - Critical": "critical", "2 - High": "high", "3 - Moderate": "moderate", "4 - Low": "low",
}

# Incident state codes -> state (others kept).
INCIDENT_STATE_CODES = {"nat": "new", "7": "resolved", "6": "closed"}

# Ticket defaults for absent columns.
TICKET_DEFAULTS = {
    "client_id": 1, "site_id": 1, "agent_id": 1, "priority_id": 3,
    "status": "Closed", "support_level": "Standard",
}
# Incident defaults for absent columns.
INCIDENT_DEFAULTS = {"client_id": 1, "site_id": 1, "priority_id": 3, "ticket_id": None}

# Per-ticket SLA minutes written by the ticket loader.
TICKET_SLA_MINUTES = {"expected_sla_resolve_min": 240, "sla_first_response_min": 30, "sla_resolution_min": 180}

# Resolution SLA in hours by priority name (extract rule; anything else breaches).
SLA_HOURS_BY_PRIORITY = {"Critical": 4, "High": 8, "Medium": 24, "Low": 48}

# Resolution SLA in minutes by priority name (configured rule).
SLA_MINUTES_BY_PRIORITY = {"Critical": 60, "High": 240, "Medium": 480, "Low": 1440}

# Region-group membership as configured.
REGION_ASSIGNMENTS = {
    "India": ["India_North", "India_South", "India_West", "India_East"],
    "International": ["APAC", "Middle East", "Europe", "Americas"],
}

# Estimated lifecycle offsets (minutes) when a time is missing.
LIFECYCLE_OFFSETS_MIN = {"first_response_after_create": 30, "resolved_after_create": 120, "closed_after_resolve": 15}

# Reassignment bins: right-closed edges and their labels.
REASSIGN_BIN_EDGES = [-1, 0, 1, 2, 3, 100]
REASSIGN_BIN_LABELS = ["0", "1", "2", "3", "4+"]

# Day order of the day x hour heatmap.
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Column renames applied to raw sources (absent names are ignored).
TICKET_RENAMES = {
    "subject": "subject", "body": "body", "answer": "survey_results", "ticket_type": "topic",
    "assignment_group": "assignment_group", "priority_level": "priority_name", "language": "source",
    "product_version": "product_group", "tags": "support_level",
}
INCIDENT_RENAMES = {
    "number": "incident_id", "incident_state": "incident_state", "active": "active",
    "reassignment_count": "reassignment_count", "reopen_count": "reopen_count",
    "sys_mod_count": "modification_count", "made_sla": "made_sla", "caller_id": "caller_id",
    "opened_at": "opened_at", "sys_created_at": "acknowledged_at", "sys_updated_at": "updated_at",
    "contact_type": "contact_type", "u_symptom": "u_symptom", "cmdb_ci": "configuration_item",
    "impact": "impact", "urgency": "urgency", "priority": "priority_id",
    "assignment_group": "assignment_group", "assigned_to": "assigned_to",
    "knowledge": "knowledge_flag", "u_priority_confirmation": "priority_confirmed_flag",
    "notify": "notification_type", "closed_code": "closed_code", "resolved_by": "resolved_by",
    "resolved_at": "resolved_at", "closed_at": "closed_at", "priority_level": "priority_name",
}
SUPPORT_RENAMES = {"Body": "body", "Department": "assignment_group", "Priority": "priority_name", "Tags": "support_level"}
TECH_SUPPORT_RENAMES = {"body": "body", "assignment_group": "assignment_group", "priority_name": "priority_name",
                        "support_level": "support_level"}

# Text column widths enforced on load.
TICKET_TEXT_WIDTHS = {"source": 50, "topic": 100, "subject": 200, "body": 1000, "survey_results": 50,
                      "product_group": 100, "support_level": 50}
INCIDENT_TEXT_WIDTHS = {"incident_state": 50, "caller_id": 50, "u_symptom": 200, "assignment_group": 100,
                        "assigned_to": 100, "closed_code": 50, "resolved_by": 100, "contact_type": 50}
SUPPORT_TEXT_WIDTHS = {"body": 4000, "assignment_group": 100, "priority_name": 50, "support_level": 50}

# Tokens a CSV reader treats as missing.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
