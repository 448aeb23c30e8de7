"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole test tables in ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskflow.plans import views
from deskflow.sources.fixtures import HOME_COUNTRY, Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def wrap(fn):
        REGISTRY[name] = fn
        return fn
    return wrap


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)


# ------------------------------------------------------------------ views
@register("ticket_kpis")
def q_ticket_kpis(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return views.ticket_kpis(w.fact_ticket, w.dim_client, w.dim_site, w.dim_agent, w.dim_priority)


@register("incident_kpis")
def q_incident_kpis(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return views.incident_kpis(w.fact_incident, w.dim_client, w.dim_site, w.dim_priority)


@register("operations_view")
def q_operations_view(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return views.operations_view(w.fact_ticket, w.fact_incident, w.dim_client, w.dim_site, w.dim_region, w.dim_priority)


@register("sla_view")
def q_sla_view(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return views.sla_view(w.fact_incident, w.dim_client, w.dim_site, w.dim_region, w.dim_priority)


@register("customer_health")
def q_customer_health(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return views.customer_health(w.dim_client, w.fact_ticket, w.fact_incident)


def ticket_extract(w: Warehouse) -> DataFrame:
    return views.ticket_extract(w.fact_ticket, w.dim_client, w.dim_priority, HOME_COUNTRY)


def incident_extract(w: Warehouse) -> DataFrame:
    return views.incident_extract(w.fact_incident, w.dim_client, w.dim_site, w.dim_region, w.dim_priority, HOME_COUNTRY)


@register("ticket_extract")
def q_ticket_extract(spark, sf_dir):
    return ticket_extract(_wh(spark, sf_dir))


@register("incident_extract")
def q_incident_extract(spark, sf_dir):
    return incident_extract(_wh(spark, sf_dir))


# --------------------------------------------------------------- analysis
from deskflow.plans import analysis  # noqa: E402


def _te(spark, sf_dir):
    return ticket_extract(_wh(spark, sf_dir))


def _ie(spark, sf_dir):
    return incident_extract(_wh(spark, sf_dir))


for _name, _fn, _src in [
    ("tickets_by_month", analysis.tickets_by_month, _te),
    ("monthly_peaks", analysis.monthly_peaks, _te),
    ("tickets_by_region_type", analysis.tickets_by_region_type, _te),
    ("tickets_by_client", analysis.tickets_by_client, _te),
    ("top_clients_by_volume", analysis.top_clients_by_volume, _te),
    ("tickets_by_priority", analysis.tickets_by_priority, _te),
    ("day_hour_heatmap", analysis.day_hour_heatmap, _te),
    ("incidents_by_region_type", analysis.incidents_by_region_type, _ie),
    ("mttr_by_region_type", analysis.mttr_by_region_type, _ie),
    ("incident_region_detail", analysis.incident_region_detail, _ie),
    ("mttr_box_stats", analysis.mttr_box_stats, _ie),
    ("rework_overall", analysis.rework_overall, _ie),
    ("rework_by_client", analysis.rework_by_client, _ie),
    ("top_clients_by_rework", analysis.top_clients_by_rework, _ie),
    ("rework_by_region_type", analysis.rework_by_region_type, _ie),
    ("reassign_impact", analysis.reassign_impact, _ie),
    ("reassign_step", analysis.reassign_step, _ie),
    ("corr_tickets", analysis.corr_tickets, _te),
    ("corr_incidents", analysis.corr_incidents, _ie),
    ("mttr_by_priority", analysis.mttr_by_priority, _ie),
    ("ticket_summary", analysis.ticket_summary, _te),
    ("incident_summary", analysis.incident_summary, _ie),
    ("csat_distribution", analysis.csat_distribution, _te),
]:
    REGISTRY[_name] = (lambda fn, src: lambda spark, sf_dir: fn(src(spark, sf_dir)))(_fn, _src)


@register("insights")
def q_insights(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return analysis.insights(ticket_extract(w), incident_extract(w), HOME_COUNTRY)


# ------------------------------------------------------------ cleaning, load
from deskflow.plans import etl  # noqa: E402


@register("rename_map")
def q_rename_map(spark, sf_dir):
    return etl.rename_ticket_columns(_wh(spark, sf_dir).raw_ticket)


# Raw sources, the map that renames their columns, and the table they feed.
RENAMED_SOURCES = [("raw_ticket", "TICKET_RENAMES", "fact_ticket"), ("raw_incident", "INCIDENT_RENAMES", "fact_incident"),
                   ("raw_support_named", "SUPPORT_RENAMES", "stg_it_support"),
                   ("raw_tech_support", "TECH_SUPPORT_RENAMES", "stg_tech_support")]


def _renamed(source: str, mapping: str):
    def query(spark, sf_dir):
        from deskflow import schemas
        from deskflow.functions.renames import apply_renames

        return apply_renames(getattr(_wh(spark, sf_dir), source), getattr(schemas, mapping))
    return query


REGISTRY["rename_incident"] = _renamed("raw_incident", "INCIDENT_RENAMES")
REGISTRY["rename_it_support"] = _renamed("raw_support_named", "SUPPORT_RENAMES")
REGISTRY["rename_tech_support"] = _renamed("raw_tech_support", "TECH_SUPPORT_RENAMES")


@register("rename_report")
def q_rename_report(spark, sf_dir):
    from deskflow import schemas
    from deskflow.functions.renames import rename_report

    w, out = _wh(spark, sf_dir), None
    for source, mapping, table in RENAMED_SOURCES:
        one = rename_report(source, getattr(w, source), getattr(schemas, mapping), schemas.TABLES[table].names)
        out = one if out is None else out.unionByName(one)
    return out


@register("ticket_priority_rules")
def q_ticket_priority_rules(spark, sf_dir):
    return etl.ticket_priority_rules(_wh(spark, sf_dir).raw_ticket)


@register("synthetic_fill")
def q_synthetic_fill(spark, sf_dir):
    return etl.synthetic_fill(_wh(spark, sf_dir).raw_ticket)


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    return etl.surrogate_key(_wh(spark, sf_dir).raw_ticket)


@register("ticket_transform")
def q_ticket_transform(spark, sf_dir):
    return etl.ticket_transform(_wh(spark, sf_dir).raw_ticket)


@register("default_columns")
def q_default_columns(spark, sf_dir):
    return etl.default_columns(_wh(spark, sf_dir).raw_ticket)


@register("agent_lookup")
def q_agent_lookup(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.agent_lookup(w.raw_ticket, w.dim_agent)


@register("load_fact_ticket")
def q_load_fact_ticket(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.load_fact_ticket(w.raw_ticket, w.dims())[0]


@register("fk_rejects")
def q_fk_rejects(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.fk_rejects(w.batch_ticket, w.dim_client, w.dim_site)


@register("pk_dedupe")
def q_pk_dedupe(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.pk_dedupe(w.batch_ticket, w.fact_ticket.where("status = 'Closed'"))


@register("incident_clean")
def q_incident_clean(spark, sf_dir):
    return etl.incident_clean(_wh(spark, sf_dir).raw_incident)


@register("incident_priority_rules")
def q_incident_priority_rules(spark, sf_dir):
    return etl.incident_priority_rules(_wh(spark, sf_dir).raw_incident)


@register("incident_rejects")
def q_incident_rejects(spark, sf_dir):
    return etl.incident_rejects(_wh(spark, sf_dir).raw_incident)


@register("incident_impute")
def q_incident_impute(spark, sf_dir):
    return etl.incident_impute(_wh(spark, sf_dir).fact_incident)


@register("load_fact_incident")
def q_load_fact_incident(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.load_fact_incident(w.raw_incident, w.dims())[0]


@register("incident_load_rejects")
def q_incident_load_rejects(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.load_fact_incident(w.raw_incident, w.dims())[1]


@register("metrics_clean")
def q_metrics_clean(spark, sf_dir):
    return etl.metrics_clean(_wh(spark, sf_dir).raw_metrics)


@register("metrics_rejects")
def q_metrics_rejects(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.metrics_rejects(w.raw_metrics, w.dim_site)


@register("load_fact_metrics")
def q_load_fact_metrics(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return etl.load_fact_metrics(w.raw_metrics, w.dim_site)[0]


@register("stage_support")
def q_stage_support(spark, sf_dir):
    return etl.stage_support(_wh(spark, sf_dir).raw_support)


@register("lifecycle_times")
def q_lifecycle_times(spark, sf_dir):
    return etl.lifecycle_times(_wh(spark, sf_dir).fact_ticket)


@register("dim_time")
def q_dim_time(spark, sf_dir):
    from pyspark.sql import functions as F

    w = _wh(spark, sf_dir)
    return etl.dim_time(F.col("created_at"), F.col("opened_at"), frames=[w.fact_ticket, w.fact_incident])


@register("schema_intersect")
def q_schema_intersect(spark, sf_dir):
    from deskflow import schemas

    dim = _wh(spark, sf_dir).dim_client
    return dim.select([c for c in dim.columns if c in schemas.DIM_CLIENT_DDL.names])


@register("table_counts")
def q_table_counts(spark, sf_dir):
    from deskflow.operators.profile import table_counts

    w = _wh(spark, sf_dir)
    tables = {**{n: w.dims()[n] for n in ["dim_client", "dim_site", "dim_agent", "dim_priority", "dim_region"]},
              **w.facts(), "stg_it_support": w.raw_support, "stg_tech_support": w.raw_tech_support}
    return table_counts(tables)


# --------------------------------------------------------------- business
from deskflow.plans import business  # noqa: E402

# Region-group membership used with the test tables (4 home, 4 abroad; the
# remaining regions are reported as unassigned).
FIXTURE_REGION_GROUPS = {
    HOME_COUNTRY: ["NATION_2", "NATION_7", "NATION_12", "NATION_17"],
    "International": ["NATION_0", "NATION_1", "NATION_3", "NATION_4"],
}


@register("executive_summary")
def q_executive_summary(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.executive_summary(w.fact_incident, w.dim_site, w.dim_region, w.dim_priority)


@register("penalty_exposure")
def q_penalty_exposure(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.penalty_exposure(w.dim_client, w.fact_ticket, w.fact_incident)


@register("capacity_hourly")
def q_capacity_hourly(spark, sf_dir):
    return business.capacity_hourly(_wh(spark, sf_dir).fact_metrics)


@register("capacity_by_region")
def q_capacity_by_region(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.capacity_by_region(w.fact_metrics, w.dim_site, w.dim_region)


@register("sla_config_minutes")
def q_sla_config_minutes(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.sla_config_minutes(w.fact_ticket, w.dim_priority)


@register("sla_contract_terms")
def q_sla_contract_terms(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.sla_contract_terms(w.fact_ticket, w.dim_client)


@register("region_rollup")
def q_region_rollup(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return business.region_rollup(w.fact_incident, w.dim_site, w.dim_region, FIXTURE_REGION_GROUPS)


@register("datediff_boundaries")
def q_datediff_boundaries(spark, sf_dir):
    return business.datediff_boundaries(_wh(spark, sf_dir).fact_incident)


@register("date_features")
def q_date_features(spark, sf_dir):
    return business.date_features(_wh(spark, sf_dir).fact_ticket)


# ---------------------------------------------------------------- profiling
from deskflow.operators import profile, quality  # noqa: E402


@register("profile_shape")
def q_profile_shape(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return profile.shape({"raw_incident": w.raw_incident, "raw_ticket": w.raw_ticket,
                          "raw_metrics": w.raw_metrics, "raw_support": w.raw_support})


@register("profile_missing")
def q_profile_missing(spark, sf_dir):
    return profile.missing_values(_wh(spark, sf_dir).raw_incident)


@register("profile_duplicates")
def q_profile_duplicates(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return profile.duplicate_rows({"raw_incident": w.raw_incident, "raw_ticket": w.raw_ticket,
                                   "raw_metrics": w.raw_metrics, "batch_ticket": w.batch_ticket})


@register("profile_describe")
def q_profile_describe(spark, sf_dir):
    return profile.describe(_wh(spark, sf_dir).raw_incident)


@register("profile_key_columns")
def q_profile_key_columns(spark, sf_dir):
    return profile.key_columns(_wh(spark, sf_dir).raw_incident)


@register("profile_unique")
def q_profile_unique(spark, sf_dir):
    return profile.unique_values(_wh(spark, sf_dir).raw_incident)


@register("mttr_quantiles_by_client")
def q_mttr_quantiles_by_client(spark, sf_dir):
    from deskflow.operators.quantiles import grouped_quantiles

    return grouped_quantiles(_ie(spark, sf_dir), ["client_name"], "resolution_hours", [0.25, 0.5, 0.95])


@register("profile_date_ranges")
def q_profile_date_ranges(spark, sf_dir):
    return profile.date_ranges(_wh(spark, sf_dir).facts())


# ------------------------------------------------------------------ quality
def _tables(w: Warehouse) -> dict:
    return {**w.dims(), **w.facts()}


@register("fk_audit")
def q_fk_audit(spark, sf_dir):
    from deskflow import schemas

    return quality.fk_audit(_tables(_wh(spark, sf_dir)), schemas.FOREIGN_KEYS)


def validation_metrics(w: Warehouse):
    from pyspark.sql import functions as F

    from deskflow import schemas
    from deskflow.operators.quality import Check, null_pct, table_checks

    def pct(c):  # null share in percent, rounded half to even at 4 digits
        return F.rint(null_pct(c) * 10000) / 10000

    def dup(c):
        return F.count(F.lit(1)) - F.count_distinct(c)

    neg = lambda a, b: F.count_if(F.col(b) < F.col(a))
    outside = lambda c, lo, hi: F.count_if((F.col(c) < lo) | (F.col(c) > hi))
    rows = [
        table_checks(w.fact_ticket, "fact_ticket", [
            Check("completeness", "resolved_at null pct", pct("resolved_at"), 10),
            Check("completeness", "survey_results null pct", pct("survey_results"), 10),
            Check("validity", "resolved before created", neg("created_at", "resolved_at"), 0),
            Check("validity", "responded before created", neg("created_at", "first_response_at"), 0),
            Check("uniqueness", "duplicate ticket_id", dup("ticket_id"), 0)]),
        table_checks(w.fact_incident, "fact_incident", [
            Check("completeness", "made_sla null pct", pct("made_sla"), 5),
            Check("completeness", "resolved_at null pct", pct("resolved_at"), 10),
            Check("validity", "resolved before opened", neg("opened_at", "resolved_at"), 0),
            Check("uniqueness", "duplicate incident_id", dup("incident_id"), 0)]),
        table_checks(w.fact_metrics, "fact_metrics", [
            Check("range", "cpu_util_pct outside 0-100", outside("cpu_util_pct", 0, 100), 0),
            Check("range", "packet_loss_pct outside 0-100", outside("packet_loss_pct", 0, 100), 0),
            Check("completeness", "latency_ms null pct", pct("latency_ms"), 1)]),
        table_checks(w.dim_client, "dim_client", [
            Check("completeness", "industry null pct", pct("industry"), 5),
            Check("uniqueness", "duplicate client_id", dup("client_id"), 0)]),
    ]
    fk = quality.fk_audit(_tables(w), schemas.FOREIGN_KEYS).select(
        F.col("child_table").alias("table_name"), F.lit("referential").alias("validation_type"),
        F.concat_ws(" -> ", "fk_column", "parent_table").alias("validation_metric"),
        F.col("orphan_rows").cast(quality.METRIC_TYPE).alias("metric_value"),
        F.lit(0).cast(quality.METRIC_TYPE).alias("threshold_value"), F.lit(None).cast("string").alias("notes"))
    out = fk
    for r in rows:
        out = out.unionByName(r)
    return out


def _validation_log(spark, sf_dir):
    return quality.validation_log(validation_metrics(_wh(spark, sf_dir)), etl.as_of_lit())


@register("validation_log")
def q_validation_log(spark, sf_dir):
    from deskflow.plans import reload
    from deskflow.session import work_dir

    return reload.save_validation_log(spark, _validation_log(spark, sf_dir), work_dir(spark, "validation"))


@register("dq_score")
def q_dq_score(spark, sf_dir):
    return quality.dq_score(_validation_log(spark, sf_dir))


# -------------------------------------------------------- sources and sinks
from deskflow.plans import reload  # noqa: E402
from deskflow.session import work_dir  # noqa: E402
from deskflow.sources import files  # noqa: E402


def _sources(w: Warehouse) -> reload.Sources:
    return reload.Sources(w.dims(), w.raw_ticket, w.raw_incident, w.raw_metrics, w.raw_support, w.raw_tech_support)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    src = _wh(spark, sf_dir).raw_support
    path = work_dir(spark, "csv") + "/support"
    files.write_csv(src, path)
    return files.read_csv(spark, path, src.schema, token_columns=["assignment_group", "priority_name", "support_level"])


@register("csv_corrupt")
def q_csv_corrupt(spark, sf_dir):
    """Sound rows and rejects of a CSV source with damaged lines."""
    from pyspark.sql import functions as F, types as T

    path = work_dir(spark, "csv") + "/lines"
    _wh(spark, sf_dir).csv_lines.select("value").write.text(path)
    schema = T._parse_datatype_string("order_id long, client_id long, amount long, placed date, note string")
    sound, rejects = files.read_csv_split(spark, path, schema, {"header": "false"})
    return sound.withColumns({"record": F.lit(None).cast("string"), "reject_reason": F.lit(None).cast("string")}).unionByName(
        rejects, allowMissingColumns=True)


@register("optional_source")
def q_optional_source(spark, sf_dir):
    from pyspark.sql import functions as F

    from deskflow import schemas

    w = _wh(spark, sf_dir)
    wanted = {"customer": w.raw("customer").schema, "orders": w.raw("orders").schema,
              "ticket_archive": schemas.FACT_TICKET}
    out = None
    for name, schema in wanted.items():
        df, found = files.read_optional(spark, f"{w.sf_dir}/{name}.parquet", schema)
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source_name"), F.lit("loaded" if found else "missing").alias("status"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


SAMPLE_ROWS = 100  # size of the sample report


@register("sample_first_n")
def q_sample_first_n(spark, sf_dir, rows=SAMPLE_ROWS):
    return _wh(spark, sf_dir).raw_ticket.orderBy("seq").limit(rows)


@register("append_aligned")
def q_append_aligned(spark, sf_dir):
    return reload.append_aligned(spark, _wh(spark, sf_dir).batch_ticket, work_dir(spark, "append"))


@register("dim_reload")
def q_dim_reload(spark, sf_dir):
    return reload.dim_reload(spark, _wh(spark, sf_dir).dims(), work_dir(spark, "dims"))


def _loaded(spark, sf_dir):
    w = _wh(spark, sf_dir)
    src = _sources(w)
    root = work_dir(spark, "load")
    reload.run_load(spark, src, root)
    return src, root


@register("load_report")
def q_load_report(spark, sf_dir):
    src, root = _loaded(spark, sf_dir)
    return reload.load_report(spark, src, root)


@register("load_report_sample")
def q_load_report_sample(spark, sf_dir, rows=SAMPLE_ROWS):
    src, root = _sources(_wh(spark, sf_dir)), work_dir(spark, "load")
    reload.load_outcomes(spark, src, root, sample=rows)
    return reload.load_report(spark, src, root, sample=rows)


@register("load_report_faults")
def q_load_report_faults(spark, sf_dir):
    """A run over broken sources: the agents fail at once, the metrics at
    some of their rows; what does not depend on them is loaded."""
    from pyspark.sql import functions as F

    def broken(df, column, when):
        return df.withColumn(column, F.when(when, F.raise_error(F.lit("planted fault")).cast("string")).otherwise(F.col(column)))

    src, root = _sources(_wh(spark, sf_dir)), work_dir(spark, "load")
    src.dims["dim_agent"] = broken(src.dims["dim_agent"], "team", F.col("agent_id") >= 0)
    src.raw_metrics = broken(src.raw_metrics, "latency_ms", F.col("seq") % 1000 == 7)
    reload.load_outcomes(spark, src, root)
    return reload.load_report(spark, src, root)


@register("audit_log")
def q_audit_log(spark, sf_dir):
    src, root = _loaded(spark, sf_dir)
    return reload.audit_log(spark, reload.load_report(spark, src, root), root)


@register("schema_catalog")
def q_schema_catalog(spark, sf_dir):
    _, root = _loaded(spark, sf_dir)
    return reload.schema_catalog(spark, root)


# ---------------------------------------------------------------- streaming
@register("metrics_incremental")
def q_metrics_incremental(spark, sf_dir):
    from deskflow.streaming import incremental

    w = _wh(spark, sf_dir)
    base = work_dir(spark, "stream")
    incremental.land_in_files(w.raw_metrics, f"{base}/landing", files=4)
    return incremental.run_incremental(spark, f"{base}/landing", w.raw_metrics.schema, w.dim_site,
                                       f"{base}/fact_metrics", f"{base}/_checkpoint")


@register("tickets_incremental")
def q_tickets_incremental(spark, sf_dir, chunks=4):
    """Tickets that arrive in chunks, with ids that go on between them."""
    from pyspark.sql import functions as F

    from deskflow.streaming import chunks as C, incremental

    w = _wh(spark, sf_dir)
    base = work_dir(spark, "stream")
    lo, hi = w.raw_ticket.agg(F.min("seq"), F.max("seq")).first()
    bounds = [] if lo is None else [lo + (hi - lo) * i // chunks for i in range(1, chunks)]
    C.land_chunks(w.raw_ticket, f"{base}/landing", "seq", bounds)
    return incremental.run_ticket_stream(spark, f"{base}/landing", w.raw_ticket.schema, w.dims(),
                                         f"{base}/fact_ticket", f"{base}/_checkpoint")
