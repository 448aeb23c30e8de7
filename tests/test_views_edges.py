"""Edge cases of the KPI views on literal frames (FIXTURES section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from deskflow.plans import analysis, views
from deskflow.functions.util import local_rows

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def mins(m):
    return T0 + dt.timedelta(minutes=m)


@pytest.fixture
def dims(spark):
    return {
        "dim_client": local_rows(spark, [(1, "Acme", "Tech", "Gold", "ASIA", "N1"), (2, "Beta", None, "Gold", "EUROPE", "N2")],
                                 "client_id long, client_name string, industry string, contract_tier string, "
                                 "hq_country string, region_group string").withColumn(
            "monthly_contract_value", F.lit(10).cast("decimal(10,2)")),
        "dim_site": local_rows(spark, [(1, "S1", 7)], "site_id long, site_name string, region_id int"),
        "dim_agent": local_rows(spark, [(1, "Ann")], "agent_id long, agent_name string"),
        "dim_priority": local_rows(spark, [(1, "Critical"), (2, "High"), (3, "Medium"), (4, "Low"), (9, "Odd")],
                                   "priority_id int, priority_name string"),
        "dim_region": local_rows(spark, [(7, "R7", "ASIA")], "region_id int, region_name string, country string"),
    }


def tickets(spark, rows):
    return local_rows(spark, rows, "ticket_id long, client_id long, site_id long, agent_id long, priority_id int, "
                                   "created_at timestamp_ntz, first_response_at timestamp_ntz, resolved_at timestamp_ntz, "
                                   "sla_first_response_min int, sla_resolution_min int, agent_interactions int, "
                                   "survey_results string, status string")


def test_breach_flags_unresolved_and_exact_limits(spark, dims):
    t = tickets(spark, [(1, 1, 1, 1, 1, T0, mins(30), mins(180), 30, 180, 1, None, "Closed"),
                        (2, 1, 1, 1, 1, T0, mins(31), mins(181), 30, 180, 1, None, "Closed"),
                        (3, 1, 1, 1, 1, T0, mins(5), None, 30, 180, 1, None, "Open")])
    k = views.ticket_kpis(t, dims["dim_client"], dims["dim_site"], dims["dim_agent"], dims["dim_priority"])
    got = {r.ticket_id: (r.response_breach, r.resolution_breach) for r in k.collect()}
    assert got == {1: (0, 0), 2: (1, 1), 3: (0, 0)}


def test_sla_status_by_priority_hours(spark, dims):
    t = tickets(spark, [(1, 1, 1, 1, 1, T0, mins(1), mins(240), 30, 180, 1, None, "Closed"),
                        (2, 1, 1, 1, 1, T0, mins(1), mins(300), 30, 180, 1, None, "Closed"),
                        (3, 1, 1, 1, 9, T0, mins(1), mins(1), 30, 180, 1, None, "Closed")])
    te = views.ticket_extract(t, dims["dim_client"], dims["dim_priority"], "ASIA")
    assert {r.ticket_id: r.sla_status for r in te.collect()} == {1: "Met", 2: "Breached", 3: "Breached"}


def test_sla_rates_sql_vs_non_null(spark, dims):
    inc = local_rows(spark, [(1, 1, 1, 1, T0, mins(60), 1, 0, 0), (2, 1, 1, 1, T0, mins(60), None, 0, 0),
                             (3, 1, 1, 1, T0, mins(60), 0, 0, 0)],
                     "incident_id long, client_id long, site_id long, priority_id int, opened_at timestamp_ntz, "
                     "resolved_at timestamp_ntz, made_sla int, reassignment_count int, reopen_count int")
    sla = views.sla_view(inc, dims["dim_client"], dims["dim_site"], dims["dim_region"], dims["dim_priority"]).first()
    assert (sla.incident_count, sla.sla_met, sla.sla_breached) == (3, 1, 1)
    health = {r.client_name: r for r in views.customer_health(dims["dim_client"], tickets(spark, []), inc).collect()}
    assert str(health["Acme"].sla_compliance_pct) == "33.33"
    assert health["Beta"].incident_count == 0 and str(health["Beta"].sla_compliance_pct) == "0.00"
    ie = views.incident_extract(inc, dims["dim_client"], dims["dim_site"], dims["dim_region"], dims["dim_priority"], "ASIA")
    assert analysis.incident_summary(ie).first().sla_compliance_pct == pytest.approx(50.0)


def test_null_keys_sql_group_vs_dropped(spark, dims):
    t = tickets(spark, [(1, 2, 1, 1, 1, T0, mins(1), mins(2), 30, 180, 1, None, "Closed"),
                        (2, 1, 1, 1, 1, T0, mins(1), mins(2), 30, 180, 1, "Satisfied", "Closed")])
    te = views.ticket_extract(t, dims["dim_client"], dims["dim_priority"], "ASIA")
    # SQL-style grouping keeps the null industry as a group; dataframe-style drops null keys.
    assert te.groupBy("industry").count().count() == 2
    assert analysis.csat_distribution(te).count() == 1


def test_unknown_or_null_fk_drops_row_from_view(spark, dims):
    t = tickets(spark, [(1, 1, None, 1, 1, T0, mins(1), mins(2), 30, 180, 1, None, "Closed"),
                        (2, 1, 99, 1, 1, T0, mins(1), mins(2), 30, 180, 1, None, "Closed"),
                        (3, 1, 1, 1, 1, T0, mins(1), mins(2), 30, 180, 1, None, "Closed")])
    k = views.ticket_kpis(t, dims["dim_client"], dims["dim_site"], dims["dim_agent"], dims["dim_priority"])
    assert [r.ticket_id for r in k.collect()] == [3]
