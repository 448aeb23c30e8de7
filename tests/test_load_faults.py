"""Loads of faulty sources: rows are rejected with a reason, never lost."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from deskflow.functions import clean
from deskflow.plans import etl, reload
from deskflow.streaming import incremental



def test_flags_in_text_form(spark):
    rows = spark.createDataFrame([("true",), ("0",), ("maybe",), (None,)], "x string")
    assert [r[0] for r in rows.select(clean.bool_to_int("x")).collect()] == [1, 0, None, None]
    assert spark.range(1).select(clean.bool_to_int(F.lit(1.0)), clean.bool_to_int(F.lit(False))).first()[:] == (1, 0)


def test_ticket_keys_are_checked(spark, wh):
    few = wh.raw_ticket.where("seq < 400")
    n = few.count()
    text = F.when(F.col("seq") % 4 == 0, F.lit("T-9")).when(F.col("seq") % 4 == 1, F.lit(None)).otherwise(
        (F.col("seq") % 8).cast("string"))
    raw = few.withColumn("ticket_id", text).withColumn("status", F.lit("Open"))
    acc, rej = etl.load_fact_ticket(raw, wh.dims())
    assert acc.count() + rej.count() == n
    rows = acc.collect()
    assert sorted(r.ticket_id for r in rows) == sorted({s % 8 for (s,) in few.select("seq").collect() if s % 4 > 1})
    assert {r.status for r in rows} == {"Open"}
    assert {r.reject_reason for r in rej.select("reject_reason").distinct().collect()} == {
        "ticket_id is not an integer: T-9", "ticket_id is not an integer: null", "ticket_id is repeated"}


def test_incident_columns_of_the_source_are_kept(spark, wh):
    client = wh.dim_client.agg(F.max("client_id")).first()[0]
    few = wh.raw_incident.where("number < 1000 and impact in ('1 - High', '2 - Medium') and urgency = '1 - High'").limit(20)
    one = few.limit(1).withColumn("number", F.lit("5"))
    raw = one.withColumns({"resolved_at": F.lit("1/2/2030 10:00"), "acknowledged_at": F.lit("31/1/2030 9:00"),
                           "reopen_count": F.lit("7"), "client_id": F.lit(client), "seq": F.lit(2)})
    raw = raw.unionByName(raw.withColumns({"reopen_count": F.lit("8"), "seq": F.lit(1)}))
    raw = raw.unionByName(raw.withColumn("number", F.lit("INC100002")).where("seq = 1"))
    raw = raw.unionByName(raw.withColumns({"number": F.lit("6"), "reopen_count": F.lit("many")}).where("seq = 2"))
    acc, rej = etl.load_fact_incident(raw, wh.dims())
    (row,) = acc.collect()
    assert (row.incident_id, row.reopen_count, row.client_id) == (5, 8, client)  # the first by seq
    assert (row.resolved_at, row.acknowledged_at) == (dt.datetime(2030, 2, 1, 10), dt.datetime(2030, 1, 31, 9))
    assert {r.reject_reason for r in rej.collect()} == {
        "number is not an integer: INC100002", "reopen_count is not an integer: many", "incident_id is repeated"}
    assert rej.count() == 3


def test_stream_rejects_repeats_and_accounts_for_every_row(spark, wh):
    base = tempfile.mkdtemp(prefix="deskflow-stream-", dir="/tmp")
    twice = wh.raw_metrics.unionByName(wh.raw_metrics)
    incremental.land_in_files(twice, f"{base}/landing", files=1)
    n, sound = twice.count(), etl.accepted_metrics(wh.raw_metrics, wh.dim_site).count()
    for turn, run in enumerate(("a", "b"), start=1):
        out = incremental.run_incremental(spark, f"{base}/landing", twice.schema, wh.dim_site, f"{base}/target", f"{base}/{run}")
        assert out.count() == sound
        rejected = incremental.metric_table(spark, f"{base}/target").read("rejected")
        assert rejected.count() == turn * n - sound
        assert rejected.where("reject_reason = 'seq is repeated'").count() == (2 * turn - 1) * sound


def test_audit_ids_go_on(spark):
    root = tempfile.mkdtemp(prefix="deskflow-audit-", dir="/tmp")
    report = spark.createDataFrame([("fact_ticket", 3, 1)], "table_name string, accepted_rows long, rejected_rows long")
    for _ in range(3):
        log = reload.audit_log(spark, report, root)
    assert sorted(r.audit_id for r in log.collect()) == [1, 2, 3]
