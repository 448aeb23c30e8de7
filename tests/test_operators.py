"""Operators and invariants on the small test tables."""

import datetime as dt

from pyspark.sql import functions as F

from deskflow.operators.joins import first_per_key, lookup_with_default, new_rows_only
from deskflow.operators.keys import dense_ids
from deskflow.operators.profile import exact_quantiles
from deskflow.plans import analysis, etl, views
from deskflow.queries import REGISTRY
from deskflow.sources.fixtures import HOME_COUNTRY

SF = "/root/testdata/sf0.001"


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    out = dense_ids(df, ["k"], "rid", base=10, num_partitions=5).orderBy("k").collect()
    assert [r.rid for r in out] == list(range(10, 10 + 5000))
    ks = [r.k for r in out]
    assert ks == sorted(ks)


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = exact_quantiles(df, ["x"], [0.25, 0.5]).first()
    assert (q.q0, q.q1) == (1.75, 2.5)


def test_lookup_last_wins_and_default(spark):
    dim = spark.createDataFrame([(1, "g1"), (5, "g1"), (3, "g2")], "agent_id long, assignment_group string")
    facts = spark.createDataFrame([("g1",), ("g2",), ("zz",), (None,)], "queue string")
    got = [r.agent_id for r in lookup_with_default(facts, "queue", dim, "assignment_group", "agent_id", "agent_id",
                                                    default=1, last_wins_by="agent_id").orderBy("queue").collect()]
    assert sorted(got) == sorted([5, 3, 1, 1])


def test_first_per_key_and_rerun_adds_nothing(spark):
    batch = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 0)], "ticket_id long, v string, seq int")
    first = first_per_key(batch, ["ticket_id"], ["seq"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, "a", 0), (2, "c", 0)]
    assert new_rows_only(first, first, ["ticket_id"]).count() == 0


def test_facts_keep_every_row(wh):
    assert wh.fact_ticket.count() == wh.raw("orders").count()
    orders = wh.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    assert wh.fact_incident.count() == wh.raw("lineitem").join(orders, "l_orderkey").count()
    assert wh.fact_incident.select("incident_id").distinct().count() == wh.fact_incident.count()


def test_pk_dedupe_adds_missing_tickets_only(wh):
    closed = wh.fact_ticket.where("status = 'Closed'")
    added = etl.pk_dedupe(wh.batch_ticket, closed)
    missing = wh.batch_ticket.select("ticket_id").distinct().join(closed, "ticket_id", "left_anti")
    assert added.count() == missing.count() > 0


def test_pk_dedupe_second_load_is_empty(wh):
    added = etl.pk_dedupe(wh.batch_ticket, wh.fact_ticket)
    target = wh.fact_ticket.select("ticket_id").unionByName(added.select("ticket_id"))
    assert etl.pk_dedupe(wh.batch_ticket, target).count() == 0


def test_view_invariants(wh):
    sla = views.sla_view(wh.fact_incident, wh.dim_client, wh.dim_site, wh.dim_region, wh.dim_priority)
    assert sla.where(F.col("sla_met") + F.col("sla_breached") > F.col("incident_count")).count() == 0
    health = views.customer_health(wh.dim_client, wh.fact_ticket, wh.fact_incident)
    assert health.count() == wh.dim_client.count()
    ops = views.operations_view(wh.fact_ticket, wh.fact_incident, wh.dim_client, wh.dim_site, wh.dim_region,
                                wh.dim_priority)
    by_type = dict(ops.groupBy("record_type").count().collect())
    te = views.ticket_extract(wh.fact_ticket, wh.dim_client, wh.dim_priority, HOME_COUNTRY)
    assert by_type["Ticket"] <= te.count()


def test_shares_sum_to_100(wh):
    te = views.ticket_extract(wh.fact_ticket, wh.dim_client, wh.dim_priority, HOME_COUNTRY)
    total = analysis.tickets_by_priority(te).agg(F.sum("share_pct")).first()[0]
    assert abs(total - 100.0) < 1e-9


def test_rejects_account_for_every_row(wh):
    acc, rej = etl.load_fact_metrics(wh.raw_metrics, wh.dim_site)
    assert acc.count() + rej.count() == wh.raw_metrics.count()
    acc_i, rej_i = etl.load_fact_incident(wh.raw_incident, wh.dims())
    assert acc_i.count() + rej_i.count() == wh.raw_incident.count()
    assert rej_i.where("reject_reason = 'incident_id is repeated'").count() > 0
    assert acc_i.groupBy("incident_id").count().where("count > 1").count() == 0


def test_incremental_equals_batch_and_replay_is_idempotent(spark, wh):
    import tempfile

    from deskflow.streaming import incremental

    base = tempfile.mkdtemp(prefix="deskflow-stream-", dir="/tmp")
    incremental.land_in_files(wh.raw_metrics, f"{base}/landing", files=3)
    out = incremental.run_incremental(spark, f"{base}/landing", wh.raw_metrics.schema, wh.dim_site,
                                      f"{base}/target", f"{base}/ckpt1")
    batch = etl.accepted_metrics(wh.raw_metrics, wh.dim_site)
    assert out.count() == batch.count()
    assert out.exceptAll(batch.select(*out.columns)).count() == 0
    # Same files again under a fresh checkpoint: every key already stored.
    again = incremental.run_incremental(spark, f"{base}/landing", wh.raw_metrics.schema, wh.dim_site,
                                        f"{base}/target", f"{base}/ckpt2")
    assert again.count() == batch.count()


def test_csv_roundtrip_keeps_multiline_quotes(spark):
    import tempfile

    from deskflow.sources import files

    df = spark.createDataFrame([(1, 'say "hi"\nsecond line', "  padded  "), (2, None, "")], "id long, body string, g string")
    path = tempfile.mkdtemp(prefix="deskflow-csv-", dir="/tmp") + "/out"
    files.write_csv(df, path)
    back = files.read_csv(spark, path, df.schema)
    # An empty field reads back as missing (CSV readers treat empty as null).
    assert sorted(tuple(r) for r in back.collect()) == [(1, 'say "hi"\nsecond line', "  padded  "), (2, None, None)]


def test_monthly_peak_ties_take_earliest(spark):
    rows = [(dt.datetime(2020, 1, 5), "x"), (dt.datetime(2020, 2, 5), "x"), (dt.datetime(2020, 3, 5), "x"),
            (dt.datetime(2020, 3, 6), "x"), (dt.datetime(2020, 1, 7), "x")]
    te = spark.createDataFrame(rows, "created_at timestamp_ntz, k string").withColumn(
        "year_month", F.date_format("created_at", "yyyy-MM"))
    p = analysis.monthly_peaks(te).first()
    assert (p.peak_month, p.peak_tickets, p.low_month, p.low_tickets) == ("2020-01", 2, "2020-02", 1)


def test_entry_and_registry_shapes(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    # the optional corpus queries come on top, with SQL where they have one
    corpus, corpus_sql = entry._corpus()
    assert set(entry.queries()) == set(REGISTRY) | set(corpus) and not set(REGISTRY) & set(corpus)
    assert set(entry.oracle_sql()) == set(REGISTRY) | set(corpus_sql)


def test_views_register_for_sql(spark, wh):
    names = views.register_views(spark, wh.fact_ticket, wh.fact_incident, wh.dims(), HOME_COUNTRY)
    assert "customer_health" in names
    n = spark.sql("select count(*) from customer_health").first()[0]
    assert n == wh.dim_client.count()


def test_load_run_counts_match_stored_tables(spark, wh):
    import tempfile

    from deskflow.plans import reload

    root = tempfile.mkdtemp(prefix="deskflow-load-", dir="/tmp")
    src = reload.Sources(wh.dims(), wh.raw_ticket, wh.raw_incident, wh.raw_metrics, wh.raw_support, wh.raw_tech_support)
    counts = reload.run_load(spark, src, root)
    report = {r.table_name: r for r in reload.load_report(spark, src, root).collect()}
    for name in ["fact_ticket", "fact_incident", "fact_metrics", "stg_it_support"]:
        assert counts[f"{name}.accepted"] == report[name].accepted_rows
        assert counts[f"{name}.rejected"] == report[name].rejected_rows


def test_dense_ids_spread_a_hot_value(spark):
    # A third of the rows share one value: the range partitions must still split them.
    df = spark.range(0, 3000, 1, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    ranked = dense_ids(df, ["v"], "rid", base=0, num_partitions=6)
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000
    assert sorted(r.rid for r in ranked.collect()) == list(range(3000))
    vals = [r.v for r in ranked.orderBy("rid").collect()]
    assert vals == sorted(vals)


def test_load_run_goes_on_without_a_source(spark, wh):
    import tempfile

    from deskflow.plans import reload

    root = tempfile.mkdtemp(prefix="deskflow-load-", dir="/tmp")
    src = reload.Sources(wh.dims(), wh.raw_ticket, wh.raw_incident, None, wh.raw_support, wh.raw_tech_support)
    counts = reload.run_load(spark, src, root)
    report = {r.table_name: r for r in reload.load_report(spark, src, root).collect()}
    assert (counts["fact_metrics.accepted"], report["fact_metrics"].input_rows, report["fact_metrics"].accepted_rows) == (0, 0, 0)
    assert report["fact_ticket"].accepted_rows == wh.raw_ticket.count()
