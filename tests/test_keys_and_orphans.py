"""Primary and foreign keys: both sides of every split, and plans that move
keys rather than rows."""

import re

import pytest
from pyspark.sql import functions as F

from deskflow.operators.joins import mark_repeats, orphan_keys, split_by_foreign_keys, split_by_key


def test_split_by_key_accounts_for_every_row(spark):
    rows = [(1, 5, "a"), (1, 4, "b"), (1, 4, "b"), (2, 1, "c"), (None, 1, "d"), (None, 1, "d"), (3, None, "e"), (3, 2, "f")]
    df = spark.createDataFrame(rows, "k long, o int, v string")
    first, rest = split_by_key(df, "k", ["o", "v"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, 4, "b"), (2, 1, "c"), (3, None, "e")]
    assert sorted((r.k is None, r.k or 0, r.o, r.v, r.reject_reason) for r in rest.collect()) == [
        (False, 1, 4, "b", "k is repeated"), (False, 1, 5, "a", "k is repeated"), (False, 3, 2, "f", "k is repeated"),
        (True, 0, 1, "d", "k is missing"), (True, 0, 1, "d", "k is missing")]


def test_split_by_key_of_a_hot_key_and_an_empty_frame(spark):
    df = spark.range(0, 9000, 1, 7).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o"))
    first, rest = split_by_key(df, "k", ["o"], "twice")
    assert (first.count(), rest.count()) == (6001, 2999)
    assert first.where("k = -1").first().o == -8997
    assert {r.reject_reason for r in rest.select("reject_reason").distinct().collect()} == {"twice"}
    first, rest = split_by_key(df.limit(0), "k", ["o"])
    assert (first.count(), rest.count()) == (0, 0)


def test_mark_repeats_shuffles_wide_rows_of_repeated_keys_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("wide", F.concat_ws("-", "l_shipdate", "l_partkey"))
    marked = mark_repeats(df, "l_orderkey", ["l_linenumber"])
    marked.collect()
    plan = marked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", final)
    assert exchanged and "BroadcastHashJoin" in final
    # No exchange stands over a row that carries the wide column.
    for line in final.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "wide" not in line


def test_rows_without_a_key_are_spread_over_the_tasks_of_the_join(spark):
    """Too many repeated keys to broadcast, and most rows without a key: no
    task of the join gets them all."""
    df = spark.range(0, 8000, 1, 4).select(F.when(F.col("id") % 4 == 0, F.col("id") % 1500).alias("k"), "id")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        rows = mark_repeats(df, "k", ["id"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)
    first = {}
    for r in sorted(rows, key=lambda r: r.id):
        first.setdefault(r.k, r.id)
    assert len(rows) == 8000 and all(r["__again"] == (r.k is not None and first[r.k] != r.id) for r in rows)
    tasks = [r.task for r in rows]
    assert max(tasks.count(t) for t in set(tasks)) < 2000


@pytest.fixture
def facts(spark):
    rows = [(i, i % 50 if i % 7 else 1000 + i % 3, None if i % 11 == 0 else i % 20) for i in range(2000)]
    return spark.createDataFrame(rows, "id long, client_id long, site_id long")


def _sides(facts, clients, sites):
    acc, rej = split_by_foreign_keys(facts, [("client_id", clients, "client_id", "no client"), ("site_id", sites, "site_id", "no site")])
    return sorted(tuple(r) for r in acc.collect()), sorted((r.id, r.reject_reason) for r in rej.collect())


def test_orphan_split_equals_flag_split(spark, facts):
    clients, sites = spark.range(50).withColumnRenamed("id", "client_id"), spark.range(15).withColumnRenamed("id", "site_id")
    small = _sides(facts, clients, sites)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        large = _sides(facts, clients, sites)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert small == large and len(small[0]) + len(small[1]) == 2000
    assert {r for _, r in small[1]} == {"no client", "no site"}
    assert {r.client_id for r in orphan_keys(facts, "client_id", clients, "client_id").collect()} == {1000, 1001, 1002}


def test_large_parents_do_not_move_fact_rows(spark):
    """Parents above the broadcast threshold, few orphans: the facts stay in
    place, and only keys are shuffled."""
    facts = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3000 == 1, -5).otherwise(F.col("o_custkey")).alias("client_id"),
        F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("wide"))
    parent = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select(F.col("c_custkey").alias("client_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    try:
        acc, rej = split_by_foreign_keys(facts, [("client_id", parent, "client_id", "no client")])
        assert rej.count() == 5 and acc.count() == 14995
        rows = acc.collect()
        final = acc._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 14995 and all(r.client_id > -5 for r in rows)
    assert re.search(r"BroadcastHashJoin[^\n]*LeftOuter", final) and "Exchange hashpartitioning" not in final
