"""Readers, writers and schema alignment."""

import tempfile

from pyspark.sql import types as T

from deskflow import schemas
from deskflow.session import cluster_conf
from deskflow.sources import files


def test_optional_source_missing_and_present(spark):
    schema = T.StructType([T.StructField("x", T.LongType())])
    df, found = files.read_optional(spark, "/root/testdata/sf0.001/no_such_table.parquet", schema)
    assert (found, df.count(), df.schema) == (False, 0, schema)
    df, found = files.read_optional(spark, "/root/testdata/sf0.001/region.parquet", spark.read.parquet(
        "/root/testdata/sf0.001/region.parquet").schema)
    assert found and df.count() == 5


def test_align_and_create_if_absent_keeps_rows(spark):
    root = tempfile.mkdtemp(prefix="deskflow-src-", dir="/tmp")
    path = f"{root}/fact_ticket"
    batch = spark.createDataFrame([(1, 2, "extra")], "ticket_id int, client_id int, junk string")
    aligned = files.align(batch, schemas.FACT_TICKET)
    assert aligned.schema == schemas.FACT_TICKET
    files.create_if_absent(spark, path, schemas.FACT_TICKET)
    files.append(batch, path, schemas.FACT_TICKET)
    files.create_if_absent(spark, path, schemas.FACT_TICKET)  # existing table is kept
    back = files.read_table(spark, path, schemas.FACT_TICKET).collect()
    assert [(r.ticket_id, r.client_id, r.status) for r in back] == [(1, 2, None)]


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(shuffle_bytes=100 * 1024 ** 4, executors_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
