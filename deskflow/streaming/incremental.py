"""Incremental loads of metrics and tickets as file streams.

New raw files landing in a folder are picked up by a file-source stream, a
few files per micro-batch; each batch is cleaned and checked like the batch
load, and its accepted and rejected rows are committed together as one chunk
(see ``deskflow.streaming.chunks``), so every delivered row is in exactly one
of them and a batch replayed after a failure adds nothing twice.

Metrics are keyed by ``seq``: a key that an earlier chunk or an earlier row
of the batch holds is a reject, as is a missing one.  Tickets without ids get
dense ones that go on from chunk to chunk, starting at the table's
high-water mark; tickets with ids are keyed by them in the same way.
"""

from __future__ import annotations

import datetime as _dt
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deskflow import schemas
from deskflow.plans import etl
from deskflow.streaming.chunks import ChunkTable, drain, landed

ACCEPTED_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("site_id", T.IntegerType()),
    T.StructField("timestamp_utc", T.TimestampNTZType()),
    T.StructField("cpu_util_pct", T.DecimalType(5, 2)), T.StructField("mem_util_pct", T.DecimalType(5, 2)),
    T.StructField("link_util_pct", T.DecimalType(5, 2)), T.StructField("latency_ms", T.DecimalType(8, 2)),
    T.StructField("packet_loss_pct", T.DecimalType(5, 2)),
])
REJECT_SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("reject_reason", T.StringType())])
TICKET_REJECT_SCHEMA = T.StructType([T.StructField("ticket_id", T.LongType()), T.StructField("reject_reason", T.StringType())])


def land_in_files(raw_metrics: DataFrame, landing: str, files: int) -> None:
    """Write raw metric rows as ``files`` parquet files in key ranges (the
    test stand-in for files arriving over time)."""
    raw_metrics.repartitionByRange(files, "seq").write.mode("overwrite").parquet(landing)


def metric_table(spark: SparkSession, path: str) -> ChunkTable:
    return ChunkTable(spark, path, {"accepted": ACCEPTED_SCHEMA, "rejected": REJECT_SCHEMA})


def ticket_table(spark: SparkSession, path: str) -> ChunkTable:
    parts = {"accepted": schemas.FACT_TICKET, "rejected": TICKET_REJECT_SCHEMA}
    return ChunkTable(spark, path, parts, first_id=etl.FIRST_TICKET_ID)


def held_keys(rows: DataFrame, key: str, stored: DataFrame) -> DataFrame:
    """Keys of ``rows`` that the stored table holds.  Only keys in the rows'
    range can collide; the range filter lets the parquet reader skip files
    and row groups by their statistics."""
    lo, hi = rows.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return stored.select(key).limit(0)
    mine = rows.select(F.col(key).alias("__mine")).distinct()
    near = stored.where(F.col(key).between(lo, hi)).select(key)
    return near.join(mine, F.col(key) == F.col("__mine"), "left_semi")


def _against_table(accepted: DataFrame, rejected: DataFrame, key: str, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move accepted rows whose key the table holds to the rejects."""
    held = held_keys(accepted, key, stored).select(F.col(key).alias("__held"))
    same = F.col(key) == F.col("__held")
    again = accepted.join(held, same, "left_semi").select(key, F.lit(f"{key} is repeated").alias("reject_reason"))
    return accepted.join(held, same, "left_anti"), rejected.select(key, "reject_reason").unionByName(again)


def run_incremental(spark: SparkSession, landing: str, raw_schema: T.StructType, dim_site: DataFrame,
                    target: str, checkpoint: str, files_per_batch: int = 1) -> DataFrame:
    """Drain raw metrics from the landing folder into ``target`` and return
    the accepted rows; ``metric_table(spark, target).read("rejected")`` gives
    the others."""
    table = metric_table(spark, target)

    def load_batch(batch: DataFrame, epoch: int) -> None:
        def build(mark):
            rows = etl.split_metrics(batch, dim_site).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(rows)
            accepted, rejected = etl.accepted_metrics(batch, dim_site, rows), etl.metrics_rejects(batch, dim_site, rows)
            accepted, rejected = _against_table(accepted, rejected, "seq", table.read("accepted"))
            return {"accepted": accepted, "rejected": rejected}, 0

        held: list[DataFrame] = []
        try:
            table.commit(checkpoint, epoch, build)
        finally:
            for df in held:
                df.unpersist()

    drain(spark, landing, raw_schema, checkpoint, load_batch, files_per_batch)
    return table.read("accepted")


def run_ticket_stream(spark: SparkSession, landing: str, raw_schema: T.StructType, dims: dict[str, DataFrame],
                      target: str, checkpoint: str, as_of: _dt.datetime = etl.AS_OF, files_per_batch: int = 1) -> DataFrame:
    """Drain raw tickets from the landing folder into ``target`` and return
    the accepted rows.  Each chunk takes as many ids as it has rows, rejected
    ones too, as the batch load does.  A chunk is a chunk folder, or a few
    files where the landing folder holds files only."""
    table = ticket_table(spark, target)
    supplied = "ticket_id" in etl.rename_ticket_columns_names(raw_schema.names)

    def load_batch(stream: str, batch: DataFrame, epoch: int) -> None:
        def build(mark):
            batch.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(batch)
            accepted, rejected = etl.load_fact_ticket(batch, dims, as_of, keep=held, first_id=mark.next_id)
            if supplied:
                accepted, rejected = _against_table(accepted, rejected, "ticket_id", table.read("accepted"))
            return {"accepted": accepted, "rejected": rejected}, 0 if supplied else batch.count()

        held: list[DataFrame] = []
        try:
            table.commit(stream, epoch, build)
        finally:
            for df in held:
                df.unpersist()

    for folder, progress, some in landed(spark, landing, checkpoint, files_per_batch):
        drain(spark, folder, raw_schema, progress, partial(load_batch, progress), some)
    return table.read("accepted")
