"""Warehouse load runs: dimensions and facts in dependency order, with
failures kept to the tables they concern, rejected rows kept, staging, load
report, audit row, table catalog.

Tables are parquet folders under a root in the shared work area (see
``deskflow.session.work_dir``), each reloaded as a new version that is
published when it is whole (see ``deskflow.sources.files``).  Counts in
reports are read back from the written tables, so a report always describes
what was stored.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from deskflow import schemas
from deskflow.functions.util import local_rows
from deskflow.plans import etl
from deskflow.sources import files


@dataclass
class Sources:
    """Inputs of a load run (raw sources and dimension sources).  A raw
    source that is missing (None) is skipped: its table is created empty and
    the rest of the run goes on."""
    dims: dict[str, DataFrame]
    raw_ticket: DataFrame | None
    raw_incident: DataFrame | None
    raw_metrics: DataFrame | None
    raw_support: DataFrame | None
    raw_tech_support: DataFrame | None

    def of(self, table: str) -> DataFrame | None:
        """The source of a table."""
        return getattr(self, RAW_OF[table]) if table in RAW_OF else self.dims[table]

    def first_rows(self, n: int) -> Sources:
        """The same sources with the first ``n`` rows of each fact, by key
        (rows that share it: by the other columns)."""
        def head(raw: DataFrame | None, key: str) -> DataFrame | None:
            return raw if raw is None else raw.orderBy(key, *[c for c in raw.columns if c != key]).limit(n)

        return replace(self, raw_ticket=head(self.raw_ticket, "seq"), raw_incident=head(self.raw_incident, "number"),
                       raw_metrics=head(self.raw_metrics, "seq"))


FACTS = ["fact_ticket", "fact_incident", "fact_metrics"]
STAGING = ["stg_it_support", "stg_tech_support"]
RAW_OF = {"fact_ticket": "raw_ticket", "fact_incident": "raw_incident", "fact_metrics": "raw_metrics",
          "stg_it_support": "raw_support", "stg_tech_support": "raw_tech_support"}
REJECT_SCHEMA = "key long, reject_reason string"
RUN_SCHEMA = "load_order int, table_name string, status string, error string"


@dataclass(frozen=True)
class Load:
    """One table of a load run: ``build`` gives its (accepted, rejected or
    None) rows from the source and the stored tables it depends on."""
    table: str
    key: str
    build: Callable[[DataFrame, dict[str, DataFrame], list], tuple[DataFrame, DataFrame | None]]

    @property
    def parents(self) -> list[str]:
        """Tables that must be loaded first: those its foreign keys name."""
        return sorted({parent for child, _, parent, _ in schemas.FOREIGN_KEYS if child == self.table})


@dataclass(frozen=True)
class Outcome:
    """How the load of a table ended: ``loaded``, ``no source``, ``failed``
    or ``skipped`` (a table it depends on was not loaded)."""
    table: str
    status: str
    error: str | None = None
    accepted: int = 0
    rejected: int = 0


def load_graph(as_of: _dt.datetime = etl.AS_OF) -> list[Load]:
    """Loads of the warehouse, parents first."""
    def dimension(raw, dims, keep):
        return raw, None

    def staging(raw, dims, keep):
        return etl.stage_support(raw, as_of), None

    loads = {name: Load(name, schemas.PRIMARY_KEYS[name], dimension) for name in schemas.DIMENSION_LOAD_ORDER}
    loads["fact_ticket"] = Load("fact_ticket", "ticket_id", lambda raw, dims, keep: etl.load_fact_ticket(raw, dims, as_of, keep=keep))
    loads["fact_incident"] = Load("fact_incident", "incident_id",
                                  lambda raw, dims, keep: etl.load_fact_incident(raw, dims, as_of, keep=keep))
    loads["fact_metrics"] = Load("fact_metrics", "seq", lambda raw, dims, keep: etl.load_fact_metrics(raw, dims["dim_site"], keep=keep))
    loads |= {name: Load(name, "support_id", staging) for name in STAGING}
    order = TopologicalSorter({name: load.parents for name, load in loads.items()})
    return [loads[name] for name in order.static_order()]


def load_dimensions(spark: SparkSession, dims: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Reload each dimension table, parents first; returns the stored tables."""
    stored = {}
    for name in schemas.DIMENSION_LOAD_ORDER:
        files.overwrite(dims[name], f"{root}/{name}", schemas.TABLES[name])
        stored[name] = files.read_table(spark, f"{root}/{name}")
    return stored


def dim_reload(spark: SparkSession, dims: dict[str, DataFrame], root: str, runs: int = 2) -> DataFrame:
    """Reload the dimensions ``runs`` times (a reload replaces, never
    doubles) and report the stored row counts in load order."""
    stored = {}
    for _ in range(runs):
        stored = load_dimensions(spark, dims, root)
    out = None
    for order, name in enumerate(schemas.DIMENSION_LOAD_ORDER, start=1):
        one = stored[name].agg(F.count(F.lit(1)).alias("rows_loaded")).select(
            F.lit(name).alias("table_name"), F.lit(order).alias("load_order"), "rows_loaded")
        out = one if out is None else out.unionByName(one)
    return out


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled in by the write itself."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _cause(ex: Exception) -> str:
    """First line of the innermost cause."""
    java = getattr(ex, "_origin", None) or getattr(ex, "java_exception", None)
    text = None
    while java is not None:
        text, java = java.getMessage() or text, java.getCause()
    return (text or str(ex) or type(ex).__name__).splitlines()[0][:500]


def _load_table(spark: SparkSession, load: Load, raw: DataFrame | None, dims: dict[str, DataFrame], root: str) -> Outcome:
    """Write both sides of a table, then publish them; on a failure neither
    is published."""
    path, rejects = f"{root}/{load.table}", f"{root}/_rejects/{load.table}"
    schema = schemas.TABLES[load.table]
    if raw is None:
        files.overwrite(spark.createDataFrame([], schema), path)
        files.overwrite(spark.createDataFrame([], REJECT_SCHEMA), rejects)
        return Outcome(load.table, "no source")
    # Intermediates that both writes read are persisted and released after.
    keep: list[DataFrame] = []
    try:
        acc, rej = load.build(raw, dims, keep)
        acc, acc_obs = _counted(files.align(acc, schema), f"{load.table}_accepted")
        new = files.stage(acc, path)
        if rej is None:
            bad, refused = files.stage(spark.createDataFrame([], REJECT_SCHEMA), rejects), 0
        else:
            rej, rej_obs = _counted(rej.select(F.col(load.key).cast("long").alias("key"), "reject_reason"), f"{load.table}_rejected")
            bad = files.stage(rej, rejects)
            refused = rej_obs.get["rows"]
    finally:
        for df in keep:
            df.unpersist()
    files.publish(spark, path, new)
    files.publish(spark, rejects, bad)
    return Outcome(load.table, "loaded", None, acc_obs.get["rows"], refused)


def run_load(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime = etl.AS_OF,
             sample: int | None = None, old_parents: bool = False) -> dict[str, int]:
    """``load_outcomes``, as accepted and rejected row counts by table."""
    counts = {}
    for o in load_outcomes(spark, src, root, as_of, sample, old_parents):
        counts[f"{o.table}.accepted"], counts[f"{o.table}.rejected"] = o.accepted, o.rejected
    return counts


def load_outcomes(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime = etl.AS_OF,
                  sample: int | None = None, old_parents: bool = False) -> list[Outcome]:
    """Full reload: dimensions, facts (accepted rows to the table, rejected
    rows with reasons to ``_rejects``), staging, in dependency order.

    A table whose load fails keeps its stored rows, and the other tables go
    on.  Tables that depend on it are skipped, or with ``old_parents`` loaded
    against the rows that it still holds from an earlier run, if any.
    ``sample`` loads the first rows by key of each fact only.  The outcomes
    are returned and stored as table ``_run``; row counts are observed while
    writing (no extra pass)."""
    if sample is not None:
        src = src.first_rows(sample)
    done: dict[str, Outcome] = {}
    for load in load_graph(as_of):
        lost = [p for p in load.parents if done[p].status in ("failed", "skipped")]
        if lost and not (old_parents and all(files.path_exists(spark, f"{root}/{p}/{files.POINTER}") for p in lost)):
            done[load.table] = Outcome(load.table, "skipped", f"{lost[0]} was not loaded")
            continue
        try:
            dims = {p: files.read_table(spark, f"{root}/{p}") for p in load.parents}
            done[load.table] = _load_table(spark, load, src.of(load.table), dims, root)
        except Exception as ex:  # noqa: BLE001 - the failure is the table's outcome
            done[load.table] = Outcome(load.table, "failed", _cause(ex))
    out = list(done.values())
    rows = [(i, o.table, o.status, o.error) for i, o in enumerate(out, start=1)]
    files.overwrite(local_rows(spark, rows, RUN_SCHEMA), f"{root}/_run")
    return out


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def load_report(spark: SparkSession, src: Sources, root: str, sample: int | None = None) -> DataFrame:
    """Per table of the last run: status and error, source rows, stored rows,
    rejected rows, and how many of those are repeated keys.  Every source row
    of a loaded table is stored or rejected (``unaccounted_rows`` is 0).
    Counts of a table that was not loaded are null."""
    if sample is not None:
        src = src.first_rows(sample)
    run = files.read_table(spark, f"{root}/_run")
    out = None
    for row in run.orderBy("load_order").collect():  # one row a table
        name = row["table_name"]
        told = [F.lit(name).alias("table_name"), F.lit(row["status"]).alias("status"), F.lit(row["error"]).cast("string").alias("error")]
        if row["status"] in ("failed", "skipped"):
            none = F.lit(None).cast("long")
            one = local_rows(spark, [(0,)], "zero int").select(*told, *[none.alias(c) for c in REPORT_COUNTS])
        else:
            source = src.of(name)
            given = _count(source, "input_rows") if source is not None else local_rows(spark, [(0,)], "input_rows long")
            stored = _count(files.read_table(spark, f"{root}/{name}"), "accepted_rows")
            bad = files.read_table(spark, f"{root}/_rejects/{name}").agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("reject_reason").endswith("is repeated")).alias("again"))
            one = given.select(*told, "input_rows", stored.scalar().alias("accepted_rows"),
                               bad.select("n").scalar().alias("rejected_rows"), bad.select("again").scalar().alias("duplicate_rows"))
            one = one.withColumn("unaccounted_rows", F.col("input_rows") - F.col("accepted_rows") - F.col("rejected_rows"))
        out = one if out is None else out.unionByName(one)
    return out


REPORT_COUNTS = ["input_rows", "accepted_rows", "rejected_rows", "duplicate_rows", "unaccounted_rows"]


def audit_log(spark: SparkSession, report: DataFrame, root: str, as_of: _dt.datetime = etl.AS_OF) -> DataFrame:
    """Append one audit row for the run (real stored and rejected counts of
    the facts; PARTIAL if a table was not loaded) and return the audit
    table."""
    path = f"{root}/etl_audit_log"
    files.create_if_absent(spark, path, schemas.ETL_AUDIT_LOG)
    last = files.read_table(spark, path, schemas.ETL_AUDIT_LOG).agg(F.coalesce(F.max("audit_id"), F.lit(0)).alias("last"))
    fact = F.col("table_name").isin(FACTS)
    lost = F.count_if(F.col("status").isin("failed", "skipped")) if "status" in report.columns else F.lit(0)
    total = lambda c: F.coalesce(F.sum(F.when(fact, F.col(c))), F.lit(0))
    row = report.agg(total("accepted_rows").alias("acc"), total("rejected_rows").alias("rej"), lost.alias("lost")).select(
        (last.scalar() + 1).cast("long").alias("audit_id"),
        F.lit(f"deskflow_load_{as_of:%Y%m%d_%H%M%S}").alias("process_name"),
        F.col("acc").cast("string").alias("rows_processed"),
        F.when(F.col("lost") > 0, "PARTIAL").otherwise("COMPLETED").alias("status"),
        etl.as_of_lit(as_of).alias("run_timestamp"),
        F.concat(F.lit("rejected="), F.col("rej").cast("string")).alias("notes"))
    files.append(row, path, schemas.ETL_AUDIT_LOG)
    return files.read_table(spark, path, schemas.ETL_AUDIT_LOG)


def schema_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Create every warehouse table that is absent (existing ones are kept)
    and list name, column count, columns and stored rows."""
    out = None
    for name, schema in schemas.TABLES.items():
        path = f"{root}/{name}"
        files.create_if_absent(spark, path, schema)
        one = _count(files.read_table(spark, path), "row_count").select(
            F.lit(name).alias("table_name"), F.lit(len(schema.fields)).alias("column_count"),
            F.lit(",".join(schema.names)).alias("columns"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def append_aligned(spark: SparkSession, batch: DataFrame, root: str, table: str = "fact_ticket") -> DataFrame:
    """Append a narrower batch to a table through its column list (absent
    columns null, extra columns dropped) and read the table back."""
    path = f"{root}/{table}"
    files.create_if_absent(spark, path, schemas.TABLES[table])
    files.append(batch, path, schemas.TABLES[table])
    return files.read_table(spark, path, schemas.TABLES[table])


def save_validation_log(spark: SparkSession, log: DataFrame, root: str) -> DataFrame:
    """Replace the validation log with this run's rows (the log is reset
    before each run) and return the stored table."""
    path = f"{root}/data_validation_log"
    files.overwrite(log, path, schemas.DATA_VALIDATION_LOG)
    return files.read_table(spark, path, schemas.DATA_VALIDATION_LOG)
