"""Load runs: failures stay with their table, reloads are all or nothing,
chunks commit with their ids, corrupt CSV records are kept."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from deskflow import schemas
from deskflow.functions.renames import RenameCollision, apply_renames, plan_renames, rename_report
from deskflow.plans import etl, reload
from deskflow.sources import files
from deskflow.streaming import chunks, incremental


def folder(name):
    return tempfile.mkdtemp(prefix=f"deskflow-{name}-", dir="/tmp")


def sources(wh):
    return reload.Sources(wh.dims(), wh.raw_ticket, wh.raw_incident, wh.raw_metrics, wh.raw_support, wh.raw_tech_support)


def broken(df, column="team"):
    return df.withColumn(column, F.when(F.col(df.columns[0]).isNotNull(), F.raise_error(F.lit("planted")).cast("string")))


# ------------------------------------------------------------------- reload
def test_failed_reload_keeps_the_old_rows(spark):
    path = folder("reload") + "/t"
    old = spark.range(10).select("id", F.lit("old").alias("team"))
    files.overwrite(old, path)
    with pytest.raises(Exception, match="planted"):
        files.overwrite(broken(spark.range(0, 1000, 1, 4).select("id", F.lit("x").alias("team"))), path)
    assert files.read_table(spark, path).count() == 10
    files.overwrite(files.read_table(spark, path).where("id < 4"), path)  # may read itself
    assert files.read_table(spark, path).count() == 4
    before = files.table_folder(spark, path)
    files.overwrite(old, path)
    files.overwrite(old.where("id = 1"), path)
    assert files.read_table(spark, path).count() == 1 and files.path_exists(spark, before) is False
    files.append(spark.range(20, 22).select("id", F.lit("z").alias("team")), path, old.schema)
    files.create_if_absent(spark, path, old.schema)
    assert sorted(r.id for r in files.read_table(spark, path).collect()) == [1, 20, 21]


def test_staged_versions_are_not_seen(spark):
    path = folder("reload") + "/t"
    files.overwrite(spark.range(3), path)
    new = files.stage(spark.range(5), path)
    assert files.read_table(spark, path).count() == 3
    files.publish(spark, path, new)
    assert files.read_table(spark, path).count() == 5


# ---------------------------------------------------------------- load runs
def test_graph_loads_parents_first():
    order = [load.table for load in reload.load_graph()]
    assert sorted(order) == sorted(schemas.DIMENSION_LOAD_ORDER + reload.FACTS + reload.STAGING)
    for child, _, parent, _ in schemas.FOREIGN_KEYS:
        assert order.index(parent) < order.index(child)


def test_failures_stay_with_their_table(spark, wh):
    root = folder("load")
    src = sources(wh)
    first = {o.table: o for o in reload.load_outcomes(spark, src, root)}
    assert {o.status for o in first.values()} == {"loaded"}
    for row in reload.load_report(spark, src, root).collect():
        assert row.unaccounted_rows == 0 and row.input_rows == row.accepted_rows + row.rejected_rows

    bad = sources(wh)
    bad.dims["dim_agent"] = broken(bad.dims["dim_agent"])
    bad.raw_ticket = bad.raw_ticket.where("seq < 100")
    out = {o.table: o for o in reload.load_outcomes(spark, bad, root)}
    assert out["dim_agent"].status == "failed" and "planted" in out["dim_agent"].error
    assert (out["fact_ticket"].status, out["fact_ticket"].error) == ("skipped", "dim_agent was not loaded")
    assert out["fact_incident"].status == out["fact_metrics"].status == "loaded"
    report = {r.table_name: r for r in reload.load_report(spark, bad, root).collect()}
    assert report["fact_ticket"].accepted_rows is None and report["fact_ticket"].status == "skipped"
    assert files.read_table(spark, f"{root}/dim_agent").count() == first["dim_agent"].accepted
    assert files.read_table(spark, f"{root}/fact_ticket").count() == first["fact_ticket"].accepted
    log = reload.audit_log(spark, reload.load_report(spark, bad, root), root).collect()
    assert [r.status for r in log] == ["PARTIAL"]

    # Against the agents that are still stored from the first run.
    out = {o.table: o for o in reload.load_outcomes(spark, bad, root, old_parents=True)}
    assert out["dim_agent"].status == "failed" and out["fact_ticket"].status == "loaded"
    assert files.read_table(spark, f"{root}/fact_ticket").count() == bad.raw_ticket.count()


def test_a_fact_that_fails_midway_publishes_neither_side(spark, wh):
    root, src = folder("load"), sources(wh)
    reload.load_outcomes(spark, src, root)
    rows, rejects = (files.read_table(spark, f"{root}/{p}fact_metrics").count() for p in ("", "_rejects/"))
    src.raw_metrics = src.raw_metrics.withColumn("latency_ms", F.when(F.col("seq") == 77, F.raise_error(F.lit("planted")).cast("string"))
                                                 .otherwise(F.col("latency_ms")))
    out = {o.table: o for o in reload.load_outcomes(spark, src, root)}
    assert out["fact_metrics"].status == "failed"
    assert [files.read_table(spark, f"{root}/{p}fact_metrics").count() for p in ("", "_rejects/")] == [rows, rejects]


def test_sample_loads_the_first_rows_by_key(spark, wh):
    root, src = folder("load"), sources(wh)
    out = {o.table: o for o in reload.load_outcomes(spark, src, root, sample=50)}
    for table in reload.FACTS:
        assert out[table].accepted + out[table].rejected == 50
    assert out["stg_it_support"].accepted == wh.raw_support.count()
    first = [r.seq for r in wh.raw_ticket.orderBy("seq").limit(50).collect()]
    assert sorted(r.subject for r in files.read_table(spark, f"{root}/fact_ticket").collect()) == sorted(f"Subject {s}" for s in first)


# ------------------------------------------------------------------ streams
def test_ticket_stream_equals_batch_after_a_replay(spark, wh, monkeypatch):
    base = folder("tickets")
    chunks.land_chunks(wh.raw_ticket, f"{base}/landing", "seq", [100, 700, 701])
    run = lambda: incremental.run_ticket_stream(spark, f"{base}/landing", wh.raw_ticket.schema, wh.dims(), f"{base}/t", f"{base}/c")
    commit, seen = files.replace_small, []

    def fail_once(spark_, path, text):
        seen.append(path)
        if len(seen) == 3:  # the third chunk is written, its mark is not
            raise RuntimeError("lost before the commit")
        commit(spark_, path, text)

    monkeypatch.setattr(files, "replace_small", fail_once)
    with pytest.raises(Exception, match="lost before the commit"):
        run()
    table = incremental.ticket_table(spark, f"{base}/t")
    assert table.mark().chunk == 1 and table.read("accepted").count() == wh.raw_ticket.where("seq < 700").count()
    got = run()
    want, rejected = etl.load_fact_ticket(wh.raw_ticket, wh.dims())
    assert got.exceptAll(files.align(want, schemas.FACT_TICKET)).count() == 0 and got.count() == want.count()
    assert table.read("rejected").count() == rejected.count()
    assert table.mark().next_id == etl.FIRST_TICKET_ID + wh.raw_ticket.count()
    assert run().count() == want.count()  # nothing new


def test_a_chunk_of_many_files_is_one_batch(spark, wh):
    """Chunks are written by as many tasks as they need; ids still follow
    the rows' order, rows of one seq theirs in the source."""
    base, setting = folder("tickets"), "spark.sql.adaptive.coalescePartitions.enabled"
    raw = wh.raw_ticket.withColumn("seq", F.floor(F.col("seq") / 3))
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        chunks.land_chunks(raw, f"{base}/landing", "seq", [100, 300])
    finally:
        spark.conf.set(setting, before)
    assert len(list(Path(f"{base}/landing").rglob("*.parquet"))) > 3
    got = incremental.run_ticket_stream(spark, f"{base}/landing", raw.schema, wh.dims(), f"{base}/t", f"{base}/c")
    want = files.align(etl.load_fact_ticket(raw, wh.dims())[0], schemas.FACT_TICKET)
    assert incremental.ticket_table(spark, f"{base}/t").mark().chunk == 2
    assert got.count() == raw.count() and got.exceptAll(want).count() == 0


def test_a_committed_batch_is_passed_over(spark):
    schema = T.StructType([T.StructField("x", T.LongType())])
    table = chunks.ChunkTable(spark, folder("chunks"), {"accepted": schema}, first_id=5)
    build = lambda mark: ({"accepted": spark.range(mark.next_id, mark.next_id + 3).toDF("x")}, 3)
    assert table.read("accepted").count() == 0
    assert table.commit("s", 0, build) and table.commit("s", 1, build)
    assert not table.commit("s", 1, build) and not table.commit("s", 0, build)
    assert table.commit("other", 0, build)
    assert sorted(r.x for r in table.read("accepted").collect()) == list(range(5, 14))


def test_supplied_ticket_ids_are_keys_across_chunks(spark, wh):
    base = folder("tickets")
    raw = wh.raw_ticket.where("seq < 300").withColumn("ticket_id", F.col("seq") % 120)
    chunks.land_chunks(raw, f"{base}/landing", "seq", [100, 200])
    got = incremental.run_ticket_stream(spark, f"{base}/landing", raw.schema, wh.dims(), f"{base}/t", f"{base}/c")
    n, ids = raw.count(), raw.select("ticket_id").distinct().count()
    rejected = incremental.ticket_table(spark, f"{base}/t").read("rejected")
    assert got.count() + rejected.count() == n and got.select("ticket_id").distinct().count() == got.count() == ids
    assert rejected.where("reject_reason = 'ticket_id is repeated'").count() == n - ids


def test_metric_stream_accounts_for_missing_and_repeated_keys(spark, wh):
    base = folder("metrics")
    raw = wh.raw_metrics.withColumn("seq", F.when(F.col("seq") % 10 == 0, F.lit(None).cast("long")).otherwise(F.col("seq") % 400))
    raw.repartition(3, "asset_id").write.parquet(f"{base}/landing")
    got = incremental.run_incremental(spark, f"{base}/landing", raw.schema, wh.dim_site, f"{base}/t", f"{base}/c")
    rejected = incremental.metric_table(spark, f"{base}/t").read("rejected")
    assert got.count() + rejected.count() == raw.count()
    assert got.select("seq").distinct().count() == got.count() and got.where("seq is null").count() == 0
    why = {r.reject_reason for r in rejected.select("reject_reason").distinct().collect()}
    assert {"seq is missing", "seq is repeated"} <= why


# ---------------------------------------------------------------------- csv
def test_corrupt_records_are_kept(spark):
    path = folder("csv") + "/in"
    lines = ["id,amount,day,note", "1,5,2024-01-02,fine", '2,6,2024-01-03,"a, ""b"""', "3,x,2024-01-03,bad", "4,6", "5,6,2024-01-03,n,more",
             "6,7,nonsense,n", "7,,,", "8,9,2024-01-03,NA"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    schema = T._parse_datatype_string("id long, amount int, day date, note string")
    sound, rejects = files.read_csv_split(spark, path, schema, token_columns=["note"])
    assert sorted((r.id, r.note) for r in sound.collect()) == [(1, "fine"), (2, 'a, "b"'), (7, None), (8, None)]
    assert {r.record: r.reject_reason for r in rejects.collect()} == {
        "3,x,2024-01-03,bad": "amount is not of type int", "4,6": "too few fields", "5,6,2024-01-03,n,more": "too many fields",
        "6,7,nonsense,n": "day is not of type date"}
    assert sound.count() + rejects.count() == len(lines) - 1
    assert sound.select("id").count() == 4  # whatever columns are read


# ------------------------------------------------------------------ renames
def test_rename_plan_sees_collisions_gaps_and_unknown_names(spark):
    steps = plan_renames(["a", "B", "c", "x"], {"A": "x", "b": "y", "c": "y", "gone": "z"}, target=["x", "y"])
    assert [(s.source, s.target, s.status, s.in_target) for s in steps] == [
        ("a", "x", "renamed", True), ("B", "y", "renamed", True), ("c", "y", "collision", True), ("x", "x", "collision", True),
        ("gone", "z", "absent", False)]
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, B int, c int, x int")
    mapping = {"a": "x", "B": "y", "c": "y"}
    with pytest.raises(RenameCollision, match="c would take the name y"):
        apply_renames(df, mapping)
    assert apply_renames(df, mapping, collisions="first").first().asDict() == {"x": 1, "y": 2}
    kept = apply_renames(df, {"a": "id"}, target=["id", "c"], known_only=True)
    assert kept.first().asDict() == {"id": 1, "c": 3}
    rows = {r.source_column: r for r in rename_report("s", df.unionByName(df.withColumn("c", F.lit(None).cast("int"))), mapping, ["x"]).collect()}
    assert (rows["c"].non_null_rows, rows["c"].status, rows["a"].non_null_rows, rows["B"].in_target) == (1, "collision", 2, False)
