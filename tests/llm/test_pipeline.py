"""The pipeline, stage by stage, and registration."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from deskflow.llm.decontaminate import contaminated
from deskflow.llm.queries import QUERIES
from deskflow.llm.simhash import simhash_classes

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_stages_take_effect(spark, docs):
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        if name != "mixing":
            assert after.columns == docs.columns
        if name == "simhash":
            assert simhash_classes(after).where("doc_id <> component_id").count() == 0
        if name == "decontamination":
            assert contaminated(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        if name == "secrets":
            assert after.count() == before.count()
            assert after.where("text rlike '[0-9a-f]{16,}' or n_chars <> length(text)").count() == 0
        if name == "mixing":
            assert after.where("epoch = 0").count() == before.count()
        before = after


def test_good_labelled_documents_survive_the_rules(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    kept = corpus_pipeline.quality(spark, docs, SF).select("doc_id")
    lost = docs.join(labels, "doc_id").join(kept, "doc_id", "left_anti")
    assert lost.where("size(split(trim(text), '\\\\s+')) >= 50").count() == 0


def test_stages_keep_columns_that_clash(spark, docs):
    """The values of the user's columns, whatever they are called."""
    names = ["kept", "n_words", "distance", "base_failed", "base", "spans", "masked", "found", "epoch", "weight", "n_tokens", "mix_block",
             "mix_order", "ka", "kb", "key", "bad_a", "bad_b", "component_id", "fingerprint", "g", "runs", "cls"]
    mine = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        out, plain = stage(spark, mine, SF), stage(spark, docs, SF)
        assert out.columns[:len(mine.columns)] == mine.columns, name
        if name != "mixing":
            assert out.columns == mine.columns
        rows = out.collect()
        assert len(rows) == plain.count() and rows, name
        for row in rows:
            assert all(row[n] == f"{n} of {row['doc_id']}" for n in names), name
    added = [c for c in out.columns if c not in mine.columns]
    assert added == ["_n_tokens", "_weight", "_epoch", "_mix_block", "_mix_order"]


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "epoch", "mix_block"} <= set(out.columns)


def test_pipeline_of_odd_rows(spark, odd, empty, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (odd, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, start, str(tmp_path))
            assert docs.count() <= 2 * start.count()
    by_name = {name: {(r.doc_id, r.text) for r in stage(spark, odd, str(tmp_path)).collect()} for name, stage in corpus_pipeline.STAGES}
    rows = {(r.doc_id, r.text) for r in odd.collect()}
    assert by_name["decontamination"] == by_name["secrets"] == by_name["mixing"] == rows
    assert by_name["quality_rules"] == set()  # too short, or one passage over and over
    # Texts without words are one class, as are the two equal ones.
    assert {i for i, _ in by_name["simhash"]} == {1, 4, 5, 7, None} and len(by_name["simhash"]) == 5
